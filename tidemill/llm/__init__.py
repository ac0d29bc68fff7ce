"""Operations of large training-data pipelines: quality, near-duplicates, privacy, packing, sharding, tokens, HTML, licences."""
