import collections
import zlib

import corpus_pipeline
import numpy as np
from test_pii import brute_disclosed
from test_simhash import brute_classes

from tidemill.llm import packing, pii, quality
from tidemill.llm.wordpieces import WordTokenizer


def brute_kept(text):
    """The current policy by plain Python."""
    from test_quality import brute

    n, chars, symbols, dups, repeats = brute(text)
    t = text or ""
    lines = sum(bool(x.strip(" \t\n\x0b\x0c\r")) for x in t.split("\n"))
    import unicodedata

    upper = sum(unicodedata.category(c) == "Lu" for c in t)
    failed = [n < 50, 100 * repeats > 50 * n, 100 * symbols > 30 * n, 100 * dups > 50 * lines, 100 * upper > 60 * chars, 100 * t.count("!") > 40 * n, chars > 14 * n or chars < 2 * n]
    assert len(failed) == len(quality.CURRENT.rules)
    return not any(failed)


def test_stages_equal_plain_versions(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    kept = corpus_pipeline.quality_rules(spark, docs, sf)
    want = [r for r in docs.collect() if brute_kept(r.text)]
    assert kept.columns == columns and sorted(kept.collect()) == sorted(want)

    one = corpus_pipeline.near_duplicates(spark, kept, sf)
    stay = [d for d, _, c in brute_classes([(r.doc_id, r.text) for r in want]) if d == c]
    want = [r for r in want if r.doc_id in stay]
    assert one.columns == columns and sorted(one.collect()) == sorted(want)

    clean = corpus_pipeline.personal_data(spark, one, sf)
    told = brute_disclosed([r.text for r in want], pii.Disclosure())
    texts = {}
    for r in want:
        ents = set(pii.entities(r.text, pii.base_spans(r.text)))
        texts[r.doc_id] = pii.sanitise_text(r.text, {w: any(told.get((e, w), False) for e in ents) for w in pii.terms(r.text) if any((e, w) in told for e in ents)})
    assert clean.columns == columns and clean.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    rows = clean.collect()
    assert {r.doc_id: r.text for r in rows} == texts and all(r.n_chars == len(r.text) for r in rows)
    assert not any(pii.base_spans(t) for t in texts.values())

    tok, at = WordTokenizer.shared(), collections.Counter()
    for p in sorted(corpus_pipeline.run(spark, sf).collect(), key=lambda p: (p.doc_id, p.start)):
        ids = tok.encode_bytes(texts[p.doc_id]) + np.array([2], "<u4").tobytes()
        assert p.start == at[p.doc_id] and p.ids_crc32 == zlib.crc32(ids[4 * p.start : 4 * (p.start + p.length)])
        at[p.doc_id] += p.length
    assert at == {d: len(tok.encode_bytes(t)) // 4 + 1 for d, t in texts.items()}


def test_stages_take_odd_rows(spark, sf):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "word " * 100_000, "en", "s", 1), (None, " ".join(f"word{i}" for i in range(80)), "en", "s", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for docs in (df, df.limit(0)):
        out = docs
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, out, sf)
        n = out.count()
        assert n >= 1 if docs is df else n == 0
    assert packing.pack_documents(df).count() >= 5
