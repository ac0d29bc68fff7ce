"""The queries of this subpackage and the SQL they are checked against."""

from __future__ import annotations

from . import embeddings, html, licenses, packing, pieces, pii, quality, sharding, simhash, tokencount

MODULES = [licenses, pieces, embeddings, tokencount, simhash, pii, sharding, html, quality, packing]


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in m.ORACLE_SQL.items()}
