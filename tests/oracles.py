"""Runs queries beside their SQL and compares rows."""

import math
import sys


def compare(spark, name, query, sql, sf_dir):
    import duckdb

    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        c.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    df = query(spark, sf_dir)
    cols = sorted(df.columns)
    got = [tuple(r[k] for k in cols) for r in df.select(*cols).collect()]
    rel = c.execute(sql)
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols, (name, sorted(names), cols)
    want = [tuple(r[names.index(k)] for k in cols) for r in rel.fetchall()]
    key = lambda r: tuple((x is None, str(round(x, 9)) if isinstance(x, float) and math.isfinite(x) else str(x)) for x in r)
    got, want = sorted(map(key, got)), sorted(map(key, want))
    bad = [(a, b) for a, b in zip(got, want) if a != b][:3]
    assert len(got) == len(want) and not bad, (name, len(got), len(want), bad)
    return len(got)


if __name__ == "__main__":
    import time

    sys.path.insert(0, ".")
    import __spark_entry__ as e
    from tidemill.session import build_session

    spark = build_session("oracles", "local[8]", spark__sql__shuffle__partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    qs, sql = e.queries(), e.oracle_sql()
    for n in sys.argv[2:] or [q for q in qs if not q.startswith("op") and q != "pipeline"]:
        t = time.time()
        try:
            k = compare(spark, n, qs[n], sql[n], sys.argv[1]) if n in sql else qs[n](spark, sys.argv[1]).count()
            print("ok " if n in sql else "run", n, k, round(time.time() - t, 1), flush=True)
        except Exception as x:  # noqa: BLE001
            print("BAD", n, str(x)[:600], flush=True)
