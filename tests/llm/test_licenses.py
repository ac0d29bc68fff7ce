import duckdb

from tidemill.llm import licenses
from tidemill.llm.licence_texts import BOOST, ISC, MIT, TEMPLATES, UNLICENSE, ZLIB


def brute(text, t=licenses.THRESHOLD):
    """Every window that starts and ends at a template's bigram, compared as sets."""
    w = licenses.normalise(text or "").split()
    b = list(zip(w, w[1:]))  # noqa: B905
    out = set()
    for name, texts in TEMPLATES.items():
        for no, template in enumerate(texts):
            v = licenses.normalise(template).split()
            c = set(zip(v, v[1:]))  # noqa: B905
            m, most = len(c), licenses.bounds(len(c), t)[1]
            at = [i for i, g in enumerate(b) if g in c]
            wins = []
            for i in at:
                ends = [(-2 * len(set(b[i : e + 1]) & c) / (e - i + 1 + m), e) for e in at if i <= e < i + most]
                e = min(ends)[1]
                d = 2 * len(set(b[i : e + 1]) & c) / (len(set(b[i : e + 1])) + m)
                if d >= t:
                    wins.append((i, e, d))
            for i, e, d in wins:
                if not any(p <= e and i <= q and (x > d or x == d and p < i) for p, q, x in wins):
                    out.add((i, e - i + 2, name, no, round(d, 6)))
    return out


def got(df):
    return sorted(((r.doc_id, r.start, r.n_words, r.license, r.template, r.dice) for r in df.collect()), key=str)


def test_every_template_is_found_wherever_it_stands(spark):
    texts = [t for x in TEMPLATES.values() for t in x]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(1000 + i, "Some words of it.\n\n" + t.replace("\n", "\n * ") + " more of that in the end " * 9) for i, t in enumerate(texts)]
    rows += [(2000 + i, " ".join(w for k, w in enumerate(t.split()) if k % 11 != 7)) for i, t in enumerate(texts)]
    rows += [(2500, f"{texts[0]}. {texts[0]}, {texts[2]} {texts[1]} " * 3), (2501, "All rights reserved. All rights reserved, all rights."), (2502, "the Software is provided as is " * 40)]
    rows += [(3000, None), (3001, ""), (3002, "\n \n"), (3003, "MIT"), (3003, "MIT"), (None, texts[0]), (3005, texts[0]), (3005, texts[0])]
    df = spark.createDataFrame([(*r, "x", 1, "y", [1]) for r in rows], "doc_id long, text string, w string, n int, license string, h array<int>").repartition(4)
    found = got(licenses.scan(df))
    assert found == sorted(((d, *x) for d, t in rows for x in brute(t)), key=str)
    for base in (0, 1000):
        assert {r[0] for r in found} >= {base + i for i in range(len(texts))}
    assert licenses.scan(df.limit(0)).count() == 0


def test_very_long_texts(spark):
    rows = [(1, "a b of the software is " * 60_000 + "\n" + MIT), (2, (TEMPLATES["MIT"][0] + ".\n") * 3000)]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).groupBy("doc_id", "license").count().collect()
    assert {(r.doc_id, r.license): r["count"] for r in found} == {(1, "MIT"): 1, (2, "MIT"): 6000}


def test_texts_that_hold_no_anchor_cannot_reach_the_threshold():
    rows = licenses.template_rows()
    words = set(licenses.anchors(rows))
    for _, _, b in rows:
        assert sum(words.isdisjoint(g.split()) for g in b) < licenses.bounds(len(b))[0]


def test_query_equals_sql(spark, sf):
    c = duckdb.connect()
    c.execute(f"create view documents as select * from read_parquet('{sf}/documents.parquet')")
    want = sorted(c.execute(licenses.ORACLE_SQL["op1_license_scan"]).fetchall())
    assert sorted((r.doc_id, r.start, r.n_words, r.license, r.template, r.dice) for r in licenses.op1_license_scan(spark, sf).collect()) == want and want


def test_sql_equals_brute_force_on_texts():
    c = duckdb.connect()
    texts = [MIT, "x y " + ISC + " z", UNLICENSE * 2, ZLIB[:400], BOOST.replace("Software", "Work"), "All rights reserved. all rights reserved", None, ""]
    c.execute("create table documents (doc_id bigint, text varchar)")
    c.executemany("insert into documents values (?, ?)", list(enumerate(texts)))
    assert set(c.execute(licenses.ORACLE_SQL["op1_license_scan"]).fetchall()) == {(d, *x) for d, t in enumerate(texts) for x in brute(t)}


def test_notices_inside_lines_and_texts_in_parts(spark):
    parts = MIT.split("\n\n")
    rows = [
        (1, "Some prose here.\nAll rights reserved.\nMore prose of it."),
        (2, "Copyright 2020 X. Licensed under the MIT License. See LICENSE."),
        (3, "all the rights were reserved"),
        (4, "/* MIT\n *\n * " + "\n *\n * ".join(parts) + "\n */\nint main() {}\n" * 30),
        (5, "Words of a page.\n\n" + "\n\n".join(parts).upper() + "\n\nAnd many more words " * 40),
    ]
    found = {(r.doc_id, r.license) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found >= {(1, "proprietary"), (2, "MIT"), (4, "MIT"), (5, "MIT")} and 3 not in {d for d, _ in found}
