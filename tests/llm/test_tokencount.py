import random

from tidemill.llm import tokencount
from tidemill.llm.tokencount import Counter, Tree


def whole(text):
    return len(Counter.shared().encoding.encode_ordinary(text))


def test_edits_equal_recounts():
    rnd = random.Random(8)
    parts = ["a", "the", " ", "  ", "\n", "'s", "'", "don't", "12", "é", "中", "!!", "\t", " x", "word ", " long-word", "\n\n ", "I'll"]
    text = lambda k: "".join(rnd.choice(parts) for _ in range(rnd.randint(0, k)))
    for _ in range(400):
        tree = Tree(Counter.shared(), t := text(300))
        assert tree.count == whole(t)
        for _ in range(6):
            at, delete, insert = rnd.randint(0, len(t) + 3), rnd.choice([0, 0, 1, 3, 40, 1000]), text(rnd.choice([0, 1, 3, 60]))
            tree.edit(at, delete, insert)
            t = t[:at] + insert + t[at + delete :]
            assert tree.text == t and tree.count == whole(t), (t, at, delete, insert)
            assert sum(x[0] for x in tree.leaves()) == len(t)


def test_an_edit_encodes_few_pretokens():
    tree = Tree(Counter.shared(), "some ordinary words of a long text, " * 5000)
    assert tree.edit(80_000, 4, "other") <= 4 * tokencount.RUN and tree.count == whole(tree.text)


def test_query_equals_whole_text_counts(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in tokencount.op4_token_counts(spark, sf).collect():
        t = docs[r.doc_id]
        assert r.n_tokens == whole(t)
        n = len(t)
        t = t[: n // 3] + " an inserted phrase" + t[n // 3 :]
        t = t[: n // 2] + t[n // 2 + 12 :] + "\nThe end."
        assert r.edited_tokens == whole(t)


def test_odd_rows_known_leaves_and_clashing_columns(spark):
    from pyspark.sql import functions as F

    rows = [(1, None), (2, ""), (None, " a "), (3, "x y"), (3, "x y"), (4, "wörter " * 60_000)]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], "doc_id long, text string, leaves string, t int")
    got = sorted(((r.doc_id, r.n_tokens) for r in tokencount.counts(df).collect()), key=str)
    assert got == sorted(((d, whole(t or "")) for d, t in rows), key=str) and tokencount.counts(df.limit(0)).count() == 0
    held = tokencount.counts(df.filter("doc_id in (2, 4)")).join(df.select("doc_id", "text"), "doc_id")
    edit = F.array(F.struct(F.lit(7).alias("at"), F.lit(2).alias("delete"), F.lit("neu").alias("insert")))
    for r in tokencount.edited(held, edit, leaves=F.col("leaves")).collect():
        assert r.edited_tokens == whole(r.text) and r.n_encoded < 100
