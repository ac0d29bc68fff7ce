import collections
import re

from tidemill.llm import quality


def brute(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = collections.Counter(zip(w, w[1:], w[2:]))  # noqa: B905
    covered = {j for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_measures_equal_brute_force(spark, sf):
    x = quality.op9_quality_rules(spark, sf).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(x) == len(texts)
    for r in x:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_odd_rows_and_clashing_columns(spark):
    texts = [None, "", " \n\t", "a b c", "a b c d", "a b c a b c", "x x x x x", "l\nl\n \nl\r\n", "é\x85ü a b   <|>", "α β " * 30_000, "α β " * 30_000]
    df = spark.createDataFrame([(t, i, "r", "w") for i, t in enumerate(texts)], "text string, doc_id int, row string, _w string")
    got = {r.row.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality.measure(df).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}
    assert quality.keep_clean(df).columns == df.columns and quality.keep_clean(df).count() == 0
    assert quality.measure(df.limit(0)).count() == 0


def test_ablation_counts(spark, sf):
    led = quality.ledger(spark.read.parquet(f"{sf}/documents.parquet")).select("failed")
    bits = [r.failed for r in led.collect()]
    for r in quality.ablation(led).collect():
        p, bit = quality.POLICIES[r.policy], quality.BIT[r.rule]
        assert r.n_failed == sum(bool(b & bit) for b in bits)
        assert r.n_only == sum((b & p.mask) == bit for b in bits)
        assert r.n_kept_without == sum(not b & p.mask & ~bit for b in bits)
