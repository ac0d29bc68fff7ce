"""Pairs of near texts: distances of many pairs at once, heads with many texts, copies."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.functions import distances as N
from tidemill.functions.similarity import indel_ratio, lcs_length, levenshtein, levenshtein_ratio
from tidemill.operators import dedup as D


def changed(rnd, t, share):
    return "".join(c if rnd.random() >= share else rnd.choice(["", "x", "yy"]) for c in t) or "x"


def test_distances_of_many_pairs_equal_those_of_one():
    rnd = random.Random(3)
    for base in (1, 5, 63, 64, 65, 130, 300, 700):
        a = ["".join(rnd.choice("abcdé漢 ") for _ in range(base + rnd.randint(0, 70))) for _ in range(40)]
        b = [changed(rnd, t, rnd.choice([0.0, 0.02, 0.1, 0.3])) if rnd.random() < 0.7 else rnd.choice(a) for t in a]
        for share in (0.0, 0.02, 0.1, 0.22, 1.0):
            most = np.array([int(share * max(len(x), len(y))) for x, y in zip(a, b, strict=True)])
            want = [levenshtein(x, y, int(k)) for x, y, k in zip(a, b, most, strict=True)]
            assert N.distances(a, b, most).tolist() == [-1 if d is None else d for d in want]
            apart = [len(x) + len(y) - 2 * lcs_length(x, y) for x, y in zip(a, b, strict=True)]
            assert N.distances(a, b, most, "indel").tolist() == [d if d <= k else -1 for d, k in zip(apart, most, strict=True)]
        assert (N.gram_bound(N.gram_counts(a), N.gram_counts(b)) <= [levenshtein(x, y) for x, y in zip(a, b, strict=True)]).all()
    many = ["".join(chr(0x4E00 + rnd.randrange(900)) for _ in range(80)) for _ in range(30)]
    assert N.distances(many, many[::-1], np.full(30, 200)) is None
    for metric, plain in (("levenshtein", levenshtein_ratio), ("indel", indel_ratio)):
        for a, b in ((many, many[::-1]), (many, [changed(rnd, t, 0.1) for t in many]), (["abcd " * k for k in range(1, 40)], ["abxd " * k for k in range(1, 40)])):
            for least in (0.0, 70.0, 90.0):
                got = N.ratios(a, b, metric, least)
                assert [None if x != x else x for x in got.tolist()] == [plain(x, y, least) for x, y in zip(a, b, strict=True)]


def prose(rnd, n):
    words = ["th", "on", "er", "re", "an", "ha", "ou", "tion", "ing", "ble", "st", "nd"]
    out = "same head"
    while len(out) < n:
        out += " " + "".join(rnd.choice(words) for _ in range(rnd.randint(1, 4)))
    return out[:n].rstrip().ljust(n, "x")


def test_many_long_pairs_cost_a_fraction_of_one_by_one():
    rnd = random.Random(1)
    a, b = ([prose(rnd, 1400 + i % 30) for i in range(1000)] for _ in range(2))
    began = time.process_time()
    assert all(levenshtein_ratio(x, y, 78.0) is None for x, y in zip(a[:100], b[:100], strict=True))
    one = (time.process_time() - began) / 100
    began = time.process_time()
    assert np.isnan(N.ratios(a, b, "levenshtein", 78.0)).all()
    assert (time.process_time() - began) / 1000 < one / 3


@pytest.mark.parametrize("metric", ["levenshtein", "indel"])
def test_blocks_lose_no_pair(spark, metric, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_ROWS", 5)
    rnd = random.Random(8)
    base = [prose(rnd, rnd.choice([40, 95, 140, 180])) for _ in range(12)]
    rows = [(i, "ABC"[i % 3], changed(rnd, rnd.choice(base), rnd.choice([0.0, 0.02, 0.08, 0.3]))) for i in range(150)]
    df = spark.createDataFrame(rows, "pos long, dataset_id string, t string")
    from tidemill.functions import text as X

    norm = {r.pos: r.n for r in df.select("pos", X.dedup_norm("t").alias("n")).collect()}
    head = {k: tuple(v.split()[:2]) for k, v in norm.items()}
    p, plain = D.Blocking(metric=metric, threshold=80.0), {"levenshtein": levenshtein_ratio, "indel": indel_ratio}[metric]
    for r in D.fuzzy_set(df, F.col("t"), p=p).collect():
        found, seen = [], set()
        for c in range(r.pos):
            a, b = norm[r.pos], norm[c]
            if b not in seen and head[c] == head[r.pos] and abs(len(a) - len(b)) <= p.delta and abs(len(a) // 100 - len(b) // 100) <= 1 and (s := plain(a, b, p.threshold)) is not None:
                found.append((-s, len(b) // 100 - len(a) // 100, c))
            seen.add(b)
        assert (r._fuzzy_score, r._fuzzy_matched_pos) == ((-min(found)[0], min(found)[2]) if found else (None, None))


def test_two_names_are_compared_once_however_many_parts_have_them(spark, tmp_path):
    from tidemill.plans.corpus_queries import indel_ratio as query

    names = ["red bolt", "old bolt", "hot plate", "é漢"]
    rows = [(i, names[i % 4], "B#1" if i % 8 < 4 else "B#2", i % 3) for i in range(240)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_size int").write.parquet(str(tmp_path / "part.parquet"))
    df = query(spark, str(tmp_path))
    assert "ArrowEvalPython" not in df._jdf.queryExecution().executedPlan().toString()
    want = {(a[0], b[0]): round(indel_ratio(a[1], b[1]), 9) for a in rows for b in rows if a[0] < b[0] and a[2:] == b[2:]}
    assert {(r.p_partkey, r.k2): r.ratio for r in df.collect()} == want


def test_truth_aware_rows_of_one_text_share_its_comparison(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_ROWS", 4)
    rnd = random.Random(4)
    base = [prose(rnd, rnd.choice([60, 95, 150])) for _ in range(6)]
    rows = [(i, rnd.choice("ABC"), rnd.choice(["x", "y", None]), changed(rnd, rnd.choice(base), rnd.choice([0.0, 0.03, 0.08]))) for i in range(120)]
    rows = [r if rnd.random() < 0.6 else (*r[:3], rnd.choice(rows)[3]) for r in rows]
    df = spark.createDataFrame(rows, "pos long, dataset_id string, g string, t string")
    from tidemill.functions import text as X

    norm = {r.pos: r.n for r in df.select("pos", X.dedup_norm("t").alias("n")).collect()}
    p = D.Blocking(metric="levenshtein", threshold=90.0)
    want = {}
    for pos, ds, g, _ in rows:
        near = [r for r in rows[:pos] if norm[r[0]].split()[:2] == norm[pos].split()[:2] and abs(len(norm[r[0]]) // 100 - len(norm[pos]) // 100) <= 1 and abs(len(norm[r[0]]) - len(norm[pos])) <= 40 and levenshtein_ratio(norm[pos], norm[r[0]], 90.0) is not None]
        cross, same = any(r[1] != ds for r in near), any(r[1] == ds and (r[2] or "") == (g or "") for r in near)
        want[pos] = "fuzzy_cross_dataset" if cross else "fuzzy_intra_dataset_same_gt" if same else None
    got = D.fuzzy_truth_aware(df, F.col("t"), F.col("g"), p=p)
    assert {r.pos: r._drop_reason for r in got.collect()} == want
    pairs = D.truth_aware_matches(df, F.col("t"), F.col("g"), "dataset_id", "pos", p, [90.0])
    assert pairs.count() == pairs.select("q_pos").distinct().count()


def test_sequential_decisions_need_no_texts(spark):
    rnd = random.Random(6)
    t = prose(rnd, 130)
    rows = [(0, "A", t), (1, "B", t[:-1] + "q"), (2, "A", "same head of quite another text"), (3, "B", t), (4, "C", changed(rnd, t, 0.02))]
    df = spark.createDataFrame(rows, "pos long, dataset_id string, t string")
    x = D.fuzzy_sequential(df, F.col("t"))
    assert "norm" not in x._jdf.queryExecution().optimizedPlan().toString().split("MapInPandas", 1)[1].split("\n", 2)[1]
    assert {r.pos: r._drop_reason is not None for r in x.collect()} == {0: False, 1: True, 2: False, 3: True, 4: True}


def test_last_lanes_of_a_batch_and_long_texts_are_decided_later(monkeypatch):
    monkeypatch.setattr(N, "REST", 2)
    rnd = random.Random(5)
    a = [prose(rnd, rnd.choice([70, 300, 900, 2500])) for _ in range(40)]
    b = [changed(rnd, t, rnd.choice([0.01, 0.05, 0.1])) if i % 4 else rnd.choice(a) for i, t in enumerate(a)]
    some = N.apart(a, b, np.array([int(0.44 * len(t)) for t in a]), whole=False)
    assert (some == -2).any() and (some == -1).any()
    for metric, plain in (("levenshtein", levenshtein_ratio), ("indel", indel_ratio)):
        assert [None if x != x else x for x in N.ratios(a, b, metric, 78.0).tolist()] == [plain(x, y, 78.0) for x, y in zip(a, b, strict=True)]


def test_grams_rule_out_unrelated_texts_of_any_length_and_no_near_ones():
    rnd = random.Random(7)
    a = ["".join(rnd.choice("abcdefghij ") for _ in range(n)) for n in (40, 700, 3000, 9000) for _ in range(6)]
    b = [changed(rnd, t, 0.02) for t in a]
    i, j = (x.ravel() for x in np.indices((24, 24)))
    most = np.array([int(0.1 * max(len(a[x]), len(b[y]))) for x, y in zip(i, j, strict=True)])
    keep = N.apart_by_grams(a, b, i, j, most)
    like = (i // 6 == j // 6) & (i >= 6)
    assert keep[i == j].all() and not keep[like & (i != j)].any()


def test_texts_move_once_where_their_head_is_small(spark, monkeypatch):
    rnd = random.Random(9)
    rows = spark.createDataFrame([(0, i, "h" if i < 60 else f"h{i}", rnd.randint(20, 900)) for i in range(80)], "part int, pos long, head string, len int")
    assert D._places(rows, D.Blocking()).groupBy("pos").count().filter("count > 1").count() == 0
    monkeypatch.setattr(D, "BLOCK_ROWS", 10)
    p = D.Blocking()
    by = {}
    for r in D._places(rows, p).collect():
        by.setdefault(r.pos, {})[r.tile] = r.side
    some = rows.filter("head = 'h'").collect()
    near = [(a.pos, b.pos) for a in some for b in some if a.pos < b.pos and abs(a.len - b.len) <= p.delta and abs(a.len - b.len) <= 0.22 * (a.len + b.len)]
    assert near and all(sum(by[a][t] == 2 or by[a][t] != by[b][t] for t in by[a].keys() & by[b].keys()) == 1 for a, b in near)


def test_few_texts_follow_their_parities(spark):
    rnd = random.Random(2)
    base = [prose(rnd, 400 + i) for i in range(20)]
    rows = [(0, i, t) for i, t in enumerate([*base, base[3][:-1] + "q"])]
    texts = spark.createDataFrame(rows, "part int, pos long, norm string")
    p = D.Blocking(threshold=98.0, metric="levenshtein")
    x = texts.selectExpr("part", "pos", "'h' AS head", "length(norm) AS len")
    tiles = D._dealt(texts.mapInPandas(D._sketched, "part int, pos bigint, len int, sketch binary"), D._places(x, p))
    assert {r.pos for r in tiles.mapInPandas(D._maybe(p), "tile string, side int, part int, pos bigint").collect()} == {3, 20}
    assert [(r.q_pos, r.c_pos) for r in D.near_pairs(x, texts, p).collect()] == [(20, 3)]
