import itertools
import random

import numpy as np
import pandas as pd
import xxhash

from tidemill.llm import simhash
from tidemill.llm.graph import components


def brute_fp(text):
    import re

    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in (text or ""))
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    sh = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(nodes, links):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def brute_classes(rows):
    fp = [brute_fp(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (fp[i] ^ fp[j]).bit_count() <= 4]
    comp = brute_components(range(len(rows)), links)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[comp[i]] = min(d, least.get(comp[i], d))
    return sorted(((d, f"{fp[i]:016x}", least.get(comp[i])) for i, (d, _) in enumerate(rows)), key=str)


def got(df):
    return sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in df.collect()), key=str)


def test_query_equals_brute_force_on_small_table(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got(simhash.op5_simhash_near_dedup(spark, sf)) == brute_classes(rows)


def test_odd_rows_and_clashing_columns(spark):
    rows = [(3, "a b c d e"), (1, "A B C D E"), (None, "a b c d e"), (2, None), (4, ""), (5, " \n\t"), (5, " \n\t"), (6, "x"), (7, "É é"), (8, "wörd " * 70_000), (None, "lonely words here")]
    df = spark.createDataFrame([(a, b, "x", 1) for a, b in rows], "doc_id long, text string, component_id string, __least int")
    assert got(simhash.near_duplicates(df)) == brute_classes(rows)
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 2, 6, 7, 8, None]
    assert simhash.near_duplicates(df.limit(0)).count() == 0 and simhash.drop_near_duplicates(df.limit(0)).count() == 0


def test_links_connect_what_all_pairs_connect(spark):
    rnd = random.Random(5)
    centre = rnd.getrandbits(64)
    fps = {centre}
    for _ in range(700):  # a dense group
        x = centre
        for b in rnd.sample(range(64), rnd.randint(1, 7)):
            x ^= 1 << b
        fps.add(x)
    fps |= {rnd.getrandbits(64) for _ in range(300)}
    for x in list(fps)[:200]:  # chains
        for b in rnd.sample(range(64), 4):
            x ^= 1 << b
        fps.add(x)
    a = np.array(sorted(fps), np.uint64)
    want = brute_components(a.tolist(), [(int(a[i]), int(a[j])) for i in range(len(a)) for j in np.flatnonzero(np.bitwise_count(a[:i] ^ a[i]) <= 4)])
    df = spark.createDataFrame(pd.DataFrame({"fp": a.view(np.int64)}))
    for segments, block in ((simhash.layout(4, 3), 2048), (simhash.layout(4, 2), 64), (simhash.layout(4, 4), 50), (simhash.ring(), 2048), (simhash.ring(), 64)):
        links = simhash.hamming_links(df, 4, segments, block)
        rows = [(r.src % 2**64, r.dst % 2**64) for r in links.collect()]
        assert brute_components(a.tolist(), rows) == want
        assert len(rows) <= 20 * len(a)


def test_components_of_chains_stars_and_nulls(spark):
    rnd = random.Random(1)
    links = [(i, i + 1) for i in range(0, 12)] + [(100, 101 + i) for i in range(200)] + [(rnd.randrange(500, 600), rnd.randrange(500, 600)) for _ in range(60)] + [(1, 1), (0, 1)]
    want = brute_components({x for l in links for x in l if l[0] != l[1]} | {0, 1}, links)
    df = spark.createDataFrame([*links, (None, 4), (7, None)], "src long, dst long")
    assert {r.node: r.root for r in components(df).collect()} == {n: r for n, r in want.items() if any(n in l and l[0] != l[1] for l in links)}
    assert components(df.limit(0)).count() == 0


def test_one_id_of_different_texts_loses_no_class(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in ("alpha", "beta", "gamma"))
    for rows in ([(3, a), (5, a), (5, b)], [(3, a), (5, b), (5, a), (5, c), (5, c)]):
        got = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(1)).collect()
        assert sorted((r.doc_id, r.text) for r in got) == sorted({(3, a)} | {r for r in rows if r[1] != a})


def test_every_layout_finds_every_pattern_of_four_bits():
    """By the number of differing bits in each of the least parts, which is all that a layout sees."""
    for n in (10, simhash.THREE, simhash.FIVE):
        segments = simhash.layout_for(n)
        edges = sorted({x for parts, _ in segments for s, w in parts for x in (s, s + w)} | {0, 64})
        cells = list(zip(edges, edges[1:]))  # noqa: B905
        for bits in itertools.combinations_with_replacement(range(len(cells)), 4):
            near = [sum(any(s <= cells[b][0] and cells[b][1] <= s + w for s, w in parts) for b in bits) <= r for parts, r in segments]
            assert any(near), (n, bits)
