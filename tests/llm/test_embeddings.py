import numpy as np
import pytest

from tidemill.llm import embeddings


def brute(rows, cosine=0.9):
    """(id, n_links, component) with sizes counted from all pairs."""
    unit = []
    for _, v in rows:
        a = np.array([np.nan if c is None else c for c in v], float) if v else np.array([np.nan])
        n = np.linalg.norm(a)
        unit.append(a / n if np.isfinite(n) and n > 0 else None)
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    links = [0] * len(rows)
    for i, a in enumerate(unit):
        for j in range(i):
            if a is not None and unit[j] is not None and len(a) == len(unit[j]) and a @ unit[j] >= cosine:
                links[i] += 1
                links[j] += 1
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, links[i], least.get(root(i))) for i, (d, _) in enumerate(rows)), key=str)


def got(df):
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert got(embeddings.op3_embedding_near_dedup(spark, sf)) == brute(rows)


def test_clumps_chains_copies_and_odd_vectors(spark):
    rnd = np.random.default_rng(3)
    centre = rnd.normal(size=(6, 12))
    rows = [centre[i % 6] + rnd.normal(size=12) * s for i, s in enumerate(rnd.choice([0.02, 0.3, 0.6], 240))]
    rows += [centre[0]] * 5 + [7 * centre[0]] + list(rnd.normal(size=(60, 12)))
    rows = [(i if i % 17 else None, v.tolist()) for i, v in enumerate(rows)]
    rows += [(900, None), (901, [0.0] * 12), (902, [float("nan")] * 12), (903, [float("inf")] + [1.0] * 11), (904, [1.0]), (904, [3.0]), (910, [1.0, 2.0]), (911, [1.0, 2.1]), (912, [-1.0, 2.0]), (905, []), (906, [None] + [1.0] * 11), (907, [1e200] * 12), (908, [1e-200] * 12)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, c int, leader string")
    want = brute([(d, [x / 1e200 for x in v] if v and v[0] == 1e200 else [x * 1e200 for x in v] if v and v[0] == 1e-200 else v) for d, v in rows])
    for p in (embeddings.Index(), embeddings.Index(shard=40, block=16, overlap=3, queries=50)):
        assert got(embeddings.near_duplicates(df, p=p)) == want
    assert embeddings.near_duplicates(df.limit(0)).count() == 0
    assert got(embeddings.near_duplicates(df.filter("vec_id in (900, 901)"))) == [(900, 0, 900), (901, 0, 901)]


def test_range_search_finds_what_is_in_range():
    rnd = np.random.default_rng(1)
    v = rnd.normal(size=(1500, 16))
    v[700:900] = v[:200] + 0.1 * rnd.normal(size=(200, 16))
    v /= np.linalg.norm(v, axis=1)[:, None]
    theta = float(np.arccos(0.9))
    none = np.full((len(v), 1), -1)
    found = {(a, b) for a, b in embeddings.range_search(v, embeddings.build_graph(v, 24, 64, 1.2), np.zeros(len(v)), v, np.zeros(len(v)), none, theta, 24) if a != b}
    s = v @ v.T
    true = {(int(a), int(b)) for a, b in np.argwhere(s >= 0.9) if a != b}
    assert found <= true and len(found) >= 0.95 * len(true) > 0


def test_sparse_links_among_many_cells_are_found(spark):
    rnd = np.random.default_rng(5)
    v = rnd.normal(size=(6000, 64))
    v /= np.linalg.norm(v, axis=1)[:, None]
    u = rnd.normal(size=(15, 64))
    u -= (u * v[:15]).sum(1)[:, None] * v[:15]
    v = np.concatenate([v, 0.9001 * v[:15] + np.sqrt(1 - 0.9001**2) * u / np.linalg.norm(u, axis=1)[:, None]])
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    links = {r.vec_id: r.n_links for r in embeddings.near_duplicates(df, p=embeddings.Index(shard=60)).collect()}
    s = v @ v.T
    want = (s >= 0.9).sum(1) - 1
    assert want.sum() == 30 and sum(links[i] != n for i, n in enumerate(want)) <= 2


def test_no_true_pair_is_no_evidence(spark):
    v = np.eye(40)
    df = spark.createDataFrame([(i, bytearray(x.tobytes()), 0.0) for i, x in enumerate(v)], "leader long, v binary, r double")
    pairs = spark.createDataFrame([], "a long, b long, cos double")
    assert embeddings._audit(df, pairs, 0.4, embeddings.Index()) is None


def test_loose_blobs_equal_brute_force(spark):
    rnd = np.random.default_rng(11)
    centre = rnd.normal(size=(150, 24))
    v = centre[rnd.integers(0, 150, 6000)] + 0.35 * rnd.normal(size=(6000, 24))
    v /= np.linalg.norm(v, axis=1)[:, None]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    links = {r.vec_id: r.n_links for r in embeddings.near_duplicates(df, p=embeddings.Index(shard=300, recall=0.98)).collect()}
    want = (v @ v.T >= 0.9).sum(1) - 1
    got = np.array([links[i] for i in range(len(v))])
    assert (got <= want).all() and got.sum() >= 0.98 * want.sum() > 5000


def test_a_search_goes_on_in_other_shards(spark):
    """Nodes of one chain lie in shards that the queries do not probe at first."""
    angles = np.linspace(0, 3.0, 400)
    v = np.stack([np.cos(angles), np.sin(angles)], 1)
    rows = [(i, bytearray(x.tobytes()), 0.0) for i, x in enumerate(v)]
    leaders = spark.createDataFrame(rows, "leader long, v binary, r double")
    centroids = {16: v[[50, 150, 250, 350]]}
    graph = embeddings.Graph(leaders, centroids, embeddings.Index(shard=1000, overlap=2))
    theta = 0.5
    got = {(r.a, r.b) for r in graph.pairs(theta, 1, 24).collect()}
    s = np.abs(angles[:, None] - angles[None, :]) <= theta
    assert got == {(int(a), int(b)) for a, b in np.argwhere(s) if a < b}


def test_too_many_lengths_are_refused(spark):
    df = spark.createDataFrame([(i, [1.0] * (i + 1)) for i in range(5)], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="lengths"):
        embeddings.near_duplicates(df, p=embeddings.Index(lengths=4))
