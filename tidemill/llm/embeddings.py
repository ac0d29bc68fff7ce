"""Near-duplicate vectors by a robust-pruned flat graph.

1. Equal vectors become one class, counted by a partial aggregate. Vectors of different lengths never meet.
2. Centroids are fitted on a bounded sample of each length. Classes of a cell are dealt into blocks of bounded size, and in each block
   vectors within half the link angle of a leader form a group: any two of a group are linked, so a
   clump of any size costs no pairs.
3. Leaders go to the shards of their `overlap` nearest centroids; a crowded cell has several shards. Each shard builds a graph by
   robust pruning; a leader's adjacency lists from all its shards are united.
4. Every leader searches the shards of its `probes` nearest centroids, in each greedily from the medoid, and from itself
   where it is a node, and expands from what lies in range until nothing new does. What it finds lies in other shards too: it goes
   on there from these nodes, round after round, until no shard is new, so the search follows the united graph across shards.
5. Recall is audited against brute force for leaders drawn until `evidence` true pairs are met, those with few
   pairs also for themselves, and for planted partners at the edge of the range; the least share counts. Below
   `recall` the probes are doubled, then the beam; if that does not help the job fails.
6. Every pair of groups found is verified in double precision, down to single vectors unless their
   angles alone prove all or none linked.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, join_hot, partitions, table
from .graph import components


@dataclass(frozen=True)
class Index:
    """`sample`: vectors that fit the centroids, in all; `shard`: leaders aimed at in a cell, and half of what a shard holds at most; `block`: vectors grouped in one task; `degree`, `pool`, `slack`: of robust pruning; `beam`, `stride`: nodes that a greedy search holds, and that it opens at a time; `queries`: that one task searches; `audit`: queries drawn at first, and planted partners; `evidence`: true pairs to draw; `most_audit`: queries at most; `lengths`: different lengths of vectors at most."""

    sample: int = 8192
    shard: int = 1000
    most_cells: int = 4096
    block: int = 4096
    overlap: int = 2
    probes: int = 4
    degree: int = 24
    pool: int = 64
    slack: float = 1.2
    beam: int = 24
    stride: int = 4
    queries: int = 8192
    audit: int = 256
    evidence: int = 200
    most_audit: int = 16_384
    recall: float = 0.95
    lengths: int = 1000


EPS = 1e-12


def _vectors(column) -> np.ndarray:  # noqa: ANN001
    return np.stack([np.frombuffer(x, np.float64) for x in column]) if len(column) else np.zeros((0, 1))


def _angle(cos: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cos, -1.0, 1.0))


def normalised(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): unit vectors as bytes of doubles; null for vectors that link with nothing."""
    schema = f"id {vectors.schema[id_col].dataType.simpleString()}, v binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for x in b.column(1).to_pylist():
                v = np.array([np.nan if c is None else c for c in x], np.float64) if x else np.array([np.nan])
                with np.errstate(all="ignore"):
                    v = v / m if (m := np.max(np.abs(v))) > 0 and np.isfinite(m) else v * 0  # no overflow in the norm
                    n = np.sqrt(v @ v)
                out.append((v / n + 0.0).tobytes() if n > 0 and np.isfinite(n) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["id", "v"])

    return vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("x")).mapInArrow(run, schema)


def fit_centroids(sample: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means, seeded by the first k different vectors."""
    c = sample[:k].copy()
    for _ in range(rounds):
        at = np.argmax(sample @ c.T, axis=1)
        total = np.zeros_like(c)
        np.add.at(total, at, sample)
        n = np.linalg.norm(total, axis=1)
        c = np.where(n[:, None] > EPS, total / np.maximum(n, EPS)[:, None], c)
    return c


Centroids = dict[int, np.ndarray]


def fit_cells(classes: DataFrame, p: Index) -> Centroids:
    """Centroids by length, from a sample of each in hash order; the numbers of lengths and vectors are bounded."""
    size = F.octet_length("v")
    counts = {r["size"]: r["n"] for r in classes.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("n")).limit(p.lengths + 1).collect()}
    if len(counts) > p.lengths:
        raise ValueError(f"vectors have more than {p.lengths} different lengths")
    each = max(64, p.sample // max(1, len(counts)))
    order = Window.partitionBy("size").orderBy(F.xxhash64("c"), "c")
    rows = classes.select("c", "v", size.alias("size")).withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= each).orderBy("size", "nth").select("size", "v").collect()
    out = {}
    for n, total in counts.items():
        sample = _vectors([bytes(r["v"]) for r in rows if r["size"] == n])
        out[n] = fit_centroids(sample, max(1, min(p.most_cells, len(sample), -(-total // p.shard))))
    return out


def _nearest(df: DataFrame, centroids: Centroids, n: int, keep: str) -> DataFrame:
    """Adds `cells`, the n nearest centroids of a vector's length, nearest first: the length's bytes times 2^32 plus a number."""
    names = [f.name for f in df.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vs = b.column(names.index("v")).to_pylist()
            sizes = np.array([len(v) for v in vs], np.int64)
            out: list[list[int]] = [[]] * len(vs)
            for size in np.unique(sizes).tolist():
                at, c = np.flatnonzero(sizes == size), centroids[size]
                top = np.argsort(-(_vectors([vs[i] for i in at]) @ c.T), axis=1, kind="stable")[:, : min(n, len(c))]
                for i, cells in zip(at, (top + (size << 32)).tolist()):  # noqa: B905
                    out[i] = cells
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.list_(pa.int64()))], [*names, "cells"])

    return df.mapInArrow(run, f"{keep}, cells array<bigint>")


def group_block(v: np.ndarray, half: float) -> tuple[np.ndarray, np.ndarray]:
    """(leader's row, angle to it) of each row: a leader is the first row that no earlier leader has within `half`."""
    n = len(v)
    leader, far = np.full(n, -1), np.zeros(n)
    bound = np.cos(half)
    lone = np.ones(n, bool)
    for i in range(0, n, 512):
        s = v[i : i + 512] @ v.T
        s[np.arange(len(s)), np.arange(i, i + len(s))] = -1
        lone[i : i + 512] = ~(s >= bound).any(1)
    leader[lone] = np.flatnonzero(lone)
    rest = np.flatnonzero(~lone)
    while len(rest):
        s = v[rest] @ v[rest[0]]
        s[0] = 1.0
        near = s >= bound
        leader[rest[near]] = rest[0]
        far[rest[near]] = _angle(s[near])
        far[rest[0]] = 0
        rest = rest[~near]
    return leader, far


def build_graph(v: np.ndarray, degree: int, pool: int, slack: float) -> np.ndarray:
    """Adjacency (n, degree), -1 where there is none: robust pruning of each node's nearest `pool` nodes, then of what points back."""
    n = len(v)
    x = v.astype(np.float32)
    out = np.full((n, degree), -1, np.int64)
    if n < 2:
        return out

    def prune(node: int, cand: np.ndarray, d: np.ndarray) -> np.ndarray:
        order = np.argsort(d, kind="stable")
        cand, d = cand[order], d[order]
        between = np.sqrt(np.maximum(0, 2 - 2 * (x[cand] @ x[cand].T)))
        alive, chosen = np.ones(len(cand), bool), []
        for i in range(len(cand)):
            if alive[i]:
                chosen.append(cand[i])
                if len(chosen) == degree:
                    break
                alive &= slack * between[i] > d
        return np.array(chosen)

    k = min(pool, n - 1)
    back: list[list[int]] = [[] for _ in range(n)]
    for i in range(0, n, 512):
        s = x[i : i + 512] @ x.T
        s[np.arange(len(s)), np.arange(i, i + len(s))] = -9
        near = np.argpartition(-s, k - 1, axis=1)[:, :k]
        for r in range(len(s)):
            got = prune(i + r, near[r], np.sqrt(np.maximum(0, 2 - 2 * s[r, near[r]])))
            out[i + r, : len(got)] = got
            for j in got:
                back[j].append(i + r)
    for i in range(n):
        more = np.setdiff1d(np.array(back[i], np.int64), out[i])
        free = np.flatnonzero(out[i] < 0)
        if len(more) <= len(free):
            out[i, free[: len(more)]] = more
        elif len(more):
            cand = np.union1d(more, out[i][out[i] >= 0])
            got = prune(i, cand, np.sqrt(np.maximum(0, 2 - 2 * (x[cand] @ x[i]))))
            out[i] = -1
            out[i, : len(got)] = got
    return out


def range_search(v: np.ndarray, adj: np.ndarray, radius: np.ndarray, q: np.ndarray, q_radius: np.ndarray, begin: np.ndarray, theta: float, beam: int, stride: int = 4) -> list[tuple[int, int]]:
    """Pairs (query, node) with an angle of at most theta + the query's radius + the node's.

    Greedy from the medoid and from the nodes `begin` of each query (-1 for none), with a beam whose best `stride` unopened
    nodes are opened at a time; then outwards while in range.
    """
    n = len(v)
    x = np.concatenate([v, np.zeros((1, v.shape[1]))]).astype(np.float32)  # the last stands for no neighbour
    adj = np.where(adj < 0, n, adj)
    medoid = int(np.argmax(v @ v.mean(0)))
    widest = float(radius.max(initial=0.0))
    begin = np.concatenate([np.full((len(q), 1), medoid), np.where(begin < 0, n, begin)], 1)
    beam, stride = max(beam, begin.shape[1]), min(stride, beam)
    out: list[tuple[int, int]] = []
    for lo in range(0, len(q), 256):
        y = q[lo : lo + 256].astype(np.float32)
        m = len(y)
        seen = np.zeros((m, n + 1), bool)
        seen[:, n] = True
        ids, sim, done = np.full((m, beam), n), np.full((m, beam), -9.0, np.float32), np.ones((m, beam), bool)
        live, near = np.arange(m), begin[lo : lo + 256]
        while len(live):
            near = np.sort(near, axis=1)
            fresh = ~seen[live[:, None], near]
            fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
            r, c = np.nonzero(fresh)
            node = near[r, c]
            seen[live[r], node] = True
            s = np.full(near.shape, np.float32(-9))
            s[r, c] = np.einsum("id,id->i", y[live[r]], x[node])
            ids_, sim_, done_ = np.concatenate([ids[live], near], 1), np.concatenate([sim[live], s], 1), np.concatenate([done[live], ~fresh], 1)
            top = np.argpartition(-sim_, beam - 1, axis=1)[:, :beam]
            ids[live], sim[live], done[live] = (np.take_along_axis(a, top, 1) for a in (ids_, sim_, done_))
            score = np.where(done, np.float32(-99), sim)
            live = np.flatnonzero((~done).any(1))
            pick = np.argpartition(-score[live], stride - 1, axis=1)[:, :stride]
            open_ = ~np.take_along_axis(done[live], pick, 1)
            near = np.where(open_[:, :, None], adj[np.take_along_axis(ids[live], pick, 1).clip(max=n - 1)], n).reshape(len(live), stride * adj.shape[1])
            done[live[:, None], pick] = True
        reach = np.cos(np.minimum(np.pi, theta + q_radius[lo : lo + 256] + widest)) - 1e-5
        for i in np.flatnonzero((sim >= reach[:, None]).any(1)):
            hit = ids[i][sim[i] >= reach[i]]
            got, known = hit, np.zeros(n + 1, bool)
            known[[*hit, n]] = True
            while len(hit):
                near = np.unique(adj[hit])
                near = near[~known[near]]
                known[near] = True
                hit = near[x[near] @ y[i] >= reach[i]]
                got = np.concatenate([got, hit])
            a = _angle(v[got] @ q[lo + i])
            out += [(int(lo + i), int(g)) for g in got[a <= theta + q_radius[lo + i] + radius[got] + 1e-9]]
    return out


class Graph:
    """The united graph of leaders (leader long, v, r): in each shard its nodes with their lists."""

    def __init__(self, leaders: DataFrame, centroids: Centroids, p: Index) -> None:
        self.leaders, self.centroids, self.p = leaders, centroids, p
        placed = _nearest(leaders, centroids, p.overlap, "leader bigint, v binary, r double").select("leader", "v", "r", F.explode("cells").alias("cell"))
        placed = cut(placed)
        # a cell that holds more than a shard may is dealt into several; the numbers of cells are bounded by `most_cells` a length
        self.subs = F.broadcast(cut(placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(2 * p.shard)).cast("int").alias("subs"))))
        placed = cut(placed.join(self.subs, "cell").withColumn("sub", F.pmod(F.xxhash64("leader"), F.col("subs")).cast("int")).drop("subs"))

        def build(pdf: pd.DataFrame) -> pd.DataFrame:
            ids = pdf["leader"].to_numpy()
            adj = build_graph(_vectors(pdf["v"]), p.degree, p.pool, p.slack)
            return pd.DataFrame({"leader": ids, "near": [ids[a[a >= 0]].tolist() for a in adj]})

        lists = placed.groupBy("cell", "sub").applyInPandas(build, "leader bigint, near array<bigint>")
        united = lists.groupBy("leader").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
        self.nodes = cut(placed.join(united, "leader"))
        self.places = self.nodes.select("leader", F.col("cell").alias("at_cell"), F.col("sub").alias("at_sub"))

    def _first_probes(self, probes: int) -> DataFrame:
        x = _nearest(self.leaders, self.centroids, probes, "leader bigint, v binary, r double").select(F.col("leader").alias("q"), F.explode("cells").alias("cell"))
        return x.join(self.subs, "cell").select("q", "cell", F.explode(F.sequence(F.lit(0), F.col("subs") - 1)).alias("sub"), F.array().cast("array<bigint>").alias("begin"))

    def _search(self, probes: DataFrame, theta: float, beam: int) -> DataFrame:
        """(q, x, cos) in range, of probes (q, cell, sub, begin)."""
        p = self.p
        parts = cut(probes.groupBy(F.col("cell").alias("c_"), F.col("sub").alias("s_")).agg(F.ceil(F.count(F.lit(1)) / F.lit(p.queries)).cast("int").alias("parts")))
        here = (F.col("cell") == F.col("c_")) & (F.col("sub") == F.col("s_"))
        asked = probes.join(parts, here).drop("c_", "s_").withColumn("part", F.pmod(F.xxhash64("q"), F.col("parts")).cast("int")).drop("parts")
        asked = asked.join(self.leaders.select(F.col("leader").alias("q"), "v", "r"), "q")
        nodes = self.nodes.join(parts, here).drop("c_", "s_").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")

        def search(ask: pd.DataFrame, node: pd.DataFrame) -> pd.DataFrame:
            if not len(ask) or not len(node):
                return pd.DataFrame({"q": np.zeros(0, np.int64), "x": np.zeros(0, np.int64), "cos": np.zeros(0)})
            ids, qs = node["leader"].to_numpy(), ask["q"].to_numpy()
            at = {x: i for i, x in enumerate(ids.tolist())}
            near = [[at[x] for x in xs if x in at] for xs in node["near"]]  # the others lie in other shards, where the search goes on
            adj = np.full((len(ids), max([1, *map(len, near)])), -1)
            for i, xs in enumerate(near):
                adj[i, : len(xs)] = xs
            firsts = [[at[x] for x in (q, *xs) if x in at] for q, xs in zip(qs.tolist(), ask["begin"])]  # noqa: B905
            begin = np.full((len(qs), max([1, *map(len, firsts)])), -1)
            for i, xs in enumerate(firsts):
                begin[i, : len(xs)] = xs
            v, w = _vectors(node["v"]), _vectors(ask["v"])
            found = range_search(v, adj, node["r"].to_numpy(), w, ask["r"].to_numpy(), begin, theta, beam, p.stride)
            i, j = (np.array([f[k] for f in found], np.int64) for k in (0, 1))
            keep = qs[i] != ids[j]
            i, j = i[keep], j[keep]
            return pd.DataFrame({"q": qs[i], "x": ids[j], "cos": np.einsum("id,id->i", w[i], v[j])})

        by = ["cell", "sub", "part"]
        return asked.groupBy(*by).cogroup(nodes.groupBy(*by)).applyInPandas(search, "q bigint, x bigint, cos double")

    def pairs(self, theta: float, probes: int, beam: int) -> DataFrame:
        """(a, b, cos), a < b, of leaders found in range of each other."""
        asked = cut(self._first_probes(probes))
        told = lambda df: df.select(F.col("q").alias("q_"), F.col("cell").alias("c_"), F.col("sub").alias("s_"))
        done, found = told(asked), None
        while True:
            got = cut(self._search(asked, theta, beam))
            found = got if found is None else found.unionByName(got)
            # what was found lies in other shards too: go on there, from these nodes
            further = got.select("q", F.col("x").alias("leader")).join(self.places, "leader").withColumns({"cell": F.col("at_cell") + 0, "sub": F.col("at_sub") + 0}).join(done, (F.col("q") == F.col("q_")) & (F.col("cell") == F.col("c_")) & (F.col("sub") == F.col("s_")), "left_anti")
            asked = cut(further.groupBy("q", "cell", "sub").agg(F.slice(F.array_sort(F.collect_set("leader")), 1, beam).alias("begin")))
            if not asked.limit(1).count():
                break
            done = cut(done.unionByName(told(asked)))
        return cut(found.groupBy(F.least("q", "x").alias("a"), F.greatest("q", "x").alias("b")).agg(F.max("cos").alias("cos")))


def partners(v: np.ndarray, angle: np.ndarray) -> np.ndarray:
    """For each unit vector another one at the given angle, in a direction drawn by a fixed seed; needs two dimensions."""
    u = np.random.default_rng(7).normal(size=v.shape)
    u -= (u * v).sum(1)[:, None] * v
    u /= np.maximum(np.linalg.norm(u, axis=1), EPS)[:, None]
    return np.cos(angle)[:, None] * v + np.sin(angle)[:, None] * u


def _picked(leaders: DataFrame, n: int) -> tuple[list, np.ndarray, np.ndarray]:
    rows = leaders.orderBy(F.xxhash64("leader"), "leader").limit(n).collect()
    return [x["leader"] for x in rows], _vectors([bytes(x["v"]) for x in rows]), np.array([x["r"] for x in rows])


def _audit(leaders: DataFrame, pairs: DataFrame, theta: float, p: Index) -> float | None:
    """The part of the drawn leaders' true pairs that was found, or of those of leaders with at most two, if that is less; None if none was met."""
    kind = leaders.schema["leader"].dataType.simpleString()
    total, n = leaders.count(), p.audit
    while True:
        ids, v, r = _picked(leaders, n)

        def brute(batches: Iterator[pa.RecordBatch], ids: list = ids, v: np.ndarray = v, r: np.ndarray = r) -> Iterator[pa.RecordBatch]:
            for b in batches:
                other, size = b.column(0).to_pylist(), v[0].nbytes if len(v) else 0
                for lo in range(0, b.num_rows, 512):
                    same = [x if len(x) == size else bytes(size) for x in b.column(1).slice(lo, 512).to_pylist()]
                    s, q = _vectors(same) @ v.T, b.column(2).slice(lo, 512).to_numpy()
                    i, j = np.nonzero(s >= np.cos(np.minimum(np.pi, theta + q + r.max()))[:, None])
                    near = _angle(s[i, j]) <= theta + q[i] + r[j] - 1e-9
                    i, j = i[near], j[near]
                    rows = [(ids[y], *sorted((other[lo + x], ids[y]))) for x, y in zip(i, j) if other[lo + x] != ids[y]]  # noqa: B905
                    yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], b.schema.field(0).type) for k in range(3)], ["q", "a", "b"])

        true = cut(leaders.select("leader", "v", "r").mapInArrow(brute, f"q {kind}, a {kind}, b {kind}"))
        if true.count() >= p.evidence or n >= min(total, p.most_audit):
            break
        n = min(4 * n, p.most_audit)
    got = true.join(pairs.select("a", "b", F.lit(1).alias("hit")), ["a", "b"], "left").groupBy("q").agg(F.count(F.lit(1)).alias("n"), F.count("hit").alias("hit"))
    few = F.col("n") <= 2
    x = got.agg(F.sum("n").alias("n"), F.sum("hit").alias("hit"), F.sum(F.when(few, F.col("n"))).alias("n2"), F.sum(F.when(few, F.col("hit"))).alias("hit2")).first()
    parts = [h / m for m, h in ((x["n"], x["hit"]), (x["n2"], x["hit2"])) if m]
    return min(parts, default=None)


def _graph_pairs(groups: DataFrame, centroids: Centroids, theta: float, p: Index) -> tuple[DataFrame, float]:
    """Pairs of leaders in range, and the recall of the audit, which is at least `recall`. Audited are the leaders of the most frequent length; the index is one for all."""
    slim = groups.select("leader", "v", "r")
    usual = groups.groupBy(F.octet_length("v").alias("n")).count().orderBy(F.desc("count"), "n").first()["n"]
    drawn = slim.filter(F.octet_length("v") == usual)
    ids, v, r = _picked(drawn, p.audit)
    planted = partners(v, np.minimum(np.pi, theta + r) - 1e-6) if v.shape[1] > 1 else v
    names = [int(x) for x in pd.util.hash_array(np.array(ids, np.int64)).view(np.int64)]
    spark = groups.sparkSession
    extra = spark.createDataFrame([(a, bytearray(w.tobytes()), 0.0) for a, w in zip(names, planted)], "leader bigint, v binary, r double")  # noqa: B905
    both = spark.createDataFrame([(min(x), max(x)) for x in zip(ids, names)], "a bigint, b bigint")  # noqa: B905
    graph = Graph(cut(slim.unionByName(extra)), centroids, p)
    most, probes, beam = max(map(len, centroids.values())), p.probes, p.beam
    while True:
        found = graph.pairs(theta, probes, beam)
        pairs = found.filter(~F.col("a").isin(names) & ~F.col("b").isin(names))
        seen = both.join(found, ["a", "b"], "left_semi").count() / len(ids)
        told = _audit(drawn, pairs, theta, p)
        recall = min(seen, 1.0 if told is None else told)
        if recall >= p.recall:
            return pairs, recall
        if probes < most:
            probes *= 2
        elif beam < 4 * p.shard:
            beam *= 2
        else:
            raise RuntimeError(f"the index finds {recall:.3f} of the audited pairs, {p.recall} are wanted: raise degree, pool or overlap")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.9, p: Index = Index()) -> DataFrame:
    """One row for each row of `vectors`: id, n_links, component_id (least id reachable by links), kept.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing; vectors of different
    lengths do not link. Rows with null ids count as linked vectors; such a row that links with
    nothing has a null component. Of ids that tie the least stands for its class. Repeated rows give a row each; other columns are not read; an empty
    table gives an empty result. More than `Index.lengths` different lengths raise a ValueError.
    """
    theta = float(np.arccos(cosine))
    rows = cut(normalised(vectors, id_col, vector_col).withColumn("k", F.md5("v")))
    # every class has a number of its own, as ids can be null or repeat
    classes = rows.filter("v is not null").groupBy("k").agg(F.first("v").alias("v"), F.count(F.lit(1)).alias("n"), F.min("id").alias("least")).withColumn("c", F.xxhash64("k", "v"))
    classes = cut(classes.select("c", "k", "v", "n", "least"))
    total = classes.count()
    none = rows.select(F.col("id").alias(id_col), F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    if not total:
        return none
    centroids = fit_cells(classes, p)

    home = _nearest(classes.select("c", "v"), centroids, 1, "c bigint, v binary").select("c", "v", F.get("cells", F.lit(0)).alias("cell"))
    home = cut(home)
    blocks = home.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(p.block)).cast("bigint").alias("nb"))
    dealt = home.join(F.broadcast(blocks), "cell").withColumn("block", F.pmod(F.xxhash64("c"), F.col("nb")))

    def lead(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("c")
        ids = pdf["c"].to_numpy()
        leader, far = group_block(_vectors(pdf["v"]), theta / 2 - 1e-9)
        return pd.DataFrame({"c": ids, "leader": ids[leader], "far": far})

    members = dealt.groupBy("cell", "block").applyInPandas(lead, "c bigint, leader bigint, far double").join(classes, "c")
    members = cut(members.select("c", "k", "v", "n", "least", "leader", "far"))
    groups = members.groupBy("leader").agg(F.max("far").alias("r"), F.sum("n").alias("size"), F.min("least").alias("least"))
    groups = cut(groups.join(members.filter("c = leader").select("leader", "v"), "leader"))

    pairs, _ = _graph_pairs(groups, centroids, theta, p)

    side = groups.select("leader", "r", "size")
    x = pairs.join(side.select(F.col("leader").alias("a"), F.col("r").alias("ra"), F.col("size").alias("na")), "a").join(side.select(F.col("leader").alias("b"), F.col("r").alias("rb"), F.col("size").alias("nb")), "b")
    x = x.withColumn("angle", F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), "cos"))))
    sure = (F.col("angle") + F.col("ra") + F.col("rb") <= theta - 1e-9) | ((F.col("ra") + F.col("rb") == 0) & (F.col("cos") >= cosine))
    x = cut(x.filter(F.col("ra") + F.col("rb") > 0).unionByName(x.filter((F.col("ra") + F.col("rb") == 0) & (F.col("cos") >= cosine))).withColumn("sure", sure))
    both = lambda df: df.select(F.col("a").alias("one"), F.col("nb").alias("n")).unionByName(df.select(F.col("b").alias("one"), F.col("na").alias("n")))
    whole = both(x.filter("sure")).groupBy("one").agg(F.sum("n").alias("whole"))
    checked = _count_open(x.filter("not sure").select("a", "b"), members, side, cosine)
    single = checked.groupBy("c").agg(F.sum("n").alias("single"))
    links = x.filter("sure").select(F.col("a").alias("src"), F.col("b").alias("dst")).unionByName(checked.select(F.col("one").alias("src"), F.col("other").alias("dst")).distinct())
    roots = components(links)
    labelled = cut(groups.select("leader", "size", "least").join(roots, F.col("leader") == F.col("node"), "left").select("leader", "size", "least", F.coalesce("root", "leader").alias("root")))
    least = cut(labelled.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("rows")))
    classes_in = members.groupBy("leader").agg(F.count(F.lit(1)).alias("rows"))
    by_group = join_hot(labelled, least, "root", "rows").drop("rows").join(whole, F.col("leader") == F.col("one"), "left").join(classes_in, "leader")
    by_group = cut(by_group.select("leader", (F.col("size") - 1 + F.coalesce("whole", F.lit(0))).alias("links"), "component_id", "rows"))
    by_class = join_hot(members.select("k", "c", "n", "leader"), by_group, "leader", "rows").drop("rows").join(single, "c", "left")
    by_class = cut(by_class.select("k", (F.col("links") + F.coalesce("single", F.lit(0))).cast("bigint").alias("links"), "component_id", F.col("n").alias("rows")))
    out = join_hot(rows.filter("v is not null").select("id", "k"), by_class, "k", "rows").select(F.col("id").alias(id_col), F.col("links").alias("n_links"), "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
    lone = rows.filter("v is null").select(F.col("id").alias(id_col), F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    return out.unionByName(lone)


#: Vectors of a group that meet those of another at a time.
CHUNK = 256


def _count_open(open_: DataFrame, members: DataFrame, side: DataFrame, cosine: float) -> DataFrame:
    """(c, one, other, n): of each class c of group `one` the vectors of group `other` that it links with, for pairs (a, b) of groups whose angles do not tell. Chunks of both meet once, so a vector moves with one row in 256 of what it is compared with."""
    parts = F.pmod(F.xxhash64("c"), F.ceil(F.col("size") / CHUNK)).alias("part")
    chunk = members.join(side.select("leader", "size"), "leader").groupBy("leader", parts).agg(F.collect_list(F.struct("c", "n", "v")).alias("them"))
    chunk = cut(chunk.join(open_.select(F.col("a").alias("leader")).unionByName(open_.select(F.col("b").alias("leader"))).distinct(), "leader", "left_semi"))
    named = lambda n: chunk.select(F.col("leader").alias(n), F.col("them").alias(f"{n}_them"))
    met = open_.join(named("a"), "a").join(named("b"), "b").select("a", "b", *[F.col(f"{n}_them.{f}").alias(f"{n}{f}") for n in "ab" for f in "cnv"])
    met = met.repartition(partitions(open_.sparkSession), F.xxhash64("ac"), F.xxhash64("bc"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                a, b, ac, an, av, bc, bn, bv = (batch.column(i)[row].as_py() for i in range(8))
                near = _vectors(av) @ _vectors(bv).T >= cosine
                left, right = near @ np.array(bn), np.array(an) @ near
                cols = [np.array(ac + bc), np.array([a] * len(ac) + [b] * len(bc)), np.array([b] * len(ac) + [a] * len(bc)), np.concatenate([left, right])]
                keep = cols[3] > 0
                yield pa.RecordBatch.from_arrays([pa.array(c[keep], pa.int64()) for c in cols], ["c", "one", "other", "n"])

    return cut(met.mapInArrow(count, "c bigint, one bigint, other bigint, n bigint"))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: near-duplicates of all `embeddings` at a cosine of 0.9."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))


QUERIES = {"op3_embedding_near_dedup": op3_embedding_near_dedup}
ORACLE_SQL: dict[str, str] = {}
