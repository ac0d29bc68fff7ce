"""SimHash near-duplicates by multi-index hashing.

Fingerprints that differ in at most `radius` bits agree, within a small radius, on one of a few
segments. Each fingerprint enters one table per segment under its segment value and probes the values in
a small Hamming ball around it; what it meets is verified over all 64 bits. Buckets are compared in
blocks of at most `block` fingerprints, and a block gives a spanning forest of its links, never all pairs
of a group: components lose nothing and rows stay in proportion to fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, join_hot, partitions, table
from .graph import components

RADIUS, WORDS, SEED = 4, 4, 42
#: Fingerprints of one bucket that are compared at a time.
BLOCK = 2048
#: Hot buckets that may be broadcast; beyond, they are joined by a shuffle.
BROADCAST = 50_000
#: Rows that a linking task holds at a time, beside one block pair.
CHUNK = 200_000


def fingerprint(text: str | None, words: int = WORDS, seed: int = SEED) -> int:
    """The signed 64-bit fingerprint of a whole text; no word: 0. Shingles keep repeats; fewer words than a shingle has: the whole sequence."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z only, and the six ASCII white spaces
    if not w:
        return 0
    joined = b" ".join(w)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w))) + np.arange(len(w))
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = max(1, len(w) - words + 1)
    last = ends[min(words, len(w)) - 1 :]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, k, 1 << 16):  # a long text takes no more memory than this many shingles
        h = np.fromiter((digest(joined[s:e], seed) for s, e in zip(starts[i : min(k, i + (1 << 16))].tolist(), last[i : i + (1 << 16)].tolist())), np.uint64)  # noqa: B905
        counts += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > k).view(">i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) for every row: no shuffle, one pass over the texts. Null text counts as empty; null ids stay null."""
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, fp bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t) for t in b.column(1).to_pylist()), np.int64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], ["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")).mapInArrow(run, schema)


#: A segment: the (shift, width) of its parts, low bits first, and the radius of the ball around its value.
Segment = tuple[tuple[tuple[int, int], ...], int]
#: Fingerprints up to which three segments of 21 or 22 bits keep buckets small; up to which five of 25 or 26 bits do.
THREE, FIVE = 1 << 24, 1 << 32


def layout(radius: int, segments: int) -> list[Segment]:
    """Disjoint segments. By the pigeonhole rule with q, a = divmod(radius, segments), a + 1 segments are searched to radius q and the others to q - 1 (not at all if that is negative)."""
    q, a = divmod(radius, segments)
    widths = [64 // segments + (i < 64 % segments) for i in range(segments)]
    out, at = [], 0
    for i, w in enumerate(widths):
        r = q if i <= a else q - 1
        if r >= 0:
            out.append((((at, w),), r))
        at += w
    return out


def ring() -> list[Segment]:
    """Five segments of two fifths of the bits each, neighbours in a ring of the fifths, searched to radius 1.

    They find every pair within 4 bits: were there two differing bits or more in every two neighbouring fifths, these
    five sums, which count each bit twice, would come to 10 at least, and 4 bits make 8.
    """
    widths = [13, 13, 13, 13, 12]
    parts = [(sum(widths[:i]), w) for i, w in enumerate(widths)]
    return [((parts[i], parts[(i + 1) % 5]), 1) for i in range(5)]


def layout_for(n: int, radius: int = RADIUS) -> list[Segment]:
    """Segments of about log2(n) bits, so that a bucket holds a few fingerprints: about 26 entries a fingerprint, 70 beyond THREE, 280 beyond FIVE. Each finds every pair."""
    if n < THREE or radius > 4:
        return layout(radius, 3)
    return ring() if n < FIVE else layout(radius, 2)


def _ball(width: int, radius: int) -> list[int]:
    from itertools import combinations

    return [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(width), r)]


class _Union:
    """Union-find over the fingerprints of one task's chunk."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (p := up.get(x, x)) != x:
            up[x] = up.get(p, p)
            x = p
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def _link_chunk(gid: np.ndarray, member: np.ndarray, fp: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between probes and members of equal gid. Rows come sorted by gid."""
    out: list[tuple[int, int]] = []
    near = _Union()
    cutp = np.flatnonzero(np.diff(gid)) + 1
    starts, ends = np.concatenate(([0], cutp)), np.concatenate((cutp, [len(gid)]))
    members = np.add.reduceat(member.astype(np.int64), starts)
    small = members * (ends - starts - members) <= 1024
    for big in np.flatnonzero(~small):
        f, m = fp[starts[big] : ends[big]], member[starts[big] : ends[big]]
        have, probes = np.unique(f[m]), np.unique(f[~m])
        labels = np.fromiter((near.root(int(x)) for x in have), np.uint64, len(have))
        for i in range(0, len(probes), 256):
            hit = np.bitwise_count(probes[i : i + 256, None] ^ have[None, :]) <= radius
            for row in np.flatnonzero(hit.any(1)):
                p = int(probes[i + row])
                mine = labels[hit[row]]
                first = np.unique(mine, return_index=True)[1]
                at = np.flatnonzero(hit[row])[first]
                merged = [(p, int(have[j])) for j in at if near.join(p, int(have[j]))]
                out += merged
                if len(first) > 1 or merged:
                    labels[np.isin(labels, mine)] = near.root(p)
    keep = np.repeat(small, ends - starts)
    if keep.any():
        g, m, f = gid[keep], member[keep], fp[keep]
        order = np.lexsort((~m, g))  # members first within a group
        g, m, f = g[order], m[order], f[order]
        cutp = np.flatnonzero(np.diff(g)) + 1
        s, e = np.concatenate(([0], cutp)), np.concatenate((cutp, [len(g)]))
        nm = np.add.reduceat(m.astype(np.int64), s)
        np_ = e - s - nm
        size = nm * np_
        for lo in range(0, len(s), 50_000):
            sl = slice(lo, lo + 50_000)
            n = size[sl]
            which = np.repeat(np.arange(len(n)), n)
            k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            a = f[s[sl][which] + k // np.maximum(1, np_[sl][which])]
            b = f[(s[sl] + nm[sl])[which] + k % np.maximum(1, np_[sl][which])]
            ok = (a != b) & (np.bitwise_count(a ^ b) <= radius)
            out += [(x, y) for x, y in zip(a[ok].tolist(), b[ok].tolist()) if near.join(x, y)]  # noqa: B905
    return out


def _entries(i: int, parts: tuple[tuple[int, int], ...], radius: int) -> Column:
    """What a fingerprint puts into table i: itself, and its probes. Of two values the lesser probes for the greater, so a pair meets once."""
    seg, width = F.lit(0).cast("long"), 0
    for shift, w in parts:
        bits = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << w) - 1).cast("long"))
        seg, width = seg.bitwiseOR(F.shiftleft(bits, width)), width + w
    ball = F.array(*[F.lit(x).cast("long") for x in _ball(width, radius)])
    probes = F.filter(F.transform(ball, lambda x: seg.bitwiseXOR(x)), lambda k: k >= seg)
    entry = lambda k, member: F.struct(F.lit(i).alias("seg"), k.alias("key"), F.lit(member).alias("member"))
    return F.concat(F.array(entry(seg, True)), F.transform(probes, lambda k: entry(k, False)))


def hamming_links(fps: DataFrame, radius: int = RADIUS, segments: list[Segment] | None = None, block: int = BLOCK) -> DataFrame:
    """(src, dst) over the distinct longs of column `fp`: links that connect all that all pairs within `radius` bits connect."""
    rows = [_entries(i, *segment) for i, segment in enumerate(segments or layout_for(fps.count(), radius))]
    p = fps.select("fp", F.explode(F.concat(*rows)).alias("x")).select("fp", "x.*")
    # buckets beyond a block are rare: at most entries / block
    hot = p.groupBy("seg", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)
    hot = cut(hot.select(F.col("seg").alias("s_"), F.col("key").alias("k_"), F.ceil(F.col("n") / F.lit(block)).cast("int").alias("nb")))
    few = hot.limit(BROADCAST + 1).count() <= BROADCAST
    met = p.join(F.broadcast(hot) if few else hot, (F.col("seg") == F.col("s_")) & (F.col("key") == F.col("k_")), "left").select("seg", "key", "member", "fp", F.coalesce("nb", F.lit(1)).alias("nb"))
    mine = F.pmod(F.xxhash64("fp"), F.col("nb").cast("long")).cast("int")
    met = met.select("seg", "key", "member", "fp", mine.alias("mine"), F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("other"))
    i, j = F.when(F.col("member"), F.col("other")).otherwise(F.col("mine")), F.when(F.col("member"), F.col("mine")).otherwise(F.col("other"))
    # a group: one block of probes and one of members of a bucket
    met = met.select(F.xxhash64("seg", "key", i, j).alias("gid"), "member", "fp")
    met = met.repartition(partitions(fps.sparkSession), "gid").sortWithinPartitions("gid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        n = 0

        def links(cols) -> pa.RecordBatch:
            got = _link_chunk(*cols, radius) if len(cols[0]) else []
            a = np.array(got, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], ["src", "dst"])

        for b in batches:
            if not b.num_rows:
                continue
            held.append((b.column(0).to_numpy(), b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_numpy().view(np.uint64)))
            n += b.num_rows
            if n >= CHUNK:
                cols = [np.concatenate(x) for x in zip(*held)]  # noqa: B905
                at = int(np.searchsorted(cols[0], cols[0][-1]))
                if at:
                    yield links([c[:at] for c in cols])
                held, n = [tuple(c[at:] for c in cols)], len(cols[0]) - at
        if n:
            yield links([np.concatenate(x) for x in zip(*held)])  # noqa: B905

    return met.mapInArrow(run, "src bigint, dst bigint")


def classes(fps: DataFrame, radius: int = RADIUS, segments: list[Segment] | None = None) -> tuple[DataFrame, DataFrame]:
    """Of (id, fp): the rows themselves, cut from their lineage, and (fp, root, component_id, rows); component_id is the least id of the class, null if it has none, rows those that have the fingerprint."""
    rows = cut(fps)
    distinct = cut(rows.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("rows")))
    roots = components(hamming_links(distinct.select("fp"), radius, segments))
    labelled = cut(distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", "rows", F.coalesce("root", "fp").alias("root")))
    least = cut(labelled.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("fps")))
    return rows, cut(join_hot(labelled.drop("least"), least, "root", "fps").select("fp", "root", "component_id", "rows"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row for each row of `docs`: id, fingerprint (16 hex digits), component_id (least id reachable by links) and kept.

    Texts without a word have fingerprint zero and are linked like any other. Null text counts as
    empty. A row with a null id has a fingerprint and the component's least id, and is not kept. Other columns are not read.
    """
    rows, by_fp = classes(fingerprints(docs, id_col, text_col), radius)
    x = join_hot(rows, by_fp, "fp", "rows")
    return x.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """The rows of `docs`, unchanged, that stand for their class: one of each.

    Ids that stand for a class select rows by a semi-join, repeated ids together with the class's least
    fingerprint that has the id; of rows that repeat both, and of a class whose ids are all null, the row whose content has the
    least hash stays.
    """
    rows, by_fp = classes(fingerprints(docs, id_col, text_col), radius)
    least = by_fp.select(F.col("component_id").alias("__least")).filter("__least is not null").distinct()
    twice = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 and id is not null").select(F.col("id").alias("__twice"))
    out = docs.join(least, docs[id_col] == least["__least"], "left_semi")
    if twice.limit(1).count():
        mark = out.select(F.struct("*").alias("row"), out[id_col].alias("__id"), out[text_col].cast("string").alias("t_")).join(twice, F.col("__id") == twice["__twice"], "left")
        stands = rows.join(twice, F.col("id") == F.col("__twice")).join(by_fp, "fp").filter("id = component_id").groupBy("root").agg(F.min("id").alias("__id"), F.min("fp").alias("fp"))
        again = _with_fingerprint(mark.filter("__twice is not null")).join(stands.select("__id", "fp"), ["__id", "fp"], "left_semi")
        more = again.groupBy("__id", "fp").agg(_one_row()).select("row.*")
        out = mark.filter("__twice is null").select("row.*").unionByName(more)
    if rows.filter("id is null").limit(1).count():
        lone = by_fp.filter("component_id is null").select("fp", "root")
        nulls = docs.filter(docs[id_col].isNull()).select(F.struct("*").alias("row"), F.col(text_col).cast("string").alias("t_"))
        marked = _with_fingerprint(nulls).join(lone, "fp")
        out = out.unionByName(marked.groupBy("root").agg(_one_row()).select("row.*"))
    return out


def _one_row() -> Column:
    """The row whose content has the least hash: the same one whenever it is computed."""
    return F.min_by("row", F.sha2(F.to_json("row"), 256)).alias("row")


def _with_fingerprint(df: DataFrame) -> DataFrame:
    @F.pandas_udf("bigint")
    def fp(t):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.Series([fingerprint(x) for x in t], dtype="int64")

    return df.withColumn("fp", fp("t_"))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: SimHash classes of all `documents`."""
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op5_simhash_near_dedup": op5_simhash_near_dedup}
ORACLE_SQL: dict[str, str] = {}
