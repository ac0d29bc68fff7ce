"""Shards of nearly equal bytes by Karmarkar-Karp differencing; equal texts stay together.

Groups are dealt by hash into parts of bounded size. Each part differences its own groups: it takes the two
partial partitions with the largest spread, sets the heaviest shard of one against the lightest of the
other, and goes on until one partial partition is left. A part's result is again a partial partition, so parts are
differenced the same way, `fan` at a time, level by level, until one is left for all. What goes up a
level is `shards` sums a part; what comes down is where each part's shards end up.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import cut, table

SHARDS = 24
#: Groups that a task differences, and parts that a task combines.
GROUPS, FAN = 16_384, 512
#: Rows that are numbered in one task of a shard.
NUMBERED = 250_000


def difference(vectors: list[list[int]], shards: int) -> tuple[list[list[int]], list[int]]:
    """Where each vector's entries go, and the sums. A vector is a partial partition: up to `shards` sums, missing ones zero."""
    if not vectors:
        return [], [0] * shards
    heap = []
    tree: list[tuple] = []  # of a node: the two below and, by position, which entry of each it holds
    for i, v in enumerate(vectors):
        full = list(v) + [0] * (shards - len(v))
        order = sorted(range(shards), key=lambda k: (-full[k], k))
        sums = [full[k] for k in order]
        tree.append((None, order))
        heap.append((sums[-1] - sums[0], i, sums))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a, x = heapq.heappop(heap)
        _, b, y = heapq.heappop(heap)
        z = [p + q for p, q in zip(x, reversed(y))]  # noqa: B905
        order = sorted(range(shards), key=z.__getitem__, reverse=True)
        sums = [z[k] for k in order]
        tree.append((a, b, order))
        heapq.heappush(heap, (sums[-1] - sums[0], len(tree) - 1, sums))
    place: dict[int, list[int]] = {len(tree) - 1: list(range(shards))}
    out: list[list[int]] = [[]] * len(vectors)
    for n in range(len(tree) - 1, -1, -1):
        at = place.pop(n)
        node = tree[n]
        if node[0] is None:
            to = [0] * shards
            for position, k in enumerate(node[1]):
                to[k] = at[position]
            out[n] = to[: max(1, len(vectors[n]))]
        else:
            a, b, order = node
            pa, pb = [0] * shards, [0] * shards
            for position, k in enumerate(order):
                pa[k] = at[position]
                pb[shards - 1 - k] = at[position]
            place[a], place[b] = pa, pb
    return out, heap[0][2]


def _differenced(df: DataFrame, by: str, shards: int) -> DataFrame:
    """Of (by, child, sums: array): (by, child, places, total)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("child", kind="stable")
        places, total = difference([[int(x) for x in v] for v in pdf["sums"]], shards)
        return pd.DataFrame({by: pdf[by], "child": pdf["child"], "places": places, "total": [total] * len(pdf)})

    return df.groupBy(by).applyInPandas(run, f"{by} bigint, child string, places array<int>, total array<bigint>")


def assign_groups(groups: DataFrame, shards: int = SHARDS, per_task: int = GROUPS, fan: int = FAN) -> DataFrame:
    """(key, shard) of groups (key string, bytes long)."""
    n = groups.count()
    parts = max(1, -(-n // per_task))
    g = groups.select("key", F.array(F.col("bytes").cast("bigint")).alias("sums"), F.pmod(F.xxhash64("key"), F.lit(parts)).alias("part"))
    low = cut(_differenced(g.select("part", F.col("key").alias("child"), "sums"), "part", shards))
    # (node, sums) of the level at hand; `lower` maps each part's shard to the node's at hand
    nodes = low.groupBy(F.col("part").alias("node")).agg(F.first("total").alias("sums"))
    lower = None
    while parts > 1:
        up = cut(_differenced(nodes.select((F.floor(F.col("node") / fan)).cast("bigint").alias("up"), F.col("node").cast("string").alias("child"), "sums"), "up", shards))
        step = up.select(F.col("child").cast("bigint").alias("child"), "up", "places")
        if lower is None:
            lower = step.select(F.col("child").alias("part"), F.col("up").alias("node"), "places")
        else:
            lower = lower.join(step.select("child", F.col("up").alias("up_"), F.col("places").alias("then")), F.col("node") == F.col("child")).select("part", F.col("up_").alias("node"), F.transform("places", lambda p: F.get("then", p)).alias("places"))
        nodes = up.groupBy(F.col("up").alias("node")).agg(F.first("total").alias("sums"))
        parts = -(-parts // fan)
    at = low.select("part", F.col("child").alias("key"), F.get("places", F.lit(0)).alias("shard"))
    if lower is None:
        return at.select("key", "shard")
    return at.join(lower.select(F.col("part").alias("p_"), "places"), F.col("part") == F.col("p_")).select("key", F.get("places", F.col("shard")).alias("shard"))


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, overhead: int = 8) -> DataFrame:
    """One row for each row of `docs`: id, size, text_crc32, law ('bytes'), shard, slot (gapless from 0 in its shard), grown_shard (null).

    A row's size is its text's UTF-8 bytes (null text: none) plus `overhead`; null and empty texts are
    one group, null ids are carried, repeated rows take a slot each, and other columns are not
    read. A group stays whole: one that is larger than a shard's part has a shard to itself. An empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + overhead).cast("bigint").alias("size"), F.crc32(text).alias("crc"), F.sha2(text, 256).alias("key"))
    rows = cut(rows.withColumn("no", F.monotonically_increasing_id()))  # written with the rows, so it stays
    placed = cut(assign_groups(rows.groupBy("key").agg(F.sum("size").alias("bytes")), shards).withColumnRenamed("key", "k_"))
    x = rows.join(placed, F.col("key") == F.col("k_"))
    # slots: rows of a shard are numbered in blocks by a hash of the id, rows that repeat one over 64 of them, each after what the blocks before it hold
    blocks = max(1, -(-rows.count() // NUMBERED))
    x = x.withColumn("block", F.pmod(F.xxhash64("id", "crc", F.pmod("no", F.lit(64))), F.lit(blocks)))
    counts = x.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select(F.col("shard").alias("s_"), F.col("block").alias("b_"), (F.sum("n").over(Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"))
    x = x.withColumn("nth", F.row_number().over(Window.partitionBy("shard", "block").orderBy("id", "key", "no")))
    x = x.join(before, (F.col("shard") == F.col("s_")) & (F.col("block") == F.col("b_")))
    return x.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), (F.col("before") + F.col("nth") - 1).cast("bigint").alias("slot"), F.lit(None).cast(T.IntegerType()).alias("grown_shard"))


def op7_karmarkar_karp_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: all `documents` in 24 shards of nearly equal bytes."""
    return shard_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op7_karmarkar_karp_sharding": op7_karmarkar_karp_sharding}
ORACLE_SQL: dict[str, str] = {}
