"""Seeded samples by hash order: the same rows on any cluster and partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def seeded(key: str, seed: int = 42) -> Column:
    """A text that orders rows at random: the same on any engine that knows MD5."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(key).cast("string"), F.lit(""))))


def capped_tagged(df: DataFrame, by: list[str], key: str, cap: int, seed: int = 42, reason: str = "subset_cap_downsample") -> DataFrame:
    """At most `cap` rows of each group stay, the others get a reason; a cap of 0 or less keeps all.

    The bound is a group's cap-th least hash. Rows are counted by the first four digits of their hashes, so at most 65,536 counts a group tell in
    which of these parts the bound lies; only that part's rows are ranked.
    """
    if cap <= 0:
        return df.withColumn("_drop_reason", F.lit(None).cast("string")).withColumn("_keep", F.lit(True))
    x = df.withColumn("_h", seeded(key, seed)).withColumn("_part", F.substring("_h", 1, 4))
    same = lambda n: [F.col(b).eqNullSafe(F.col(f"{n}{i}")) for i, b in enumerate(by)]
    names = lambda n: [F.col(b).alias(f"{n}{i}") for i, b in enumerate(by)]
    counts = x.groupBy(*by, "_part").agg(F.count(F.lit(1)).alias("_c"))
    upto = counts.withColumn("_upto", F.sum("_c").over(Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)))
    cut = upto.filter((F.col("_upto") >= cap) & (F.col("_upto") - F.col("_c") < cap)).select(*names("_a"), F.col("_part").alias("_at"), (F.lit(cap) - F.col("_upto") + F.col("_c")).alias("_left"))
    ranked = x.select(*by, "_h", key, "_part").join(cut, [*same("_a"), F.col("_part") == F.col("_at")]).withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy("_h", key)))
    edge = ranked.filter("_n = _left").select(*names("_b"), F.struct("_h", key).alias("_edge"))
    y = x.join(edge, same("_b"), "left")
    over = F.coalesce(F.struct("_h", key) > F.col("_edge"), F.lit(False))
    return y.withColumn("_drop_reason", F.when(over, reason)).withColumn("_keep", ~over).drop("_h", "_part", "_edge", *[f"_b{i}" for i in range(len(by))])


def capped(df: DataFrame, by: list[str], key: str, cap: int, seed: int = 42) -> DataFrame:
    """At most `cap` rows of each group: the stratified reservoir."""
    return capped_tagged(df, by, key, cap, seed).filter("_keep").drop("_keep", "_drop_reason")


def uniform(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows of the table, in hash order (a top-n: each task keeps n)."""
    return df.orderBy(seeded(key, seed), key).limit(n)


def ordered_sample(df: DataFrame, key: str, pos: str, n: int, seed: int = 42) -> DataFrame:
    """A uniform sample in the table's own order."""
    return uniform(df, key, n, seed).orderBy(pos)
