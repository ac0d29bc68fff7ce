"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, settled


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole input table, read by Spark from any store it knows."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Uses the cluster's spark.checkpoint.dir; a folder of its own only on one machine, where none is set."""
    checkpoint_dir(spark)


def cut(df: DataFrame) -> DataFrame:
    """Cuts lineage with a reliable checkpoint in the shared folder, so lost executors cost no recomputation of what came before."""
    return settled(df)


def join_hot(big: DataFrame, small: DataFrame, key: str, rows: str, hot: int = 1000, most: int = 100_000) -> DataFrame:
    """The inner join of `big` with `small` on `key`, no task of which gets a frequent key whole.

    `small` has one row a key and in `rows` how many rows of `big` have it; it should be cut from its lineage. Keys with more than
    `hot` rows are broadcast and meet their rows where these lie; the others are shuffled. If there are more than `most` such
    keys, `hot` grows until there are not.
    """
    while (n := small.filter(F.col(rows) > hot).limit(most + 1).count()) > most:
        hot *= 4
    if not n:
        return big.join(small, key)
    frequent = small.filter(F.col(rows) > hot)
    others = big.join(F.broadcast(frequent.select(key)), key, "left_anti").join(small.filter(F.col(rows) <= hot), key)
    return big.join(F.broadcast(frequent), key).unionByName(others)


def bound(expr: Column, body) -> Column:
    """`body` applied to a lambda variable that holds `expr`: evaluated once for a row, however often the body names it."""
    return F.transform(F.array(expr), body)[0]


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def rewritten(df: DataFrame) -> DataFrame:
    """`df` written as Parquet in the shared checkpoint folder and read again."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sealed(df: DataFrame) -> DataFrame:
    """`df` with a row number `__no` that filters put on it later cannot be pushed below: what they test is computed once, by the projections that name it, and not again in the filter."""
    return df.withColumn("__no", F.monotonically_increasing_id()).filter("__no >= 0")
