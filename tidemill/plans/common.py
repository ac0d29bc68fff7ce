"""Tables of the queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id and m, the turns in order."""
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    x = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(turns.alias("t"))
    return x.select("conv_id", F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content"))).alias("m"))
