"""Drop reasons: the first failing check of a row names it, kept and dropped rows are two views of one tagged table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_reason(checks: list[tuple[Column, Column | str]]) -> Column:
    """The reason of the first check that holds, null if none does."""
    return F.coalesce(*[F.when(c, r if isinstance(r, Column) else F.lit(r)) for c, r in checks], F.lit(None).cast("string"))


def tag(df: DataFrame, reason: Column) -> DataFrame:
    """Adds `_drop_reason` and `_keep`."""
    return df.withColumn("_drop_reason", reason).withColumn("_keep", F.col("_drop_reason").isNull())


def split(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped); together they are the input."""
    return tagged.filter("_keep").drop("_keep", "_drop_reason"), tagged.filter("not _keep").drop("_keep")


def drop_report(tagged: DataFrame) -> DataFrame:
    """(reason, n) of dropped rows; null reasons count as 'unknown'."""
    return tagged.filter("not _keep").groupBy(F.coalesce("_drop_reason", F.lit("unknown")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def kept_by(tagged: DataFrame, *by: str) -> DataFrame:
    """Kept and dropped rows of each group."""
    return tagged.groupBy(*by).agg(F.count_if("_keep").alias("kept"), F.count_if(~F.col("_keep")).alias("dropped"))


def duplicate_pairs(dropped: DataFrame, dataset: str, matched: str, top: int = 50) -> DataFrame:
    """The `top` most frequent (dataset, matched dataset) pairs; ties in order of name."""
    pairs = dropped.groupBy(dataset, matched).agg(F.count(F.lit(1)).alias("n"))
    return pairs.orderBy(F.desc("n"), dataset, matched).limit(top)
