"""Merging of corpora: lenient or strict schemas, hard-coded priority as an explicit rank."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lenient(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns: cast where a cast succeeds, null where it does not or the column is missing; strings take any value."""
    out = []
    for f in schema.fields:
        if f.name not in df.columns:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif df.schema[f.name].dataType == f.dataType:
            out.append(F.col(f.name))
        elif isinstance(f.dataType, T.StringType):
            c = F.col(f.name)
            out.append((F.to_json(c) if isinstance(df.schema[f.name].dataType, T.ArrayType | T.StructType | T.MapType) else c.cast("string")).alias(f.name))
        else:
            out.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
    return df.select(*out)


def schema_problems(df: DataFrame, schema: T.StructType) -> list[str]:
    """Missing, unexpected and differently typed columns."""
    have, want = {f.name: f.dataType for f in df.schema.fields}, {f.name: f.dataType for f in schema.fields}
    return [f"missing {n}" for n in want if n not in have] + [f"unexpected {n}" for n in have if n not in want] + [f"{n}: {have[n].simpleString()} for {t.simpleString()}" for n, t in want.items() if n in have and have[n] != t]


def union_lenient(parts: dict[str, DataFrame], schema: T.StructType) -> DataFrame:
    """Parts in order of name, with `_file_ord`."""
    return reduce(DataFrame.unionByName, [lenient(df, schema).withColumn("_file_ord", F.lit(i)) for i, (_, df) in enumerate(sorted(parts.items()))])


def union_by_priority(parts: list[tuple[str, DataFrame]], schema: T.StructType) -> DataFrame:
    """Parts in the order given, `merge_rank` first in what 'first' means; any schema problem raises."""
    wrong = {n: p for n, df in parts if (p := schema_problems(df, schema))}
    if wrong:
        raise ValueError(f"schemas differ: {wrong}")
    return reduce(DataFrame.unionByName, [df.select(*schema.names).withColumn("merge_rank", F.lit(i)) for i, (_, df) in enumerate(parts)])


def merge_counts(merged: DataFrame, parts: dict[str, DataFrame], dataset: str = "dataset_id") -> DataFrame:
    """(dataset, merged, expected, ok): counts of the merged table against those of its parts."""
    want = reduce(DataFrame.unionByName, [df.groupBy(dataset).agg(F.count(F.lit(1)).alias("expected")) for df in parts.values()]).groupBy(dataset).agg(F.sum("expected").alias("expected"))
    got = merged.groupBy(dataset).agg(F.count(F.lit(1)).alias("merged"))
    x = got.join(want.withColumnRenamed(dataset, "_d"), F.col(dataset).eqNullSafe(F.col("_d")), "full")
    return x.select(F.coalesce(dataset, "_d").alias(dataset), F.coalesce("merged", F.lit(0)).alias("merged"), F.coalesce("expected", F.lit(0)).alias("expected")).withColumn("ok", F.col("merged") == F.col("expected"))


def canonical(df: DataFrame, columns: list[str]) -> DataFrame:
    """These columns in this order; a missing one raises, others are left out."""
    gone = [c for c in columns if c not in df.columns]
    if gone:
        raise ValueError(f"missing columns: {gone}")
    return df.select(*columns)
