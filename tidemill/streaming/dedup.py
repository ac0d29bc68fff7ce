"""Deduplication of streams: the first row that arrives wins.

State is keyed by hash, kept by the streaming checkpoint, and bounded by the watermark where one is given.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.query import StreamingQuery

from ..functions import text as X


def distinct_within(df: DataFrame, text: Column, event_time: str, delay: str = "1 hour") -> DataFrame:
    """Rows whose normalised text is new within the watermark's delay; late rows lose."""
    x = df.withColumn("_dedup_hash", X.text_hash(X.dedup_norm(text)))
    return x.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["_dedup_hash"])


def exact_cross_source(df: DataFrame, text: Column, dataset: str, key: str, pos: str | None = None, ttl: str | None = None) -> DataFrame:
    """(key, dataset, owner, _drop_reason): a row goes if another dataset's row with its text came first.

    Rows of an earlier micro-batch came first; in one micro-batch, the row with the least `pos` (by default the key, in its own
    order: numbers as numbers), then the dataset that sorts first. One owner for each hash is held as state, for good or until no row of that hash has come
    for `ttl` ('30 days'); with a ttl the stream runs by processing time, as "available now" waits for the timeouts. The rows of a hash in one micro-batch are read by one task, without their texts.
    """
    kind = df.schema[pos or key].dataType.simpleString()
    x = df.select(X.text_hash(X.dedup_norm(text)).alias("h"), F.col(key).cast("string").alias("key"), X.missing(dataset).alias("dataset"), F.col(pos or key).alias("pos"))
    wait = None if ttl is None else int(pd.Timedelta(ttl).total_seconds() * 1000)

    def run(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        owner = state.get[0] if state.exists else None
        rows = pd.concat(list(frames))
        if owner is None and len(rows):
            owner = rows.sort_values(["pos", "dataset"], kind="stable")["dataset"].iloc[0]
        rows = rows.assign(owner=owner)
        rows["_drop_reason"] = ["exact_hash_cross_dataset" if d != owner else None for d in rows["dataset"]]
        yield rows[["key", "dataset", "owner", "_drop_reason"]]
        if owner is not None:
            state.update((owner,))
            if wait is not None:
                state.setTimeoutDuration(wait)

    if kind not in ("string", "bigint", "int", "double", "timestamp"):
        raise TypeError(f"{pos or key} must have an order that both sides share, not {kind}")
    timeout = GroupStateTimeout.NoTimeout if wait is None else GroupStateTimeout.ProcessingTimeTimeout
    return x.groupBy("h").applyInPandasWithState(run, "key string, dataset string, owner string, _drop_reason string", "owner string", "append", timeout)


def windowed_counts(df: DataFrame, event_time: str, by: str, width: str = "1 hour", delay: str = "2 hours") -> DataFrame:
    """Rows of each window and group; late rows beyond the watermark do not count."""
    return df.withWatermark(event_time, delay).groupBy(F.window(event_time, width), by).agg(F.count(F.lit(1)).alias("n"))


def write_kept_and_dropped(df: DataFrame, kept: str, dropped: str, checkpoint: str, **trigger: object) -> StreamingQuery:
    """Each micro-batch adds to two Parquet tables; the checkpoint resumes after a loss."""

    def batch(part: DataFrame, _: int) -> None:
        part.persist()
        part.filter("_drop_reason is null").write.mode("append").parquet(kept)
        part.filter("_drop_reason is not null").write.mode("append").parquet(dropped)
        part.unpersist()

    return df.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
