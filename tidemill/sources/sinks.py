"""Sinks: Spark's commit protocol makes each write whole or absent; reports are small aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.reasons import split


def write_split(tagged: DataFrame, kept_path: str, dropped_path: str) -> list[str]:
    """Kept and dropped rows as Parquet (snappy); a part without rows is not written. The paths written."""
    done = []
    for part, path in zip(split(tagged), (kept_path, dropped_path), strict=True):
        if not part.isEmpty():
            part.write.mode("overwrite").option("compression", "snappy").parquet(path)
            done.append(path)
    return done


def write_head(df: DataFrame, path: str, order: str, n: int = 200) -> None:
    """The first n rows as JSON lines: a look at the data."""
    df.orderBy(order).limit(n).coalesce(1).write.mode("overwrite").json(path)


def write_predictions(df: DataFrame, path: str) -> None:
    """CSV of example_id, predicted_domain, confidence (four places), subsource_raw."""
    x = df.select("example_id", "predicted_domain", F.format_string("%.4f", F.col("confidence")).alias("confidence"), "subsource_raw")
    x.write.mode("overwrite").option("header", True).csv(path)


def read_predictions(spark, path: str) -> DataFrame:  # noqa: ANN001
    return spark.read.option("header", True).schema("example_id string, predicted_domain string, confidence double, subsource_raw string").csv(path)


def write_json_report(report: DataFrame, path: str) -> None:
    """A report's few rows as JSON lines in one file, where the rest of the output lies."""
    report.coalesce(1).write.mode("overwrite").json(path)


def markdown(report: DataFrame, title: str, most: int = 1000) -> str:
    """A report's rows as a Markdown table; one that has more than `most` says so in its last line."""
    rows = report.limit(most + 1).collect()
    cell = lambda v: str(v).replace("|", "\\|").replace("\n", " ")
    head = [f"# {title}", "", "| " + " | ".join(report.columns) + " |", "|" + "---|" * len(report.columns)]
    more = ["", f"The first {most} rows; the report has more."] if len(rows) > most else []
    return "\n".join(head + ["| " + " | ".join(map(cell, r)) + " |" for r in rows[:most]] + more) + "\n"
