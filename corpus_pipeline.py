"""The corpus pipeline: quality rules, near-duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as Parquet and read again as
the next one's docs. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import packing, pii, quality, simhash
from tidemill.llm.common import rewritten, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy keeps."""
    return quality.keep_clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class."""
    return simhash.drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, personal data and disclosing terms replaced; n_chars is the new length."""
    out = pii.sanitise(docs)
    return out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens."""
    return packing.pack_documents(docs)


STAGES = [("quality rules", quality_rules), ("near-duplicates", near_duplicates), ("personal data", personal_data), ("packing", pack)]

#: SQL expresses neither stage 2 nor the later ones; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES applied to the whole of `documents`."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = rewritten(docs)
    return docs
