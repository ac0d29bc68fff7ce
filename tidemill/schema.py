"""Canonical columns of chat and reward corpora, and positions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MESSAGES = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())]))
SFT_COLUMNS = "_keep _drop_reason dataset_id dataset_version_date example_id row_id source_dataset_id subsource_raw language translation_of_example_id domain reasoning_type license used_by_model context_messages reasoning_text response_text ground_truth_present final_answer_text prompt_text_preview assistant_last_content difficulty category".split()
RL_COLUMNS = "dataset_id dataset_version_date example_id row_id subsource_raw source_dataset_id license used_by_model context_messages language domain ability difficulty verifier_type verifier_source ground_truth_text verification_info_raw avg_reward reward_model_metadata".split()


def _type(name: str) -> T.DataType:
    return MESSAGES if name == "context_messages" else T.BooleanType() if name == "_keep" else T.FloatType() if name == "avg_reward" else T.StringType()


SFT_SCHEMA = T.StructType([T.StructField(c, _type(c)) for c in SFT_COLUMNS])
RL_SCHEMA = T.StructType([T.StructField(c, _type(c)) for c in RL_COLUMNS])


def with_pos(df: DataFrame, by: str | None = None) -> DataFrame:
    """Adds `pos`, what 'first' means: a column of the source, or places in the order of its files (unique and ascending, not dense)."""
    return df.withColumn("pos", F.col(by).cast("bigint") if by else F.monotonically_increasing_id())
