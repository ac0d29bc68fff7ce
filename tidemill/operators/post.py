"""Post-processing: consistency fixes, domain backfill, chains of named steps."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from .reasons import first_reason

# Sub-sources whose domain is known.
SUBSOURCE_DOMAIN = {
    "saumyamalik/correct-python-sft-187k-x16-thoughts-filtered-decontam-v2": "code",
    "saumyamalik/OpenThoughts3-full-filtered-code-subsampled-decontam-v2": "code",
    "saumyamalik/OpenThoughts3-full-filtered-science-decontam-v2": "science",
    "saumyamalik/OpenThoughts3-full-filtered-math-decontam-v2": "math",
    "saumyamalik/if_qwq_reasoning_verified_filtered_decontam_v2": "reasoning",
}


def as_flag(c: Column) -> Column:
    """yes, no, unknown, true and false, and booleans, as a boolean; unknown as null."""
    t = F.lower(c.cast("string"))
    return F.when(t.isin("yes", "true"), True).when(t.isin("no", "false"), False)


def fix_ground_truth(df: DataFrame, flag: str = "ground_truth_present", answer: str = "final_answer_text") -> DataFrame:
    """A truth that is said to be there and is not."""
    f = as_flag(F.col(flag))
    return df.withColumn(flag, F.when(f & (F.coalesce(F.col(answer), F.lit("")) == ""), False).otherwise(f))


def backfill_domains(df: DataFrame, rules: dict[str, str] | None = None, domain: str = "domain", subsource: str = "subsource_raw") -> DataFrame:
    """Empty domains by sub-source, from a map literal."""
    pairs = [F.lit(x) for kv in (rules or SUBSOURCE_DOMAIN).items() for x in kv]
    return df.withColumn(domain, F.coalesce(F.nullif(F.col(domain), F.lit("")), F.try_element_at(F.create_map(*pairs), F.col(subsource))))


def apply_predictions(df: DataFrame, predictions: DataFrame, domain: str = "domain", key: str = "example_id", order: str | None = None) -> DataFrame:
    """Empty domains by predicted_domain on a key. Of repeated keys the last in `order` counts; without one, the prediction of greatest confidence, if there is such a column, then the name that sorts last. A left join that adaptive execution broadcasts if predictions are few."""
    first = order or ("confidence" if "confidence" in predictions.columns else None)
    last = F.max(F.struct(*([F.col(first).alias("o")] if first else []), F.col("predicted_domain").alias("d")))
    p = predictions.groupBy(F.col(key).alias("_key")).agg(last.alias("_l")).select("_key", F.col("_l.d").alias("_p"))
    return df.join(p, F.col(key) == F.col("_key"), "left").withColumn(domain, F.coalesce(F.nullif(F.col(domain), F.lit("")), F.nullif("_p", F.lit("")))).drop("_key", "_p")


Step = Callable[[DataFrame], DataFrame]


def run_steps(df: DataFrame, transforms: dict[str, Step], filters: dict[str, Column]) -> DataFrame:
    """Transforms one after another, then filters: the first that fails names the row's reason."""
    for step in transforms.values():
        df = df.transform(step)
    return df.withColumn("_drop_reason", first_reason([(~F.coalesce(ok, F.lit(False)), name) for name, ok in filters.items()])).withColumn("_keep", F.col("_drop_reason").isNull())


def preview(c: Column, most: int = 2000) -> Column:
    return F.substring(X.col(c), 1, most)
