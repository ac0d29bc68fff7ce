"""End-to-end jobs: chat corpora and reward corpora, every dropped row with its reason. `python -m tidemill.plans.jobs` runs one from paths."""

from __future__ import annotations

import argparse
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..adapters.chat import ADAPTERS as CHAT
from ..adapters.reward import ADAPTERS as REWARD
from ..functions import messages as M
from ..operators import dedup as D
from ..operators import merge as G
from ..operators import post as PP
from ..operators import validate as V
from ..operators.quality import QualityScorer, apply_threshold, calibrate
from ..operators.sft_filters import FilterConfig, language_category_ok

from ..schema import RL_COLUMNS, RL_SCHEMA, SFT_COLUMNS, SFT_SCHEMA
from ..session import settled
from ..sources.readers import positioned


@dataclass
class Outcome:
    """What is left, and what each stage dropped with `_drop_reason`."""

    kept: DataFrame
    dropped: dict[str, DataFrame] = field(default_factory=dict)

    def stage(self, name: str, tagged: DataFrame) -> None:
        """Splits a tagged table; its extra columns go, `pos` and the canonical ones stay."""
        keep = [c for c in self.kept.columns if c in tagged.columns]
        tagged = settled(tagged)
        self.dropped[name] = tagged.filter("not _keep").select(*keep, "_drop_reason")
        self.kept = tagged.filter("_keep").select(*keep)

    def funnel(self) -> DataFrame:
        """(stage, reason, n) of all dropped rows."""
        parts = [d.groupBy(F.lit(n).alias("stage"), F.col("_drop_reason").alias("reason")).agg(F.count(F.lit(1)).alias("n")) for n, d in self.dropped.items()]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out


def chat_job(spark: SparkSession, inputs: list[tuple[str, DataFrame]], cfg: FilterConfig = FilterConfig(), scorer: QualityScorer | None = None, threshold: float = 0.2, most_dropped: float = 0.05, blocking: D.Blocking = D.Blocking(), predictions: DataFrame | None = None) -> Outcome:
    """Adapters and filters, quality, same ids, exact and fuzzy copies across datasets, post-processing. `inputs`: (adapter, rows) in order of priority."""
    tagged = None
    for i, (name, df) in enumerate(inputs):
        part = CHAT[name].apply(positioned(df), cfg).withColumn("pos", F.lit(i).cast("bigint") * (1 << 52) + F.col("pos"))
        tagged = part if tagged is None else tagged.unionByName(part)
    body = ["pos", *[c for c in SFT_COLUMNS if not c.startswith("_")]]
    out = Outcome(tagged.select(*body))
    out.stage("filters", tagged)
    prompt = M.dedup_context(F.col("context_messages"))
    if scorer:
        scored = scorer.score(out.kept, M.scoring_text("context_messages", "response_text"))
        t = calibrate(scored, threshold, most_dropped)
        out.stage("quality", apply_threshold(scored, t).withColumn("_drop_reason", F.when(~F.col("_keep"), "low_quality")))
    out.stage("same_id", D.same_id(out.kept))
    out.stage("exact", D.exact_cross_source(out.kept, prompt))
    out.stage("fuzzy", D.fuzzy_set(out.kept, prompt, p=blocking))
    steps = {"truth": PP.fix_ground_truth, "domains": PP.backfill_domains}
    if predictions is not None:
        steps["predictions"] = lambda df: PP.apply_predictions(df, predictions)
    out.stage("post", PP.run_steps(out.kept, steps, {"language_filter": language_category_ok(F.col("category"), F.col("language"))}))
    return out


def reward_job(spark: SparkSession, inputs: list[tuple[str, DataFrame]], skip: tuple[str, ...] = (), skip_intra: tuple[str, ...] = (), blocking: D.Blocking = D.Blocking(threshold=90.0)) -> Outcome:
    """Adapters and filters, merge in order of priority, exact and fuzzy copies by ground truth, the canonical columns."""
    kept, dropped = [], None
    for name, df in inputs:
        t = settled(REWARD[name].apply(positioned(df)))
        gone = t.filter("not _keep").select("pos", *RL_COLUMNS, "_drop_reason")
        dropped = gone if dropped is None else dropped.unionByName(gone)
        kept.append((name, t.filter("_keep").select("pos", *RL_COLUMNS)))
    merged = G.union_by_priority(kept, kept[0][1].schema)
    out = Outcome(merged.withColumn("pos", F.col("merge_rank").cast("bigint") * (1 << 52) + F.col("pos")).drop("merge_rank"), {"filters": dropped})
    out.stage("exact", D.exact_truth_aware(out.kept, M.last_user_or_any("context_messages"), F.col("ground_truth_text"), skip=skip))
    out.stage("fuzzy", D.fuzzy_truth_aware(out.kept, M.last_user("context_messages"), F.col("ground_truth_text"), p=blocking, skip=skip, skip_intra=skip_intra))
    return out


def reward_checks(df: DataFrame) -> DataFrame:
    """(name, status, detail) of a finished reward corpus."""
    schema_verifier = F.col("verifier_type").isin("schema_structured_outputs", "schema_pydantic")
    problem = V.payload_problem(F.col("verification_info_raw"), F.col("verifier_type"))
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    checks: dict[str, tuple[Column, str]] = {
        "null_example_id": (F.count_if(F.col("example_id").isNull()), "FAIL"),
        "repeated_example_id": (F.count(F.lit(1)) - F.count_distinct("example_id"), "FAIL"),
        "empty_context": (F.count_if(F.coalesce(F.size("context_messages"), F.lit(0)) == 0), "FAIL"),
        "missing_ground_truth": (F.count_if(blank(F.col("ground_truth_text")) & ~schema_verifier), "FAIL"),
        "payload": (F.count_if(problem.isNotNull()), "WARN"),
        "no_user_message": (F.sum(V.structure_problems(F.col("context_messages"))["no_user_message"]), "WARN"),
    }
    return V.report(df, checks)


def finalise(df: DataFrame, schema=RL_SCHEMA) -> DataFrame:  # noqa: ANN001
    """The canonical columns alone, in order."""
    return G.canonical(df, schema.names)


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="Curates a corpus from Parquet inputs.")
    p.add_argument("kind", choices=["chat", "reward"])
    p.add_argument("--input", action="append", required=True, metavar="ADAPTER=PATH", help="in order of priority")
    p.add_argument("--out", required=True)
    a = p.parse_args(args)
    from ..session import build_session, checkpoint_dir
    from ..sources.sinks import write_json_report

    spark = build_session(f"tidemill-{a.kind}")
    checkpoint_dir(spark)
    inputs = [(x.split("=", 1)[0], spark.read.parquet(x.split("=", 1)[1])) for x in a.input]
    out = chat_job(spark, inputs) if a.kind == "chat" else reward_job(spark, inputs)
    schema = RL_SCHEMA if a.kind == "reward" else T.StructType([f for f in SFT_SCHEMA if not f.name.startswith("_")])
    finalise(out.kept, schema).write.mode("overwrite").parquet(f"{a.out}/kept")
    for name, df in out.dropped.items():
        df.write.mode("overwrite").parquet(f"{a.out}/dropped/{name}")
    write_json_report(out.funnel(), f"{a.out}/funnel")


if __name__ == "__main__":
    main()
