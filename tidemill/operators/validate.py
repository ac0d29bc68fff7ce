"""Validation of a finished corpus: one pass of aggregates, and a report of checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

# Payload keys that each verifier needs; one list of each suffices.
REQUIRED_KEYS = {
    "multiple_choice": [["options"]],
    "code_stdio": [["unit_tests"]],
    "code_asserts": [["fn_name", "test_format"]],
    "if_rules": [["constraint_text", "constraint_type"]],
    "schema_structured_outputs": [["schema_json"]],
    "schema_pydantic": [["schema_code"]],
    "prolog_rule_induction": [["evaluation_config"]],
    "synlogic_rule_based": [["data_source", "game_data"]],
    "reasoning_gym": [["source_dataset"], ["metadata"]],
    "puzzle_match": [["game_type"]],
    "structured_match": [["match_kind"]],
    "math_equiv": [["raw_answer"], ["answer_type"]],
    "multi_gt": [["alternative_ground_truths"]],
    "text_match": [["scrambled"]],
}
ROLES = ["user", "assistant", "system", "tool"]


def payload_problem(payload: Column, verifier: Column) -> Column:
    """Null if the payload is JSON with the keys its verifier needs."""
    keys = F.json_object_keys(payload)
    missing = F.lit(None).cast("string")
    for v, sets in REQUIRED_KEYS.items():
        ok = reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, [F.coalesce(F.array_contains(keys, k), F.lit(False)) for k in ks]) for ks in sets])
        missing = F.when(verifier == v, F.when(~ok, "missing_keys")).otherwise(missing)
    return F.when(X.blank(payload), "empty_payload").when(F.try_parse_json(payload).isNull(), "not_json").otherwise(missing)


def structure_problems(m: Column) -> Column:
    """struct of counts over a chat's turns."""
    n = lambda f: F.size(F.filter(m, f))
    return F.struct(
        n(lambda t: t.isNull()).alias("null_turn"),
        n(lambda t: t["role"].isNull()).alias("missing_role"),
        n(lambda t: t["role"].isNotNull() & ~t["role"].isin(ROLES)).alias("unknown_role"),
        n(lambda t: X.blank(t["content"])).alias("empty_content"),
        F.when(n(lambda t: t["role"] == "user") == 0, 1).otherwise(0).alias("no_user_message"),
    )


def structure_report(df: DataFrame, messages: str = "context_messages") -> DataFrame:
    x = df.select(structure_problems(F.col(messages)).alias("s"))
    return x.agg(*[F.coalesce(F.sum(f"s.{n}"), F.lit(0)).alias(n) for n in ("null_turn", "missing_role", "unknown_role", "empty_content", "no_user_message")])


def distributions(df: DataFrame, *columns: str) -> DataFrame:
    """(column, value, n) of every column in one scan: GROUPING SETS."""
    x = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("<null>")).alias(c) for c in columns])
    sets = [[F.col(c)] for c in columns]
    g = x.groupingSets(sets, *[F.col(c) for c in columns]).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.coalesce(*[F.when(F.col(c).isNotNull(), c) for c in columns]).alias("column"), F.coalesce(*columns).alias("value"), "n")


def cross_tab(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def null_report(df: DataFrame, columns: list[str], allowed: dict[str, Column] | None = None) -> DataFrame:
    """(column, n) of null or empty values where they are not allowed; every column has its row."""
    allowed = allowed or {}
    counts = df.agg(*[F.count_if(X.blank(F.col(c).cast("string")) & ~F.coalesce(allowed.get(c, F.lit(False)), F.lit(False))).alias(c) for c in columns])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in columns])).alias("x")).select("x.*")


def uniqueness(df: DataFrame, *keys: str) -> DataFrame:
    """rows, distinct keys and rows too many, by a two-step aggregate on the keys."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_distinct")).withColumn("n_repeated", F.col("n_rows") - F.col("n_distinct"))


def mean_reward(*columns: Column) -> Column:
    """Mean of the rewards that are not null."""
    there = F.filter(F.array(*[c.cast("double") for c in columns]), lambda x: x.isNotNull())
    return F.when(F.size(there) > 0, F.aggregate(there, F.lit(0.0), lambda a, x: a + x) / F.size(there))


def smoke_match(answer: Column, truth: Column, verifier: Column) -> Column:
    """Whether a truth verifies itself the way its verifier compares: a real check for four kinds, null for others."""
    from ..functions.answers import letter, number

    norm = lambda c: F.lower(X.ws_norm(c))
    return (
        F.when(verifier == "multiple_choice", letter(answer) == letter(truth))
        .when(verifier == "math_equiv", F.coalesce(number(answer).try_cast("double") == number(truth).try_cast("double"), norm(answer) == norm(truth)))
        .when(verifier == "text_match", norm(answer) == norm(truth))
        .when(verifier == "multi_gt", norm(answer) == norm(truth))
    )


def report(df: DataFrame, checks: dict[str, tuple[Column, str]]) -> DataFrame:
    """(name, status, detail): each check is an aggregate that counts what is wrong, and FAIL or WARN if that is above zero."""
    counts = df.agg(*[c.alias(n) for n, (c, _) in checks.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("name"), F.when(F.coalesce(F.col(n), F.lit(0)) > 0, level).otherwise("PASS").alias("status"), F.coalesce(F.col(n), F.lit(0)).cast("string").alias("detail")) for n, (_, level) in checks.items()])
    return counts.select(F.explode(rows).alias("x")).select("x.*")


def content_hash(df: DataFrame) -> DataFrame:
    """Rows and a hash of their content that does not depend on order or files."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(F.xxhash64(*[F.col(c) for c in df.columns]).cast("decimal(38,0)")), F.lit(0)).cast("string").alias("hash"))
