"""Rule bitmask ledger: every rule is evaluated once a document, its failure kept as a bit beside the
measurements; versioned policies are masks over the ledger and ablations are bitwise aggregates of it.

Everything is a DataFrame expression. No shuffle is needed for the ledger or a policy: a document's
figures depend on its text alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound, sealed, table

WHITE = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"

#: name -> failure as SQL over the measurements. The order fixes the bits; rules are only ever appended.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbol_words": "100 * n_symbols > 30 * n_words",
    "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
    "shouting": "100 * n_upper > 60 * word_chars",
    "exclaiming": "100 * n_exclaim > 40 * n_words",
    "word_length": "word_chars > 14 * n_words or word_chars < 2 * n_words",
}
BIT = {name: 1 << i for i, name in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A version of what is rejected: a document goes if it fails any of `rules`."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


BASE = Policy("base-1", ("few_words", "repeated_words"))
POLICIES = {p.version: p for p in (BASE, Policy("web-1", (*BASE.rules, "symbol_words", "repeated_lines")), Policy("web-2", tuple(RULES)))}
CURRENT = POLICIES["web-2"]
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_exclaim"]


def _chars_of(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def _window(w: Column, i: Column) -> Column:
    return F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))


def _covered(positions: Column) -> Column:
    """Words under 3-word windows that start at these ascending positions."""
    n = F.size(positions)
    return F.aggregate(
        F.transform(positions, lambda x, i: F.when(i + 1 < n, F.least(F.lit(3), F.get(positions, i + 1) - x)).otherwise(3)),
        F.lit(0).cast("long"),
        lambda a, x: a + x,
    )


def _repeat_words(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words from `_w` (words).

    Each window becomes one long: high bits of its hash, low bits its position. Sorting longs puts
    equal windows side by side, so a linear pass finds every window that may repeat (a superset, as hash
    prefixes can agree by chance); those few are compared as whole strings. O(n log n) for a text of n words.
    """
    df = df.withColumn("_n", F.size("_w"))
    # bits that hold a position: at least one more than the words need
    df = df.withColumn("_b", F.length(F.bin(F.col("_n").cast("long"))))
    keys = F.transform(
        F.col("_w"),
        lambda x, i: F.when(
            i + 2 < F.col("_n"),
            F.call_function("shiftleft", F.xxhash64(x, F.get(F.col("_w"), i + 1), F.get(F.col("_w"), i + 2)), F.col("_b")).bitwiseOR(i.cast("long")),
        ),
    )
    df = df.withColumn("_k", F.when(F.col("_n") >= 4, F.sort_array(F.filter(keys, lambda x: x.isNotNull()))).otherwise(F.array().cast("array<bigint>")))
    same = lambda a, b: F.call_function("shiftright", a, F.col("_b")) == F.call_function("shiftright", b, F.col("_b"))
    maybe = F.filter(
        F.col("_k"),
        lambda x, i: F.coalesce((i > 0) & same(F.get(F.col("_k"), i - 1), x), F.lit(False)) | F.coalesce(same(F.get(F.col("_k"), i + 1), x), F.lit(False)),
    )
    df = df.withColumn("_m", maybe)
    at = lambda x: x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_b")) - 1).cast("int")
    named = F.sort_array(F.transform(F.col("_m"), lambda x: F.struct(_window(F.col("_w"), at(x)).alias("g"), at(x).alias("p"))))
    repeated = bound(named, lambda s: F.sort_array(F.transform(
        F.filter(s, lambda x, i: F.coalesce((i > 0) & (F.get(s, i - 1)["g"] == x["g"]), F.lit(False)) | F.coalesce(F.get(s, i + 1)["g"] == x["g"], F.lit(False))),
        lambda x: x["p"],
    )))
    return df.withColumn("n_repeat_words", F.when(F.size("_m") == 0, F.lit(0).cast("long")).otherwise(bound(repeated, _covered)))


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """One row for each of `docs`: `row` (the whole input row, so no column name clashes) and MEASURES.

    Null text counts as empty: every figure 0. Repeated rows are measured each for itself; an empty
    table gives an empty result.
    """
    t = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    df = docs.select(F.struct("*").alias("row"), t.alias("_t"))
    df = df.withColumn("_w", F.filter(F.split("_t", WHITE), lambda x: x != ""))
    df = df.withColumn("_l", F.filter(F.split("_t", "\n"), lambda x: F.length(F.translate(x, " \t\n\x0b\f\r", "")) > 0))
    df = _repeat_words(df)
    return df.select(
        "row",
        F.col("_n").cast("long").alias("n_words"),
        F.length(F.translate("_t", " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        _chars_of(F.col("_t"), SYMBOLS).alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.size("_l").cast("long").alias("n_lines"),
        F.length(F.regexp_replace("_t", "\\P{Lu}+", "")).cast("long").alias("n_upper"),
        _chars_of(F.col("_t"), "!").alias("n_exclaim"),
    )


def ledger(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`row`, MEASURES and `failed` (long): bit i is set if rule i of RULES fails."""
    m = measure(docs, text_col)
    bits = None
    for name, rule in RULES.items():
        bit = F.when(F.expr(rule), F.lit(BIT[name]).cast("long")).otherwise(F.lit(0).cast("long"))
        bits = bit if bits is None else bits.bitwiseOR(bit)
    return m.withColumn("failed", bits)


def apply_policy(led: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """Adds `policy`, `rejected_by` (the failed bits that the policy counts) and `kept`."""
    by = F.col("failed").bitwiseAND(F.lit(policy.mask).cast("long"))
    return led.withColumns({"policy": F.lit(policy.version), "rejected_by": by, "kept": by == 0})


def ablation(led: DataFrame, policies: list[Policy] | None = None) -> DataFrame:
    """One row for each policy and rule: documents that fail the rule, that it alone rejects, and that stay if it is left out.

    Failure patterns are counted first, so at most 2^rules rows are shuffled, whatever the input.
    """
    policies = policies or list(POLICIES.values())
    patterns = led.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    cases = [F.struct(F.lit(p.version).alias("policy"), F.lit(r).alias("rule"), F.lit(p.mask).cast("long").alias("mask"), F.lit(BIT[r]).cast("long").alias("bit")) for p in policies for r in p.rules]
    x = patterns.select("failed", "n", F.explode(F.array(*cases)).alias("c")).select("failed", "n", "c.*")
    hit = F.col("failed").bitwiseAND(F.col("mask"))
    count = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(0)).cast("long")
    return x.groupBy("policy", "rule").agg(
        count(hit.bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        count(hit == F.col("bit")).alias("n_only"),
        count(hit.bitwiseAND(F.bitwise_not(F.col("bit"))) == 0).alias("n_kept_without"),
        F.bit_or(hit).alias("bits_seen"),
    )


def keep_clean(docs: DataFrame, policy: Policy = CURRENT, text_col: str = "text") -> DataFrame:
    """The rows of `docs`, unchanged, that the policy keeps."""
    return sealed(apply_policy(ledger(docs, text_col), policy)).filter("kept").select("row.*")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: the ledger of `documents` under the base rules and the current policy."""
    x = apply_policy(ledger(table(spark, sf_dir, "documents")), CURRENT)
    return x.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("failed").bitwiseAND(F.lit(BASE.mask).cast("long")) != 0).alias("base_failed"),
        "kept", "n_lines", "n_upper", "n_exclaim", "failed", "policy", "rejected_by",
    )


def _oracle() -> str:
    bits = " + ".join(f"CASE WHEN {rule} THEN {BIT[n]} ELSE 0 END" for n, rule in RULES.items())
    return f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, r, t,
        list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
g AS (SELECT r, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)),
p AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM g),
n AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i+1, i+2]) AS j FROM p WHERE c > 1) GROUP BY r),
m AS (SELECT doc_id, len(w) AS n_words,
        length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')) AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
        len(l) - len(list_distinct(l)) AS n_dup_lines,
        coalesce(n.n, 0) AS n_repeat_words, len(l) AS n_lines,
        length(regexp_replace(t, '[^\\p{{Lu}}]+', '', 'g')) AS n_upper,
        length(regexp_replace(t, '[^!]+', '', 'g')) AS n_exclaim
      FROM w LEFT JOIN n USING (r)),
b AS (SELECT *, {bits} AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (failed & {BASE.mask}) <> 0 AS base_failed, (failed & {CURRENT.mask}) = 0 AS kept,
  n_lines, n_upper, n_exclaim, CAST(failed AS BIGINT) AS failed, '{CURRENT.version}' AS policy, CAST(failed & {CURRENT.mask} AS BIGINT) AS rejected_by
FROM b"""


QUERIES = {"op9_quality_rules": op9_quality_rules}
ORACLE_SQL = {"op9_quality_rules": _oracle()}
