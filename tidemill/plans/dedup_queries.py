"""Deduplication queries over `documents` (source as dataset, doc_id as position), `events` and `benchmark`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import dedup as D
from ..operators import reasons as R
from ..session import settled
from . import sql as S
from .common import table

P = D.Blocking(head=2, threshold=78.0, metric="levenshtein")
P_TRUTH = D.Blocking(head=2, threshold=90.0, metric="levenshtein")
P_CROSS = D.Blocking(head=1, delta=200, radius=2, threshold=90.0, metric="levenshtein")
P_INDEL = D.Blocking(head=1, threshold=50.0)
P_LANGUAGE = D.Blocking(head=2, threshold=98.0, metric="levenshtein")
SWEEP = [78.0, 85.0, 90.0, 95.0]


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("pos"), F.col("source").alias("dataset_id"), "text", "lang")


def exact_dedup_cross_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = D.exact_cross_source(_docs(spark, sf_dir), F.col("text"))
    return x.select(F.col("pos").alias("doc_id"), "_dedup_hash", "_dedup_seen_in_ds", "_drop_reason", "_keep")


def exact_dedup_per_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = D.exact_cross_source(_docs(spark, sf_dir), F.col("text"), within=("lang",), algorithm="md5", reason="exact_hash_cross_source")
    return x.select(F.col("pos").alias("doc_id"), "lang", "_dedup_hash", "_dedup_seen_in_ds", "_drop_reason")


def exact_dedup_truth_aware(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = D.exact_truth_aware(_docs(spark, sf_dir), F.col("text"), F.col("lang"), skip=("src3",))
    return x.select(F.col("pos").alias("doc_id"), "_dedup_hash", "_dedup_matched_ds", "_drop_reason")


def same_id_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = D.same_id(table(spark, sf_dir, "events"), "event_type", "user_id", "event_id")
    return x.select("event_id", "_drop_reason")


def first_in_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.first_in_scope(_docs(spark, sf_dir), F.col("text"), ["lang"]).select(F.col("pos").alias("doc_id"), "_drop_reason")


def dup_pairs_top50(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = D.exact_cross_source(_docs(spark, sf_dir), F.col("text")).filter("not _keep")
    return R.duplicate_pairs(x, "dataset_id", "_dedup_seen_in_ds", 50)


def bucket_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = settled(D.blocked(_docs(spark, sf_dir), X.dedup_norm("text"), P, counts=False, pos=F.col("pos"), ds=X.missing("dataset_id")).withColumn("norm", F.md5("norm")))
    return D.candidate_pairs(base, D.distinct_owners(base, "ds"), P).select("q_pos", "c_pos", "offset")


def fuzzy_dedup_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = D.fuzzy_set(_docs(spark, sf_dir), F.col("text"), p=P)
    return x.select(F.col("pos").alias("doc_id"), F.round("_fuzzy_score", 6).alias("_fuzzy_score"), "_fuzzy_matched_dataset", "_drop_reason")


def fuzzy_dedup_indel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns of all `conversations`, in seven collections, by insertions and deletions alone."""
    x = table(spark, sf_dir, "conversations").filter("role = 'user'").select((F.col("conv_id") * 100000 + F.col("turn")).alias("pos"), F.concat(F.lit("c"), F.pmod("conv_id", F.lit(7)).cast("string")).alias("dataset_id"), "text")
    return D.fuzzy_set(x, F.col("text"), p=P_INDEL).select("pos", F.round("_fuzzy_score", 6).alias("_fuzzy_score"), "_fuzzy_matched_dataset", "_drop_reason")


def fuzzy_dedup_per_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = D.fuzzy_set(_docs(spark, sf_dir), F.col("text"), p=P_LANGUAGE, reason="fuzzy_duplicate_cross_source", within=("lang",))
    return x.select(F.col("pos").alias("doc_id"), "lang", F.round("_fuzzy_score", 6).alias("_fuzzy_score"), "_fuzzy_matched_dataset", "_drop_reason")


def fuzzy_dedup_truth_aware(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = D.fuzzy_truth_aware(_docs(spark, sf_dir), F.col("text"), F.col("lang"), p=P_TRUTH, skip=("src3",), skip_intra=("src5",))
    return x.select(F.col("pos").alias("doc_id"), "_drop_reason")


def cross_collection_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = D.cross_collection(_docs(spark, sf_dir), table(spark, sf_dir, "benchmark"), F.col("text"), F.col("text"), p=P_CROSS)
    return x.select(F.col("pos").alias("doc_id"), "_drop_reason")


def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.threshold_sweep(_docs(spark, sf_dir), F.col("text"), F.col("lang"), SWEEP, p=P)


def fuzzy_dedup_sequential(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of 20,000 positions by insertions and deletions; tested against a plain sequential version."""
    return D.fuzzy_sequential(_docs(spark, sf_dir), F.col("text"))


QUERIES = {f.__name__: f for f in (exact_dedup_cross_source, exact_dedup_per_language, exact_dedup_truth_aware, same_id_dedup, first_in_scope, dup_pairs_top50, bucket_candidates, fuzzy_dedup_set, fuzzy_dedup_indel, fuzzy_dedup_per_language, fuzzy_dedup_truth_aware, cross_collection_dedup, threshold_sweep, fuzzy_dedup_sequential)}


def _base(p: D.Blocking, norm: str, truth: str = "", where: str = "") -> str:
    return f"""n AS (SELECT doc_id AS pos, coalesce(source, '__MISSING__') AS ds, {norm} AS norm{truth} FROM documents {where}),
base AS (SELECT *, length(norm) AS len, {S.head('norm', p.head)} AS head, CAST(floor(length(norm) / {p.width}) AS INTEGER) AS bin FROM n WHERE norm <> '')"""


_BEST = "best AS (SELECT q_pos, round(score, 6) AS _fuzzy_score, c_ds FROM (SELECT *, row_number() OVER (PARTITION BY q_pos ORDER BY score DESC, off, c_pos) AS rn FROM pairs) WHERE rn = 1)"
_TRUTH = f", sha1(coalesce({S.strip('lang')}, '')) AS truth"

ORACLE_SQL = {
    "exact_dedup_cross_source": f"""WITH d AS (SELECT doc_id, coalesce(source, '__MISSING__') AS ds, sha1({S.norm('text')}) AS h FROM documents),
w AS (SELECT *, first_value(ds) OVER (PARTITION BY h ORDER BY doc_id) AS o FROM d)
SELECT doc_id, h AS _dedup_hash, o AS _dedup_seen_in_ds, CASE WHEN ds <> o THEN 'exact_hash_cross_dataset' END AS _drop_reason, ds = o AS _keep FROM w""",
    "exact_dedup_per_language": f"""WITH d AS (SELECT doc_id, lang, coalesce(source, '__MISSING__') AS ds, md5({S.norm('text')}) AS h FROM documents),
w AS (SELECT *, first_value(ds) OVER (PARTITION BY lang, h ORDER BY doc_id) AS o FROM d)
SELECT doc_id, lang, h AS _dedup_hash, o AS _dedup_seen_in_ds, CASE WHEN ds <> o THEN 'exact_hash_cross_source' END AS _drop_reason FROM w""",
    "exact_dedup_truth_aware": f"""WITH d AS (SELECT doc_id, coalesce(source, '__MISSING__') AS ds, sha1({S.norm('text')}) AS h, CASE WHEN {S.blank('lang')} THEN '' ELSE sha1({S.strip('lang')}) END AS g FROM documents),
w AS (SELECT *, first_value(ds) OVER w AS o, first_value(g) OVER w AS og, first_value(doc_id) OVER w AS p FROM d WHERE ds <> 'src3' WINDOW w AS (PARTITION BY h ORDER BY doc_id))
SELECT doc_id, h AS _dedup_hash, o AS _dedup_matched_ds, CASE WHEN ds <> o THEN 'exact_hash_cross_dataset' WHEN doc_id <> p AND g = og THEN 'exact_hash_intra_dataset_same_gt' END AS _drop_reason FROM w
UNION ALL SELECT doc_id, '__SKIPPED__', ds, NULL FROM d WHERE ds = 'src3'""",
    "same_id_dedup": "SELECT event_id, CASE WHEN row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id) > 1 THEN 'same_id_duplicate' END AS _drop_reason FROM events",
    "first_in_scope": f"SELECT doc_id, CASE WHEN row_number() OVER (PARTITION BY lang, {S.norm('text')} ORDER BY doc_id) > 1 THEN 'duplicate_prompt' END AS _drop_reason FROM documents",
    "dup_pairs_top50": f"""WITH d AS (SELECT doc_id, coalesce(source, '__MISSING__') AS ds, {S.norm('text')} AS h FROM documents),
w AS (SELECT *, first_value(ds) OVER (PARTITION BY h ORDER BY doc_id) AS o FROM d)
SELECT ds AS dataset_id, o AS _dedup_seen_in_ds, count(*) AS n FROM w WHERE ds <> o GROUP BY 1, 2 ORDER BY n DESC, 1, 2 LIMIT 50""",
    "bucket_candidates": f"""WITH {_base(P, S.norm('text'))},
owners AS (SELECT norm, len, head, bin, min(pos) AS pos FROM base GROUP BY norm, len, head, bin)
SELECT q.pos AS q_pos, c.pos AS c_pos, CAST(c.bin - q.bin AS INTEGER) AS "offset" FROM base q JOIN owners c ON q.head = c.head AND abs(q.bin - c.bin) <= {P.radius} AND abs(q.len - c.len) <= {P.delta} AND c.pos < q.pos""",
    "fuzzy_dedup_set": f"""WITH {_base(P, S.byte_norm('text'))}, {S.pairs_sql(P)}, {_BEST}
SELECT doc_id, _fuzzy_score, c_ds AS _fuzzy_matched_dataset, CASE WHEN c_ds <> coalesce(source, '__MISSING__') THEN 'fuzzy_duplicate' END AS _drop_reason FROM documents LEFT JOIN best ON q_pos = doc_id""",
    "fuzzy_dedup_indel": f"""WITH RECURSIVE n AS (SELECT conv_id * 100000 + turn AS pos, 'c' || CAST(conv_id % 7 AS VARCHAR) AS ds, {S.byte_norm('text')} AS norm FROM conversations WHERE role = 'user'),
base AS (SELECT *, length(norm) AS len, {S.head('norm', 1)} AS head, CAST(floor(length(norm) / 100) AS INTEGER) AS bin FROM n WHERE norm <> ''),
owners AS (SELECT norm, len, head, bin, min(pos) AS pos, arg_min(ds, pos) AS ds FROM base GROUP BY norm, len, head, bin),
maybe AS MATERIALIZED (SELECT row_number() OVER () AS id, q.pos AS q_pos, q.ds AS q_ds, c.pos AS c_pos, c.ds AS c_ds, c.bin - q.bin AS off, q.norm AS a, c.norm AS b, q.len + c.len AS total
  FROM base q JOIN owners c ON q.head = c.head AND abs(q.bin - c.bin) <= 1 AND abs(q.len - c.len) <= 40 AND c.pos < q.pos), {S.lcs('maybe')},
pairs AS (SELECT * FROM (SELECT maybe.*, 200.0 * n / total AS score FROM maybe JOIN lcs USING (id)) WHERE score >= {P_INDEL.threshold}), {_BEST}
SELECT n.pos, _fuzzy_score, c_ds AS _fuzzy_matched_dataset, CASE WHEN c_ds <> ds THEN 'fuzzy_duplicate' END AS _drop_reason FROM n LEFT JOIN best ON q_pos = n.pos""",
    "fuzzy_dedup_per_language": f"""WITH n AS (SELECT doc_id AS pos, lang, coalesce(source, '__MISSING__') AS ds, {S.byte_norm('text')} AS norm FROM documents),
base AS (SELECT *, length(norm) AS len, coalesce(lang, chr(1)) || chr(2) || {S.head('norm', 2)} AS head, CAST(floor(length(norm) / 100) AS INTEGER) AS bin FROM n WHERE norm <> ''), {S.pairs_sql(P_LANGUAGE)}, {_BEST}
SELECT doc_id, lang, _fuzzy_score, c_ds AS _fuzzy_matched_dataset, CASE WHEN c_ds <> coalesce(source, '__MISSING__') THEN 'fuzzy_duplicate_cross_source' END AS _drop_reason FROM documents LEFT JOIN best ON q_pos = doc_id""",
    "fuzzy_dedup_truth_aware": f"""WITH {_base(P_TRUTH, S.byte_norm('text'), _TRUTH, "WHERE coalesce(source, '__MISSING__') <> 'src3'")},
{S.pairs_sql(P_TRUTH, ', truth, ds').replace(', arg_min(ds, pos) AS ds', '')},
dec AS (SELECT q_pos, any_value(q_ds) AS ds, bool_or(q_ds <> c_ds) AS x, bool_or(q_ds = c_ds AND q_truth = c_truth) AS s FROM pairs GROUP BY q_pos)
SELECT doc_id, CASE WHEN x THEN 'fuzzy_cross_dataset' WHEN s AND ds <> 'src5' THEN 'fuzzy_intra_dataset_same_gt' END AS _drop_reason FROM documents LEFT JOIN dec ON q_pos = doc_id""",
    "cross_collection_dedup": f"""WITH nn AS (SELECT doc_id AS pos, coalesce(source, '__MISSING__') AS ds, {S.byte_norm('text')} AS norm FROM documents),
every AS (SELECT *, length(norm) AS len, {S.head('norm', 1)} AS head, CAST(floor(length(norm) / 100) AS INTEGER) AS bin FROM nn WHERE norm <> ''),
rr AS (SELECT DISTINCT {S.byte_norm('text')} AS norm FROM benchmark),
ref AS (SELECT *, length(norm) AS len, {S.head('norm', 1)} AS head, CAST(floor(length(norm) / 100) AS INTEGER) AS bin FROM rr WHERE norm <> ''),
tried AS MATERIALIZED (SELECT q.pos, q.norm AS qn, c.norm AS cn, greatest(q.len, c.len) AS longer FROM every q JOIN ref c ON {S.near(P_CROSS, before=False)}),
hit AS (SELECT DISTINCT pos FROM tried WHERE 100.0 * (1.0 - CAST(levenshtein(qn, cn) AS DOUBLE) / longer) >= 90),
base AS (SELECT * FROM every WHERE pos NOT IN (SELECT pos FROM hit)), {S.pairs_sql(P_CROSS)}, {_BEST}
SELECT doc_id, CASE WHEN hit.pos IS NOT NULL THEN 'cross_collection_duplicate' WHEN c_ds <> coalesce(source, '__MISSING__') THEN 'intra_new_cross_source_duplicate' END AS _drop_reason
FROM documents LEFT JOIN hit ON hit.pos = doc_id LEFT JOIN best ON q_pos = doc_id""",
    "threshold_sweep": f"""WITH {_base(P, S.byte_norm('text'), _TRUTH)}, {S.pairs_sql(P, ', truth, ds').replace(', arg_min(ds, pos) AS ds', '')},
x AS (SELECT t AS threshold, q_pos, bool_or(q_ds <> c_ds) AS x, bool_or(q_ds = c_ds AND q_truth = c_truth) AS s FROM pairs, (VALUES (78.0::DOUBLE), (85.0), (90.0), (95.0)) v(t) WHERE score >= t GROUP BY 1, 2)
SELECT CAST(threshold AS DOUBLE) AS threshold, count(*) FILTER (x) AS cross_dataset, count(*) FILTER (NOT x AND s) AS same_truth, count(*) FILTER (NOT x AND NOT s) AS kept_other_truth FROM x GROUP BY threshold""",
}
