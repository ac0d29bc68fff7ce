"""Filter, text and chat queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..adapters.chat import ADAPTERS
from ..functions import answers as A
from ..functions import messages as M
from ..functions import text as X
from ..operators import rl_filters as RL
from ..operators import sft_filters as SF
from ..operators.reasons import drop_report, tag
from . import sql as S
from .common import chats, table

CFG = SF.FilterConfig(require_think=False, min_question_chars=60)


def drop_reason_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_report(tag(chats(spark, sf_dir), SF.drop_reason(F.col("m"), CFG)))


def chat_drop_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag(chats(spark, sf_dir), SF.drop_reason(F.col("m"), CFG)).select("conv_id", "_drop_reason", "_keep")


def question_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", X.blank(t).alias("empty"), SF.has_http(t).alias("http"), SF.any_word(t, SF.IMAGE_WORDS).alias("image"), SF.multipart(t).alias("multipart"), (F.length(t) < 200).alias("short"), SF.prompt_too_short(t).alias("short_norm"))


def chinese_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.round(X.cjk_ratio("text"), 9).alias("ratio"), (X.cjk_ratio("text") >= 0.05).alias("drop"))


def identity_and_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("m")
    return chats(spark, sf_dir).select("conv_id", SF.identity(M.last(m)["content"]).alias("identity"), SF.cutoff_mention(m).alias("cutoff"), F.size(SF.cutoff_mentions(m)).cast("bigint").alias("n_mentions"))


def safety_flag_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, flags = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").groupBy("doc_id").agg((F.max("toxic") == 1).alias("toxic"))
    return d.join(flags, "doc_id", "left").select("doc_id", SF.safety_reason(F.col("toxic"), F.lit(False)).alias("reason"))


def repetition_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "documents").select("doc_id", X.repeated_sentence("text").alias("r"))
    return x.select("doc_id", F.col("r.n").cast("bigint").alias("n"), F.col("r.item").alias("item"))


def repetition_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "documents").select("doc_id", X.repeated_ngram("text", 3).alias("r"))
    return x.select("doc_id", F.col("r.n").cast("bigint").alias("n"), F.col("r.item").alias("item"))


def prompt_reference_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", RL.prompt_reference_reason(F.col("url")).alias("url_reason"), RL.prompt_reference_reason(F.col("html")).alias("html_reason"))


def passrate_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", RL.passrate_reason((F.col("value") / 100).cast("string"), drop_zero=True).alias("reason"))


def ground_truth_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "click", "schema_pydantic").when(F.col("event_type") == "view", "llm_judge_open").otherwise("math_equiv")
    truth = F.when(F.col("user_id") < 20, "N/A ").when(F.col("user_id") < 40, "").otherwise(F.col("user_id").cast("string"))
    return table(spark, sf_dir, "events").select("event_id", RL.ground_truth_reason(truth, kind, F.col("props"), 2).alias("reason"))


def numeric_answer_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", F.explode(F.array(
        F.struct(F.concat(F.lit("$1,"), F.lpad(F.col("p_size").cast("string"), 3, "0"), F.lit(".50")).alias("a"), F.lit("Float").alias("k")),
        F.struct(F.concat(F.col("p_size").cast("string"), F.lit(" units")).alias("a"), F.lit("Integer").alias("k")),
        F.struct(F.concat(F.substring("p_name", 1, 1), F.lit(").")).alias("a"), F.lit("Multiple Choice").alias("k")),
        F.struct(F.concat(F.col("p_size").cast("string"), F.lit("% to 60%")).alias("a"), F.lit("Percentage").alias("k")),
        F.struct(F.concat(F.lit("1/"), F.col("p_size").cast("string")).alias("a"), F.lit("Fraction").alias("k")),
        F.struct(F.col("p_brand").alias("a"), F.lit("Boolean").alias("k")),
    )).alias("x")).select("p_partkey", "x.*")
    value, reason = A.normalised("a", "k")
    return p.select("p_partkey", F.col("k").alias("kind"), value.alias("value"), reason.alias("reason"))


def think_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.concat(F.lit("<THINK>"), F.col("text"), F.when(F.col("lang") == "de", F.lit("")).otherwise(F.lit("</think> rest <answer> ")), F.col("source"), F.lit(" </answer>"))
    x = table(spark, sf_dir, "documents").select("doc_id", t.alias("t"))
    return x.select("doc_id", F.sha1(X.think_text("t")).alias("think"), X.answer_text("t").alias("answer"), F.sha1(X.response_text("t")).alias("response"), X.balanced_think("t").alias("balanced"), SF.truncated_think(F.col("t")).alias("truncated"), SF.think_too_short(F.col("t")).alias("short"))


def context_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats(spark, sf_dir).select("conv_id", F.size(M.context("m")).cast("bigint").alias("n_context"), F.sha1(M.prompt_text("m")).alias("prompt"), F.sha1(M.dedup_context("m")).alias("dedup"), F.sha1(M.flat_text("m")).alias("flat"))


def last_user_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats(spark, sf_dir).select("conv_id", F.sha1(M.last_user_or_any("m")).alias("exact"), F.sha1(M.last_user("m")).alias("fuzzy"), F.sha1(M.user_text("m")).alias("users"))


def scoring_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats(spark, sf_dir).select("conv_id", F.sha1(M.scoring_text("m", M.last("m")["content"])).alias("text"))


def chat_canonical_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations through an adapter: canonical ids and reasons."""
    x = chats(spark, sf_dir).withColumns({"pos": F.col("conv_id"), "messages": F.col("m"), "ds_uid": F.col("conv_id"), "dataset_name": F.lit("talk"), "source": F.lit("math_chats")})
    return ADAPTERS["named_english"].apply(x, CFG, dataset_id="talks").select("row_id", "example_id", "domain", "source_dataset_id", "_keep", "_drop_reason")


QUERIES = {f.__name__: f for f in (chat_canonical_rows, drop_reason_histogram, chat_drop_reasons, question_flags, chinese_ratio, identity_and_cutoff, safety_flag_join, repetition_sentences, repetition_phrases, prompt_reference_filter, passrate_filter, ground_truth_gate, numeric_answer_normalise, think_extract, context_messages, last_user_message, scoring_text)}


def _words(t: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains(lower(coalesce({t}, '')), '{w}')" for w in words) + ")"


def _top(items: str, key: str, table_name: str) -> str:
    """The most frequent item of a list, the first seen among equals."""
    return f"""u AS (SELECT {key}, unnest(l) AS item, unnest(range(len(l))) AS i FROM (SELECT {key}, {items} AS l FROM {table_name})),
g AS (SELECT {key}, item, count(*) AS n, min(i) AS i FROM u GROUP BY {key}, item),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY n DESC, i) AS rn FROM g) WHERE rn = 1)"""


def _sentences(t: str) -> str:
    return f"list_filter(list_transform(list_filter(list_transform(string_split_regex({t}, '[.!?]+'), lambda s: {S.strip('s')}), lambda s: s <> ''), lambda s: lower({S.ws_norm('s')})), lambda s: s <> '')"


def _word_list(t: str) -> str:
    return f"list_filter(string_split(lower({S.ws_norm(t)}), ' '), lambda x: x <> '')"


def _grams(w: str, n: int) -> str:
    """n-grams of a column of words."""
    return f"list_transform(range(1, greatest(len({w}) - {n - 2}, 1)), lambda i: array_to_string({w}[i:i+{n - 1}], ' '))"


_IDENTITY = "(?i)" + "|".join(f"(?:{p})" for p in SF.IDENTITY_PATTERNS)
_IDENTITY_SQL = _IDENTITY.replace("'", "''")
_CUTOFF = SF.CUTOFF
_PROMPT = f"array_to_string(list_transform(list_filter(m, lambda t: coalesce(t.role <> 'assistant', true) AND NOT {S.blank('t.content')}), lambda t: t.content), chr(10) || chr(10))"
_LAST = "m[len(m)].content"
_CHATS = "chats AS (SELECT conv_id, list(struct_pack(role := role, content := text) ORDER BY turn, role, text) AS m FROM conversations GROUP BY conv_id)"
_CJK = "CASE WHEN length({0}) = 0 THEN 0.0 ELSE (length({0}) - length(regexp_replace({0}, '[\\x{{4e00}}-\\x{{9fff}}]', '', 'g'))) / CAST(length({0}) AS DOUBLE) END"
_REASONS = f"""{_CHATS},
c AS (SELECT conv_id, m, {_PROMPT} AS p, {_LAST} AS a, m[len(m)].role AS r FROM chats),
us AS (SELECT conv_id, unnest(l) AS item, unnest(range(len(l))) AS i FROM (SELECT conv_id, {_sentences('a')} AS l FROM c WHERE a IS NOT NULL)),
gs AS (SELECT conv_id, item, count(*) AS n, min(i) AS i FROM us GROUP BY conv_id, item),
ts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY n DESC, i) AS rn FROM gs) WHERE rn = 1),
up AS (SELECT conv_id, unnest(l) AS item, unnest(range(len(l))) AS i FROM (SELECT conv_id, {_grams('w', 3)} AS l FROM (SELECT conv_id, {_word_list('a')} AS w FROM c WHERE a IS NOT NULL))),
gp AS (SELECT conv_id, item, count(*) AS n, min(i) AS i FROM up GROUP BY conv_id, item),
tp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY n DESC, i) AS rn FROM gp) WHERE rn = 1),
d AS (SELECT c.conv_id, CASE
  WHEN m IS NULL OR len(m) < 2 THEN 'bad_messages'
  WHEN coalesce(r, '') <> 'assistant' THEN 'last_not_assistant'
  WHEN length({S.ws_norm('p')}) < 50 THEN 'prompt_too_short'
  WHEN {S.blank('a')} THEN 'empty_assistant'
  WHEN {S.blank('p')} THEN 'empty_question'
  WHEN regexp_matches(p, '(?i)https?://') THEN 'question_has_http'
  WHEN {_words('p', SF.IMAGE_WORDS)} THEN 'question_has_image_ref'
  WHEN starts_with(lower({S.strip('p')}), 'a)') AND contains(lower({S.strip('p')}), 'b)') THEN 'question_multipart'
  WHEN length(p) < 60 THEN 'question_too_short'
  WHEN {_CJK.format('a')} >= 0.05 THEN 'chinese_ratio'
  WHEN regexp_matches(a, '{_IDENTITY_SQL}') THEN 'identity_self_id'
  WHEN len(list_filter(m, lambda t: coalesce(regexp_matches(t.content, '{_CUTOFF}'), false))) > 0 THEN 'cutoff_mention'
  WHEN length(a) >= 200 AND ts.n >= 6 AND length(ts.item) >= 8 THEN 'repetition_sentences'
  WHEN length(a) >= 200 AND tp.n >= 30 AND length(tp.item) >= 12 THEN 'repetition_phrases' END AS reason
  FROM c LEFT JOIN ts USING (conv_id) LEFT JOIN tp USING (conv_id))"""

_NUM = f"regexp_extract(regexp_replace(a, '[$€£¥]', '', 'g'), '{A.NUMBER}', 0)"
ORACLE_SQL = {
    "chat_canonical_rows": f"WITH {_REASONS} SELECT CAST(conv_id AS VARCHAR) AS row_id, sha256('talks|train|' || conv_id) AS example_id, 'math' AS domain, 'talk' AS source_dataset_id, reason IS NULL AS _keep, reason AS _drop_reason FROM d",
    "drop_reason_histogram": f"WITH {_REASONS} SELECT reason, count(*) AS n FROM d WHERE reason IS NOT NULL GROUP BY reason",
    "chat_drop_reasons": f"WITH {_REASONS} SELECT conv_id, reason AS _drop_reason, reason IS NULL AS _keep FROM d",
    "question_flags": f"SELECT doc_id, {S.blank('text')} AS empty, coalesce(regexp_matches(text, '(?i)https?://'), false) AS http, {_words('text', SF.IMAGE_WORDS)} AS image, starts_with(lower({S.strip('text')}), 'a)') AND contains(lower(text), 'b)') AS multipart, length(text) < 200 AS short, length({S.ws_norm('text')}) < 50 AS short_norm FROM documents",
    "chinese_ratio": f"SELECT doc_id, round({_CJK.format('text')}, 9) AS ratio, {_CJK.format('text')} >= 0.05 AS \"drop\" FROM documents",
    "identity_and_cutoff": f"WITH {_CHATS} SELECT conv_id, coalesce(regexp_matches({_LAST}, '{_IDENTITY_SQL}'), false) AS identity, len(list_filter(m, lambda t: coalesce(regexp_matches(t.content, '{_CUTOFF}'), false))) > 0 AS cutoff, CAST(list_sum(list_transform(m, lambda t: len(regexp_extract_all(coalesce(t.content, ''), '{_CUTOFF}')))) AS BIGINT) AS n_mentions FROM chats",
    "safety_flag_join": "SELECT doc_id, CASE WHEN t = 1 THEN 'unsafe_toxic' END AS reason FROM documents LEFT JOIN (SELECT doc_id, max(toxic) AS t FROM labels GROUP BY doc_id) USING (doc_id)",
    "repetition_sentences": f"WITH {_top(_sentences('text'), 'doc_id', 'documents')} SELECT doc_id, n, item FROM documents LEFT JOIN top USING (doc_id)",
    "repetition_phrases": f"WITH ww AS (SELECT doc_id, {_word_list('text')} AS w FROM documents), {_top(_grams('w', 3), 'doc_id', 'ww')} SELECT doc_id, n, item FROM documents LEFT JOIN top USING (doc_id)",
    "prompt_reference_filter": "SELECT page_id, " + ", ".join(f"CASE WHEN regexp_matches({c}, '(?i)https?://') THEN 'prompt_has_http' WHEN {_words(c, RL.IMAGE_WORDS)} THEN 'prompt_has_image' END AS {c}_reason" for c in ("url", "html")) + " FROM pages",
    "passrate_filter": "SELECT event_id, CASE WHEN value / 100 > 0.9 THEN 'passrate_too_high' WHEN value = 0 THEN 'passrate_zero' END AS reason FROM events",
    "ground_truth_gate": "SELECT event_id, CASE WHEN event_type = 'click' THEN CASE WHEN props IS NULL OR props = '' THEN 'missing_verification_info' WHEN NOT json_valid(props) THEN 'invalid_verification_info' WHEN coalesce(json_extract_string(props, '$.schema_code'), '') = '' THEN 'missing_verification_info_schema_code' END "
    "WHEN user_id < 20 THEN 'placeholder_ground_truth' WHEN user_id < 40 THEN CASE WHEN event_type = 'view' THEN NULL ELSE 'missing_ground_truth' END WHEN length(CAST(user_id AS VARCHAR)) < 2 THEN 'ground_truth_too_short' END AS reason FROM events",
    "numeric_answer_normalise": f"""WITH a AS (SELECT p_partkey, '$1,' || lpad(CAST(p_size AS VARCHAR), 3, '0') || '.50' AS a, 'Float' AS k FROM part UNION ALL SELECT p_partkey, CAST(p_size AS VARCHAR) || ' units', 'Integer' FROM part UNION ALL SELECT p_partkey, substr(p_name, 1, 1) || ').', 'Multiple Choice' FROM part
  UNION ALL SELECT p_partkey, CAST(p_size AS VARCHAR) || '% to 60%', 'Percentage' FROM part UNION ALL SELECT p_partkey, '1/' || CAST(p_size AS VARCHAR), 'Fraction' FROM part UNION ALL SELECT p_partkey, p_brand, 'Boolean' FROM part)
SELECT p_partkey, k AS kind, CASE k WHEN 'Float' THEN replace({_NUM}, ',', '') WHEN 'Integer' THEN {_NUM} WHEN 'Multiple Choice' THEN CASE WHEN upper(a[1]) BETWEEN 'A' AND 'H' THEN upper(a[1]) END WHEN 'Fraction' THEN a END AS value,
  CASE k WHEN 'Multiple Choice' THEN CASE WHEN NOT upper(a[1]) BETWEEN 'A' AND 'H' THEN 'mcq_non_letter_answer' END WHEN 'Percentage' THEN 'percentage_invalid_or_range' WHEN 'Boolean' THEN 'boolean_non_canonical' END AS reason FROM a""",
    "think_extract": f"""WITH t AS (SELECT doc_id, '<THINK>' || text || CASE WHEN lang = 'de' THEN '' ELSE '</think> rest <answer> ' END || source || ' </answer>' AS t FROM documents)
SELECT doc_id, CASE WHEN regexp_matches(t, '{X.THINK}') THEN sha1({S.strip(f"regexp_extract(t, '{X.THINK}', 1)")}) END AS think, CASE WHEN regexp_matches(t, '{X.ANSWER}') THEN {S.strip(f"regexp_extract(t, '{X.ANSWER}', 1)")} END AS answer,
  sha1({S.strip(f"regexp_replace(regexp_replace(t, '{X.THINK}', '', 'g'), '{X.ANSWER}', '', 'g')")}) AS response, contains(lower(t), '</think>') AS balanced, NOT contains(lower(t), '</think>') AS truncated,
  coalesce(CASE WHEN regexp_matches(t, '{X.THINK}') THEN length({S.ws_norm(f"regexp_extract(t, '{X.THINK}', 1)")}) < 80 END, false) AS short FROM t""",
    "context_messages": f"""WITH {_CHATS} SELECT conv_id, CAST(len(list_filter(CASE WHEN m[len(m)].role = 'assistant' THEN m[:len(m) - 1] ELSE m END, lambda t: t.role IS NOT NULL AND t.content IS NOT NULL)) AS BIGINT) AS n_context, sha1({_PROMPT}) AS prompt,
  sha1(array_to_string(list_transform(list_filter(m, lambda t: NOT {S.blank('t.content')}), lambda t: lower(coalesce(t.role, '')) || ': ' || t.content), chr(10))) AS dedup,
  sha1(array_to_string(list_transform(list_filter(m, lambda t: NOT {S.blank('t.content')}), lambda t: coalesce(t.role, '') || ': ' || {S.strip('t.content')}), chr(10) || chr(10) || '---' || chr(10) || chr(10))) AS flat FROM chats""",
    "last_user_message": f"""WITH {_CHATS}, x AS (SELECT conv_id, list_filter(m, lambda t: t.role = 'user' AND NOT {S.blank('t.content')}) AS u, list_filter(m, lambda t: NOT {S.blank('t.content')}) AS e, list_filter(m, lambda t: t.role = 'user' AND t.content IS NOT NULL) AS f FROM chats)
SELECT conv_id, sha1(coalesce(u[len(u)].content, e[len(e)].content, '')) AS exact, sha1(coalesce(f[len(f)].content, '')) AS fuzzy, sha1(array_to_string(list_transform(u, lambda t: t.content), chr(10) || chr(10))) AS users FROM x""",
    "scoring_text": f"WITH {_CHATS} SELECT conv_id, sha1(array_to_string(list_concat(list_transform(list_filter(m, lambda t: t.role = 'user' AND NOT {S.blank('t.content')}), lambda t: t.content), list_filter([{_LAST}], lambda r: NOT {S.blank('r')})), ' [SEP] ')) AS text FROM chats",
}
