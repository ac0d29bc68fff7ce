"""Every adapter over rows of its source's shape: chats from `conversations`, reward rows from `part`, in a cycle of cases."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..adapters import chat as C
from ..adapters import reward as R
from .common import chats, table
from .filter_queries import _REASONS, CFG

SUBSOURCES = ["open-thoughts/OpenThoughts3 math", "nemotron code", "Tulu Persona", None, "identity set", "plain"]
SUB_DOMAINS = ["math", "code", "instruction_following", None, "chat", None]
TASKS = ["verifiable_math", "prime_rl_code", "ifeval", "unheard_of"]
TASK_DOMAINS = ["math", "code", "general", "general"]
NAMES = ["math set", "a program set", "stem", "talk"]
NAME_DOMAINS = ["math", "code", "science", "general"]
LANGUAGES = ["German", "french", None, "Klingon"]
CODES = ["de", "fr", None, "kl"]
CATEGORIES = ["Math", "code", "chat", "other"]
CATEGORY_DOMAINS = ["math", "code", "chat", None]


def _pick(values: list, by: str = "conv_id") -> Column:
    """A value by its place in the cycle."""
    return F.get(F.array(*[F.lit(v).cast("string") for v in values]), F.pmod(F.col(by), F.lit(len(values))).cast("int"))


def _pick_sql(values: list, by: str = "conv_id") -> str:
    said = ["NULL" if v is None else "'" + str(v).replace("'", "''") + "'" for v in values]
    return f"([{', '.join(said)}]::VARCHAR[])[1 + CAST({by} % {len(values)} AS INTEGER)]"


def _chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats(spark, sf_dir).withColumns({"pos": F.col("conv_id"), "messages": F.col("m")})


def _told(df: DataFrame) -> DataFrame:
    return df.select("row_id", "subsource_raw", "language", "domain", "category", "source_dataset_id", "_drop_reason")


def adapter_labelled_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _chats(spark, sf_dir).withColumns({"id": F.col("conv_id").cast("string"), "dataset_source": _pick(SUBSOURCES)})
    return _told(C.ADAPTERS["labelled_mixture"].apply(x, CFG))


def adapter_sharegpt(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.transform("m", lambda t: F.struct(F.when(t["role"] == "user", "human").when(t["role"] == "assistant", "gpt").otherwise(t["role"]).alias("from"), t["content"].alias("value")))
    x = _chats(spark, sf_dir).withColumns({"conversations": said, "source": _pick(NAMES), "difficulty": F.pmod("conv_id", F.lit(5)), "domain": _pick(CATEGORIES)}).drop("messages")
    return _told(C.ADAPTERS["sharegpt"].apply(x, CFG))


def adapter_configured_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _told(C.ADAPTERS["configured_mixture"].apply(_chats(spark, sf_dir).withColumn("config", _pick(["math", "code", "science"])), CFG))


def adapter_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _chats(spark, sf_dir).withColumns({"uuid": F.concat(F.lit("u"), "conv_id"), "category": F.lit("c")})
    return _told(C.split_adapter("multilingual_de").apply(x, CFG))


def adapter_formal_proofs(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _chats(spark, sf_dir).withColumns({"uuid": F.concat(F.lit("u"), "conv_id"), "formal_statement": F.lit("theorem"), "messages": F.when(F.pmod("conv_id", F.lit(3)) > 0, F.col("m"))})
    return _told(C.ADAPTERS["formal_proofs"].apply(x, CFG))


def adapter_task_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _told(C.ADAPTERS["task_typed"].apply(_chats(spark, sf_dir).withColumns({"problem_id": F.concat(F.lit("p"), "conv_id"), "task_type": _pick(TASKS)}), CFG))


def adapter_three_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All turns but the last as input, the last as output."""
    x = _chats(spark, sf_dir).withColumns({"system_prompt": F.lit(None).cast("string"), "input": F.slice("m", 1, F.greatest(F.size("m") - 1, F.lit(0))), "output": F.get("m", F.size("m") - 1)["content"], "category": _pick(CATEGORIES)}).drop("messages")
    return _told(C.ADAPTERS["three_field"].apply(x.filter(F.get("m", F.size("m") - 1)["role"] == "assistant"), CFG))


def _with_reasoning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chats whose turns hold reasoning beside them, in two of three."""
    said = F.transform("m", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"), F.when((t["role"] == "assistant") & (F.pmod("conv_id", F.lit(3)) > 0), "so it is").alias("reasoning_content")))
    return _chats(spark, sf_dir).withColumn("messages", said)


def adapter_out_of_band_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _with_reasoning(spark, sf_dir).withColumns({"uuid": F.concat(F.lit("u"), "conv_id"), "expected_answer": F.lit("7"), "data_source": _pick(NAMES)})
    out = C.ADAPTERS["out_of_band_math"].apply(x, CFG)
    return out.select("row_id", "subsource_raw", "domain", "reasoning_text", "reasoning_type", "final_answer_text", F.coalesce(F.col("_drop_reason") == "empty_reasoning_content", F.lit(False)).alias("no_reasoning"))


def adapter_competitive_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _with_reasoning(spark, sf_dir).withColumns({"uuid": F.lit(""), "question_id": F.col("conv_id"), "source": _pick(NAMES), "difficulty": F.lit("hard")})
    out = C.ADAPTERS["competitive_code"].apply(x, CFG)
    return out.select("row_id", "subsource_raw", "domain", "difficulty", "reasoning_text", "reasoning_type", F.coalesce(F.col("_drop_reason") == "empty_reasoning_content", F.lit(False)).alias("no_reasoning"))


def adapter_nested_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    info = lambda t: F.struct(_pick(["KodCode", "AIME", "openthoughts", None]).alias("source"), F.lit(" 4 ").alias("reference_answer"), F.lit(None).cast("string").alias("test_case"), F.when(t["role"] == "assistant", "so").alias("think_content"), F.when(t["role"] == "assistant", "done").alias("answer_content"))
    x = _chats(spark, sf_dir).withColumn("messages", F.transform("m", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"), info(t).alias("info"))))
    out = C.ADAPTERS["nested_info"].apply(x.withColumn("id", F.col("conv_id").cast("string")), CFG)
    return out.select("row_id", "subsource_raw", "final_answer_text", "reasoning_text", "response_text")


def adapter_named_multilingual(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _chats(spark, sf_dir).withColumns({"ds_uid": F.col("conv_id"), "dataset_name": F.lit("d"), "source": _pick(NAMES), "language": _pick(LANGUAGES)})
    return _told(C.ADAPTERS["named_multilingual"].apply(x, CFG))


ASK = "Please work out item {} with care and say how you came to the answer."


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("pos"), "p_size")
    before, after = ASK.split("{}")
    return p.withColumns({"id": F.col("pos").cast("string"), "prompt": F.concat(F.lit(before), F.col("pos"), F.lit(after))})


def _turns(c: Column) -> Column:
    return F.array(F.struct(F.lit("user").alias("role"), c.alias("content")))


def _reward(df: DataFrame, *more: str) -> DataFrame:
    return df.select("row_id", "verifier_type", "ground_truth_text", "domain", *more, "_drop_reason")


#: (answer, type, normalised, verifier, reason)
ANSWERS = [
    ("$1,200.50", "Float", "1200.50", "math_equiv", None), ("b)", "Multiple Choice", "B", "multiple_choice", None), ("Yes.", "Boolean", "True", "math_equiv", None), ("3.5", "Integer", None, "math_equiv", "integer_not_integer"),
    ("5% to 7%", "Percentage", None, "math_equiv", "percentage_invalid_or_range"), ("x", "Matrix", None, None, "requires_model_verifier"), ("1/5", "Fraction", "1/5", "math_equiv", None), ("x", "Poem", None, None, "unknown_answer_type"),
]


def adapter_typed_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _parts(spark, sf_dir).withColumns({"question": F.concat(F.col("prompt"), _pick(["", " see image", " png"], "pos")), "answer": _pick([a[0] for a in ANSWERS], "pos"), "answer_type": _pick([a[1] for a in ANSWERS], "pos"), "category": _pick(["Law", "Physics", "none"], "pos"), "difficulty": F.lit("hard")})
    return _reward(R.ADAPTERS["typed_qa"].apply(x))


#: (label, domain, verifier, reason)
LABELS = [("math", "math", "math_equiv", None), ("code_stdio", "code", "code_stdio", None), ("general-quality", "chat", "llm_judge_open", "ungradeable_verifier_llm_judge_open"), ("odd", None, None, "unknown_verifier")]


def adapter_flat_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _parts(spark, sf_dir).withColumns({"prompt": F.concat(F.lit("system: Be brief.\nuser: "), "prompt"), "ground_truth": F.array(F.lit("4"), F.lit("four")), "dataset": F.array(_pick([v[0] for v in LABELS], "pos")), "original_dataset": F.lit("o"), "custom_id": F.col("id"), "constraint": F.lit(None).cast("string"), "constraint_type": F.lit(None).cast("string"), "passrate": F.col("p_size") / 50.0})
    return _reward(R.ADAPTERS["flat_prompts"].apply(x), F.size("context_messages").cast("bigint").alias("n_turns"), F.get_json_object("verification_info_raw", "$.alternative_ground_truths[0]").alias("other"))


#: (problem id's beginning or None, payload, verifier, truth, reason)
KEYED = [
    ("sky_work_math_", {"ground_truth": " 7 "}, "math_equiv", "7", None),
    ("ifeval_", {"ground_truth": json.dumps({"func_name": "validate_title", "n": None})}, "if_rules", '[{"instruction_id":"detectable_format:title","kwargs":{}}]', None),
    ("ifeval_", {"ground_truth": json.dumps({"func_name": "unheard_of"})}, "if_rules", None, "missing_ground_truth"),
    ("formatask_dual_e0_", {"ground_truth1": "a1", "ground_truth2": "b1"}, "multi_gt", "a1", None),
    ("prime_rl_code_", {"style": "s", "test_cases": json.dumps({"fn_name": "f", "inputs": [[1]], "outputs": [[2]]})}, "code_asserts", '["assert f(1) == 2"]', None),
    ("prime_rl_code_", {"style": "s", "test_cases": json.dumps({"inputs": ["1", "2"], "outputs": ["x", "y"]})}, "code_stdio", "x\n---\ny", None),
    ("complex_json_output_", {"ground_truth": '{"b": 1, "a": 2}'}, "structured_match", '{"a":2,"b":1}', None),
    ("pydantic_adherance_", {"model_name": "M", "pydantic_config": "class M: pass"}, "schema_pydantic", None, None),
    ("unscramble_", {"ground_truth": "N/A", "scrambled": "an"}, "text_match", "N/A", "placeholder_ground_truth"),
    (None, {"ground_truth": "g1", "reasoning_gym_dataset": "t", "reasoning_gym_entry": "{}"}, "puzzle_match", "g1", None),
    ("unscramble_", {"ground_truth": "a", "more": "b"}, None, "a", "unknown_verifier"),
]


def adapter_keyed_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _parts(spark, sf_dir).withColumns({"problem_id": F.concat(_pick([k[0] for k in KEYED], "pos"), F.col("id")), "verification_info": _pick([json.dumps(k[1]) for k in KEYED], "pos")})
    return R.ADAPTERS["keyed_json"].apply(x).select("row_id", "verifier_type", "ground_truth_text", "_drop_reason")


def adapter_choice_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each input stands in several rows; the first stays."""
    x = _parts(spark, sf_dir).withColumns({"id_": F.col("id"), "input": F.concat(F.lit(ASK.format("")), F.pmod("pos", F.lit(300))), "answer_text": _pick(["yes", "no", " "], "pos"), "category": F.lit("Logic"), "original_dataset": _pick(["folio", "adv"], "pos"), "choices": F.when(F.pmod("pos", F.lit(4)) > 0, F.array(F.lit("no"), F.lit("yes")))})
    return _reward(R.ADAPTERS["choice_qa"].apply(x), "ability", F.get_json_object("verification_info_raw", "$.answer_letter").alias("letter"))


#: (language, rule, program, reason)
RULES = [("en", "eastbound(T) :- car(T).", "eastbound(a). westbound(b).", None), ("de", "ost(T) :- wagen(T).", "ost(a). west(b).", None), ("fr", "est(T).", "est(a). ouest(b).", "ground_truth_rule_has_no_body"), ("en", "eastbound(T) :- x.", "eastbound(a).", "validation_program_missing_pos_or_neg"), ("en", " ", "x", "empty_ground_truth_rule")]


def adapter_rule_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts of less than 100 characters, blanks counted, are too short."""
    x = _parts(spark, sf_dir).withColumns({"prompt": F.concat("prompt", F.repeat(F.lit(" "), F.lit(30) + F.pmod("pos", F.lit(2)) * 20), F.lit("x")), "language": _pick([r[0] for r in RULES], "pos"), "ground_truth_rule": _pick([r[1] for r in RULES], "pos"), "validation_program": _pick([r[2] for r in RULES], "pos"), "curriculum_level": F.pmod("pos", F.lit(12)), "curriculum_tier": F.lit("easy")})
    return _reward(R.ADAPTERS["rule_induction"].apply(x), "subsource_raw", "language")


def adapter_logic_puzzles(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _parts(spark, sf_dir).withColumns({"data_source": _pick(["sudoku", "chess", "maze"], "pos"), "answer": _pick(["4", ""], "pos"), "game_data": _pick(["{}", "[1]", "{", None, "{}"], "pos"), "prompt": _turns(F.col("prompt"))})
    return _reward(R.puzzles(("sudoku", "maze")).apply(x), "language")


def adapter_procedural(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _parts(spark, sf_dir).withColumns({"uuid": F.concat(F.lit("u"), "id"), "question": F.col("prompt"), "answer": F.lit("4"), "responses_create_params": F.lit("{}"), "metadata": _pick(['{"source_dataset": "graph_color"}', '{"source_dataset": "sums"}', "{}"], "pos")})
    return _reward(R.ADAPTERS["procedural"].apply(x), "subsource_raw")


#: (ability, truth, verifier, truth as text, reason)
ABILITIES = [("math", "4", "math_equiv", "4", None), ("code", '{"inputs": ["1"], "outputs": ["2", "3"]}', "code_stdio", "2\n---\n3", None), ("code", '{"call_type": "assert", "fn_name": "f"}', "code_asserts", '{"call_type": "assert", "fn_name": "f"}', None), ("poetry", "4", None, "4", "unknown_verifier")]


def adapter_ability_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth user names a cutoff."""
    x = _parts(spark, sf_dir).withColumns({"data_source": F.lit("d"), "ability": _pick([a[0] for a in ABILITIES], "pos"), "ground_truth": _pick([a[1] for a in ABILITIES], "pos"), "prompt": _turns(F.concat("prompt", F.when(F.pmod("pos", F.lit(5)) == 0, " knowledge cutoff 2021").otherwise("")))})
    return _reward(R.ADAPTERS["ability_labelled"].apply(x), "ability")


#: (label, verifier, domain, truth, reason)
BLENDS = [
    ("nano_v3_sft_profiled_stem_mcqa", "multiple_choice", "mcqa", "B", None),
    ("nano_v3_sft_profiled_instruction_following", "if_rules", "instruction_following", '[{"instruction_id":"keywords:existence","kwargs":{"k":["a"]}}]', None),
    ("nano_v3_sft_profiled_structured_outputs", "schema_structured_outputs", "structured_outputs", None, None),
    ("nano_v3_sft_profiled_dapo17k", "math_with_judge", "math", "B", "placeholder_only_prompt"),
    ("nano_v3_sft_profiled_workbench", "tool_calls", "tool_use", "B", "ungradeable_verifier_tool_calls"),
    ("odd", None, None, "B", "unknown_verifier"),
]


def adapter_blend(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _parts(spark, sf_dir).withColumns({
        "dataset": _pick([b[0] for b in BLENDS], "pos"), "uuid": F.col("id"), "hash_id": F.lit("h"), "expected_answer": F.lit(" B "), "schema_str": F.lit('{"type": "object", "a": 1}'), "verifier_metadata": F.lit(None).cast("string"), "pass_rate": F.lit(0.5), "input": _turns(F.col("prompt")),
        "options": F.array(F.create_map(F.lit("A"), F.lit("x "), F.lit("B"), F.lit(None).cast("string")), F.create_map(F.lit("A"), F.lit(None).cast("string"), F.lit("B"), F.lit("y"))),
        "instruction_id_list": F.array(F.lit("keywords:existence")), "kwargs": F.lit('[{"k": ["a"], "n": null}]'),
    })
    return _reward(R.ADAPTERS["blend"].apply(x), F.get_json_object("verification_info_raw", "$.options.A").alias("option_a"), F.get_json_object("verification_info_raw", "$.schema_json").alias("schema"))


QUERIES = {f.__name__: f for f in (adapter_labelled_mixture, adapter_sharegpt, adapter_configured_mixture, adapter_split, adapter_formal_proofs, adapter_task_typed, adapter_three_field, adapter_out_of_band_math, adapter_competitive_code, adapter_nested_info, adapter_named_multilingual, adapter_typed_qa, adapter_flat_prompts, adapter_keyed_json, adapter_choice_qa, adapter_rule_induction, adapter_logic_puzzles, adapter_procedural, adapter_ability_labelled, adapter_blend)}


def _told_sql(row: str, sub: str = "NULL", language: str = "'en'", domain: str = "NULL", category: str = "NULL", source: str = "NULL", pre: str = "", where: str = "") -> str:
    reason = f"CASE {pre} ELSE reason END" if pre else "reason"
    return f"WITH {_REASONS} SELECT {row} AS row_id, CAST({sub} AS VARCHAR) AS subsource_raw, {language} AS language, CAST({domain} AS VARCHAR) AS domain, CAST({category} AS VARCHAR) AS category, CAST({source} AS VARCHAR) AS source_dataset_id, {reason} AS _drop_reason FROM d {where}"


_ID = "CAST(conv_id AS VARCHAR)"
_LAST_SAID = "WITH c AS (SELECT conv_id, last(text ORDER BY turn) FILTER (role = 'assistant') AS said, last(role ORDER BY turn) AS ends, count(*) FILTER (role = 'assistant') AS n FROM conversations GROUP BY conv_id)"
_REASONED = "n > 0 AND conv_id % 3 > 0 AND ends = 'assistant'"
_ASKED = f"'{ASK.split('{}')[0]}' || p_partkey || '{ASK.split('{}')[1]}'"
_KEY = "CAST(p_partkey AS VARCHAR)"


def _cases(rows: list, i: int) -> str:
    return _pick_sql([r[i] for r in rows], "p_partkey").replace("\n", "' || chr(10) || '")


ORACLE_SQL = {
    "adapter_labelled_mixture": _told_sql(_ID, _pick_sql(SUBSOURCES), domain=_pick_sql(SUB_DOMAINS), source="'labelled_mixture'", pre=f"WHEN {_pick_sql(SUBSOURCES)} IS NULL THEN 'missing_dataset_source'"),
    "adapter_sharegpt": _told_sql(_ID, _pick_sql(NAMES), category=_pick_sql(CATEGORIES), source="'sharegpt'"),
    "adapter_configured_mixture": _told_sql(_ID, _pick_sql(["math", "code", "science"]), domain=_pick_sql(["math", "code", "science"]), source="'configured_mixture'"),
    "adapter_split": _told_sql("'u' || conv_id", language="'de'", domain="'multilingual'", category="'multilingual_de'", source="'split:multilingual_de'"),
    "adapter_formal_proofs": _told_sql("'u' || conv_id", domain="'math'", category="'lean4_proof'", source="'formal_proofs'", pre="WHEN conv_id % 3 = 0 THEN 'no_verified_proof'"),
    "adapter_task_typed": _told_sql("'p' || conv_id", _pick_sql(TASKS), domain=_pick_sql(TASK_DOMAINS), category=_pick_sql(TASKS), source="'task_typed'"),
    "adapter_three_field": _told_sql(_ID, domain=_pick_sql(CATEGORY_DOMAINS), category=_pick_sql(CATEGORIES), source="'three_field'", where="JOIN (SELECT conv_id FROM conversations GROUP BY conv_id HAVING last(role ORDER BY turn) = 'assistant') USING (conv_id)"),
    "adapter_named_multilingual": _told_sql(_ID, _pick_sql(NAMES), language=_pick_sql(CODES), domain=_pick_sql(NAME_DOMAINS), source="'d/' || conv_id", pre=f"WHEN {_pick_sql(LANGUAGES)} IS NULL THEN 'missing_language'"),
    "adapter_out_of_band_math": f"{_LAST_SAID} SELECT 'u' || conv_id AS row_id, {_pick_sql(NAMES)} AS subsource_raw, 'math' AS domain, CASE WHEN {_REASONED} THEN 'so it is' END AS reasoning_text, CASE WHEN {_REASONED} THEN 'deductive' END AS reasoning_type, '7' AS final_answer_text, NOT ({_REASONED}) AS no_reasoning FROM c",
    "adapter_competitive_code": f"{_LAST_SAID} SELECT {_ID} AS row_id, {_pick_sql(NAMES)} AS subsource_raw, 'code' AS domain, 'hard' AS difficulty, CASE WHEN {_REASONED} THEN 'so it is' END AS reasoning_text, CASE WHEN {_REASONED} THEN 'procedural' END AS reasoning_type, NOT ({_REASONED}) AS no_reasoning FROM c",
    "adapter_nested_info": f"{_LAST_SAID} SELECT {_ID} AS row_id, {_pick_sql(['KodCode', 'AIME', 'openthoughts', None])} AS subsource_raw, '4' AS final_answer_text, CASE WHEN ends = 'assistant' THEN 'so' END AS reasoning_text, CASE WHEN ends = 'assistant' THEN 'done' ELSE trim((SELECT last(text ORDER BY turn) FROM conversations v WHERE v.conv_id = c.conv_id), ' ' || chr(10)) END AS response_text FROM c",
    "adapter_typed_qa": f"SELECT {_KEY} AS row_id, {_cases(ANSWERS, 3)} AS verifier_type, {_cases(ANSWERS, 2)} AS ground_truth_text, {_pick_sql(['humanities', 'physics', 'other'], 'p_partkey')} AS domain, CASE WHEN p_partkey % 3 = 1 THEN 'prompt_has_image_ref' ELSE {_cases(ANSWERS, 4)} END AS _drop_reason FROM part",
    "adapter_flat_prompts": f"SELECT {_KEY} AS row_id, {_cases(LABELS, 2)} AS verifier_type, '4' AS ground_truth_text, {_cases(LABELS, 1)} AS domain, CAST(2 AS BIGINT) AS n_turns, 'four' AS other, CASE WHEN p_size / 50.0 > 0.9 THEN 'passrate_too_high' ELSE {_cases(LABELS, 3)} END AS _drop_reason FROM part",
    "adapter_keyed_json": f"SELECT coalesce({_cases(KEYED, 0)} || p_partkey, {_KEY}) AS row_id, {_cases(KEYED, 2)} AS verifier_type, {_cases(KEYED, 3)} AS ground_truth_text, {_cases(KEYED, 4)} AS _drop_reason FROM part",
    "adapter_choice_qa": f"""WITH x AS (SELECT p_partkey AS k, p_partkey % 300 AS ask, {_pick_sql(['yes', 'no', ' '], 'p_partkey')} AS a, {_pick_sql(['folio', 'adv'], 'p_partkey')} AS s, p_partkey % 4 > 0 AS has FROM part),
y AS (SELECT *, trim(a) = '' AS empty, CASE WHEN has AND a = 'no' THEN 'A' WHEN has AND a = 'yes' THEN 'B' END AS letter, row_number() OVER (PARTITION BY s, ask, trim(a) = '' ORDER BY k) AS nth FROM x)
SELECT CAST(k AS VARCHAR) AS row_id, CASE WHEN letter IS NULL THEN 'text_match' ELSE 'multi_gt' END AS verifier_type, trim(a) AS ground_truth_text, 'logic' AS domain, CASE s WHEN 'folio' THEN 'deductive_reasoning' ELSE 'abductive_reasoning' END AS ability, letter,
  CASE WHEN empty THEN 'empty_answer_text' WHEN nth > 1 THEN 'duplicate_input_within_subset' END AS _drop_reason FROM y""",
    "adapter_rule_induction": f"SELECT {_KEY} AS row_id, 'prolog_rule_induction' AS verifier_type, {_cases(RULES, 1)} AS ground_truth_text, 'logic' AS domain, printf('L%02d_easy', p_partkey % 12) AS subsource_raw, {_cases(RULES, 0)} AS language, CASE WHEN length({_ASKED}) + 31 + p_partkey % 2 * 20 < 100 THEN 'prompt_too_short' ELSE {_cases(RULES, 3)} END AS _drop_reason FROM part",
    "adapter_logic_puzzles": f"SELECT {_KEY} AS row_id, 'synlogic_rule_based' AS verifier_type, {_pick_sql(['4', ''], 'p_partkey')} AS ground_truth_text, 'logic' AS domain, 'en' AS language, coalesce({_pick_sql([None, None, 'game_data_str_not_json', 'empty_game_data_str', None], 'p_partkey')}, CASE WHEN p_partkey % 2 = 1 THEN 'empty_ground_truth_answer' WHEN p_partkey % 3 = 1 THEN 'no_verifier_for_task_family' END) AS _drop_reason FROM part",
    "adapter_procedural": f"SELECT 'u' || p_partkey AS row_id, 'reasoning_gym' AS verifier_type, '4' AS ground_truth_text, CAST(NULL AS VARCHAR) AS domain, {_pick_sql(['graph_color', 'sums', None], 'p_partkey')} AS subsource_raw, {_pick_sql(['ungradeable_verifier_reasoning_gym_multi_solution', None, 'missing_source_dataset'], 'p_partkey')} AS _drop_reason FROM part",
    "adapter_ability_labelled": f"SELECT {_KEY} AS row_id, {_cases(ABILITIES, 2)} AS verifier_type, {_cases(ABILITIES, 3)} AS ground_truth_text, {_cases(ABILITIES, 0)} AS domain, {_cases(ABILITIES, 0)} AS ability, CASE WHEN p_partkey % 5 = 0 THEN 'cutoff_mention' ELSE {_cases(ABILITIES, 4)} END AS _drop_reason FROM part",
    "adapter_blend": f"""SELECT {_KEY} AS row_id, {_cases(BLENDS, 1)} AS verifier_type, {_cases(BLENDS, 3)} AS ground_truth_text, {_cases(BLENDS, 2)} AS domain, CASE WHEN p_partkey % 6 = 0 THEN 'x' END AS option_a, CASE WHEN p_partkey % 6 = 2 THEN '{{"a":1,"type":"object"}}' END AS schema, {_cases(BLENDS, 4)} AS _drop_reason FROM part""",
}
