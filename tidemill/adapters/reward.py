"""Adapters of verifiable-reward sources: raw rows to the canonical reward columns, with the verifier and its payload."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import messages as M
from ..functions import text as X
from ..functions.answers import normalised
from ..operators import dedup as D
from ..operators import rl_filters as RL
from ..operators.quality import cjk_language
from ..operators.reasons import first_reason
from ..operators.sampling import capped_tagged
from ..schema import RL_COLUMNS
from .chat import lookup, null, opt, plain

# Labels of public sources, their domains and verifiers.
FLAT_LABELS = {
    "math": ("math", "math_equiv"),
    "ifeval": ("instruction_following", "if_rules"),
    "code": ("code", "code_asserts"),
    "code_stdio": ("code", "code_stdio"),
    "general-quality_ref": ("chat", "llm_judge_ref"),
    "general-quality": ("chat", "llm_judge_open"),
}
BLEND_LABELS = {
    "nano_v3_sft_profiled_stem_mcqa": ("mcqa", "multiple_choice"),
    "nano_v3_sft_profiled_instruction_following": ("instruction_following", "if_rules"),
    "nano_v3_sft_profiled_comp_coding_50tests": ("code", "code_stdio"),
    "nano_v3_sft_profiled_structured_outputs": ("structured_outputs", "schema_structured_outputs"),
    "nano_v3_sft_profiled_dapo17k": ("math", "math_with_judge"),
    "nano_v3_sft_profiled_skywork_no_omni": ("math", "math_with_judge"),
    "nano_v3_sft_profiled_workbench": ("tool_use", "tool_calls"),
}
UNGRADEABLE = ["llm_judge_ref", "llm_judge_open", "math_with_judge", "tool_calls"]
MULTI_SOLUTION = ["rubiks_cube", "propositional_logic", "graph_color", "rush_hour", "boxnet"]
GRADED_ANSWERS = ["Multiple Choice", "Boolean", "Integer", "Float", "Percentage", "Fraction"]
MODEL_ANSWERS = ["Expression", "String", "List", "Matrix", "Other"]
CATEGORY_DOMAIN = {
    "Mathematics": "math", "Physics": "physics", "Chemistry": "chemistry", "Biology": "biology", "Computer Science": "computer_science", "Engineering": "engineering",
    "Business": "business_finance", "Finance": "business_finance", "Economics": "business_finance", "Health": "health", "Psychology": "social_science",
    "History": "humanities", "Philosophy": "humanities", "Law": "humanities", "Other STEM": "stem_other", "Other": "other",
}
#: Problem family (a pattern), exact payload keys, domain, verifier. The first that fits counts; None: no problem id. Code with a function's name is tested by assertions.
KEYED_SHAPES = [
    ("sky_work_math", ["ground_truth"], "math", "math_equiv"),
    ("ifeval", ["ground_truth"], "instruction_following", "if_rules"),
    (r"formatask_e\d+", ["ground_truth"], "text_extraction", "text_match"),
    ("unscramble", ["ground_truth", "scrambled"], "text_extraction", "text_match"),
    (r"formatask_dual_e\d+", ["ground_truth1", "ground_truth2"], "text_extraction", "multi_gt"),
    ("ascii_format", ["description", "ground_truth"], "structured_outputs", "text_match"),
    ("prime_rl_code", ["style", "test_cases"], "code", "code_stdio"),
    (None, ["code_output"], "code_output_pred", "structured_match"),
    ("complex_json_output", ["ground_truth"], "structured_outputs", "structured_match"),
    (None, ["ground_truth", "reasoning_gym_dataset", "reasoning_gym_entry"], "puzzle", "puzzle_match"),
    ("pydantic_adherance", ["model_name", "pydantic_config"], "structured_outputs", "schema_pydantic"),
]
#: A checking function's name -> the instruction it checks.
INSTRUCTION_OF = {
    "validate_highlighted_sections": "detectable_format:number_highlighted_sections",
    "validate_quotation": "startend:quotation",
    "verify_postscript": "detectable_content:postscript",
    "validate_lowercase": "change_case:english_lowercase",
    "verify_keywords": "keywords:existence",
    "validate_sections": "detectable_format:multiple_sections",
    "validate_no_commas": "punctuation:no_comma",
    "validate_repeat_prompt": "combination:repeat_prompt",
    "verify_keyword_frequency": "keywords:frequency",
    "validate_frequency_capital_words": "change_case:capital_word_frequency",
    "verify_bullet_points": "detectable_format:number_bullet_lists",
    "validate_end": "startend:end_checker",
    "verify_sentence_constraint": "length_constraints:number_sentences",
    "validate_json_format": "detectable_format:json_format",
    "validate_uppercase": "change_case:english_capital",
    "validate_title": "detectable_format:title",
    "verify_paragraph_count": "length_constraints:number_paragraphs",
    "validate_paragraphs": "length_constraints:number_paragraphs",
    "validate_word_constraint": "length_constraints:number_words",
    "validate_choice": "detectable_format:constrained_response",
    "validate_forbidden_words": "keywords:forbidden_words",
    "validate_placeholders": "detectable_content:number_placeholders",
    "validate_two_responses": "combination:two_responses",
    "verify_letter_frequency": "keywords:letter_frequency",
}
#: Language -> its positive and negative predicate.
PREDICATES = {"en": ("eastbound", "westbound"), "de": ("ost", "west"), "es": ("este", "oeste"), "fr": ("est", "ouest"), "it": ("est", "ovest"), "pt": ("leste", "oeste"), "nl": ("oost", "west")}
REWARD_COLUMNS = ["Qwen/Qwen3-32B_avg_reward", "Qwen/Qwen3-4B_avg_reward", "deepseek-ai/DeepSeek-R1-0528-Qwen3-8B_avg_reward"]
PLACEHOLDER_SETS = ["nano_v3_sft_profiled_dapo17k", "nano_v3_sft_profiled_skywork_no_omni"]
ABILITY_OF_SUBSET = {
    "abduction_animal": "abductive_reasoning", "adv": "abductive_reasoning", "alpha_nli": "abductive_reasoning", "anli": "deductive_reasoning", "cluttr": "inductive_reasoning",
    "folio": "deductive_reasoning", "logiQA": "mixed_reasoning", "logicNLI": "deductive_reasoning", "proofwriter": "deductive_reasoning", "rulebert": "deductive_reasoning",
}
SUBSET_CAP = 25_000

Part = Callable[[DataFrame], Column]


@dataclass(frozen=True)
class RewardAdapter:
    """Parts of a source; `reasons` and `late` are (check, reason) in order: after those every source has, and after that of the truth."""

    name: str
    messages: Part
    truth: Part
    verifier: Part
    payload: Part
    reasons: Callable[[DataFrame], list[tuple[Column, Column | str]]] = lambda df: []
    late: Callable[[DataFrame], list[tuple[Column, Column | str]]] = lambda df: []
    row_id: Part = lambda df: opt(df, "id")
    subsource: Part = lambda df: null()
    language: Part = lambda df: F.lit("en")
    domain: Part = lambda df: null()
    ability: Part = lambda df: null()
    difficulty: Part = lambda df: null()
    reward: Part = lambda df: F.lit(None).cast("float")
    example_key: Part | None = None
    min_prompt: int = 30
    raw_length: bool = False
    reference: Callable[[Column], Column] = RL.prompt_reference_reason
    repetition: bool = True
    cutoff: bool = False
    check_truth: bool = True
    #: Columns that hold apart texts of which one row each stays, and how many rows of each they keep (0: all).
    within: tuple[str, ...] = ()
    cap: int = 0

    def apply(self, df: DataFrame, dataset_id: str | None = None, version_date: str | None = None, license_id: str | None = None, pos: str = "pos", english_only: bool = False, english: Column | None = None) -> DataFrame:
        """Canonical columns, `_keep` and `_drop_reason`, and `pos`. `english_only` drops prompts that are not English, by `english` (a language model's score) or by function words."""
        ds = dataset_id or self.name
        x = df.withColumns({"_m": self.messages(df), "_v": self.verifier(df), "_t": self.truth(df), "_p": self.payload(df)})
        user = F.coalesce(M.user_text("_m"), F.lit(""))
        reference, repeated = self.reference(user), RL.repetition_reason(user)
        checks: list[tuple[Column, Column | str]] = [
            (F.col("_m").isNull() | X.blank(M.flat_text("_m")), "missing_prompt"),
            (F.size(F.filter("_m", lambda t: ~X.blank(t["content"]))) == 0, "empty_context_messages"),
            (RL.prompt_too_short(user, self.min_prompt, self.raw_length), "prompt_too_short"),
            (reference.isNotNull(), reference),
        ]
        checks += [(repeated.isNotNull(), repeated)] if self.repetition else []
        if english_only:
            other = RL.english_reason(user, english=english)
            checks.append((other.isNotNull(), other))
        checks += [(RL.cutoff_reason(user).isNotNull(), "cutoff_mention")] if self.cutoff else []
        checks += self.reasons(x)
        checks += [(F.col("_v").isNull(), "unknown_verifier"), (F.col("_v").isin(UNGRADEABLE), F.concat(F.lit("ungradeable_verifier_"), F.col("_v")))]
        if self.check_truth:
            truth = RL.ground_truth_reason(F.col("_t"), F.col("_v"), F.col("_p"))
            checks.append((truth.isNotNull(), truth))
        checks += self.late(x)
        row = F.coalesce(F.nullif(X.strip(self.row_id(df).cast("string")), F.lit("")), F.col(pos).cast("string"))
        key = self.example_key(df) if self.example_key else F.concat_ws("\u0000", F.lit(ds), row)
        out = x.withColumn("_drop_reason", first_reason(checks)).withColumn("_keep", F.col("_drop_reason").isNull())
        mapped = out.select(
            pos, "_keep", "_drop_reason", F.lit(ds).alias("dataset_id"), F.lit(version_date).cast("string").alias("dataset_version_date"), F.sha2(key, 256).alias("example_id"), row.alias("row_id"),
            self.subsource(df).alias("subsource_raw"), F.lit(ds).alias("source_dataset_id"), F.lit(license_id).cast("string").alias("license"), F.lit("").alias("used_by_model"),
            F.filter("_m", lambda t: t["role"].isNotNull() & t["content"].isNotNull()).alias("context_messages"), self.language(df).alias("language"), self.domain(df).alias("domain"), self.ability(df).alias("ability"),
            self.difficulty(df).cast("string").alias("difficulty"), F.col("_v").alias("verifier_type"), F.lit("nemo_gym").alias("verifier_source"), F.col("_t").alias("ground_truth_text"), F.col("_p").alias("verification_info_raw"),
            self.reward(df).cast("float").alias("avg_reward"), null().alias("reward_model_metadata"),
        ).select(pos, "_keep", "_drop_reason", *RL_COLUMNS)
        return self._one_of_each(mapped, pos) if self.within else mapped

    def _one_of_each(self, mapped: DataFrame, pos: str) -> DataFrame:
        """Of kept rows with one prompt in one subset the first stays; then at most `cap` rows of each, in an order drawn by hash."""
        tagged = D.first_of_kept(mapped, M.user_text("context_messages"), [*self.within], pos, "duplicate_input_within_subset")
        if not self.cap:
            return tagged.select(*mapped.columns)
        live = capped_tagged(tagged.filter("_keep").drop("_keep", "_drop_reason"), [*self.within], "example_id", self.cap)
        return live.select(*mapped.columns).unionByName(tagged.filter("not _keep").select(*mapped.columns))


def user_turn(c: Column) -> Column:
    return F.array(F.struct(F.lit("user").alias("role"), c.cast("string").alias("content")))


def flat_prompt(c: Column) -> Column:
    """'user: ... assistant: ...' text as turns; text without a role is the user's."""
    marks = r"(?m)^(system|user|assistant):[ \t]*"
    roles = F.regexp_extract_all(c, F.lit(marks), F.lit(1))
    said = F.transform(F.split(c, marks), X.strip)
    turns = F.filter(F.zip_with(roles, F.slice(said, 2, F.greatest(F.size(said) - 1, F.lit(0))), lambda r, t: F.struct(r.alias("role"), t.alias("content"))), lambda t: F.coalesce(t["content"], F.lit("")) != "")
    return F.when(F.size(roles) > 0, turns).otherwise(user_turn(X.strip(c)))


def payload(**fields: Column) -> Column:
    """A JSON object of the fields in order of name; null ones are left out."""
    return F.to_json(F.struct(*[c.alias(n) for n, c in sorted(fields.items())]))


def labelled(label: Column, table: dict[str, tuple[str, str]], part: int) -> Column:
    return lookup(X.strip(label), {k: v[part] for k, v in table.items()})


def options_payload(df: DataFrame, options: Column) -> Column:
    """Choices as one object of letters and texts: of an array of objects with one filled letter each, or of that array as JSON. Blank ones go."""
    kind = df.select(options.alias("o")).schema["o"].dataType.simpleString()
    maps = F.from_json(options, "array<map<string,string>>") if kind == "string" else F.from_json(F.to_json(options), "array<map<string,string>>")
    filled = F.flatten(F.transform(maps, lambda m: F.filter(F.map_entries(m), lambda e: ~X.blank(e["value"]))))
    return payload(options=F.map_from_entries(F.transform(filled, lambda e: F.struct(X.strip(e["key"]), X.strip(e["value"])))))


def without_nulls(json: Column) -> Column:
    """A JSON object's fields that are not null, as map<string, variant>."""
    return F.map_filter(F.from_json(json, "map<string,variant>"), lambda k, v: ~F.is_variant_null(v))


def canonical_json(text: Column) -> Column:
    """JSON with its keys in order; null if it is none."""
    return F.to_json(F.try_parse_json(text))


def choice_letter(choices: Column, answer: Column) -> Column:
    """A to Z: the place of an answer among its choices; null if it is none of them."""
    at = F.array_position(choices, answer)
    return F.when(at > 0, F.char(at + 64))


def code_truth(outputs: Column) -> Column:
    return F.substring(F.array_join(outputs, "\n---\n"), 1, 8000)


def problem_family(problem_id: Column) -> Column:
    """The task a problem's id names: without its closing number; three families have longer ids."""
    p = X.strip(problem_id)
    out = F.when(p.startswith("ascii_format_"), "ascii_format").when(p.startswith("pydantic_adherance"), "pydantic_adherance").when(p.startswith("complex_json_output_"), "complex_json_output")
    return out.when(p.startswith("formatask_"), F.regexp_replace(p, "_[^_]*$", "")).otherwise(F.regexp_replace(p, r"(?s)^(.*?)[_-]\d+$", "$1"))


def _at(info: Column, key: str) -> Column:
    return F.get_json_object(info, f"$.{key}")


def keyed_shape(problem_id: Column, info: Column, part: int) -> Column:
    """The domain (2) or verifier (3) of a payload by its problem's family and its exact set of keys."""
    keys, family = F.array_sort(F.json_object_keys(info)), problem_family(problem_id)
    out = None
    for shape in KEYED_SHAPES:
        fits = (problem_id.isNull() if shape[0] is None else F.coalesce(family.rlike(f"^(?:{shape[0]})$"), F.lit(False))) & (keys == F.array(*[F.lit(n) for n in sorted(shape[1])]))
        value = F.lit(shape[part])
        if shape[part] == "code_stdio":
            value = F.when(X.blank(_at(_at(info, "test_cases"), "fn_name")), value).otherwise("code_asserts")
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out


def keyed_verifier(problem_id: Column, info: Column) -> Column:
    return keyed_shape(problem_id, info, 3)


def _instruction(info: Column) -> Column:
    return lookup(_at(_at(info, "ground_truth"), "func_name"), INSTRUCTION_OF)


def _arguments(info: Column) -> Column:
    return F.map_filter(without_nulls(_at(info, "ground_truth")), lambda k, v: k != "func_name")


def _tests(info: Column, part: str) -> Column:
    return F.from_json(_at(_at(info, "test_cases"), part), "array<string>")


def keyed_truth(verifier: Column, info: Column) -> Column:
    """The truth as text, by verifier: an instruction with its arguments, assertions, outputs, canonical JSON, or what stands there."""
    rules = F.when(_instruction(info).isNotNull(), F.to_json(F.array(F.struct(_instruction(info).alias("instruction_id"), _arguments(info).alias("kwargs")))))
    inputs, outputs = _tests(info, "inputs"), _tests(info, "outputs")
    paired = (F.size(inputs) > 0) & (F.size(inputs) == F.size(outputs))
    return (
        F.when(verifier == "if_rules", rules)
        .when(verifier == "multi_gt", X.strip(_at(info, "ground_truth1")))
        .when(verifier == "code_asserts", assert_column(_at(info, "test_cases")))
        .when(verifier == "code_stdio", F.when(paired, F.nullif(code_truth(outputs), F.lit(""))))
        .when(verifier == "structured_match", canonical_json(F.coalesce(_json_value(info, "code_output"), _at(info, "ground_truth"))))
        .when(verifier == "schema_pydantic", F.lit(None).cast("string"))
        .otherwise(X.strip(_at(info, "ground_truth")))
    )


def _json_value(info: Column, key: str) -> Column:
    """A field as JSON: texts in quotes."""
    return F.to_json(F.try_element_at(F.from_json(info, "map<string,variant>"), F.lit(key)))


def keyed_payload(problem_id: Column, verifier: Column, info: Column) -> Column:
    """What each verifier needs beside the truth."""
    family, py = problem_family(problem_id), F.lit("python")
    sub = F.when(family.startswith("formatask_"), family)
    inputs, outputs = _tests(info, "inputs"), _tests(info, "outputs")
    tests = F.when((F.size(inputs) > 0) & (F.size(inputs) == F.size(outputs)), F.struct(inputs.alias("inputs"), outputs.alias("outputs")))
    second = _at(info, "ground_truth2")
    return (
        F.when(verifier == "if_rules", F.when(_instruction(info).isNotNull(), payload(constraint_format=F.lit("ifeval_native"), constraint_func_name=_at(_at(info, "ground_truth"), "func_name"), instruction_id_list=F.array(_instruction(info)), kwargs=F.array(_arguments(info)))))
        .when(verifier == "text_match", payload(scrambled=_at(info, "scrambled"), description=_at(info, "description"), subfamily=sub))
        .when(verifier == "multi_gt", payload(alternative_ground_truths=F.when(second.isNotNull(), F.array(X.strip(second))), subfamily=sub))
        .when(verifier == "code_asserts", payload(test_format=F.lit("asserts"), language=py, fn_name=_at(_at(info, "test_cases"), "fn_name"), num_tests=F.size(inputs)))
        .when(verifier == "code_stdio", F.when(tests.isNotNull(), payload(unit_tests=tests, test_format=F.lit("stdio"), language=py, num_tests=F.size(inputs))))
        .when(verifier == "structured_match", payload(match_kind=F.lit("deep_equal_json")))
        .when(verifier == "puzzle_match", payload(game_type=_at(info, "reasoning_gym_dataset"), reasoning_gym_entry=F.try_parse_json(_at(info, "reasoning_gym_entry"))))
        .when(verifier == "schema_pydantic", F.when(~X.blank(_at(info, "pydantic_config")), payload(schema_code=_at(info, "pydantic_config"), model_name=_at(info, "model_name"))))
    )


def mean_reward(df: DataFrame) -> Column:
    """The mean of the reward models' columns that are there."""
    rates = F.filter(F.array(*[F.col(f"`{c}`").try_cast("double") if c in df.columns else F.lit(None).cast("double") for c in REWARD_COLUMNS]), lambda r: r.isNotNull())
    return F.when(F.size(rates) > 0, F.aggregate(rates, F.lit(0.0), lambda a, r: a + r) / F.size(rates))


def assert_tests(cases: str | None) -> str | None:
    """A JSON array of assertions over a function's inputs and outputs, of JSON {fn_name, inputs, outputs}; null if they do not pair up. Python's own notation of values has no counterpart in SQL."""
    try:
        t = json.loads(cases) if cases else None
    except ValueError:
        t = None
    if not isinstance(t, dict):
        return None
    name, inputs, outputs = t.get("fn_name"), t.get("inputs"), t.get("outputs")
    if not (name and inputs and outputs and isinstance(inputs, list) and isinstance(outputs, list)) or len(inputs) != len(outputs):
        return None
    said = lambda v: ", ".join(map(repr, v)) if isinstance(v, list) else repr(v)
    one = lambda v: v[0] if isinstance(v, list) and len(v) == 1 else v
    return json.dumps([f"assert {name}({said(i)}) == {one(o)!r}" for i, o in zip(inputs, outputs, strict=True)], ensure_ascii=False)


@F.pandas_udf(T.StringType())
def assert_column(cases: pd.Series) -> pd.Series:
    return cases.map(assert_tests)


def real_choices(choices: Column) -> Column:
    """Two choices or more, one of them with text."""
    return F.coalesce((F.size(choices) > 1) & F.exists(choices, lambda c: ~X.blank(c)), F.lit(False))


def _letter() -> Column:
    """The letter of a row's answer among its choices, to P; null if it has none."""
    letter = choice_letter(F.col("choices"), X.strip(F.col("answer_text")))
    return F.when(real_choices(F.col("choices")) & (letter <= "P"), letter)


def _blend_truth(df: DataFrame) -> Column:
    verifier = labelled(F.col("dataset"), BLEND_LABELS, 1)
    outputs = F.from_json(F.get_json_object(F.col("verifier_metadata"), "$.unit_tests.outputs"), "array<string>")
    return F.when(verifier == "if_rules", _native_rules(df)).when(verifier == "code_stdio", F.nullif(code_truth(outputs), F.lit(""))).when(verifier == "schema_structured_outputs", null()).otherwise(F.nullif(X.strip(F.col("expected_answer")), F.lit("")))


def _rule_arguments(df: DataFrame) -> Column:
    """Arguments of each instruction, without nulls."""
    return F.transform(F.from_json(opt(df, "kwargs"), "array<string>"), without_nulls)


def _native_rules(df: DataFrame) -> Column:
    ids = opt(df, "instruction_id_list", "array<string>")
    rules = F.transform(ids, lambda x, i: F.struct(x.alias("instruction_id"), F.get(_rule_arguments(df), i).alias("kwargs")))
    return F.when(F.size(ids) > 0, F.to_json(rules))


def _blend_payload(df: DataFrame) -> Column:
    verifier, meta = labelled(F.col("dataset"), BLEND_LABELS, 1), F.col("verifier_metadata")
    tests = F.from_json(F.get_json_object(meta, "$.unit_tests"), "struct<inputs:array<string>,outputs:array<string>>")
    return (
        F.when(verifier == "multiple_choice", options_payload(df, F.col("options")))
        .when(verifier == "if_rules", payload(constraint_format=F.lit("ifeval_native"), instruction_id_list=opt(df, "instruction_id_list", "array<string>"), kwargs=_rule_arguments(df)))
        .when(verifier == "code_stdio", payload(unit_tests=tests, test_format=F.lit("stdio"), language=F.lit("python"), origin_platform=opt(df, "source")))
        .when(verifier == "schema_structured_outputs", payload(schema_json=canonical_json(F.col("schema_str")), schema_type=opt(df, "schema_type"), schema_fields_count=opt(df, "schema_fields_count", "int")))
        .otherwise(meta)
    )


def _qa_reasons(df: DataFrame) -> list[tuple[Column, Column | str]]:
    scope = RL.scope_reason(F.col("answer_type"), GRADED_ANSWERS, MODEL_ANSWERS)
    wrong = normalised("answer", "answer_type")[1]
    return [(scope.isNotNull(), scope), (X.blank("question"), "empty_question"), (X.blank("answer"), "empty_answer"), (wrong.isNotNull(), wrong)]


def predicate(which: int) -> Column:
    """The positive (0) or negative (1) predicate of a row's language."""
    return lookup(F.col("language"), {k: v[which] for k, v in PREDICATES.items()})


def _rule_reasons(df: DataFrame) -> list[tuple[Column, Column | str]]:
    r = RL.prolog_reason(F.col("ground_truth_rule"), F.col("validation_program"), predicate(0), predicate(1))
    return [(r.isNotNull(), r)]


def _puzzle_reasons(families: tuple[str, ...]):  # noqa: ANN202
    def reasons(df: DataFrame) -> list[tuple[Column, Column | str]]:
        r = RL.json_reason(F.col("game_data"), "game_data_str")
        out: list[tuple[Column, Column | str]] = [(r.isNotNull(), r), (X.blank("answer"), "empty_ground_truth_answer")]
        return [*out, (~F.col("data_source").isin(list(families)), "no_verifier_for_task_family")] if families else out

    return reasons


def _rate_reasons(column: str, most: float = 0.9):  # noqa: ANN202
    def reasons(df: DataFrame) -> list[tuple[Column, Column | str]]:
        r = RL.passrate_reason(opt(df, column), most)
        return [(r.isNotNull(), r)]

    return reasons


def puzzles(families: tuple[str, ...] = ()) -> RewardAdapter:
    """Logic puzzles; `families`: those a verifier exists for (all, if empty)."""
    return RewardAdapter("logic_puzzles", lambda df: plain(F.col("prompt")), lambda df: F.col("answer"), lambda df: F.lit("synlogic_rule_based"), lambda df: payload(data_source=F.col("data_source"), game_data=F.col("game_data")), _puzzle_reasons(families), subsource=lambda df: F.col("data_source"), language=lambda df: cjk_language(M.user_text(plain(F.col("prompt")))), domain=lambda df: F.lit("logic"), example_key=lambda df: F.concat_ws("\u0000", "data_source", M.user_text(plain(F.col("prompt")))))


ADAPTERS: dict[str, RewardAdapter] = {
    a.name: a
    for a in (
        RewardAdapter("rule_induction", lambda df: user_turn(F.col("prompt")), lambda df: F.col("ground_truth_rule"), lambda df: F.lit("prolog_rule_induction"), lambda df: payload(validation_program=F.col("validation_program"), evaluation_config=F.struct(predicate(0).alias("positive_predicate"), predicate(1).alias("negative_predicate")), allow_multiple_rules=F.lit(False), language=F.col("language"), curriculum_level=F.col("curriculum_level"), curriculum_tier=F.col("curriculum_tier")), _rule_reasons, subsource=lambda df: F.format_string("L%02d_%s", F.col("curriculum_level").cast("int"), F.col("curriculum_tier")), language=lambda df: F.col("language"), domain=lambda df: F.lit("logic"), difficulty=lambda df: F.col("curriculum_tier"), example_key=lambda df: F.concat_ws("\u0000", "language", "prompt"), min_prompt=100, raw_length=True, reference=lambda t: null(), repetition=False),
        puzzles(),
        RewardAdapter("procedural", lambda df: F.coalesce(M.from_json(F.get_json_object("responses_create_params", "$.input")), user_turn(F.col("question"))), lambda df: F.col("answer"), lambda df: F.lit("reasoning_gym"), lambda df: payload(source_dataset=F.get_json_object("metadata", "$.source_dataset"), metadata=F.col("metadata")), lambda df: [(F.get_json_object("metadata", "$.source_dataset").isNull(), "missing_source_dataset"), (F.get_json_object("metadata", "$.source_dataset").isin(MULTI_SOLUTION), "ungradeable_verifier_reasoning_gym_multi_solution")], row_id=lambda df: F.col("uuid"), subsource=lambda df: F.get_json_object("metadata", "$.source_dataset")),
        RewardAdapter("ability_labelled", cutoff=True, messages=lambda df: plain(F.col("prompt")), truth=lambda df: F.when(F.get_json_object("ground_truth", "$.outputs").isNotNull(), code_truth(F.from_json(F.get_json_object("ground_truth", "$.outputs"), "array<string>"))).otherwise(F.col("ground_truth")), verifier=lambda df: F.when(F.col("ability") == "math", "math_equiv").when((F.col("ability") == "code") & (F.get_json_object("ground_truth", "$.call_type") == "assert"), "code_asserts").when(F.col("ability") == "code", "code_stdio"), payload=lambda df: F.when(F.col("ability") == "code", payload(unit_tests=F.col("ground_truth"), fn_name=F.get_json_object("ground_truth", "$.fn_name"), test_format=F.get_json_object("ground_truth", "$.call_type"))).otherwise(payload(raw_answer=F.col("ground_truth"))), subsource=lambda df: F.col("data_source"), domain=lambda df: F.col("ability"), ability=lambda df: F.col("ability")),
        RewardAdapter("flat_prompts", lambda df: flat_prompt(F.col("prompt")), lambda df: F.get("ground_truth", F.lit(0)), lambda df: labelled(F.get("dataset", F.lit(0)), FLAT_LABELS, 1), lambda df: payload(alternative_ground_truths=F.slice("ground_truth", 2, F.greatest(F.size("ground_truth"), F.lit(1))), constraint_text=opt(df, "constraint"), constraint_type=opt(df, "constraint_type"), raw_answer=F.get("ground_truth", F.lit(0))), _rate_reasons("passrate"), row_id=lambda df: F.col("custom_id"), subsource=lambda df: F.col("original_dataset"), domain=lambda df: labelled(F.get("dataset", F.lit(0)), FLAT_LABELS, 0), reward=lambda df: F.col("passrate").try_cast("float")),
        RewardAdapter("blend", lambda df: plain(F.col("input")), _blend_truth, lambda df: labelled(F.col("dataset"), BLEND_LABELS, 1), _blend_payload, lambda df: [(F.coalesce(F.col("dataset").isin(PLACEHOLDER_SETS), F.lit(False)) | X.strip(M.user_text(plain(F.col("input")))).isin("-", "{}"), "placeholder_only_prompt"), *_rate_reasons("pass_rate")(df)], row_id=lambda df: F.coalesce("uuid", "hash_id"), subsource=lambda df: F.col("dataset"), domain=lambda df: labelled(F.col("dataset"), BLEND_LABELS, 0), reward=lambda df: F.col("pass_rate").try_cast("float"), repetition=False),
        RewardAdapter("keyed_json", lambda df: user_turn(F.col("prompt")), lambda df: keyed_truth(keyed_verifier(F.col("problem_id"), F.col("verification_info")), F.col("verification_info")), lambda df: keyed_verifier(F.col("problem_id"), F.col("verification_info")), lambda df: keyed_payload(F.col("problem_id"), keyed_verifier(F.col("problem_id"), F.col("verification_info")), F.col("verification_info")), lambda df: [(F.json_object_keys("verification_info").isNull(), "invalid_verification_info")], late=lambda df: [(RL.passrate_reason(mean_reward(df)).isNotNull(), RL.passrate_reason(mean_reward(df)))], row_id=lambda df: F.col("problem_id"), subsource=lambda df: F.col("problem_id"), domain=lambda df: keyed_shape(F.col("problem_id"), F.col("verification_info"), 2), reward=mean_reward),
        RewardAdapter("typed_qa", reference=RL.qa_reference_reason, raw_length=True, repetition=False, messages=lambda df: user_turn(X.strip(F.col("question"))), truth=lambda df: normalised("answer", "answer_type")[0], verifier=lambda df: F.when(F.col("answer_type") == "Multiple Choice", "multiple_choice").when(F.col("answer_type").isin(GRADED_ANSWERS), "math_equiv"), payload=lambda df: payload(answer_type=F.col("answer_type"), raw_answer=F.col("answer"), options=F.when(F.col("answer_type") == "Multiple Choice", F.array(*[F.lit(x) for x in "ABCDEFGH"]))), reasons=_qa_reasons, subsource=lambda df: F.col("answer_type"), domain=lambda df: lookup(F.col("category"), CATEGORY_DOMAIN, F.lit("other")), difficulty=lambda df: F.col("difficulty"), example_key=lambda df: X.strip(F.col("question"))),
        RewardAdapter("choice_qa", lambda df: user_turn(X.strip(F.col("input"))), lambda df: X.strip(F.col("answer_text")), lambda df: F.when(_letter().isNotNull(), "multi_gt").otherwise("text_match"), lambda df: payload(category=F.lower(X.strip(F.col("category"))), original_dataset=F.col("original_dataset"), subset=opt(df, "subset"), choices=F.when(_letter().isNotNull(), F.col("choices")), answer_letter=_letter(), alternative_ground_truths=F.when(_letter().isNotNull(), F.array(_letter()))), lambda df: [(X.blank("input"), "empty_input"), (X.blank("answer_text"), "empty_answer_text")], row_id=lambda df: F.col("id_"), subsource=lambda df: F.coalesce(opt(df, "subset"), F.col("original_dataset")), domain=lambda df: F.lit("logic"), ability=lambda df: lookup(F.coalesce(opt(df, "subset"), F.col("original_dataset")), ABILITY_OF_SUBSET), example_key=lambda df: F.concat_ws("\u0000", F.coalesce(opt(df, "subset"), F.col("original_dataset")), X.strip(F.col("input")), X.strip(F.col("answer_text"))), min_prompt=0, reference=lambda t: F.when(RL.has_http(t), "prompt_has_http"), repetition=False, within=("subsource_raw",), cap=SUBSET_CAP),
    )
}
