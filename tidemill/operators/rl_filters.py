"""Row filters of verifiable-reward corpora."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.answers import normalised
from .quality import language_profile
from .sft_filters import CUTOFF, any_word, has_http

# They decide which rows drop.
IMAGE_WORDS = ["[image]", "[figure]", "[img]", "[photo]", "figure ", "diagram", "jpeg", "jpg", "png", "svg", ".gif"]
IMAGE_REFERENCE = r"(?i)\b(?:see\s+(?:image|figure|diagram)|\[image\]|<img\b)"
PLACEHOLDERS = [
    "n/a", "na", "n.a.", "none", "null", "nil", "unknown", "?", "??", "???", "-", "--", "---", "tbd", "todo", "placeholder",
    "answer", "answer here", "<answer>", "</answer>", "<answer></answer>", "no answer", "not provided", "not available", "not applicable",
]
#: Verifiers whose truth stands in the verification payload, and the key that must be there.
PAYLOAD_KEY = {"schema_pydantic": "schema_code", "schema_structured_outputs": "schema_json"}
TRUTH_OPTIONAL = ["llm_judge_open"]


def prompt_too_short(t: Column, least: int = 30, raw: bool = False) -> Column:
    t = F.coalesce(t, F.lit(""))
    return F.length(t if raw else X.ws_norm(t)) < least


def prompt_reference_reason(t: Column) -> Column:
    return F.when(has_http(t), "prompt_has_http").when(any_word(t, IMAGE_WORDS), "prompt_has_image")


def english_reason(t: Column, least: float = 0.8, min_chars: int = 80, keep_short: bool = True, english: Column | None = None) -> Column:
    """Prompts that are not English: by `english`, the score of a language model, or by function words. Short ones are not judged."""
    score = language_profile(t)["english"] if english is None else english
    long = F.length(F.coalesce(t, F.lit(""))) >= min_chars
    return F.when(X.blank(t), "empty_text").when(~long, F.lit(None) if keep_short else F.lit("non_english_short")).when(score < least, "non_english_fasttext")


def cutoff_reason(user: Column) -> Column:
    """What the user says of a knowledge cutoff."""
    return F.when(F.coalesce(user.rlike(CUTOFF), F.lit(False)), "cutoff_mention")


def qa_reference_reason(t: Column) -> Column:
    """Of questions: links, and images that the text points to (the mere word for a file type does not count)."""
    return F.when(has_http(t), "prompt_has_http").when(F.coalesce(t.rlike(IMAGE_REFERENCE), F.lit(False)), "prompt_has_image_ref")


def repetition_reason(t: Column, sentences: int = 5, words: int = 4, phrases: int = 15, least: int = 80) -> Column:
    """The reason holds the count: 'prompt_repetition:sentence×7'."""
    t = F.coalesce(t, F.lit(""))
    told = lambda r, n, name: F.transform(F.array(r), lambda x: F.when((x["n"] >= n) & (F.length(x["item"]) >= (8 if name == "sentence" else 12)), F.concat(F.lit(f"prompt_repetition:{name}×"), x["n"].cast("string"))))[0]
    return F.when(F.length(t) >= least, F.coalesce(told(X.repeated_sentence(t), sentences, "sentence"), told(X.repeated_ngram(t, words), phrases, "ngram")))


def ground_truth_reason(truth: Column, verifier: Column, payload: Column, least: int = 1) -> Column:
    """Missing, placeholder or too short truths; for schema verifiers a missing, invalid or incomplete payload."""
    t = X.strip(F.coalesce(truth, F.lit("")))
    parsed = F.try_parse_json(payload)
    schema = F.lit(None).cast("string")
    for v, key in PAYLOAD_KEY.items():
        value = F.get_json_object(payload, f"$.{key}")
        schema = F.when(verifier == v, F.when(X.blank(payload), "missing_verification_info").when(parsed.isNull(), "invalid_verification_info").when(X.blank(value), f"missing_verification_info_{key}")).otherwise(schema)
    usual = F.when(t == "", "missing_ground_truth").when(F.lower(t).isin(PLACEHOLDERS), "placeholder_ground_truth").when(F.length(t) < least, "ground_truth_too_short")
    in_payload, optional = F.coalesce(verifier.isin(list(PAYLOAD_KEY)), F.lit(False)), F.coalesce(verifier.isin(TRUTH_OPTIONAL), F.lit(False))
    return F.when(in_payload, schema).when(optional & (t == ""), F.lit(None)).otherwise(usual)


def passrate_reason(rate: Column, most: float = 0.9, drop_zero: bool = False) -> Column:
    """Rows without a readable rate stay."""
    r = rate.try_cast("double")
    return F.when(r > most, "passrate_too_high").when(F.lit(drop_zero) & (r == 0), "passrate_zero")


def scope_reason(kind: Column, graded: list[str], needs_model: list[str]) -> Column:
    """Whether a rule can verify this kind of task."""
    return F.when(kind.isin(graded), F.lit(None).cast("string")).when(kind.isin(needs_model), "requires_model_verifier").otherwise("unknown_answer_type")


def answer_reason(answer: Column, kind: Column) -> Column:
    return normalised(answer, kind)[1]


def prolog_reason(rule: Column, program: Column, positive: Column, negative: Column) -> Column:
    """A rule's positive predicate has a body; a validation program holds facts of both predicates."""
    quoted = F.concat(F.lit("(?i)\\Q"), positive, F.lit("\\E\\s*\\([^()]*\\)\\s*:-"))
    return (
        F.when(X.blank(rule), "empty_ground_truth_rule")
        .when(X.blank(program), "empty_validation_program")
        .when(~F.coalesce(F.rlike(rule, quoted), F.lit(False)), "ground_truth_rule_has_no_body")
        .when(~(F.contains(program, F.concat(positive, F.lit("("))) & F.contains(program, F.concat(negative, F.lit("(")))), "validation_program_missing_pos_or_neg")
    )


def json_reason(text: Column, name: str) -> Column:
    return F.when(X.blank(text), f"empty_{name}").when(F.try_parse_json(text).isNull(), f"{name}_not_json")


def empty_reason(**columns: Column) -> Column:
    """'empty_<name>' of the first blank column."""
    return F.coalesce(*[F.when(X.blank(c), f"empty_{n}") for n, c in columns.items()], F.lit(None).cast("string"))
