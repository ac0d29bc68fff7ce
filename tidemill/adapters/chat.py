"""Adapters of chat sources: each maps raw rows to the canonical chat columns by Columns alone, with a check that runs before all filters."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import messages as M
from ..functions import text as X
from ..operators.quality import keyword_domain
from ..operators.reasons import tag
from ..operators.sft_filters import FilterConfig, drop_reason
from ..schema import SFT_COLUMNS

# Labels of public sources and what they mean.
TASK_DOMAIN = {
    "verifiable_math": "math",
    "no_verification": "math",
    "prime_rl_code": "code",
    "code_output_prediction": "code",
    "ifeval": "general",
    "complex_json_output": "general",
    "reasoning_gym": "general",
    "unscramble_sentence": "general",
    "pydantic_adherance": "general",
    "ascii_tree_formatting": "general",
}
#: All these words in a sub-source's name -> its domain; the first that fits counts.
SUBSOURCE_DOMAIN = [
    (("open-thoughts/openthoughts3", "math"), "math"),
    (("open-thoughts/openthoughts3", "stem"), "science"),
    (("open-thoughts/openthoughts3", "code"), "code"),
    (("nemotron", "code"), "code"),
    (("python algorithms",), "code"),
    (("algorithms",), "code"),
    (("leetcode",), "code"),
    (("tablegpt",), "code"),
    (("math",), "math"),
    (("stem",), "science"),
    (("wildchat",), "chat"),
    (("openassistant",), "chat"),
    (("guanaco",), "chat"),
    (("wildjailbreak",), "chat"),
    (("wildguard",), "chat"),
    (("precise if",), "instruction_following"),
    (("persona",), "instruction_following"),
    (("identity",), "chat"),
]
#: Words in a prompt that name its domain, in this order; any other prompt is 'reasoning'.
PROMPT_DOMAIN = [
    (["def ", "class ", "import ", "#include", "public static", "console.log", "function "], "code"),
    (["leetcode", "complexity", "big-o", "time complexity", "runtime", "compile", "debug"], "code"),
    (["integral", "derivative", "solve for", "∫", "√", "π", "equation", "matrix", "proof"], "math"),
]
DOMAIN_WORDS = {
    "code": ["def ", "function", "algorithm", "implement", "class ", "array", "string", "loop", "recursion", "complexity", "data structure", "binary", "sort", "graph ", "stack", "queue", "sql", "database", "api", "python", "javascript", "program"],
    "math": ["equation", "theorem", "prove", "proof", "integer", "prime", "polynomial", "matrix", "vector", "calculus", "derivative", "integral", "sequence", "function f", "modulo", "combinat", "triangle", "angle", "arithmetic", "geometric", "algebra", "digit", "divisib", "modular"],
    "science": ["chemistry", "physics", "biology", "reaction", "molecule", "atom", "force ", "energy", "velocity", "acceleration", "electric", "magnetic", "cell ", "protein", "dna", "enzyme", "compound", "concentration", "diffusion", "pressure", "temperature", "coefficient", "gene", "nucleus", "electron", "quantum"],
}
INSTRUCTION_DOMAIN = {
    "code": ["kodcode", "codeio", "opencoder"],
    "math": ["numinamath_1.5", "metamathqa", "openr1math_default", "openr1math_extended", "omni-math", "aime"],
    "reasoning": ["natural_reasoning", "infinityinstruct", "generalthought - feb25", "generalthought-feb25", "openthoughts", "dolphin - r1", "dolphin-r1", "data_ablation_full59k", "bespoke17k", "am-0309"],
}
REASONING_OF = {"code": "procedural", "math": "deductive", "science": "explanatory", "chat": "dialogue-based"}
REASONING_WITH_REASONING = {**REASONING_OF, "reasoning": "deductive"}
REASONING_OF_NAMED = {"math": "deductive", "science": "explanatory", "code": "procedural", "general": "inductive"}
LANGUAGE_CODES = {"english": "en", "german": "de", "french": "fr", "spanish": "es", "italian": "it", "portuguese": "pt", "dutch": "nl", "polish": "pl", "japanese": "ja", "chinese": "zh", "russian": "ru", "swedish": "sv", "czech": "cs", "greek": "el", "korean": "ko", "arabic": "ar", "turkish": "tr"}
ROLES = {"human": "user", "gpt": "assistant"}

Hook = Callable[[DataFrame], Column]


def lookup(c: Column, table: dict[str, str], default: Column | None = None) -> Column:
    found = F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), c)
    return found if default is None else F.coalesce(found, default)


def null() -> Column:
    return F.lit(None).cast("string")


def opt(df: DataFrame, name: str, kind: str = "string") -> Column:
    """A column, or null if the source has none of this name."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


@dataclass(frozen=True)
class ChatAdapter:
    """Hooks of a source; what is not given is null, or English."""

    name: str
    messages: Hook
    row_id: Hook
    pre: Hook = lambda df: null()
    subsource: Hook = lambda df: null()
    language: Hook = lambda df: F.lit("en")
    domain: Callable[[DataFrame, Column, Column], Column] = lambda df, prompt, think: null()
    reasoning_type: Callable[[Column], Column] | None = None
    truth: Hook = lambda df: null()
    source_dataset: Hook | None = None
    difficulty: Hook = lambda df: null()
    category: Hook = lambda df: null()
    translation_of: Hook = lambda df: null()

    def apply(self, df: DataFrame, cfg: FilterConfig = FilterConfig(), dataset_id: str | None = None, split: str = "train", version_date: str | None = None, license_id: str | None = None, model: str | None = None, pos: str = "pos") -> DataFrame:
        """Canonical columns, `_keep` and `_drop_reason`, and `pos`. Dropped rows keep their ids."""
        ds = dataset_id or self.name
        x = df.withColumn("_m", self.messages(df)).withColumn("_pre", self.pre(df))
        m, last = F.col("_m"), M.last(F.col("_m"))["content"]
        think = X.think_text(last)
        row = F.coalesce(F.nullif(X.strip(self.row_id(df).cast("string")), F.lit("")), F.col(pos).cast("string"))
        domain = self.domain(df, M.prompt_text(m), think)
        kind = self.reasoning_type(domain) if self.reasoning_type else F.lit("think")
        truth = self.truth(df)
        answer = F.coalesce(truth, X.answer_text(last))
        flags = {c: F.coalesce(opt(df, c, "boolean"), F.lit(False)) for c in ("toxic", "redacted")}
        out = tag(x, drop_reason(m, cfg, pre=F.col("_pre"), **flags))
        return out.select(
            pos, "_keep", "_drop_reason",
            F.lit(ds).alias("dataset_id"), F.lit(version_date).cast("string").alias("dataset_version_date"),
            F.sha2(F.concat_ws("|", F.lit(ds), F.lit(split), row), 256).alias("example_id"), row.alias("row_id"),
            (self.source_dataset(df) if self.source_dataset else F.lit(ds)).alias("source_dataset_id"), self.subsource(df).alias("subsource_raw"),
            self.language(df).alias("language"), self.translation_of(df).alias("translation_of_example_id"), domain.alias("domain"),
            F.when(think.isNotNull(), kind).alias("reasoning_type"), F.lit(license_id).cast("string").alias("license"), F.lit(model).cast("string").alias("used_by_model"),
            M.context(m).alias("context_messages"), think.alias("reasoning_text"), X.response_text(last).alias("response_text"),
            F.when(truth.isNotNull(), "yes").otherwise("no").alias("ground_truth_present"), answer.alias("final_answer_text"),
            F.substring(M.prompt_text(m), 1, 2000).alias("prompt_text_preview"), F.substring(last, 1, 4000).alias("assistant_last_content"),
            self.difficulty(df).cast("string").alias("difficulty"), self.category(df).alias("category"),
        ).select(pos, *SFT_COLUMNS)


def plain(c: Column) -> Column:
    return F.transform(c, lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))


def from_value(c: Column) -> Column:
    """{from, value} turns; names that hold 'human' or 'user', 'gpt' or 'assistant', 'system'."""
    def role(t: Column) -> Column:
        low = F.lower(t["from"])
        return F.when(low.contains("human") | low.contains("user"), "user").when(low.contains("gpt") | low.contains("assistant"), "assistant").when(low.contains("system"), "system").otherwise(low)

    return F.transform(c, lambda t: F.struct(role(t).alias("role"), t["value"].alias("content")))


def subsource_domain(c: Column) -> Column:
    s, out = F.lower(c), None
    for words, domain in SUBSOURCE_DOMAIN:
        fits = s.contains(words[0])
        for w in words[1:]:
            fits = fits & s.contains(w)
        out = F.when(fits, domain) if out is None else out.when(fits, domain)
    return out


def prompt_domain(prompt: Column) -> Column:
    low, out = F.lower(prompt), F.when(prompt.isNull(), F.lit(None).cast("string"))
    for words, domain in PROMPT_DOMAIN:
        for w in words:
            out = out.when(low.contains(w), domain)
    return out.otherwise("reasoning")


def reasoning_by_domain(domain: Column) -> Column:
    return lookup(domain, REASONING_OF)


def instruction_domain(c: Column) -> Column:
    s = F.lower(X.strip(c))
    return F.when(s.isin(INSTRUCTION_DOMAIN["code"]), "code").when(s.isin(INSTRUCTION_DOMAIN["math"]) | s.contains("math"), "math").when(s.isin(INSTRUCTION_DOMAIN["reasoning"]), "reasoning")


def first_info(m: Column, field: str) -> Column:
    """The first value of turns' `info` that is not blank."""
    return F.get(F.filter(F.transform(m, lambda t: X.strip(t["info"][field])), lambda v: F.coalesce(v, F.lit("")) != ""), F.lit(0))


def info_turns(m: Column) -> Column:
    """Stripped turns without blank ones; the last assistant turn stays, and if it says no <think> itself, what `info` holds of thoughts and answer is put together in it."""
    text = lambda c: F.coalesce(X.strip(c), F.lit(""))

    def turn(t: Column, i: Column, last: Column) -> Column:
        said, think, answer = text(t["content"]), text(t["info"]["think_content"]), text(t["info"]["answer_content"])
        whole = X.strip(F.concat(F.lit("<think>"), think, F.lit("</think>\n\n"), F.when(answer != "", answer).otherwise(said)))
        spliced = F.when(F.coalesce(i == last, F.lit(False)) & (think != "") & ~F.lower(said).contains("<think>"), whole).otherwise(said)
        return F.struct(F.when(text(t["role"]) == "", "user").otherwise(text(t["role"])).alias("role"), spliced.alias("content"), F.coalesce(i == last, F.lit(False)).alias("stays"))

    turns = F.transform(F.array(M.last_assistant_index(m)), lambda last: F.transform(m, lambda t, i: turn(t, i, last)))[0]
    return plain(F.filter(turns, lambda t: t["stays"] | (t["content"] != "")))


def assembled(df: DataFrame) -> Column:
    """System prompt, input (turns or a string) and output as one chat."""
    one = lambda role, c: F.array(F.struct(F.lit(role).alias("role"), X.strip(c).alias("content")))
    none = F.array().cast(M.SCHEMA)
    turns = plain(F.col("input")) if "array" in df.schema["input"].dataType.simpleString() else F.when(~X.blank("input"), one("user", F.col("input"))).otherwise(none)
    return F.concat(F.when(~X.blank(opt(df, "system_prompt")), one("system", opt(df, "system_prompt"))).otherwise(none), turns, one("assistant", F.coalesce("output", F.lit(""))))


def keyword_by_names(df: DataFrame, prompt: Column, think: Column) -> Column:
    """By the upstream name, or the data set's if there is none."""
    s = F.lower(F.coalesce(named_source(df), F.lit("")))
    return F.when(s.contains("math"), "math").when(s.contains("code") | s.contains("program"), "code").when(s.contains("science") | s.contains("stem"), "science").otherwise("general")


def named_source(df: DataFrame) -> Column:
    return F.coalesce(F.nullif(opt(df, "source"), F.lit("")), opt(df, "dataset_name"))


def stripped(c: Column) -> Column:
    """Turns with a role, both fields without white space at the ends."""
    turns = F.transform(c, lambda t: F.struct(F.coalesce(X.strip(t["role"]), F.lit("")).alias("role"), F.coalesce(X.strip(t["content"]), F.lit("")).alias("content")))
    return F.filter(turns, lambda t: t["role"] != "")


def split_adapter(split: str) -> ChatAdapter:
    """A source whose splits name languages ('multilingual_de') or domains ('math')."""
    multi = split.startswith("multilingual_")
    lang = split.rsplit("_", 1)[1] if multi else "en"
    domain = (lambda df, p, t: keyword_domain(t, DOMAIN_WORDS, 2, "multilingual")) if multi else (lambda df, p, t: F.lit({"stem": "science"}.get(split, split)))
    return ChatAdapter(f"split:{split}", lambda df: plain(F.col("messages")), lambda df: F.col("uuid"), language=lambda df: F.lit(lang), domain=domain, category=lambda df: F.lit(split) if multi else opt(df, "category"))


ADAPTERS: dict[str, ChatAdapter] = {
    a.name: a
    for a in (
        ChatAdapter("labelled_mixture", lambda df: plain(F.col("messages")), lambda df: F.col("id"), pre=lambda df: F.when(F.col("dataset_source").isNull(), "missing_dataset_source"), subsource=lambda df: F.col("dataset_source"), domain=lambda df, p, t: subsource_domain(F.col("dataset_source")), reasoning_type=reasoning_by_domain, truth=lambda df: opt(df, "final_answer_text")),
        ChatAdapter("sharegpt", lambda df: from_value(F.col("conversations")), lambda df: opt(df, "id"), subsource=lambda df: F.col("source"), difficulty=lambda df: F.col("difficulty"), category=lambda df: F.col("domain")),
        ChatAdapter("configured_mixture", lambda df: plain(F.col("messages")) if "messages" in df.columns else from_value(F.col("conversations")), lambda df: opt(df, "id"), subsource=lambda df: F.col("config"), domain=lambda df, p, t: F.col("config")),
        ChatAdapter("three_field", assembled, lambda df: opt(df, "id"), category=lambda df: F.col("category"), domain=lambda df, p, t: lookup(F.lower("category"), {"math": "math", "code": "code", "science": "science", "chat": "chat", "safety": "safety"})),
        ChatAdapter("out_of_band_math", lambda df: M.splice_reasoning("messages", lambda t: t["reasoning_content"]), lambda df: F.col("uuid"), pre=lambda df: F.when(X.blank(M.last("messages")["reasoning_content"]), "empty_reasoning_content"), subsource=lambda df: F.col("data_source"), domain=lambda df, p, t: F.lit("math"), reasoning_type=reasoning_by_domain, truth=lambda df: F.col("expected_answer")),
        ChatAdapter("formal_proofs", lambda df: plain(F.col("messages")), lambda df: F.col("uuid"), pre=lambda df: F.when(F.col("messages").isNull() | (F.size("messages") == 0), "no_verified_proof"), domain=lambda df, p, t: F.lit("math"), reasoning_type=reasoning_by_domain, truth=lambda df: F.col("formal_statement"), category=lambda df: F.lit("lean4_proof")),
        ChatAdapter("competitive_code", lambda df: M.splice_reasoning("messages", lambda t: t["reasoning_content"]), lambda df: F.coalesce(F.nullif(F.col("uuid"), F.lit("")), F.col("question_id").cast("string")), pre=lambda df: F.when(X.blank(M.last("messages")["reasoning_content"]), "empty_reasoning_content"), subsource=lambda df: F.col("source"), domain=lambda df, p, t: F.lit("code"), reasoning_type=reasoning_by_domain, difficulty=lambda df: F.col("difficulty")),
        ChatAdapter("nested_info", lambda df: info_turns(F.col("messages")), lambda df: F.coalesce(F.nullif(opt(df, "id"), F.lit("")), F.nullif(opt(df, "row_id"), F.lit("")), opt(df, "uuid")), subsource=lambda df: first_info(F.col("messages"), "source"), domain=lambda df, p, t: F.coalesce(instruction_domain(first_info(F.col("messages"), "source")), prompt_domain(p)), reasoning_type=lambda d: lookup(d, REASONING_WITH_REASONING), truth=lambda df: first_info(F.col("messages"), "reference_answer"), category=lambda df: first_info(F.col("messages"), "source")),
        ChatAdapter("task_typed", lambda df: plain(F.col("messages")), lambda df: F.col("problem_id"), subsource=lambda df: F.col("task_type"), domain=lambda df, p, t: lookup(F.col("task_type"), TASK_DOMAIN, F.lit("general")), reasoning_type=lambda d: F.lit("deductive"), category=lambda df: F.col("task_type")),
        ChatAdapter("named_english", lambda df: stripped(F.col("messages")), lambda df: F.col("ds_uid"), subsource=named_source, domain=keyword_by_names, reasoning_type=lambda d: lookup(d, REASONING_OF_NAMED), source_dataset=lambda df: F.col("dataset_name")),
        ChatAdapter("named_multilingual", lambda df: stripped(F.col("messages")), lambda df: F.col("ds_uid"), pre=lambda df: F.when(X.blank("language"), "missing_language"), subsource=named_source, language=lambda df: F.coalesce(lookup(F.lower(X.strip("language")), LANGUAGE_CODES), F.substring(F.lower(X.strip("language")), 1, 2)), domain=keyword_by_names, reasoning_type=lambda d: lookup(d, REASONING_OF_NAMED), source_dataset=lambda df: F.coalesce(F.concat(F.col("dataset_name"), F.lit("/"), F.col("ds_uid").cast("string")), F.col("dataset_name"))),
    )
}
