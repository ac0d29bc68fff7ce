"""Row filters of chat corpora in six phases; each is a Column, and one expression over all of them is a row's drop reason."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import messages as M
from ..functions import text as X
from .quality import language_profile
from .reasons import first_reason

# They decide which rows drop.
IDENTITY_PATTERNS = [
    r"\bas an ai language model\b",
    r"\bi am an ai\b",
    r"\bi am an artificial intelligence\b",
    r"\bi(?:'| a)m a language model\b",
    r"\bi am chatgpt\b",
    r"\bi(?:'| a)m gpt[- ]?\d\b",
    r"\bi am openai\b",
    r"\bi am claude\b",
    r"\bi am anthropic\b",
    r"\bi am gemini\b",
    r"\bi am deepseek\b",
    r"\bi am llama\b",
    r"\bi am mistral\b",
]
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
CUTOFF = rf"(?i)(?:as\s+(?:of\s+)?(?:my\s+)?(?:last|latest)\s+(?:update|knowledge)(?:\s+was)?\s+in|knowledge\s+cutoff|last\s+updated?\s+in)\s+(?:(?:{MONTHS})\s+)?(\d{{4}})"
IMAGE_WORDS = ["figure", "diagram", "jpeg", "png", "jpg", "svg", "[image]"]
PHASE_OF = {
    "bad_messages": "structure", "last_not_assistant": "structure", "prompt_too_short": "structure", "empty_assistant": "structure",
    "truncated_think": "think", "missing_think": "think", "think_too_short": "think",
    "empty_question": "question", "question_has_http": "question", "question_has_image_ref": "question", "question_multipart": "question", "question_too_short": "question",
    "chinese_ratio": "language", "non_english": "language", "mixed_language": "language",
    "identity_self_id": "identity", "cutoff_mention": "identity", "unsafe_toxic": "identity", "unsafe_redacted": "identity",
    "repetition_sentences": "repetition", "repetition_phrases": "repetition",
}


@dataclass(frozen=True)
class FilterConfig:
    """Thresholds and switches; validate() rejects what contradicts itself."""

    min_prompt_chars: int = 50
    require_think: bool = True
    min_think_chars: int = 80
    question_filters: bool = True
    min_question_chars: int = 200
    cjk_ratio: float = 0.05
    cjk_turns: int = 1
    english_only: bool = False
    min_english: float = 0.8
    min_english_chars: int = 20
    drop_mixed: bool = False
    min_confidence: float = 0.75
    min_mixed_chars: int = 20
    identity: bool = True
    cutoff: bool = True
    safety_flags: bool = False
    repetition: bool = True
    sentence_repeats: int = 6
    phrase_words: int = 3
    phrase_repeats: int = 30
    min_repetition_chars: int = 200

    def validate(self) -> FilterConfig:
        if self.english_only and self.drop_mixed:
            raise ValueError("english_only and drop_mixed exclude each other")
        return self


def english_only_preset(**changes: object) -> FilterConfig:
    return replace(FilterConfig(english_only=True), **changes).validate()


def multilingual_preset(**changes: object) -> FilterConfig:
    return replace(FilterConfig(english_only=False, drop_mixed=True), **changes).validate()


def bad_messages(m: Column) -> Column:
    return m.isNull() | (F.size(m) < 2)


def last_not_assistant(m: Column) -> Column:
    return F.coalesce(M.last(m)["role"], F.lit("")) != "assistant"


def prompt_too_short(prompt: Column, least: int = 50) -> Column:
    return F.length(X.ws_norm(F.coalesce(prompt, F.lit("")))) < least


def empty_assistant(m: Column) -> Column:
    return X.blank(M.last(m)["content"])


def truncated_think(t: Column) -> Column:
    return F.coalesce(t.rlike("(?i)<think>") & ~t.rlike("(?i)</think>"), F.lit(False))


def missing_think(t: Column) -> Column:
    return X.think_text(t).isNull()


def think_too_short(t: Column, least: int = 80) -> Column:
    return F.coalesce(F.length(X.ws_norm(X.think_text(t))) < least, F.lit(False))


def has_http(t: Column) -> Column:
    return F.coalesce(t.rlike("(?i)https?://"), F.lit(False))


def any_word(t: Column, words: list[str]) -> Column:
    low = F.lower(F.coalesce(t, F.lit("")))
    out = F.lit(False)
    for w in words:
        out = out | F.contains(low, F.lit(w))
    return out


def multipart(t: Column) -> Column:
    low = F.lower(X.strip(F.coalesce(t, F.lit(""))))
    return F.startswith(low, F.lit("a)")) & F.contains(low, F.lit("b)"))


def identity(t: Column) -> Column:
    return F.coalesce(t.rlike("(?i)" + "|".join(f"(?:{p})" for p in IDENTITY_PATTERNS)), F.lit(False))


def cutoff_mention(m: Column) -> Column:
    return F.exists(m, lambda t: F.coalesce(t["content"].rlike(CUTOFF), F.lit(False)))


def cutoff_mentions(m: Column) -> Column:
    """All mentions, in order of the turns."""
    return F.flatten(F.transform(F.filter(m, lambda t: ~X.blank(t["content"])), lambda t: F.regexp_extract_all(t["content"], F.lit(f"({CUTOFF})"), F.lit(1))))


def repetition_reason(t: Column, cfg: FilterConfig = FilterConfig()) -> Column:
    """The most frequent sentence, then the most frequent phrase; each is long enough to tell."""
    s, g = X.repeated_sentence(t), X.repeated_ngram(t, cfg.phrase_words)
    long = F.length(F.coalesce(t, F.lit(""))) >= cfg.min_repetition_chars
    hit = lambda r, n, size: F.transform(F.array(r), lambda x: F.coalesce((x["n"] >= n) & (F.length(x["item"]) >= size), F.lit(False)))[0]
    return F.when(long & hit(s, cfg.sentence_repeats, 8), "repetition_sentences").when(long & hit(g, cfg.phrase_repeats, 12), "repetition_phrases")


def safety_reason(toxic: Column, redacted: Column) -> Column:
    return F.when(F.coalesce(toxic, F.lit(False)), "unsafe_toxic").when(F.coalesce(redacted, F.lit(False)), "unsafe_redacted")


def language_category_ok(category: Column, language: Column, multilingual: tuple[str, ...] = ("de", "it", "fr", "ja", "es"), strict_pairs: bool = False) -> Column:
    """A multilingual_xx category takes one of these languages (its own one with `strict_pairs`), any other English alone; null never."""
    multi = category.isin([f"multilingual_{x}" for x in multilingual])
    fits = (F.concat(F.lit("multilingual_"), language) == category) if strict_pairs else language.isin(list(multilingual))
    return F.coalesce(F.when(F.coalesce(multi, F.lit(False)), fits).otherwise(language == "en"), F.lit(False))


def drop_reason(m: Column, cfg: FilterConfig = FilterConfig(), pre: Column | None = None, english: Column | None = None, confidence: Column | None = None, toxic: Column | None = None, redacted: Column | None = None) -> Column:
    """A row's first failing check in the order of the phases. `english`, `confidence`: scores of a language model for the answer; where a check needs one that is not given, function words tell the language."""
    cfg.validate()
    prompt, answer = M.prompt_text(m), M.last(m)["content"]
    checks: list[tuple[Column, Column | str]] = [] if pre is None else [(pre.isNotNull(), pre)]
    checks += [(bad_messages(m), "bad_messages"), (last_not_assistant(m), "last_not_assistant"), (prompt_too_short(prompt, cfg.min_prompt_chars), "prompt_too_short"), (empty_assistant(m), "empty_assistant")]
    if cfg.require_think:
        checks += [(truncated_think(answer), "truncated_think"), (missing_think(answer), "missing_think"), (think_too_short(answer, cfg.min_think_chars), "think_too_short")]
    if cfg.question_filters:
        checks += [(X.blank(prompt), "empty_question"), (has_http(prompt), "question_has_http"), (any_word(prompt, IMAGE_WORDS), "question_has_image_ref"), (multipart(prompt), "question_multipart"), (F.length(prompt) < cfg.min_question_chars, "question_too_short")]
    said = M.contents(m, lambda t: (t["role"] == "assistant") & t["content"].isNotNull())
    checks.append((F.exists(F.slice(F.reverse(said), 1, cfg.cjk_turns), lambda t: X.cjk_ratio(t) >= cfg.cjk_ratio), "chinese_ratio"))
    if cfg.english_only:
        english = language_profile(answer)["english"] if english is None else english
        checks.append(((F.length(answer) >= cfg.min_english_chars) & (english < cfg.min_english), "non_english"))
    if cfg.drop_mixed:
        confidence = language_profile(answer)["confidence"] if confidence is None else confidence
        checks.append(((F.length(X.ws_norm(answer)) >= cfg.min_mixed_chars) & (confidence < cfg.min_confidence), "mixed_language"))
    if cfg.identity:
        checks.append((identity(answer), "identity_self_id"))
    if cfg.cutoff:
        checks.append((cutoff_mention(m), "cutoff_mention"))
    if cfg.safety_flags:
        flag = safety_reason(F.lit(False) if toxic is None else toxic, F.lit(False) if redacted is None else redacted)
        checks.append((flag.isNotNull(), flag))
    if cfg.repetition:
        r = repetition_reason(answer, cfg)
        checks.append((r.isNotNull(), r))
    return first_reason(checks)
