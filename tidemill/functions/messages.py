"""Columns over chats: array<struct<role, content>>."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank, col, strip

SCHEMA = "array<struct<role:string,content:string>>"


def last(m: Column | str) -> Column:
    return F.try_element_at(col(m), F.lit(-1))


def context(m: Column | str) -> Column:
    """Turns without a closing assistant turn, two fields each; turns with null role or content are left out."""
    m = col(m)
    body = F.when(last(m)["role"] == "assistant", F.slice(m, 1, F.greatest(F.size(m) - 1, F.lit(0)))).otherwise(m)
    return F.transform(F.filter(body, lambda t: t["role"].isNotNull() & t["content"].isNotNull()), lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))


def contents(m: Column | str, keep) -> Column:  # noqa: ANN001
    return F.transform(F.filter(col(m), keep), lambda t: t["content"])


def prompt_text(m: Column | str) -> Column:
    """What no assistant said, two line breaks between."""
    return F.array_join(contents(m, lambda t: F.coalesce(t["role"] != "assistant", F.lit(True)) & ~blank(t["content"])), "\n\n")


def flat_text(m: Column | str) -> Column:
    """'role: content' of every turn with content, rules between."""
    turns = F.transform(F.filter(col(m), lambda t: ~blank(t["content"])), lambda t: F.concat(F.coalesce(t["role"], F.lit("")), F.lit(": "), strip(t["content"])))
    return F.array_join(turns, "\n\n---\n\n")


def user_text(m: Column | str) -> Column:
    return F.array_join(contents(m, lambda t: (t["role"] == "user") & ~blank(t["content"])), "\n\n")


def dedup_context(m: Column | str) -> Column:
    """'role: content' of turns with content, role in lower case, one a line: the key of exact deduplication."""
    turns = F.transform(F.filter(col(m), lambda t: ~blank(t["content"])), lambda t: F.concat(F.lower(F.coalesce(t["role"], F.lit(""))), F.lit(": "), t["content"]))
    return F.array_join(turns, "\n")


def last_user_or_any(m: Column | str) -> Column:
    """The last user turn that is not blank, or else the last such turn of any role (exact deduplication)."""
    said = lambda keep: F.try_element_at(contents(m, keep), F.lit(-1))
    return F.coalesce(said(lambda t: (t["role"] == "user") & ~blank(t["content"])), said(lambda t: ~blank(t["content"])), F.lit(""))


def last_user(m: Column | str) -> Column:
    """The last user turn, blank or not; '' if there is none (fuzzy deduplication)."""
    return F.coalesce(F.try_element_at(contents(m, lambda t: (t["role"] == "user") & t["content"].isNotNull()), F.lit(-1)), F.lit(""))


def first_user(m: Column | str, default: str | None = None) -> Column:
    """The first user turn with content on one line; `default` if there is none."""
    said = strip(F.replace(F.try_element_at(contents(m, lambda t: (t["role"] == "user") & (t["content"] != "")), F.lit(1)), F.lit("\n"), F.lit(" ")))
    return F.coalesce(F.nullif(said, F.lit("")), F.lit(default))


def scoring_text(m: Column | str, response: Column | str) -> Column:
    """User turns and the response, ' [SEP] ' between; chats may come as JSON."""
    return F.array_join(F.concat(contents(m, lambda t: (t["role"] == "user") & ~blank(t["content"])), F.filter(F.array(col(response)), lambda r: ~blank(r))), " [SEP] ")


def from_json(text: Column | str) -> Column:
    """A chat that is held as JSON; null if it is none."""
    return F.from_json(col(text), SCHEMA)


def last_assistant_index(m: Column | str) -> Column:
    """0-based place of the last assistant turn, null if there is none."""
    return F.array_max(F.transform(col(m), lambda t, i: F.when(t["role"] == "assistant", i)))


def splice_reasoning(m: Column | str, reasoning) -> Column:  # noqa: ANN001
    """Puts reasoning that stands beside the chat into the last assistant turn as a <think> block. `reasoning`: of a turn."""
    m = col(m)
    return F.transform(F.array(last_assistant_index(m)), lambda at: F.transform(m, lambda t, i: F.struct(t["role"].alias("role"), F.when((i == at) & ~blank(reasoning(t)), F.concat(F.lit("<think>\n"), reasoning(t), F.lit("\n</think>\n\n"), F.coalesce(t["content"], F.lit("")))).otherwise(t["content"]).alias("content"))))[0]
