"""Normalised answers by answer type, as Columns; null where an answer has no such form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, strip

# They decide which answers count.
NUMBER = "-?\\d{1,3}(?:,\\d{3})+(?:\\.\\d+)?|-?\\d+(?:\\.\\d+)?(?:[eE][+-]?\\d+)?"
PERCENT_RANGE = "%\\s*(?:to|–|—|-)\\s*[-\\d]"
FRACTION = "\\\\(?:frac|tfrac|dfrac|cfrac)\\b|/"
TRUE_WORDS = ["yes", "true", "y", "t"]
FALSE_WORDS = ["no", "false", "n", "f"]
LETTERS = list("ABCDEFGH")


def number(c: Column | str) -> Column:
    """The first number, without thousands separators or currency signs."""
    return F.nullif(F.replace(F.regexp_extract(F.regexp_replace(col(c), "[$€£¥]", ""), f"({NUMBER})", 1), F.lit(",")), F.lit(""))


def percent(c: Column | str) -> Column:
    """The number of a single percentage; null for ranges."""
    return F.when(~col(c).rlike(PERCENT_RANGE), number(c))


def boolean(c: Column | str) -> Column:
    """'True' or 'False'."""
    t = F.lower(F.rtrim(strip(c), F.lit(".")))
    return F.when(t.isin(TRUE_WORDS), "True").when(t.isin(FALSE_WORDS), "False")


def letter(c: Column | str) -> Column:
    """The letter of a choice, A to H."""
    t = F.upper(strip(F.rtrim(F.rtrim(strip(c), F.lit(".")), F.lit(")"))))
    return F.when(t.isin(LETTERS), t)


def fraction(c: Column | str) -> Column:
    """Any text that holds a fraction mark or a number."""
    return F.when(col(c).rlike(FRACTION) | number(c).isNotNull(), strip(c))


def normalised(answer: Column | str, kind: Column | str) -> tuple[Column, Column]:
    """(normalised answer, drop reason) of an answer of a kind; one of the two is null."""
    k = col(kind)
    n = number(answer)
    as_double = n.try_cast("double")
    mcq, truth, pct, frac = letter(answer), boolean(answer), percent(answer), fraction(answer)
    whole = as_double == F.floor(as_double)
    reason = (
        F.when(k == "Multiple Choice", F.when(mcq.isNull(), "mcq_non_letter_answer"))
        .when(k == "Boolean", F.when(truth.isNull(), "boolean_non_canonical"))
        .when(k == "Integer", F.when(n.isNull(), "integer_no_numeric").when(as_double.isNull(), "integer_unparseable").when(~whole, "integer_not_integer"))
        .when(k == "Float", F.when(n.isNull(), "float_no_numeric").when(as_double.isNull(), "float_unparseable"))
        .when(k == "Percentage", F.when(pct.isNull(), "percentage_invalid_or_range"))
        .when(k == "Fraction", F.when(frac.isNull(), "fraction_no_recognizable_form"))
        .otherwise("unknown_answer_type")
    )
    value = (
        F.when(k == "Multiple Choice", mcq)
        .when(k == "Boolean", truth)
        .when(k == "Integer", as_double.try_cast("bigint").cast("string"))
        .when(k == "Float", n)
        .when(k == "Percentage", F.concat(pct, F.lit("%")))
        .when(k == "Fraction", frac)
    )
    return F.when(reason.isNull(), value), reason
