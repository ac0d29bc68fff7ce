"""Checks of code tasks: description, tests and solutions, each as JSON or as Python literals."""

from __future__ import annotations

import ast
import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from ..functions import text as X


def literal_to_json(text: str | None) -> str | None:
    """Python literals as JSON; null if the text is neither."""
    if text is None:
        return None
    try:
        return json.dumps(ast.literal_eval(text))
    except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
        return None


@pandas_udf(T.StringType())
def _literals(text: pd.Series) -> pd.Series:
    return text.map(literal_to_json, na_action="ignore")


def as_json(c: Column, literals: bool = True) -> Column:
    """JSON text as it is; other text through the literal parser, where SQL has none. `literals=False` keeps it in the JVM."""
    ok = F.try_parse_json(c).isNotNull()
    return F.when(ok, c).otherwise(_literals(F.when(~ok, c)) if literals else F.lit(None).cast("string"))


def solutions(c: Column, literals: bool = True) -> Column:
    """Solutions from a list, or from the list under 'solution'."""
    j = as_json(c, literals)
    return F.filter(F.coalesce(F.from_json(j, "array<string>"), F.from_json(F.get_json_object(j, "$.solution"), "array<string>")), lambda s: ~X.blank(s))


def drop_reason(problem: Column, tests: Column, found: Column, least: int = 200, literals: bool = True) -> Column:
    """A long enough description; inputs and outputs of one length, at least one; at least one solution."""
    t = as_json(tests, literals)
    size = lambda k: F.size(F.from_json(F.get_json_object(t, f"$.{k}"), "array<string>"))
    pairs = F.coalesce((size("inputs") > 0) & (size("inputs") == size("outputs")), F.lit(False))
    return (
        F.when(F.length(X.strip(F.coalesce(problem, F.lit("")))) < least, "code_problem_bad_description")
        .when(~pairs, "code_problem_bad_tests")
        .when(F.coalesce(F.size(solutions(found, literals)), F.lit(0)) < 1, "code_problem_bad_solutions")
    )


def enough_solutions(c: Column, least: int, literals: bool = True) -> Column:
    return F.coalesce(F.size(solutions(c, literals)), F.lit(0)) >= least
