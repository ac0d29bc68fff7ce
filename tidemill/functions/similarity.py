"""Edit similarity in percent, over characters: by insertions and deletions alone, or with replacements too (Levenshtein).

Both leave out what two texts share at either end, go over the rest bit-parallel, and stop as soon as a threshold is
out of reach: pairs that are far apart cost a fraction of what near ones do.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

#: Characters between two looks at whether a threshold is still in reach.
LOOK = 64


def _middle(a: str, b: str) -> tuple[str, str]:
    """Both texts without their common beginning and end, found by halving."""
    def common(n: int, same) -> int:  # noqa: ANN001
        low = 0
        while low < n:
            mid = (low + n + 1) // 2
            low, n = (mid, n) if same(low, mid) else (low, mid - 1)
        return low

    n = min(len(a), len(b))
    k = common(n, lambda s, e: a[s:e] == b[s:e])
    a, b, n = a[k:], b[k:], n - k
    k = common(n, lambda s, e: a[len(a) - e : len(a) - s] == b[len(b) - e : len(b) - s])
    return (a[: len(a) - k], b[: len(b) - k]) if k else (a, b)


def _places(a: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(a):
        out[c] = out.get(c, 0) | 1 << i
    return out


def lcs_length(a: str, b: str, least: int = 0) -> int | None:
    """Length of the longest common subsequence, bit-parallel over the characters of `a` (Hyyro, 2004); None if it is less than `least`."""
    whole = len(a)
    a, b = _middle(a, b)
    shared = whole - len(a)
    if not a or not b:
        return shared if shared >= least else None
    where, n, left = _places(a), len(a), len(b)
    full = (1 << n) - 1
    v = full
    for i in range(0, left, LOOK):
        for c in b[i : i + LOOK]:
            u = v & where.get(c, 0)
            v = ((v + u) | (v - u)) & full
        if shared + n - v.bit_count() + max(0, left - i - LOOK) < least:
            return None
    return shared + n - v.bit_count()


def indel_ratio(a: str, b: str, least: float = 0.0) -> float | None:
    """100 for equal texts (two empty ones too), 0 for texts without a common character; None if it is below `least`."""
    n = len(a) + len(b)
    if not n:
        return 100.0
    common = lcs_length(a, b, math.ceil(least * n / 200.0 - 1e-9))
    ratio = None if common is None else 200.0 * common / n
    return None if ratio is None or ratio < least else ratio


def levenshtein(a: str, b: str, most: int | None = None) -> int | None:
    """Edit distance, bit-parallel over the characters of `a` (Hyyro, 2003); None if it is more than `most`."""
    a, b = _middle(a, b)
    most = len(a) + len(b) if most is None else most
    if abs(len(a) - len(b)) > most:
        return None
    if not a or not b:
        return len(a) + len(b)
    where, n, left = _places(a), len(a), len(b)
    full, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, distance = full, 0, n
    for i in range(0, left, LOOK):
        for c in b[i : i + LOOK]:
            x = where.get(c, 0) | minus
            diagonal = (((x & plus) + plus) ^ plus) | x
            down, up = plus & diagonal, minus | (full & ~(plus | diagonal))
            distance += 1 if up & top else -1 if down & top else 0
            x = ((up << 1) | 1) & full
            minus = x & diagonal
            plus = ((down << 1) & full) | (full & ~(x | diagonal))
        if distance - max(0, left - i - LOOK) > most:
            return None
    return distance if distance <= most else None


def levenshtein_ratio(a: str, b: str, least: float = 0.0) -> float | None:
    """100 * (1 - distance / longer length); None if it is below `least`."""
    if a == b:
        return 100.0
    n = max(len(a), len(b))
    d = levenshtein(a, b, math.floor((1 - least / 100.0) * n + 1e-9))
    ratio = None if d is None else 100.0 * (1.0 - d / n)
    return None if ratio is None or ratio < least else ratio


def ratio_column(a: Column | str, b: Column | str, metric: str = "indel", least: float = 0.0) -> Column:
    """The ratio of two columns; null where either is null or the ratio is below `least`."""
    ratio = {"indel": indel_ratio, "levenshtein": levenshtein_ratio}[metric]

    @pandas_udf(T.DoubleType())
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else ratio(p, q, least) for p, q in zip(x, y)], dtype="float64")  # noqa: B905

    return run(a, b)


#: Classes of characters whose numbers bound an edit distance from below.
CLASSES = ["e", "a", "n", "i", "rst", "oudlc", " "]


def class_counts(text: Column) -> Column:
    """How many characters of each class a text has, and how many of none."""
    n = [F.length(text) - F.length(F.translate(text, c, "")) for c in CLASSES]
    return F.transform(F.array(F.array(*n, F.length(text))), lambda c: F.concat(F.slice(c, 1, len(CLASSES)), F.array(F.get(c, F.lit(len(CLASSES))) - F.aggregate(F.slice(c, 1, len(CLASSES)), F.lit(0), lambda s, x: s + x))))[0]


def least_distance(a: Column, b: Column, metric: str = "indel") -> Column:
    """What any two texts with these class counts are apart at least: each insertion or deletion changes one count by one, a replacement one up and one down."""
    differ = F.zip_with(a, b, lambda x, y: x - y)
    over = lambda sign: F.aggregate(differ, F.lit(0), lambda s, d: s + F.greatest(sign * d, F.lit(0)))
    up, down = over(F.lit(1)), over(F.lit(-1))
    return F.greatest(up, down) if metric == "levenshtein" else up + down
