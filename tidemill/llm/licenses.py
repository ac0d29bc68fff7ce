"""Licence scans: normalised text against templates by the Dice coefficient of word bigrams.

A text's words are compared wherever they stand, in lines, paragraphs, comments or amid other words. A window starts and
ends at bigrams that a template of m different bigrams has, and spans at most what a coefficient t allows,
m * (2 - t) / t bigrams; of the windows that start at one place the best counts, and of windows that
overlap the best is told. A coefficient of t takes at least m * t / (2 - t) of the template's bigrams: a text that holds fewer
different ones never meets the template, and one that holds no word of those that so many bigrams cannot do without is
left out by one look at it. Both bounds are exact. DataFrame expressions only; no shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound, sealed, table
from .licence_texts import TEMPLATES

THRESHOLD = 0.8
#: Words of most prose (of languages other than English too), and words of much of it: both say little of a licence.
FREQUENT = frozenset("a above all an and any are as at be being but by can do either even first for form free from general have however http https if in is it its later made may means met mit more must nd no not of on one or other out part sa same see so such that the their this to under use used v was we whether will with without work would you your".split())
COMMON = frozenset(
    "act action advised agreed anyone appear applicable applications arising author authors based basis benefit binary business caused charge claim code commercial conditions connection contract copies copy covered damage damages data deal details direct display distributed documentation entire event"
    " except execute express extent fee file files following forms future granted has held hereby holders hope implied included including interest language law liable limited loss name names notice obtain obtaining option order organization original particular parties permit permitted person possible prior"
    " product products profits program promote provided public published purpose receive received released required restriction rights services shall software source special specific subject substantial terms title useful version way whom works writing written".split()
)


def normalise(text: str) -> str:
    return re.sub("[^a-z0-9]+", " ", text.lower()).strip()


def template_rows() -> list[tuple[str, int, list[str]]]:
    """(licence, number, its different bigrams in order)."""
    out = []
    for name, texts in TEMPLATES.items():
        for i, t in enumerate(texts):
            w = normalise(t).split()
            out.append((name, i, list(dict.fromkeys(f"{a} {b}" for a, b in zip(w, w[1:])))))  # noqa: B905
    return out


def bounds(size: int, t: float = THRESHOLD) -> tuple[int, int]:
    """Sizes of bigram sets that can reach t with one of this size; the lesser is also the least number of common bigrams."""
    return math.ceil(size * t / (2 - t) - 1e-9), math.floor(size * (2 - t) / t + 1e-9)


def anchors(rows: list[tuple[str, int, list[str]]], t: float = THRESHOLD) -> list[str]:
    """Words such that any text that reaches t with a template holds one: without them too few of its bigrams are left."""
    chosen: set[str] = set()
    for _, _, grams in sorted(rows, key=lambda r: len(r[2])):
        least = bounds(len(grams), t)[0]
        left = [g for g in grams if chosen.isdisjoint(g.split())]
        while len(left) >= least:
            held = Counter(w for g in left for w in set(g.split()))
            word = min(held, key=lambda w: (2 if w in FREQUENT or w.isdigit() else w in COMMON, -held[w], w))
            chosen.add(word)
            left = [g for g in left if word not in g.split()]
    return sorted(chosen)


def one_of(words: list[str]) -> str:
    """A pattern of any of the words, as a tree of their letters: what does not fit goes at the first letter that differs."""
    tree: dict = {}
    for w in words:
        at = tree
        for c in w:
            at = at.setdefault(c, {})
        at[""] = {}

    def told(at: dict) -> str:
        more = [c + told(at[c]) for c in sorted(at) if c]
        whole = more[0] if len(more) == 1 else f"(?:{'|'.join(more)})" if more else ""
        return whole if "" not in at or not more else f"(?:{'|'.join(more)})?+"

    return f"(?<![a-z0-9]){told(tree)}(?![a-z0-9])"


def _hits(them: Column, grams: Column) -> Column:
    """Of a row's marked bigrams (g, i), those of a template, by place, with `prev`: the place of the same bigram before, -1 if there is none."""
    mine = F.array_sort(F.filter(grams, lambda h: F.array_contains(them, h["g"])))
    with_prev = bound(mine, lambda s: F.transform(s, lambda h, j: F.struct(h["i"].alias("i"), F.when((j > 0) & F.coalesce(F.get(s, j - 1)["g"] == h["g"], F.lit(False)), F.get(s, j - 1)["i"]).otherwise(-1).alias("prev"))))
    return F.array_sort(with_prev)


def _best_end(start: Column, span: Column, m: Column) -> Column:
    """(end, common): the end of a window from `start` that makes most of its length: common bigrams twice, by its own number of bigrams and the template's. Ties go to the shorter one."""
    zero = F.struct(F.lit(0).alias("d"), F.lit(0.0).cast("double").alias("s"), F.lit(-1).alias("end"), F.lit(0).alias("common"))

    def step(a: Column, h: Column) -> Column:
        d = a["d"] + F.when(h["prev"] < start, 1).otherwise(0)
        s = (2.0 * d).cast("double") / (h["i"] - start + 1 + m)
        return F.struct(d.alias("d"), F.greatest(s, a["s"]).alias("s"), F.when(s > a["s"], h["i"]).otherwise(a["end"]).alias("end"), F.when(s > a["s"], d).otherwise(a["common"]).alias("common"))

    return F.aggregate(span, zero, step)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row for each place of a text where a template is met: id, start and n_words (the window, in words from 0), license, template, dice.

    Of windows of one template that overlap, the one with the greatest coefficient counts, the first of equal ones. Null
    and empty texts give no row; null ids are carried; repeated rows give their rows each; other columns are not read; an
    empty table gives an empty result.
    """
    rows = template_rows()
    words = anchors(rows, threshold)
    low = F.lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    x = sealed(docs.select(F.col(id_col).alias("id"), low.alias("t"))).filter(F.col("t").rlike(one_of(words)))
    x = sealed(x.select("id", F.split(F.trim(F.regexp_replace("t", "[^a-z0-9]+", " ")), " ").alias("w")))
    x = x.withColumn("b", F.transform(F.slice("w", 2, F.size("w")), lambda v, i: F.concat_ws(" ", F.get(F.col("w"), i), v)))
    known = sorted({g for *_, b in rows for g in b})
    x = x.withColumn("h", F.filter(F.transform("b", lambda g, i: F.struct(g.alias("g"), i.alias("i"))), lambda h: h["g"].isin(known)))
    x = x.withColumn("seen", F.array_distinct(F.transform("h", lambda h: h["g"])))
    # a fixed list of templates: m different bigrams, the least common ones, the widest window
    fixed = F.array(*[F.struct(F.lit(name).alias("license"), F.lit(no).alias("template"), F.lit(len(b)).alias("m"), F.lit(bounds(len(b), threshold)[0]).alias("least"), F.lit(bounds(len(b), threshold)[1]).alias("most"), F.array(*[F.lit(g) for g in b]).alias("them")) for name, no, b in rows])
    met = F.filter(fixed, lambda t: (F.size("seen") >= t["least"]) & (F.size(F.array_intersect(t["them"], F.col("seen"))) >= t["least"]))
    x = x.select("id", "b", "h", F.explode(met).alias("t")).select("id", "b", "t.*", _hits(F.col("t.them"), F.col("h")).alias("h"))

    def window(h: Column, j: Column) -> Column:
        start = h["i"]
        span = F.filter(F.slice(F.col("h"), j + 1, F.col("most")), lambda e: e["i"] < start + F.col("most"))
        best = lambda e: F.struct(start.alias("start"), e["end"].alias("end"), (2.0 * e["common"]).cast("double").alias("twice"), e["common"].alias("common"))
        return F.when(F.size(span) >= F.col("least"), bound(_best_end(start, span, F.col("m")), best))

    found = F.filter(F.transform("h", window), lambda v: F.coalesce(v["common"] >= F.col("least"), F.lit(False)))
    size = lambda v: F.size(F.array_distinct(F.slice(F.col("b"), v["start"] + 1, v["end"] - v["start"] + 1)))
    x = sealed(x.withColumn("v", found)).filter(F.size("v") > 0)
    scored = F.filter(F.transform("v", lambda v: F.struct(v["start"].alias("start"), v["end"].alias("end"), (v["twice"] / (size(v) + F.col("m"))).alias("dice"))), lambda v: v["dice"] >= threshold)
    x = x.withColumn("v", scored)

    def beaten(v: Column, j: Column) -> Column:
        near = F.slice(F.col("v"), F.greatest(j + 1 - F.col("most"), F.lit(1)), 2 * F.col("most") + 1)
        return F.exists(near, lambda u: (u["start"] <= v["end"]) & (v["start"] <= u["end"]) & ((u["dice"] > v["dice"]) | ((u["dice"] == v["dice"]) & (u["start"] < v["start"]))))

    x = x.select("id", "license", "template", F.explode(F.filter("v", lambda v, j: ~beaten(v, j))).alias("v"))
    return x.select(F.col("id").alias(id_col), F.col("v.start").alias("start"), (F.col("v.end") - F.col("v.start") + 2).alias("n_words"), "license", "template", F.round("v.dice", 6).alias("dice"))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: licences in all `documents`."""
    return scan(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    values = ",\n".join(f"('{name}', {no}, {len(b)}, {bounds(len(b))[0]}, {bounds(len(b))[1]}, [{', '.join(repr(x) for x in b)}])" for name, no, b in template_rows())
    return f"""
WITH t(license, template, m, least, most, them) AS (VALUES {values}),
tg AS (SELECT license, template, m, least, most, unnest(them) AS g FROM t),
d AS (SELECT doc_id, row_number() OVER () AS r, string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM documents),
b AS (SELECT doc_id, r, i, w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, r, w, unnest(range(len(w) - 1)) AS i FROM d)),
h AS (SELECT r, license, template, m, least, most, b.g, i, coalesce(lag(i) OVER (PARTITION BY r, license, template, b.g ORDER BY i), -1) AS prev FROM b JOIN tg ON b.g = tg.g),
ok AS (SELECT r, license, template FROM h GROUP BY ALL HAVING count(DISTINCT g) >= any_value(least)),
k AS (SELECT h.* FROM h JOIN ok USING (r, license, template)),
e AS (SELECT p.r, p.license, p.template, p.m, p.least, p.i AS s, q.i AS e,
        sum(CASE WHEN q.prev < p.i THEN 1 ELSE 0 END) OVER (PARTITION BY p.r, p.license, p.template, p.i ORDER BY q.i) AS d
      FROM k p JOIN k q ON p.r = q.r AND p.license = q.license AND p.template = q.template AND q.i >= p.i AND q.i < p.i + p.most),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY r, license, template, s ORDER BY 2.0::DOUBLE * d / (e - s + 1 + m) DESC, e) AS rn FROM e) WHERE rn = 1 AND d >= least),
n AS (SELECT best.r, license, template, s, e, 2.0::DOUBLE * any_value(d) / (count(DISTINCT b.g) + any_value(m)) AS dice
      FROM best JOIN b ON b.r = best.r AND b.i BETWEEN s AND e GROUP BY best.r, license, template, s, e),
v AS (SELECT * FROM n WHERE dice >= {THRESHOLD})
SELECT d.doc_id, CAST(v.s AS INTEGER) AS start, CAST(v.e - v.s + 2 AS INTEGER) AS n_words, v.license, v.template, round(v.dice, 6) AS dice FROM v JOIN d ON d.r = v.r
WHERE NOT EXISTS (SELECT 1 FROM v u WHERE u.r = v.r AND u.license = v.license AND u.template = v.template AND u.s <= v.e AND v.s <= u.e AND (u.dice > v.dice OR (u.dice = v.dice AND u.s < v.s)))"""


QUERIES = {"op1_license_scan": op1_license_scan}
ORACLE_SQL = {"op1_license_scan": _oracle()}
