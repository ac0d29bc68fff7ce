"""Personal data: fixed patterns, and terms that reveal what the patterns find.

The patterns' matches are the protected entities, and so are the broader classes they lie in (an email's domain,
an address's network, a card's issuer, a phone's area): most values stand in one text only, where no
statistic tells anything, but their classes recur. A kind as a whole is no such class, as its mark names it. Over the whole corpus, the
point-wise mutual information of a term (a word, a mixed word, two capitalised words in a row) with an entity says how much it tells of it; in parts of the entity's own information
that is between 0 (nothing) and 1 (the term never occurs without it). Support is weighed: of the share of a term's texts that hold the
entity the lower confidence bound must reach `sure`, which one text never does, two do without a counterexample, and
more with some. Such a term at or above `disclose` is generalised in the texts that hold the entity, at or above `remove` removed.

Only texts that hold an entity that recurs are opened up into terms; counts of terms are combined in each
task before they are shuffled. The texts of other documents are never shuffled.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table

KINDS = ("email", "ip", "card", "phone", "term")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# possessive: these match what the plain forms match, but read a long run once
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?+[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")
TERM = re.compile(r"[^\W\d_]{2,}")
#: Two capitalised words in a row, as names are; the second may begin another pair.
PHRASE = re.compile(r"(?<!\d)[A-ZÀ-ÖØ-Þ][^\W\d_]++(?= ([A-ZÀ-ÖØ-Þ][^\W\d_]++)(?!\d))")
#: Whole words of letters and digits.
MIXED = re.compile(r"(?<![^\W_])(?:[^\W\d_]++\d|\d++[^\W\d_])[^\W_]*+")


@dataclass(frozen=True)
class Disclosure:
    """`disclose`, `remove`: parts of an entity's information; `sure`: what the lower confidence bound, at `z` deviations, of the share of a term's texts that hold the entity must reach. `held`: entries that a task combines, and terms that may be broadcast."""

    disclose: float = 0.9
    remove: float = 1.0
    held: int = 200_000
    sure: float = 0.5
    z: float = 1.2816

    @property
    def texts(self) -> int:
        """The fewest different texts whose support can suffice."""
        return max(1, math.ceil(self.z**2 * self.sure / max(1e-9, 1 - self.sure) - 1e-9))

    def bound(self, share: Column | float, n: Column | float, sqrt=math.sqrt) -> Column | float:  # noqa: ANN001
        """Wilson's lower bound of a share seen in n texts."""
        zz = self.z**2
        return (share + zz / (2 * n) - self.z * sqrt(share * (1 - share) / n + zz / (4 * n * n))) / (1 + zz / n)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(t: str) -> Iterator[tuple[int, int]]:
    at, free = t.find("@"), 0
    while at >= 0:
        start = at
        while start > free and t[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(t, at + 1) if start < at else None
        if m:
            yield start, m.end()
            free = m.end()
        else:
            free = at + 1  # what is left of this sign can be in no other match
        at = t.find("@", free)


def base_spans(t: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind; code points, end exclusive; leftmost and non-overlapping within a kind."""
    out = [("email", s, e) for s, e in _emails(t)] if "@" in t else []
    if DIGIT.search(t):
        out += [("ip", *m.span()) for m in IP.finditer(t) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(t):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        if "+" in t:
            out += [("phone", *m.span()) for m in PHONE.finditer(t) if 10 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def joined(spans: Iterable[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def entities(t: str, spans: list[tuple[str, int, int]]) -> list[int]:
    """What each found value is, however it is written (digits alone count, letters in lower case), and its class."""
    out = set()
    for k, s, e in spans:
        v = t[s:e].lower() if k == "email" else t[s:e] if k == "ip" else "".join(c for c in t[s:e] if c.isdigit())
        broad = {"email": v.rpartition("@")[2], "ip": v.rpartition(".")[0], "card": v[:6], "phone": v[:-7]}[k]
        out |= {f"{k}:{v}", f"{k} in:{broad}"}
    return sorted(xxhash.xxh64_intdigest(x) - (1 << 63) for x in out)


def phrases(t: str) -> Iterator[tuple[str, int, int]]:
    for m in PHRASE.finditer(t):
        yield f"{m[0]} {m[1]}".lower(), m.start(), m.end(1)


def terms(t: str) -> set[str]:
    """Runs of two letters or more, words that mix letters and digits, and pairs of capitalised words."""
    low = t.lower()
    return {*TERM.findall(low), *(MIXED.findall(low) if DIGIT.search(low) else ()), *(p for p, _, _ in phrases(t))}


def all_spans(t: str, found: dict[str, bool]) -> list[tuple[str, int, int]]:
    """Base spans and those of the disclosing terms (`found`: whether to remove) that overlap none of them."""
    out = base_spans(t)
    if not found:
        return out
    # a pair of words goes before each, a mixed word before the letters in it
    for each in (phrases(t), ((m[0].lower(), *m.span()) for m in MIXED.finditer(t)), ((m[0].lower(), *m.span()) for m in TERM.finditer(t))):
        taken = iter([*sorted((s, e) for _, s, e in out), (len(t) + 1, len(t) + 1)])
        s0, e0 = next(taken)
        free = 0
        for term, start, end in each:
            while e0 <= start:
                s1, e1 = next(taken)
                s0, e0 = s1, max(e0, e1)
            if start >= free and end <= s0 and term in found:
                out.append(("term", start, end))
                free = end
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def sanitise_text(t: str, found: dict[str, bool]) -> str:
    """Entities become [KIND]; terms become the class they are of, [CODE] (letters and digits), [NAME] (a capital) or [WORD], or go. Overlapping spans become the first one's mark."""
    out, at = [], 0
    for kind, s, e in all_spans(t, found):
        if s >= at:
            of = "[CODE]" if DIGIT.search(t, s, e) else "[NAME]" if t[s].isupper() else "[WORD]"
            mark = f"[{kind.upper()}]" if kind != "term" else "" if found[t[s:e].lower()] else of
            out += [t[at:s], mark]
        at = max(at, e)
    return "".join([*out, t[at:]])


def _key(t: str) -> str:
    return hashlib.md5(t.encode("utf-8", "surrogatepass"), usedforsecurity=False).hexdigest()


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_email, n_ip, n_card, n_phone, base (spans), key (MD5 of the text), entities and, of texts that have any, body."""
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base string, key string, entities array<bigint>, body string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[] for _ in range(8)]
            for t in b.column(1).to_pylist():
                t = t or ""  # noqa: PLW2901
                spans = base_spans(t)
                n = Counter(k for k, _, _ in spans)
                row = (n["email"], n["ip"], n["card"], n["phone"], joined(spans), _key(t), entities(t, spans) if spans else None, t if spans else None)
                for c, v in zip(cols, row):  # noqa: B905
                    c.append(v)
            kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.list_(pa.int64()), pa.string()]
            arrays = [b.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds)]]  # noqa: B905
            yield pa.RecordBatch.from_arrays(arrays, ["id", "n_email", "n_ip", "n_card", "n_phone", "base", "key", "entities", "body"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")).mapInArrow(run, schema)


class _Sums:
    """Counts by key that go on as soon as `held` keys are held."""

    def __init__(self, held: int, names: list[str], kinds: list[pa.DataType]) -> None:
        self.held, self.names, self.kinds = held, names, kinds
        self.sums: dict[tuple, list[int]] = {}

    def add(self, key: tuple, *n: int) -> None:
        if (got := self.sums.get(key)) is None:
            self.sums[key] = list(n)
        else:
            for i, x in enumerate(n):
                got[i] += x

    def flush(self, least: int) -> Iterator[pa.RecordBatch]:
        if len(self.sums) >= max(1, least):
            rows = [(*k, *v) for k, v in self.sums.items()]
            self.sums = {}
            for i in range(0, len(rows), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[i : i + 50_000]), self.kinds)], self.names)  # noqa: B905


def _pair_counts(texts: DataFrame, p: Disclosure) -> DataFrame:
    """(entity, term, n_texts, n_rows) of texts (entities, body, n); with a null entity, of all these texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(p.held, ["entity", "term", "n_texts", "n_rows"], [pa.int64(), pa.string(), pa.int64(), pa.int64()])
        for b in batches:
            for ents, body, n in zip(*(b.column(i).to_pylist() for i in range(3))):  # noqa: B905
                for w in terms(body):
                    for e in (None, *ents):
                        sums.add((e, w), 1, n)
                        if len(sums.sums) >= p.held:
                            yield from sums.flush(p.held)
        yield from sums.flush(1)

    x = texts.select("entities", "body", "n").mapInArrow(run, "entity bigint, term string, n_texts bigint, n_rows bigint")
    return x.groupBy("entity", "term").agg(F.sum("n_texts").alias("n_texts"), F.sum("n_rows").alias("n_rows"))


def _term_counts(docs: DataFrame, text_col: str, wanted: set[str] | None, p: Disclosure) -> DataFrame:
    """(term, n_term): rows of the whole corpus that hold a term; of `wanted` only, if given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(p.held, ["term", "n_term"], [pa.string(), pa.int64()])
        for b in batches:
            for t in b.column(0).to_pylist():
                for w in terms(t or "") if wanted is None else wanted & terms(t or ""):
                    sums.add((w,), 1)
                yield from sums.flush(p.held)
        yield from sums.flush(1)

    x = docs.select(F.col(text_col).cast("string").alias("t")).mapInArrow(run, "term string, n_term bigint")
    return x.groupBy("term").agg(F.sum("n_term").alias("n_term"))


def _few(df: DataFrame, column: str, most: int) -> set[str] | None:
    """The column's values if there are at most so many."""
    got = df.select(column).distinct().limit(most + 1).collect()
    return {r[0] for r in got} if len(got) <= most else None


def disclosing_terms(docs: DataFrame, found: DataFrame, text_col: str = "text", p: Disclosure = Disclosure()) -> DataFrame | None:
    """(key, terms: array<struct<term, removed>>) of the texts that hold a term that reveals one of their entities; None if no entity recurs.

    `found`: of scan(), cut from its lineage. Counts of entities, terms and both are over all rows; the confidence is that of different texts: as many
    as hold both, and in proportion those that hold the term alone.
    """
    spark = docs.sparkSession
    held = found.filter("entities is not null")
    by_text = held.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.first("entities").alias("entities"))
    each = by_text.select("key", "n", F.explode("entities").alias("entity"))
    often = cut(each.groupBy("entity").agg(F.count(F.lit(1)).alias("n_texts"), F.sum("n").alias("n_entity")).filter(F.col("n_texts") >= p.texts))
    if not often.limit(1).count():
        return None
    ours = each.join(often.select("entity"), "entity").groupBy("key").agg(F.first("n").alias("n"), F.collect_set("entity").alias("entities"))
    texts = cut(ours.join(held.groupBy("key").agg(F.first("body").alias("body")), "key"))
    total = found.count()
    own = F.log2(F.lit(total) / F.col("n_entity"))
    part = lambda n_term: F.when(own > 0, F.log2(F.col("n_rows") * F.lit(total) / (F.col("n_entity") * F.col(n_term))) / own).otherwise(0.0)
    every = cut(_pair_counts(texts, p))
    pairs = every.filter("entity is not null").filter(F.col("n_texts") >= p.texts).select("entity", "term", "n_texts", "n_rows").join(often.select("entity", "n_entity"), "entity")
    # the whole corpus holds a term at least as often as these texts do, so pairs that fall short by their count alone go: exact
    pairs = pairs.join(every.filter("entity is null").select("term", F.col("n_rows").alias("n_held")), "term").filter(part("n_held") >= p.disclose - 1e-6)
    pairs = cut(pairs.select("entity", "term", "n_texts", "n_rows", "n_entity"))
    counts = _term_counts(docs, text_col, _few(pairs, "term", p.held), p)
    share = F.least(F.lit(1.0), F.col("n_rows") / F.col("n_term"))
    reveals = pairs.join(counts, "term").select("entity", "term", part("n_term").alias("part"), p.bound(share, F.col("n_texts") / share, F.sqrt).alias("bound"))
    reveals = cut(reveals.filter((F.col("part") >= p.disclose - 1e-9) & (F.col("bound") >= p.sure - 1e-9)).select("entity", "term", (F.col("part") >= p.remove - 1e-9).alias("removed")))
    wanted = _few(reveals, "term", p.held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, ents, body in zip(*(b.column(i).to_pylist() for i in range(3))):  # noqa: B905
                ws = sorted(terms(body) if wanted is None else terms(body) & wanted)
                for e in ents:  # a text's terms go on for one entity at a time
                    for i in range(0, len(ws), 50_000):
                        part_of = ws[i : i + 50_000]
                        yield pa.RecordBatch.from_arrays([pa.array([key] * len(part_of), pa.string()), pa.array([e] * len(part_of), pa.int64()), pa.array(part_of, pa.string())], ["key", "entity", "term"])

    if wanted is not None and not wanted:
        return spark.createDataFrame([], "key string, terms array<struct<term:string,removed:boolean>>, body string")
    hits = texts.select("key", "entities", "body").mapInArrow(run, "key string, entity bigint, term string").join(reveals, ["entity", "term"])
    hits = hits.groupBy("key", "term").agg(F.max("removed").alias("removed"))
    return hits.groupBy("key").agg(F.collect_list(F.struct("term", "removed")).alias("terms")).join(texts.select("key", "body"), "key")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", p: Disclosure = Disclosure()) -> DataFrame:
    """One row for each row of `docs`: id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term.

    Null text counts as empty: no span, the hash of the empty string. Null ids are carried; repeated
    rows are counted each for itself; other columns are not read; an empty table gives an empty result.
    """
    found = cut(scan(docs, id_col, text_col))
    by_key = disclosing_terms(docs, found, text_col, p)
    slim = found.drop("entities", "body")
    if by_key is None:
        slim = slim.withColumns({"spans": F.col("base"), "n_term": F.lit(0).cast("bigint")})
    else:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                got = [all_spans(body, {x["term"]: x["removed"] for x in ts}) for ts, body in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]  # noqa: B905
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(map(joined, got), pa.string()), pa.array([sum(k == "term" for k, _, _ in x) for x in got], pa.int64())], ["key", "spans", "n_term"])

        more = by_key.select("key", "terms", "body").mapInArrow(run, "key string, spans string, n_term bigint")
        slim = slim.join(more, "key", "left").withColumns({"spans": F.coalesce("spans", "base"), "n_term": F.coalesce("n_term", F.lit(0).cast("bigint"))})
    return slim.select(F.col("id").alias(id_col), "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans", "n_term")


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", p: Disclosure = Disclosure(), out_col: str | None = None) -> DataFrame:
    """`docs` with the text sanitised (in `out_col`, or in place). Null text stays null; every row and column stays."""
    found = cut(scan(docs, id_col, text_col))
    by_key = disclosing_terms(docs, found, text_col, p)

    @F.pandas_udf("string")
    def clean(text, marks):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.Series([None if t is None else sanitise_text(t, {x["term"]: x["removed"] for x in ([] if m is None else m)}) for t, m in zip(text, marks)], dtype=object)  # noqa: B905

    kind = "array<struct<term:string,removed:boolean>>"
    x = docs.select(F.struct("*").alias("row"), F.col(text_col).cast("string").alias("t"))
    if by_key is None:
        x = x.withColumn("terms", F.lit(None).cast(kind))
    else:
        marks = cut(by_key.select(F.col("key").alias("k"), "terms"))
        few = marks.agg(F.sum(F.size("terms"))).first()[0] or 0
        x = x.withColumn("key", F.md5(F.coalesce("t", F.lit("")))).join(F.broadcast(marks) if few <= p.held else marks, F.col("key") == F.col("k"), "left")
    x = x.withColumn("clean", clean("t", "terms"))
    target = out_col or text_col
    return x.select(*[F.col("clean").alias(c) if c == target else F.col("row")[c].alias(c) for c in docs.columns], *([F.col("clean").alias(target)] if target not in docs.columns else []))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: personal data and disclosing terms of all `documents`."""
    return find(table(spark, sf_dir, "documents"))


QUERIES = {"op6_pii": op6_pii}
ORACLE_SQL: dict[str, str] = {}
