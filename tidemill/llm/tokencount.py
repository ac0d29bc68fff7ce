"""Edit-aware token counts.

A document's pre-tokens are held in runs of about `RUN`, as the leaves of a segment tree of character and token
sums. An edit reads the text anew from the run before it, with the context that a pre-token's end depends on, to
the first boundary behind it that was one before; only these runs are encoded again, and the sums
above them are updated. The tokenizer merges within pre-tokens only, so counts are those of the whole text.
"""

from __future__ import annotations

import base64
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

RUN = 16
CACHE = 1 << 19
#: Characters before an edit that the end of a pre-token can depend on.
CONTEXT = 2


class Counter:
    """Tokens of pre-tokens by a byte-level vocabulary, remembered."""

    _shared: dict[str, Counter] = {}

    @classmethod
    def shared(cls, path: str | None = None) -> Counter:
        """One for each Python worker and vocabulary."""
        import public_tokenizers

        path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
        if path not in cls._shared:
            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            cls._shared[path] = cls(ranks, public_tokenizers.PATTERN)
        return cls._shared[path]

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import tiktoken

        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.known: dict[str, int] = {}

    def count(self, piece: str) -> int:
        if (n := self.known.get(piece)) is None:
            n = len(self.encoding.encode_ordinary(piece))
            if len(piece) <= 32:
                if len(self.known) >= CACHE:
                    self.known.clear()
                self.known[piece] = n
        return n

    def runs(self, text: str, size: int = RUN) -> list[tuple[int, int, int]]:
        """(characters, tokens, pre-tokens) of runs of `size` pre-tokens."""
        pieces = self.pattern.findall(text)
        get, count = self.known.get, self.count
        n = [get(p) or count(p) for p in pieces]
        return [(sum(map(len, pieces[i : i + size])), sum(n[i : i + size]), len(n[i : i + size])) for i in range(0, len(n), size)]


class Tree:
    """The segment tree of one text."""

    def __init__(self, counter: Counter, text: str, leaves: list[tuple[int, int, int]] | None = None) -> None:
        self.counter, self.text, self.encoded = counter, text, 0
        self._build(counter.runs(text) if leaves is None else leaves)

    def _build(self, leaves: list[tuple[int, int, int]]) -> None:
        self.width = 1 << max(0, len(leaves) - 1).bit_length()
        self.chars, self.tokens, self.pre = ([0] * (2 * self.width) for _ in range(3))
        for i, x in enumerate(leaves, self.width):
            self.chars[i], self.tokens[i], self.pre[i] = x
        for i in range(self.width - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        for a in (self.chars, self.tokens, self.pre):
            a[i] = a[2 * i] + a[2 * i + 1]

    @property
    def count(self) -> int:
        return self.tokens[1]

    def leaves(self) -> list[tuple[int, int, int]]:
        return [x for x in zip(self.chars[self.width :], self.tokens[self.width :], self.pre[self.width :]) if x[0]]  # noqa: B905

    def _leaf_at(self, at: int) -> tuple[int, int]:
        """The leaf that holds a character, and where it starts; the last one beyond the end."""
        i, start = 1, 0
        at = max(0, min(at, self.chars[1] - 1))
        while i < self.width:
            i *= 2
            if at - start >= self.chars[i]:
                start += self.chars[i]
                i += 1
        return i, start

    def edit(self, at: int, delete: int, insert: str) -> int:
        """Replaces `delete` characters at `at`, both cut to the text, by `insert`; returns how many pre-tokens were encoded."""
        n = len(self.text)
        at = max(0, min(at, n))
        end = min(n, at + max(0, delete))
        self.text = self.text[:at] + insert + self.text[end:]
        shift = len(insert) - (end - at)
        first, start = self._leaf_at(at - CONTEXT)
        # old boundaries behind the edit, by leaf
        new: list[tuple[int, int, int]] = []
        last, behind = self._leaf_at(end)
        held: list[str] = []
        encoded = 0

        def close() -> None:
            nonlocal encoded
            if held:
                new.append((sum(map(len, held)), sum(map(self.counter.count, held)), len(held)))
                encoded += len(held)
                held.clear()

        stop = 2 * self.width
        for m in self.counter.pattern.finditer(self.text, start):
            held.append(m[0])
            if len(held) == RUN:
                close()
            old = m.end() - shift
            if m.end() >= at + len(insert) and old >= end:
                while last < stop and behind + self.chars[last] <= old and self.chars[last]:
                    behind += self.chars[last]
                    last += 1
                if behind == old and old > start:
                    break
        else:
            last = stop
        close()
        self.encoded += encoded
        # leaves first..last-1 are replaced
        room = last - first
        if len(new) <= room:
            touched = set()
            for k in range(min(room, stop - first)):
                i = first + k
                value = new[k] if k < len(new) else (0, 0, 0)
                if (self.chars[i], self.tokens[i], self.pre[i]) != value:
                    self.chars[i], self.tokens[i], self.pre[i] = value
                    touched.add(i // 2)
            while touched:
                for i in touched:
                    if i:
                        self._sum(i)
                touched = {i // 2 for i in touched if i > 1}
        else:
            every = list(zip(self.chars[self.width :], self.tokens[self.width :], self.pre[self.width :]))  # noqa: B905
            kept = every[: first - self.width] + new + every[last - self.width :]
            self._build([x for x in kept if x[0]])
        return encoded


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """One row for each row of `docs`: id, n_tokens, n_pretokens, leaves array<struct<chars, tokens, pretokens>>. Null text counts as empty; null ids are carried; other columns are not read."""
    return edited(docs, F.lit(None).cast(EDITS), id_col, text_col, vocabulary).select(id_col, "n_tokens", "n_pretokens", "leaves")


EDITS = "array<struct<at:bigint,delete:bigint,insert:string>>"
_LEAF = pa.list_(pa.struct([("chars", pa.int64()), ("tokens", pa.int64()), ("pretokens", pa.int64())]))


def edited(docs: DataFrame, edits: Column, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, leaves: Column | None = None) -> DataFrame:
    """id, n_tokens and n_pretokens of the text, edited_tokens and edited_pretokens after `edits` (one after another), n_encoded (pre-tokens that the edits encoded), leaves and text after them.

    `leaves`: of counts(), if they are known; the text is then read only around the edits. Null text counts as
    empty; null edits change nothing; places beyond the text mean its end; repeated rows are counted each for itself.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_tokens bigint, n_pretokens bigint, edited_tokens bigint, edited_pretokens bigint, n_encoded bigint, leaves array<struct<chars:bigint,tokens:bigint,pretokens:bigint>>, text string"
    known = F.lit(None).cast("array<struct<chars:bigint,tokens:bigint,pretokens:bigint>>") if leaves is None else leaves

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter.shared(vocabulary)
        names = ["n_tokens", "n_pretokens", "edited_tokens", "edited_pretokens", "n_encoded"]
        for b in batches:
            rows = []
            for text, changes, held in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):  # noqa: B905
                tree = Tree(counter, text or "", None if held is None else [(x["chars"], x["tokens"], x["pretokens"]) for x in held])
                before = (tree.count, tree.pre[1])
                for e in changes or []:
                    tree.edit(e["at"] or 0, e["delete"] or 0, e["insert"] or "")
                out = [{"chars": c, "tokens": t, "pretokens": p} for c, t, p in tree.leaves()]
                rows.append((*before, tree.count, tree.pre[1], tree.encoded, out, tree.text))
            kinds = [pa.int64()] * 5 + [_LEAF, pa.string()]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]], ["id", *names, "leaves", "text"])

    x = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"), edits.cast(EDITS).alias("e"), known.alias("l"))
    return x.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: tokens of all `documents`, and after three edits of each: words put in at a third, twelve characters taken out at half, an end put on."""
    n = F.length(F.coalesce("text", F.lit("")))
    edit = lambda at, delete, insert: F.struct(F.floor(at).cast("bigint").alias("at"), F.lit(delete).cast("bigint").alias("delete"), F.lit(insert).alias("insert"))
    edits = F.array(edit(n / 3, 0, " an inserted phrase"), edit(n / 2, 12, ""), edit(n * 2.0, 0, "\nThe end."))
    return edited(table(spark, sf_dir, "documents"), edits).drop("leaves", "text")


QUERIES = {"op4_token_counts": op4_token_counts}
ORACLE_SQL: dict[str, str] = {}
