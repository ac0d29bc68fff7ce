"""SentencePiece encoding and decoding.

An Aho-Corasick automaton over the pieces reads a text once; at each position its output links name
the pieces that end there, longest first, and each relaxes the best score of a segmentation up to that
position. Ties go to the longer last piece. No piece spans the start of a word, so words are
segmented one at a time and remembered.

A Viterbi search needs log probabilities. A model of merges holds ranks in their place, and sums of ranks prefer many early
pieces to one late one; its pieces get the law of Zipf and Mandelbrot, -log(rank + SHIFT), a fixed rule of the
vocabulary's order. Nothing is trained. Scores that are no ranks are used as they are.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

SPACE = "▁"
#: Of the law by which ranks become scores.
SHIFT = 1000
CACHE = 1 << 19


class Pieces:
    """A model's pieces and scores. White space is kept as it is; a text that is not empty gets one space before it."""

    _shared: dict[str, Pieces] = {}

    @classmethod
    def shared(cls, path: str | None = None) -> Pieces:
        """One for each Python worker and model file."""
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("piece_bpe_32k.model")
        if path not in cls._shared:
            import sentencepiece

            m = sentencepiece.SentencePieceProcessor(model_file=path)
            n = m.vocab_size()
            usual = [i for i in range(n) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))]
            byte = {int(m.id_to_piece(i)[1:-1], 16): i for i in range(n) if m.is_byte(i)}
            scores = [m.get_score(i) for i in usual]
            if all(x <= 0 and x == int(x) for x in scores):  # ranks
                scores = [-math.log(SHIFT - x) for x in scores]
            cls._shared[path] = cls({m.id_to_piece(i): (i, x) for i, x in zip(usual, scores)}, byte, m.unk_id())  # noqa: B905
        return cls._shared[path]

    def __init__(self, scores: dict[str, tuple[int, float]], byte: dict[int, int], unknown: int) -> None:
        self.automaton = ahocorasick.Automaton()
        for piece, (i, score) in scores.items():
            self.automaton.add_word(piece, (len(piece), i, score))
        self.automaton.make_automaton()
        self.byte, self.unknown = byte, unknown
        self.unknown_score = min((s for _, s in scores.values()), default=0.0) - 10.0
        self.text_of = {i: p for p, (i, _) in scores.items()}
        self.byte_of = {i: b for b, i in byte.items()}
        self.spans_words = any(SPACE in p.lstrip(SPACE) for p in scores)
        alone = "" if any("\n" in p for p in scores) else "\n"
        self.segments = re.compile(f"{alone or '(?!)'}|{SPACE}*[^{SPACE}{alone}]+|{SPACE}+")
        self.cache: dict[str, bytes] = {}

    def viterbi(self, s: str) -> list[int]:
        """Ids of the best segmentation; a character that no piece covers becomes its bytes."""
        n = len(s)
        best, back, piece = [0.0] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        done = 0  # positions up to here have a best score

        def fallback(upto: int) -> None:
            nonlocal done
            while done < upto:
                done += 1
                best[done], back[done], piece[done] = best[done - 1] + self.unknown_score, done - 1, -1

        for last, hit in self._matches(s):
            end = last + 1
            fallback(end)
            size, i, score = hit
            start = end - size
            to = best[start] + score
            if to > best[end] or (to == best[end] and start < back[end]):
                best[end], back[end], piece[end] = to, start, i
        fallback(n)
        out: list[int] = []
        while n:
            if piece[n] >= 0:
                out.append(piece[n])
            else:
                out += [self.byte.get(b, self.unknown) for b in reversed(s[back[n] : n].encode("utf-8", "surrogatepass"))]
            n = back[n]
        return out[::-1]

    def _matches(self, s: str) -> Iterator[tuple[int, tuple[int, int, float]]]:
        return self.automaton.iter(s) if len(self.automaton) else iter(())

    def encode_bytes(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if not text:
            return b""
        s = SPACE + text.replace(" ", SPACE)
        out, cache = [], self.cache
        for seg in [s] if self.spans_words else self.segments.findall(s):
            if (got := cache.get(seg)) is None:
                got = np.array(self.viterbi(seg), "<u4").tobytes()
                if len(seg) <= 32:
                    if len(cache) >= CACHE:
                        cache.clear()
                    cache[seg] = got
            out.append(got)
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        """The text of ids: bytes are joined, the space before the text goes."""
        out: list[bytes] = []
        for i in ids:
            out.append(bytes([self.byte_of[i]]) if i in self.byte_of else self.text_of.get(i, "").encode())
        s = b"".join(out).decode("utf-8", "replace").replace(SPACE, " ")
        return s[1:] if s.startswith(" ") else s


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None) -> DataFrame:
    """One row for each row of `docs`: id, ids array<int>. Null text gives null, empty text no id; null ids are carried, repeated rows encoded each for itself, other columns not read."""
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Pieces.shared(model)
        for b in batches:
            got = [None if t is None else np.frombuffer(p.encode_bytes(t), "<i4") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.list_(pa.int32()))], ["id", "ids"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")).mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model: str | None = None) -> DataFrame:
    """One row for each row: id, text. Null ids arrays give null text."""
    schema = f"id {encoded.schema[id_col].dataType.simpleString()}, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Pieces.shared(model)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([None if x is None else p.decode(x) for x in b.column(1).to_pylist()], pa.string())], ["id", "text"])

    return encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("x")).mapInArrow(run, schema).withColumnRenamed("id", id_col)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None) -> DataFrame:
    """id, n_ids, n_byte_ids (of characters without a piece), ids_crc32, round_trip (decoding gives the text back). Null text counts as empty, null ids are carried, repeated rows counted each for itself, other columns not read; an empty table gives an empty result."""
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, n_ids bigint, n_byte_ids bigint, ids_crc32 bigint, round_trip boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Pieces.shared(model)
        low, high = min(p.byte_of, default=0), max(p.byte_of, default=-1)
        text_of = [p.text_of.get(i, "") for i in range(max([*p.text_of, high, -1]) + 1)]
        for b in batches:
            rows = []
            for t in b.column(1).to_pylist():
                raw = p.encode_bytes(t or "")
                ids = np.frombuffer(raw, "<u4")
                n_bytes = int(((ids >= low) & (ids <= high)).sum())
                back = p.decode(ids.tolist()) if n_bytes else "".join([text_of[i] for i in ids.tolist()]).replace(SPACE, " ")[1:]
                rows.append((len(ids), n_bytes, zlib.crc32(raw), back.replace(SPACE, " ") == (t or "").replace(SPACE, " ")))
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array([r[i] for r in rows], k) for i, k in enumerate([pa.int64(), pa.int64(), pa.int64(), pa.bool_()])]], ["id", "n_ids", "n_byte_ids", "ids_crc32", "round_trip"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")).mapInArrow(run, schema).withColumnRenamed("id", id_col)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: all `documents` encoded, and decoded again."""
    return digests(table(spark, sf_dir, "documents"))


QUERIES = {"op2_sentencepiece": op2_sentencepiece}
ORACLE_SQL: dict[str, str] = {}
