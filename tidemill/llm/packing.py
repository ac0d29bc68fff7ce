"""Vector bin packing of token sequences.

Examples go into sequences under three limits at once: tokens, segments and loss-bearing tokens. A
sequence takes, again and again, the waiting example with the greatest dot product of its demand with what
the sequence has left, both in parts of the limits. If none fits whole, the waiting example with
the greatest such product is cut to fill it. Each input partition packs its own rows as they stream
by, so nothing is shuffled and no group of rows has to meet in one task; a pool of at most `pool` examples waits
at any time. What is left at a partition's end is cut into powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .wordpieces import WordTokenizer


@dataclass(frozen=True)
class Limits:
    """Of one sequence. `pool`: examples that wait in a task at a time."""

    tokens: int = 4096
    segments: int = 128
    loss_tokens: int = 4096
    pool: int = 512



class Packer:
    """Packs pieces (example, start, length, loss_from) as they come; `out` gets (example, start, length, loss, sequence, offset).

    `loss_from`: the example's first loss-bearing token; those before it (a prompt) bear none.
    """

    def __init__(self, limits: Limits) -> None:
        self.lim = limits
        self.item: list[tuple[object, int, int, int]] = []  # example, start, end, loss_from
        self.waiting = 0  # tokens
        self.seq = 0
        self.out: list[tuple] = []

    @staticmethod
    def _loss(start: int, end: int, loss_from: int) -> int:
        return max(0, end - max(start, loss_from))

    def add(self, example: object, length: int, loss_from: int = 0) -> None:
        start, cap = 0, min(self.lim.tokens, self.lim.loss_tokens)
        while length - start >= self.lim.tokens and self._loss(start, start + self.lim.tokens, loss_from) <= self.lim.loss_tokens:
            self._emit([(example, start, start + self.lim.tokens, loss_from)])  # whole sequences need no search
            start += self.lim.tokens
        while length - start > cap:
            self._wait(example, start, start + cap, loss_from)
            start += cap
        if length > start:
            self._wait(example, start, length, loss_from)
        if len(self.item) >= 2 * self.lim.pool and self.waiting >= self.lim.tokens:
            self._work(self.lim.pool)

    def _wait(self, example: object, start: int, end: int, loss_from: int) -> None:
        self.item.append((example, start, end, loss_from))
        self.waiting += end - start

    def _emit(self, parts: list[tuple]) -> None:
        at = 0
        for example, s, e, lf in parts:
            self.out.append((example, s, e - s, self._loss(s, e, lf), self.seq, at))
            at += e - s
        self.seq += 1

    def _work(self, stop: int) -> None:
        """Fills sequences until at most `stop` examples wait or too few tokens do for a whole sequence."""
        lim = self.lim
        items = self.item
        n = len(items)
        length = np.fromiter((e - s for _, s, e, _ in items), np.float64, n)
        loss = np.fromiter((self._loss(s, e, lf) for _, s, e, lf in items), np.float64, n)
        live = np.ones(n, bool)
        left, waiting = n, length.sum()
        while left > stop and waiting >= lim.tokens:
            room, segs, loss_room = lim.tokens, lim.segments, lim.loss_tokens
            parts: list[tuple] = []
            while room > 0 and segs > 0 and left:
                score = length * (room / lim.tokens**2) + loss * (loss_room / lim.loss_tokens**2) + segs / lim.segments**2
                fits = live & (length <= room) & (loss <= loss_room)
                # the last free segment must fill the sequence, so it is cut from a longer example
                i = int(np.argmax(np.where(fits & ((length >= room) | (segs > 1)), score, -1.0)))
                if fits[i] and (segs > 1 or length[i] >= room):
                    parts.append(items[i])
                    live[i] = False
                    left -= 1
                    room -= int(length[i])
                    loss_room -= int(loss[i])
                    waiting -= length[i]
                else:
                    i = int(np.argmax(np.where(live, score, -1.0)))
                    ex, s, e, lf = items[i]
                    # the longest prefix within both limits
                    end = min(e, s + room, max(s, lf) + loss_room)
                    if end <= s:
                        break
                    parts.append((ex, s, end, lf))
                    took = end - s
                    loss_room -= self._loss(s, end, lf)
                    room -= took
                    waiting -= took
                    if end == e:
                        live[i] = False
                        left -= 1
                    else:
                        items[i] = (ex, end, e, lf)
                        length[i] = e - end
                        loss[i] = self._loss(end, e, lf)
                segs -= 1
            self._close(parts)
        self.item = [x for x, a in zip(items, live) if a]  # noqa: B905
        self.waiting = int(waiting)

    def _close(self, parts: list[tuple]) -> None:
        """Emits a sequence; one short of the token limit is cut into powers of two."""
        total = sum(e - s for _, s, e, _ in parts)
        if total == self.lim.tokens:
            self._emit(parts)
            return
        rest = list(parts)
        while total:
            want = 1 << (total.bit_length() - 1)
            total -= want
            take = []
            while want:
                ex, s, e, lf = rest[0]
                end = min(e, s + want)
                take.append((ex, s, end, lf))
                want -= end - s
                rest[0] = (ex, end, e, lf)
                if end == e:
                    rest.pop(0)
            self._emit(take)

    def finish(self) -> None:
        self._work(0)
        while self.item:  # fewer tokens than a sequence has
            parts, segs, loss_room = [], self.lim.segments, self.lim.loss_tokens
            while self.item and segs:
                ex, s, e, lf = self.item[0]
                end = min(e, max(s, lf) + loss_room)
                if end <= s:
                    break
                parts.append((ex, s, end, lf))
                loss_room -= self._loss(s, end, lf)
                segs -= 1
                if end == e:
                    self.item.pop(0)
                else:
                    self.item[0] = (ex, end, e, lf)
                    break
            self._close(parts)

    def drain(self) -> list[tuple]:
        done, self.out = self.out, []
        return done


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limits: Limits = Limits(), vocabulary: str | None = None, prompt_col: str | None = None, end_id: int = 2) -> DataFrame:
    """One row for each piece: id, start, length, ids_crc32, doc_tokens, loss_tokens, sequence_id, offset.

    A document's ids are those of its text, after those of its prompt, and then `end_id`; each lies in exactly one piece. Null text
    counts as empty (one id, the end). `prompt_col`: text that stands before and bears no loss. A null id is carried as it
    is; repeated rows are packed each for itself; an empty table gives an empty result. Sequence ids are unique: the
    partition's number times 2^33, plus a count. Of examples with equal products the one that came first goes first. A task that runs anew gives the same rows, as
    its input comes in the order of its file.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, loss_tokens bigint, sequence_id bigint, offset bigint"
    names = [x.split()[0] for x in schema.split(", ")]
    prompt = F.col(prompt_col).cast("string") if prompt_col else F.lit(None).cast("string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = WordTokenizer.shared(vocabulary)
        base = TaskContext.get().partitionId() << 33
        packer = Packer(limits)

        def rows() -> pa.RecordBatch:
            got = packer.drain()
            cols: list[list] = [[] for _ in names]
            for (doc, ids), s, n, loss, seq, off in got:
                vals = (doc, s, n, zlib.crc32(ids[4 * s : 4 * (s + n)]), len(ids) // 4, loss, base + seq, off)
                for c, v in zip(cols, vals):  # noqa: B905
                    c.append(v)
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(cols, [id_kind, *[pa.int64()] * 7])], names)  # noqa: B905

        id_kind = pa.int64()
        for b in batches:
            id_kind = b.schema.field(0).type
            for doc, text, before in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):  # noqa: B905
                head = tok.encode_bytes(before or "")
                ids = head + tok.encode_bytes(text or "") + np.array([end_id], "<u4").tobytes()
                packer.add((doc, ids), len(ids) // 4, len(head) // 4)
            if len(packer.out) >= 1000:
                yield rows()
        packer.finish()
        yield rows()

    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"), prompt.alias("p")).mapInArrow(run, schema)
    return out.withColumnRenamed("id", id_col)


def op10_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: all `documents` in sequences of at most 4096 tokens, 128 segments and 4096 loss-bearing tokens."""
    return pack_documents(table(spark, sf_dir, "documents"))


#: Limits for instruction data: short answers meet the segments first, long ones the loss-bearing tokens, long prompts the tokens.
INSTRUCTIONS = Limits(tokens=4096, segments=16, loss_tokens=3584)


def instruction_examples(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, prompt, text): each assistant turn, with the turn before it as its prompt if that is of another role.

    Turns are paired by a join on conversation and turn, so a conversation of any length meets in no one task. Of repeated
    turns before it the text that sorts first is the prompt; repeated assistant turns are examples each for itself.
    """
    said = conversations.filter("role <> 'assistant' and conv_id is not null and turn is not null").groupBy(F.col("conv_id").alias("c_"), (F.col("turn") + 1).alias("t_")).agg(F.min("text").alias("prompt"))
    answers = conversations.filter("role = 'assistant'").select("conv_id", "turn", "text")
    return answers.join(said, (F.col("conv_id") == F.col("c_")) & (F.col("turn") == F.col("t_")), "left").select("conv_id", "turn", "prompt", "text")


def instruction_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: the assistant turns of all `conversations` with their prompts, which bear no loss, under three limits that all bind."""
    examples = instruction_examples(table(spark, sf_dir, "conversations")).sortWithinPartitions("conv_id", "turn", "text")  # the same order whenever a task runs
    x = pack_documents(examples.select(F.struct("conv_id", "turn").alias("example"), "prompt", "text"), "example", "text", INSTRUCTIONS, prompt_col="prompt")
    return x.select("example.conv_id", "example.turn", *x.columns[1:])


QUERIES = {"op10_vector_packing": op10_vector_packing, "instruction_packing": instruction_packing}
ORACLE_SQL: dict[str, str] = {}
