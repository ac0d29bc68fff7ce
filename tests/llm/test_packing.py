import collections
import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tidemill.llm import packing
from tidemill.llm.packing import Limits, Packer
from tidemill.llm.wordpieces import WordTokenizer


def proper(items, lim):
    p = Packer(lim)
    for i, (n, lf) in enumerate(items):
        p.add(i, n, lf)
    p.finish()
    seqs, seen, pad = collections.defaultdict(list), collections.defaultdict(list), 0
    for ex, start, n, loss, seq, off in p.out:
        assert n > 0 and loss == max(0, start + n - max(start, items[ex][1]))
        seqs[seq].append((off, n, loss))
        seen[ex].append((start, n))
    for i, (n, _) in enumerate(items):
        at = 0
        for start, k in sorted(seen[i]):
            assert start == at
            at += k
        assert at == n
    for q in seqs.values():
        at = 0
        for off, n, _ in sorted(q):
            assert off == at
            at += n
        assert at <= lim.tokens and len(q) <= lim.segments and sum(x for *_, x in q) <= lim.loss_tokens
        pad += lim.tokens - at if at & (at - 1) else 0
    return pad, len(seqs)


def test_limits_hold_and_nothing_is_padded():
    rnd = random.Random(3)
    sizes = [int(rnd.lognormvariate(6.3, 1.2)) + 1 for _ in range(2500)]
    pad, n = proper([(s, 0) for s in sizes], Limits())
    assert pad == 0 and n <= sum(sizes) / 4096 + 13
    assert proper([(rnd.randint(1, 6), 0) for _ in range(3000)], Limits())[0] == 0
    assert proper([(n, rnd.randint(0, n)) for n in sizes[:800]], Limits(4096, 16, 2048))[0] == 0
    assert proper([(9000, 9000), (9000, 0), (5, 9), (1, 0)], Limits(4096, 8, 1000))[0] == 0
    assert proper([], Limits()) == (0, 0)


def test_word_ids_equal_whole_text_ids(spark, sf):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    odd = ["", " \n", "a<|endoftext|>b c", "İstanbul ΣΑΣ 'sdon't ''ll ﬁ ½x ²³ _a_b__ \x1c z 中文字 tiếng", "ªº µ ÿŸ\xadÀÉ", "́a b­c d e", "x" * 5000]
    for t in [*(r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()), *odd]:
        assert np.frombuffer(WordTokenizer.shared().encode_bytes(t), "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids


def test_query_pieces_hold_each_id_once(spark, sf):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = {r.doc_id: np.array([*tok.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    at = collections.Counter()
    for r in sorted(packing.op10_vector_packing(spark, sf).collect(), key=lambda r: (r.doc_id, r.start)):
        ids = docs[r.doc_id]
        assert r.start == at[r.doc_id] and r.doc_tokens == len(ids)
        at[r.doc_id] += r.length
        assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    assert at == {d: len(x) for d, x in docs.items()}


def test_odd_rows_and_clashing_columns(spark):
    rows = [(1, None, "p"), (1, None, "p"), (None, "a b", None), (2, "", ""), (3, "word " * 50_000, "q r")]
    df = spark.createDataFrame([(*r, "s", 0) for r in rows], "doc_id long, text string, prompt string, start string, id int")
    got = packing.pack_documents(df, prompt_col="prompt").collect()
    assert sum(r.length for r in got) == 2 + 2 + 3 + 1 + 50_003
    assert sum(r.loss_tokens for r in got) == 1 + 1 + 3 + 1 + 50_001
    assert packing.pack_documents(df.limit(0)).count() == 0


def test_instruction_data_meets_all_three_limits(spark):
    sf, lim = "/root/testdata/sf0.1", packing.INSTRUCTIONS
    rows = {(r.conv_id, r.turn): r for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()}
    tok, at, loss = WordTokenizer.shared(), collections.Counter(), collections.Counter()
    held, size, bears = collections.Counter(), collections.Counter(), collections.Counter()
    for r in sorted(packing.instruction_packing(spark, sf).collect(), key=lambda r: (r.conv_id, r.turn, r.start)):
        key, before = (r.conv_id, r.turn), rows.get((r.conv_id, r.turn - 1))
        head = tok.encode_bytes(before.text if before and before.role != "assistant" else "")
        ids = head + tok.encode_bytes(rows[key].text or "") + np.array([2], "<u4").tobytes()
        assert r.start == at[key] and r.doc_tokens == len(ids) // 4 and r.ids_crc32 == zlib.crc32(ids[4 * r.start : 4 * (r.start + r.length)])
        assert r.loss_tokens == max(0, r.start + r.length - max(r.start, len(head) // 4))
        at[key] += r.length
        loss[key] += r.loss_tokens
        held[r.sequence_id] += 1
        size[r.sequence_id] += r.length
        bears[r.sequence_id] += r.loss_tokens
    assert at.keys() == {k for k, r in rows.items() if r.role == "assistant"}
    assert max(held.values()) == lim.segments and max(size.values()) == lim.tokens and max(bears.values()) == lim.loss_tokens
    assert all(n == lim.tokens or n & (n - 1) == 0 for n in size.values())


def test_instruction_examples_take_odd_rows(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 1, "assistant", "x"), (1, 2, "assistant", None), (None, 1, "assistant", "y"), (2, None, "assistant", "z"), (3, 1, None, "w"), (3, 2, "assistant", "v"), (3, 2, "assistant", "v")]
    df = spark.createDataFrame([(*r, "p", 0) for r in rows], "conv_id long, turn long, role string, text string, prompt string, c_ int")
    got = sorted(((r.conv_id, r.turn, r.prompt, r.text) for r in packing.instruction_examples(df).collect()), key=str)
    assert got == sorted([(1, 1, "a", "x"), (1, 2, None, None), (None, 1, None, "y"), (2, None, None, "z"), (3, 2, None, "v"), (3, 2, None, "v")], key=str)
    assert packing.instruction_examples(df.limit(0)).count() == 0
