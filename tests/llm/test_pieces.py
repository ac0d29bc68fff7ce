import random

import public_tokenizers
import pytest

from tidemill.llm.pieces import SPACE, Pieces, decode, digests, encode, op2_sentencepiece


def brute_best(p, s):
    """The best score by plain dynamic programming."""
    pieces = {t: p.automaton.get(t)[2] for t in p.automaton}
    best = [0.0]
    for end in range(1, len(s) + 1):
        best.append(max([best[end - 1] + p.unknown_score] + [best[a] + pieces[s[a:end]] for a in range(max(0, end - 20), end) if s[a:end] in pieces]))
    return best[-1]


def score(p, s, ids):
    total, at = 0.0, 0
    while at < len(ids):
        if ids[at] in p.byte_of:
            raw = b""
            while True:
                raw += bytes([p.byte_of[ids[at]]])
                at += 1
                try:
                    raw.decode()
                    break
                except UnicodeDecodeError:
                    pass
            total += p.unknown_score
        else:
            total += p.automaton.get(p.text_of[ids[at]])[2]
            at += 1
    return total


def test_viterbi_is_best_and_words_are_independent():
    p, rnd = Pieces.shared(), random.Random(2)
    for _ in range(300):
        s = SPACE + "".join(rnd.choice(["a", "th", "ing", SPACE, "é", "ß", "\n", "中", "😀", "er", ".", "10"]) for _ in range(rnd.randint(1, 12)))
        ids = p.viterbi(s)
        assert abs(score(p, s, ids) - brute_best(p, s)) < 1e-9
        assert p.encode(s[1:].replace(SPACE, " ")) == ids


def test_equals_the_library_on_a_unigram_model_of_the_same_pieces():
    pb2 = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    import sentencepiece

    m = pb2.ModelProto()
    m.ParseFromString(open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read())
    m.trainer_spec.model_type = 1
    for x in m.pieces:
        if x.type == 1:
            x.score = -1.0 - len(m.pieces[0].piece) if x.score < -1e8 else x.score / 4096  # exact in single precision sums of short texts
    lib = sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())
    n = lib.vocab_size()
    p = Pieces({lib.id_to_piece(i): (i, lib.get_score(i)) for i in range(n) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i))}, {int(lib.id_to_piece(i)[1:-1], 16): i for i in range(n) if lib.is_byte(i)}, lib.unk_id())
    for t in ["Hello world", "the thing", "Ingandeou thereanti ofhehaon", "éauxreé où ça", "naïve 中文字", "x"]:
        assert p.encode(t) == lib.encode(t)


def test_round_trip(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert op2_sentencepiece(spark, sf).filter("not round_trip").count() == 0
    back = {r.doc_id: r.text for r in decode(encode(docs)).collect()}
    assert back == {r.doc_id: r.text for r in docs.collect()}


def test_odd_rows_and_clashing_columns(spark):
    rows = [(1, None), (2, ""), (None, " a "), (3, "\n\n 中\x00😀"), (3, "\n\n 中\x00😀"), (4, "wörter " * 60_000)]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], "doc_id long, text string, id string, ids int")
    back = decode(encode(df)).collect()
    assert sorted(((r.doc_id, r.text) for r in back), key=str) == sorted(rows, key=str)
    assert digests(df).filter("round_trip").count() == len(rows) and digests(df.limit(0)).count() == 0


def test_whole_documents_take_no_more_ids_than_the_librarys_merges(spark, sf):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = [r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    p = Pieces.shared()
    ours, theirs = sum(len(p.encode(t)) for t in texts), sum(map(len, lib.encode(texts, num_threads=1)))
    words = [w for t in texts for w in t.split()[:100]]
    same = sum(p.encode(w) == lib.encode(w) for w in words) / len(words)
    assert ours <= 1.01 * theirs and same > 0.75
    assert [p.text_of[i] for i in p.encode("international understanding")] == ["▁international", "▁understanding"]
