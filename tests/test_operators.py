import random

import pytest
from pyspark.sql import functions as F

from tidemill.functions import messages as M
from tidemill.functions import text as X
from tidemill.functions.similarity import indel_ratio, levenshtein, levenshtein_ratio
from tidemill.operators import dedup as D
from tidemill.operators import merge as G
from tidemill.operators import post as PP
from tidemill.operators import quality as Q
from tidemill.operators import rl_filters as RL
from tidemill.operators import sampling as T
from tidemill.operators import sft_filters as SF


def one(spark, column, **values):
    kinds = {"m": M.SCHEMA}
    schema = ", ".join(f"{k} {kinds.get(k, 'string')}" for k in values)
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first().x


def lcs(a, b):
    p = [0] * (len(b) + 1)
    for x in a:
        q = [0]
        for j, y in enumerate(b):
            q.append(p[j] + 1 if x == y else max(p[j + 1], q[-1]))
        p = q
    return p[-1]


def edit(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


def test_similarities_equal_dynamic_programming():
    rnd = random.Random(1)
    for _ in range(800):
        a, b = ("".join(rnd.choice("abcé ") for _ in range(rnd.randint(0, 12))) for _ in range(2))
        assert indel_ratio(a, b) == pytest.approx(200 * lcs(a, b) / (len(a) + len(b)) if a or b else 100)
        assert levenshtein(a, b) == edit(a, b)
    assert levenshtein_ratio("", "") == 100


def test_text_edges(spark):
    assert one(spark, X.strip(F.col("t")), t="　 a\xa0") == "a"
    assert one(spark, X.ws_norm(F.col("t")), t=" a \n b ") == "a b"
    assert one(spark, X.dedup_norm(F.col("t")), t="  Ünder_score ½, x! ") == "ünder_score ½ x"
    assert one(spark, X.think_text(F.col("t")), t="<THINK> a </think> b <think>c</think>") == "a"
    assert one(spark, X.think_text(F.col("t")), t="<think>open") is None
    assert one(spark, X.response_text(F.col("t")), t="<think>a</think> b <answer>c</answer>") == "b"
    assert one(spark, X.head_tokens(F.col("t"), 2), t="user hello system there x") == "hello_there"
    assert one(spark, X.head_tokens(F.col("t"), 2), t="user system") == "__EMPTY__"
    assert one(spark, X.repeated_sentence(F.col("t")), t="b a. a b! A  b? b a.").asDict() == {"item": "b a", "n": 2}
    assert one(spark, X.source_name(F.col("t")), t="org/set/12") == "org/set" and one(spark, X.source_name(F.col("t")), t=None) == "__MISSING__"
    assert one(spark, X.repeated_ngram(F.col("t"), 3), t="one two") is None


def test_chat_edges(spark):
    chat = [("system", "s"), ("user", " "), ("user", "u"), (None, "x"), ("assistant", "a")]
    assert [tuple(t) for t in one(spark, M.context(F.col("m")), m=chat)] == chat[:3]
    assert one(spark, M.last_user_or_any(F.col("m")), m=[("user", " "), ("tool", "t")]) == "t"
    assert one(spark, M.last_user(F.col("m")), m=[("user", "q"), ("user", " ")]) == " "
    assert one(spark, M.context(F.col("m")), m=[]) == [] and one(spark, M.last_user(F.col("m")), m=[]) == ""
    assert one(spark, M.first_user(F.col("m"), "empty"), m=[("assistant", "a")]) == "empty"


LONG = "word one two three four five six seven eight nine ten " * 6


@pytest.mark.parametrize(
    ("reason", "chat"),
    [
        ("bad_messages", [("user", "q")]),
        ("last_not_assistant", [("user", "q"), ("user", "a")]),
        ("prompt_too_short", [("user", "x" * 49), ("assistant", "a")]),
        ("empty_assistant", [("user", LONG), ("assistant", " ")]),
        ("truncated_think", [("user", LONG), ("assistant", "<THINK>a")]),
        ("missing_think", [("user", LONG), ("assistant", "a")]),
        ("think_too_short", [("user", LONG), ("assistant", "<think>" + "x" * 79 + "</think>")]),
        ("question_has_http", [("user", LONG + "HTTPS://a"), ("assistant", "<think>" + "x" * 80 + "</think>")]),
        ("question_has_image_ref", [("user", LONG + "configured"), ("assistant", "<think>" + "x" * 80 + "</think>")]),
        ("question_multipart", [("user", "a) " + LONG + " b)"), ("assistant", "<think>" + "x" * 80 + "</think>")]),
        ("question_too_short", [("user", "x" * 199), ("assistant", "<think>" + "x" * 80 + "</think>")]),
        ("chinese_ratio", [("user", LONG), ("assistant", "<think>" + "x" * 80 + "</think>" + "中" * 5)]),
        ("identity_self_id", [("user", LONG), ("assistant", "<think>" + "x" * 80 + "</think> I'm GPT-4, ok")]),
        ("cutoff_mention", [("user", LONG + "knowledge cutoff March 2021"), ("assistant", "<think>" + "x" * 80 + "</think>")]),
        ("repetition_sentences", [("user", LONG), ("assistant", "<think>" + "x" * 200 + "</think>" + "same words. " * 7)]),
        ("repetition_phrases", [("user", LONG), ("assistant", "<think>" + "x" * 80 + "</think>" + "therefore so on " * 32)]),
        (None, [("user", LONG), ("assistant", "<think>" + "x" * 80 + "</think> fine, done")]),
    ],
)
def test_first_failing_phase_names_the_reason(spark, reason, chat):
    assert one(spark, SF.drop_reason(F.col("m")), m=chat) == reason


def test_reward_filters(spark):
    ask = lambda c, **v: one(spark, c, **v)
    assert ask(RL.ground_truth_reason(F.col("t"), F.col("v"), F.col("p")), t=" N/A ", v="math_equiv", p=None) == "placeholder_ground_truth"
    assert ask(RL.ground_truth_reason(F.col("t"), F.col("v"), F.col("p")), t="", v="llm_judge_open", p=None) is None
    assert ask(RL.ground_truth_reason(F.col("t"), F.col("v"), F.col("p")), t="", v="schema_pydantic", p="{") == "invalid_verification_info"
    assert ask(RL.ground_truth_reason(F.col("t"), F.col("v"), F.col("p")), t="", v="schema_pydantic", p='{"schema_code": "x"}') is None
    assert ask(RL.passrate_reason(F.col("r")), r="0.9") is None and ask(RL.passrate_reason(F.col("r")), r="0.9000001") == "passrate_too_high" and ask(RL.passrate_reason(F.col("r")), r="x") is None
    assert ask(RL.repetition_reason(F.col("t")), t="Say it again now. " * 5) == "prompt_repetition:sentence×5"
    for answer, kind, want in (("1,234.50", "Float", None), ("5.5", "Integer", "integer_not_integer"), ("x", "Integer", "integer_no_numeric"), ("True.", "Boolean", None), ("b)", "Multiple Choice", None), ("bc", "Multiple Choice", "mcq_non_letter_answer"), ("1% to 2%", "Percentage", "percentage_invalid_or_range"), ("1/5", "Fraction", None), ("a", "Matrix", "unknown_answer_type")):
        assert ask(RL.answer_reason(F.col("a"), F.col("k")), a=answer, k=kind) == want


def test_exact_policies(spark):
    rows = [(0, "A", "Same text!", "g1"), (1, "B", "same  text", "g1"), (2, "A", "same text", "g2"), (3, "A", "SAME TEXT", "g1"), (4, None, "other", None), (5, "S", "same text", "g1")]
    df = spark.createDataFrame(rows, "pos long, dataset_id string, t string, g string")
    got = {r.pos: r._drop_reason for r in D.exact_truth_aware(df, F.col("t"), F.col("g"), skip=("S",)).collect()}
    assert got == {0: None, 1: "exact_hash_cross_dataset", 2: None, 3: "exact_hash_intra_dataset_same_gt", 4: None, 5: None}
    tagged = D.exact_cross_source(df, F.col("t"))
    assert {r.pos for r in tagged.filter("_keep").collect()} == {0, 2, 3, 4} and tagged.count() == len(rows)
    assert D.exact_cross_source(df.limit(0), F.col("t")).count() == 0


def plain_sequential(rows, p):
    kept, out = {}, {}
    key = lambda n: ("_".join([t for t in n.split() if t not in X.ROLE_WORDS][: p.head]) or X.EMPTY_HEAD, len(n) // p.width)
    for lo in range(0, len(rows), p.batch):
        local, pending = {}, []
        for pos, ds, n in rows[lo : lo + p.batch]:
            best, score = None, -1.0
            h, b = key(n)
            for off in range(-p.radius, p.radius + 1):
                for index in (kept, local):
                    for c, owner in index.get((h, b + off), {}).items():
                        s = indel_ratio(n, c)
                        if abs(len(c) - len(n)) <= p.delta and s >= p.threshold and s > score:
                            best, score = owner, s
            drop = best is not None and best != ds
            out[pos] = drop
            local.setdefault((h, b), {}).setdefault(n, ds)
            if not drop:
                pending.append((h, b, n, ds))
        for h, b, n, ds in pending:
            kept.setdefault((h, b), {}).setdefault(n, ds)
    return out


@pytest.mark.parametrize("batch", [3, 1000])
def test_sequential_fuzzy_equals_a_plain_loop(spark, batch):
    rnd = random.Random(batch)
    words = ["alpha", "beta", "gamma", "delta", "eps"]
    rows, seen = [], {}
    for i in range(90):
        n = " ".join(["red", rnd.choice(["fox", "cat"])] + [rnd.choice(words) for _ in range(rnd.randint(6, 9))])
        if rnd.random() < 0.4 and rows:
            n = rnd.choice(rows)[2][:-1] + rnd.choice("xyz")
        rows.append((i, seen.setdefault(n, rnd.choice("AB")), n))
    p = D.Blocking(batch=batch, threshold=80)
    df = spark.createDataFrame(rows, "pos long, dataset_id string, t string")
    got = {r.pos: r._drop_reason is not None for r in D.fuzzy_sequential(df, F.col("t"), p=p).collect()}
    assert got == plain_sequential(rows, p)
    if batch == 1000:  # one batch: the set version decides the same
        assert got == {r.pos: not r._keep for r in D.fuzzy_set(df, F.col("t"), p=p).collect()}


def test_samples_merges_and_fixes(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2] if i % 7 else None) for i in range(400)], "id long, g string")
    tagged = T.capped_tagged(df, ["g"], "id", 30)
    assert sorted(r["count"] for r in tagged.filter("_keep").groupBy("g").count().collect()) == [30, 30, 30] and tagged.count() == 400
    assert T.capped(df, ["g"], "id", 0).count() == 400 and len({r.id for r in T.uniform(df, "id", 10).collect()}) == 10
    order = [r.id for r in df.filter("g = 'a'").orderBy(T.seeded("id"), "id").collect()][:30]
    assert {r.id for r in tagged.filter("_keep and g = 'a'").collect()} == set(order)
    with pytest.raises(ValueError, match="schemas differ"):
        G.union_by_priority([("a", df), ("b", df.withColumn("x", F.lit(1)))], df.schema)
    assert G.lenient(spark.createDataFrame([("x1",)], "id string"), df.schema).first() == (None, None)
    fixed = PP.fix_ground_truth(spark.createDataFrame([("yes", ""), ("true", "4"), ("no", "")], "ground_truth_present string, final_answer_text string"))
    assert [r[0] for r in fixed.collect()] == [False, True, False]


def test_scorers_learn(spark, sf):
    d = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    train, held = d.filter("doc_id % 3 > 0"), d.filter("doc_id % 3 = 0")
    c = Q.DomainClassifier(features=4096).fit(train.withColumn("domain", F.col("lang")), F.col("text"), "domain", "doc_id")
    x = c.predict(held.withColumn("domain", F.lit(None).cast("string")), F.col("text"))
    assert x.filter("predicted_domain = lang").count() > 0.9 * held.count()
    assert Q.calibrate(spark.createDataFrame([(float(i),) for i in range(100)], "_quality_score double"), 50.0, 0.1) == pytest.approx(9.9)
    pooled = one(spark, Q.mean_pool(F.array(F.array(F.lit(1.0), F.lit(3.0)), F.array(F.lit(3.0), F.lit(5.0)), F.array(F.lit(9.0), F.lit(9.0))), F.array(F.lit(1), F.lit(1), F.lit(0))), t="")
    assert pooled == [2.0, 4.0]
