from pyspark.sql import functions as F

from tidemill.operators import code_tasks
from tidemill.operators.dedup import Blocking, top_matches
from tidemill.operators.sft_filters import FilterConfig
from tidemill.plans import jobs

MSG = "array<struct<role:string,content:string>>"
CFG = FilterConfig(require_think=False, min_question_chars=20)


def ask(x):
    return f"Tell me at some length about the topic number {x} and why people like it so much these days."


def test_chat_job_keeps_or_explains_every_row(spark, tmp_path):
    a = spark.createDataFrame([(str(i), f"org/math{i}", [("user", ask(i)), ("assistant", f"Answer {i}")]) for i in range(4)] + [("x", None, [("user", ask(9)), ("assistant", "b")])], f"id string, dataset_source string, messages {MSG}")
    b = spark.createDataFrame([(7, "s", "d", [("user", ask(1) + "!"), ("assistant", "c")]), (8, "s", "d", [("user", ask(77)), ("assistant", "c")]), (8, "s", "d", [("user", ask(88)), ("assistant", "c")])], f"ds_uid long, source string, dataset_name string, messages {MSG}")
    out = jobs.chat_job(spark, [("labelled_mixture", a), ("named_english", b)], CFG, blocking=Blocking(threshold=99.9))
    funnel = {(r.stage, r.reason): r.n for r in out.funnel().collect()}
    assert funnel == {("filters", "missing_dataset_source"): 1, ("same_id", "same_id_duplicate"): 1, ("exact", "exact_hash_cross_dataset"): 1}
    assert out.kept.count() == 5 and out.kept.count() + sum(d.count() for d in out.dropped.values()) == 8


def test_reward_job(spark):
    qa = spark.createDataFrame([("1", ask(1), "4", "Integer", "Law", "x"), ("2", ask(2), "5", "Integer", "Law", "x"), ("3", ask(1), "4", "Integer", "Law", "x")], "id string, question string, answer string, answer_type string, category string, difficulty string")
    choice = spark.createDataFrame([("9", ask(2), "yes", "c", "o", ["no", "yes"]), ("8", "a wholly different prompt that nobody else has asked so far", "yes", "c", "o", [])], "id_ string, input string, answer_text string, category string, original_dataset string, choices array<string>")
    out = jobs.reward_job(spark, [("typed_qa", qa), ("choice_qa", choice)], blocking=Blocking(threshold=99.9))
    assert {(r.stage, r.reason): r.n for r in out.funnel().collect()} == {("exact", "exact_hash_intra_dataset_same_gt"): 1, ("exact", "exact_hash_cross_dataset"): 1}
    final = jobs.finalise(out.kept)
    assert final.columns == jobs.RL_COLUMNS and final.count() == 3
    assert {r.name: r.status for r in jobs.reward_checks(final).collect()}["repeated_example_id"] == "PASS"


def test_code_tasks(spark):
    rows = [("d" * 200, '{"inputs": ["1"], "outputs": ["2"]}', '["x = 1"]'), ("d" * 200, "{'inputs': ['1'], 'outputs': ['2']}", "{'solution': ['y']}"), ("d", "{}", "[]"), ("d" * 200, '{"inputs": ["1"], "outputs": []}', '["x"]'), ("d" * 200, '{"inputs": ["1"], "outputs": ["2"]}', "nothing")]
    x = spark.createDataFrame(rows, "p string, t string, s string").select(code_tasks.drop_reason(F.col("p"), F.col("t"), F.col("s")).alias("r"))
    assert [r.r for r in x.collect()] == [None, None, "code_problem_bad_description", "code_problem_bad_tests", "code_problem_bad_solutions"]


def test_top_matches(spark):
    df = spark.createDataFrame([(q, c, float((c * 7) % 50), 0) for q in (1, 2) for c in range(60)], "q_pos long, c_pos long, score double, offset int")
    got = {}
    for r in top_matches(df, 20).collect():
        got.setdefault(r.q_pos, []).append((r["rank"], r.c_pos))
    want = [c for c in sorted(range(60), key=lambda c: (-((c * 7) % 50), c))][:20]
    assert all([c for _, c in sorted(v)] == want for v in got.values()) and len(got) == 2
