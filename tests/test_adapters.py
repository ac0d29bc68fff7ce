import json
from collections import Counter
from dataclasses import replace

from pyspark.sql import functions as F

from tidemill.adapters import chat, reward
from tidemill.operators.sft_filters import FilterConfig, english_only_preset, multilingual_preset
from tidemill.schema import RL_COLUMNS, SFT_COLUMNS
from tidemill.sources import readers, sinks
from tidemill.streaming import dedup as S

MSG = "array<struct<role:string,content:string>>"
THINK = "<think>" + "because of this " * 8 + "</think> so <answer>42</answer>"
ASK = "Please work out the following number with care and say how. " * 4
CFG = FilterConfig()


def rows(spark, schema, *data):
    return spark.createDataFrame([(i, *d) for i, d in enumerate(data)], f"pos long, {schema}")


def test_chat_adapters(spark):
    x = chat.ADAPTERS["labelled_mixture"].apply(rows(spark, f"id string, dataset_source string, messages {MSG}", ("a", "org/Some-Math-set", [("user", ASK), ("assistant", THINK)]), ("b", None, [("user", ASK), ("assistant", THINK)])), CFG)
    a, b = x.orderBy("pos").collect()
    assert x.columns == ["pos", *SFT_COLUMNS] and a._keep and a.domain == "math" and a.reasoning_type == "deductive" and a.final_answer_text == "42" and len(a.context_messages) == 1
    assert b._drop_reason == "missing_dataset_source"
    x = chat.ADAPTERS["sharegpt"].apply(rows(spark, "conversations array<struct<`from`:string,value:string>>, source string, difficulty int, domain string", ([("human", ASK), ("gpt", THINK)], "s", 7, "math")), CFG).first()
    assert x._keep and x.category == "math" and x.domain is None and x.difficulty == "7" and x.row_id == "0"
    x = chat.ADAPTERS["out_of_band_math"].apply(rows(spark, "uuid string, expected_answer string, data_source string, messages array<struct<role:string,content:string,reasoning_content:string>>", ("u", "7", "d", [("user", ASK, None), ("assistant", "so 7", "since " * 30)]), ("v", "7", "d", [("user", ASK, None), ("assistant", "so 7", " ")])), CFG).orderBy("pos").collect()
    assert x[0]._keep and x[0].reasoning_text.startswith("since") and x[0].ground_truth_present == "yes" and x[1]._drop_reason == "empty_reasoning_content"
    info = "struct<source:string,reference_answer:string,test_case:string,think_content:string,answer_content:string>"
    x = chat.ADAPTERS["nested_info"].apply(rows(spark, f"messages array<struct<role:string,content:string,info:{info}>>", ([("user", ASK, ("KodCode", "t", None, None, None)), ("assistant", "x", (None, None, None, "since " * 30, "done"))],)), CFG).first()
    assert x._keep and x.domain == "code" and x.final_answer_text == "t" and x.response_text == "done"
    x = chat.ADAPTERS["three_field"].apply(rows(spark, "system_prompt string, input string, output string, category string", ("be kind", ASK, THINK, "Math")), CFG).first()
    assert x._keep and [t.role for t in x.context_messages] == ["system", "user"] and x.domain == "math"
    x = chat.ADAPTERS["named_multilingual"].apply(rows(spark, f"messages {MSG}, source string, dataset_name string, ds_uid long, language string", ([("user", ASK), ("assistant", THINK)], "a stem set", "stem", 5, "German"), ([("user", ASK), ("assistant", THINK)], "s", "d", 6, " ")), CFG).orderBy("pos").collect()
    assert x[0].language == "de" and x[0].source_dataset_id == "stem/5" and x[0].domain == "science" and x[1]._drop_reason == "missing_language"
    x = chat.split_adapter("multilingual_de").apply(rows(spark, f"uuid string, category string, messages {MSG}", ("u", "c", [("user", ASK), ("assistant", "<think>prove the theorem about a prime integer polynomial, prime modulo matrix algebra here</think> x")])), CFG).first()
    assert x.language == "de" and x.domain == "math" and x.category == "multilingual_de"


def test_reward_adapters(spark):
    x = reward.ADAPTERS["typed_qa"].apply(rows(spark, "id string, question string, answer string, answer_type string, category string, difficulty string", ("1", ASK, "$1,200.50", "Float", "Law", "hard"), ("2", ASK, "x", "Matrix", "Law", "hard"), ("3", ASK, "b)", "Multiple Choice", "zzz", ""))).orderBy("pos").collect()
    assert x[0]._keep and x[0].ground_truth_text == "1200.50" and x[0].domain == "humanities" and x[1]._drop_reason == "requires_model_verifier" and x[2].ground_truth_text == "B" and x[2].verifier_type == "multiple_choice"
    x = reward.ADAPTERS["flat_prompts"].apply(rows(spark, "prompt string, ground_truth array<string>, dataset array<string>, original_dataset string, custom_id string, constraint string, constraint_type string, passrate double", (f"system: Be brief.\nuser: {ASK}", ["4", "four"], ["math"], "o", "c", None, None, 0.5), (ASK, ["4"], ["general-quality"], "o", "c", None, None, 0.95), (ASK, ["4"], ["general-quality"], "o", "c", None, None, 0.5))).orderBy("pos").collect()
    assert x[0]._keep and [t.role for t in x[0].context_messages] == ["system", "user"] and json.loads(x[0].verification_info_raw)["alternative_ground_truths"] == ["four"]
    assert x[1]._drop_reason == "passrate_too_high" and x[2]._drop_reason == "ungradeable_verifier_llm_judge_open"
    x = reward.ADAPTERS["keyed_json"].apply(rows(spark, "problem_id string, prompt string, verification_info string", ("unscramble_17", ASK, '{"scrambled": "a", "ground_truth": "b"}'), (None, ASK, '{"code_output": "3"}'), ("ifeval_2", ASK, '{"ground_truth": "x", "more": 1}'), ("ifeval_2", ASK, "{"))).orderBy("pos").collect()
    assert [r.verifier_type for r in x[:2]] == ["text_match", "structured_match"] and x[1].ground_truth_text == '"3"' and x[2]._drop_reason == "unknown_verifier" and x[3]._drop_reason == "invalid_verification_info"
    x = reward.ADAPTERS["choice_qa"].apply(rows(spark, "id_ string, input string, answer_text string, category string, original_dataset string, choices array<string>", ("1", ASK, "yes", "c", "o", ["no", "yes"]), ("2", ASK, "yes", "c", "o", []))).orderBy("pos").collect()
    assert [x[0].ground_truth_text, x[0].verifier_type, json.loads(x[0].verification_info_raw)["alternative_ground_truths"], x[1]._drop_reason] == ["yes", "multi_gt", ["B"], "duplicate_input_within_subset"]
    x = reward.ADAPTERS["rule_induction"].apply(rows(spark, "id string, prompt string, ground_truth_rule string, validation_program string, language string, curriculum_level int, curriculum_tier string", ("1", ASK, "eastbound(X) :- q(X).", "eastbound(a). westbound(b).", "en", 3, "easy"), ("2", ASK, "eastbound(a).", "eastbound(a).", "en", 3, "easy"))).orderBy("pos").collect()
    assert x[0]._keep and x[0].subsource_raw == "L03_easy" and x[1]._drop_reason == "ground_truth_rule_has_no_body"
    x = reward.puzzles(("sudoku",)).apply(rows(spark, f"id string, data_source string, prompt {MSG}, answer string, game_data string", ("1", "sudoku", [("user", ASK)], "4", "{}"), ("2", "chess", [("user", ASK)], "4", "{}"), ("3", "sudoku", [("user", ASK)], "4", "{x"))).orderBy("pos").collect()
    assert x[0]._keep and x[1]._drop_reason == "no_verifier_for_task_family" and x[2]._drop_reason == "game_data_str_not_json"
    x = reward.ADAPTERS["blend"].apply(rows(spark, f"dataset string, uuid string, hash_id string, expected_answer string, schema_str string, options string, verifier_metadata string, pass_rate double, input {MSG}", ("nano_v3_sft_profiled_structured_outputs", "u", None, None, '{"type": "object"}', None, None, 0.2, [("user", ASK)]))).first()
    assert x._keep and x.verifier_type == "schema_structured_outputs" and set(x.asDict()) == {"pos", "_keep", "_drop_reason", *RL_COLUMNS}
    x = reward.ADAPTERS["procedural"].apply(rows(spark, "uuid string, question string, answer string, responses_create_params string, metadata string", ("u", ASK, "4", "{}", '{"source_dataset": "graph_color"}'))).first()
    assert x._drop_reason == "ungradeable_verifier_reasoning_gym_multi_solution"
    x = reward.ADAPTERS["ability_labelled"].apply(rows(spark, f"id string, data_source string, ability string, prompt {MSG}, ground_truth string", ("1", "d", "code", [("user", ASK)], '{"inputs": ["1"], "outputs": ["2", "3"]}'))).first()
    assert x.verifier_type == "code_stdio" and x.ground_truth_text == "2\n---\n3"
    assert json.loads(reward.assert_tests('{"fn_name": "f", "inputs": [[1, "a"], "z"], "outputs": [[{"b": 2}], null]}')) == ["assert f(1, 'a') == {'b': 2}", "assert f('z') == None"]
    assert reward.assert_tests("x") is None and reward.assert_tests('{"fn_name": "f", "inputs": [1], "outputs": []}') is None


def test_languages_and_cutoff_reach_the_adapters(spark):
    french = "<think>" + "parce que le chat est dans la maison et les enfants sont avec elle " * 3 + "</think> le chat est dans la maison et les enfants sont pour la paix"
    english = "<think>" + "because the cat is in the house and that is it for this " * 3 + "</think> the cat is in the house and that is it"
    df = rows(spark, f"id string, dataset_source string, messages {MSG}", ("a", "s", [("user", ASK), ("assistant", french)]), ("b", "s", [("user", ASK), ("assistant", english)]))
    got = [r._drop_reason for r in chat.ADAPTERS["labelled_mixture"].apply(df, english_only_preset()).orderBy("pos").collect()]
    assert got == ["non_english", None]
    mixed = chat.ADAPTERS["labelled_mixture"].apply(rows(spark, f"id string, dataset_source string, messages {MSG}", ("a", "s", [("user", ASK), ("assistant", english + " le chat est dans la maison " * 3)])), multilingual_preset()).first()
    assert mixed._drop_reason == "mixed_language"
    schema = f"id string, data_source string, ability string, prompt {MSG}, ground_truth string"
    x = reward.ADAPTERS["ability_labelled"].apply(rows(spark, schema, ("1", "d", "math", [("user", ASK + " As of my last update in 2021.")], "4"), ("2", "d", "math", [("user", french * 2)], "4"), ("3", "d", "math", [("user", ASK)], "4")), english_only=True)
    assert [r._drop_reason for r in x.orderBy("pos").collect()] == ["cutoff_mention", "non_english_fasttext", None]


def test_domains_of_subsources_and_prompts(spark):
    names = {"open-thoughts/OpenThoughts3-math code": "math", "nemotron code": "code", "synthetic code": None, "Tulu 3 Persona": "instruction_following", "wildguard": "chat", "nemotron math": "math"}
    x = spark.createDataFrame([(k,) for k in names], "s string").select("s", chat.subsource_domain(F.col("s")).alias("d")).collect()
    assert {r.s: r.d for r in x} == names
    prompts = {"a def f": "code", "the runtime": "code", "an equation": "math", "hello": "reasoning"}
    x = spark.createDataFrame([(k,) for k in prompts], "s string").select("s", chat.prompt_domain(F.col("s")).alias("d")).collect()
    assert {r.s: r.d for r in x} == prompts


def test_payloads_of_keyed_problems(spark):
    code = json.dumps({"fn_name": "add", "inputs": [[1, 2]], "outputs": [[3]]})
    data = [
        ("ifeval_1", json.dumps({"ground_truth": json.dumps({"func_name": "validate_title", "n": 3, "x": None})})),
        ("prime_rl_code-7", json.dumps({"style": "s", "test_cases": code})),
        ("prime_rl_code-8", json.dumps({"style": "s", "test_cases": json.dumps({"inputs": ["1"], "outputs": ["2"]})})),
        ("formatask_dual_e0_12", json.dumps({"ground_truth1": "a", "ground_truth2": " b "})),
        ("complex_json_output_x", json.dumps({"ground_truth": '{"b": 1, "a": 2}'})),
        (None, json.dumps({"ground_truth": "g", "reasoning_gym_dataset": "t", "reasoning_gym_entry": "{}"})),
        ("ifeval_2", json.dumps({"ground_truth": json.dumps({"func_name": "unheard_of"})})),
    ]
    x = reward.ADAPTERS["keyed_json"].apply(rows(spark, "problem_id string, prompt string, verification_info string, `Qwen/Qwen3-4B_avg_reward` double", *[(p, ASK, v, 0.5) for p, v in data])).orderBy("pos").collect()
    assert [r.verifier_type for r in x] == ["if_rules", "code_asserts", "code_stdio", "multi_gt", "structured_match", "puzzle_match", "if_rules"]
    assert json.loads(x[0].ground_truth_text) == [{"instruction_id": "detectable_format:title", "kwargs": {"n": 3}}] and json.loads(x[0].verification_info_raw)["kwargs"] == [{"n": 3}]
    assert json.loads(x[1].ground_truth_text) == ["assert add(1, 2) == 3"] and json.loads(x[2].verification_info_raw)["unit_tests"] == {"inputs": ["1"], "outputs": ["2"]}
    assert json.loads(x[3].verification_info_raw) == {"alternative_ground_truths": ["b"], "subfamily": "formatask_dual_e0"} and x[4].ground_truth_text == '{"a":2,"b":1}'
    assert x[5].domain == "puzzle" and x[6]._drop_reason == "missing_ground_truth" and abs(x[0].avg_reward - 0.5) < 1e-6 and all(r._keep for r in x[:6])


def test_choices_are_flattened_and_subsets_capped(spark):
    df = rows(spark, "o array<struct<A:string,B:string>>", ([("x ", None), (None, "y")],))
    assert json.loads(df.select(reward.options_payload(df, F.col("o")).alias("p")).first().p) == {"options": {"A": "x", "B": "y"}}
    a = replace(reward.ADAPTERS["choice_qa"], cap=2)
    x = a.apply(rows(spark, "id_ string, input string, answer_text string, category string, original_dataset string, choices array<string>", *[(str(i), f"{ASK} {i % 5}", "yes", "c", "o", []) for i in range(9)])).collect()
    reasons = Counter(r._drop_reason for r in x)
    assert reasons == {None: 2, "subset_cap_downsample": 3, "duplicate_input_within_subset": 4}


def test_sources_and_sinks(spark, tmp_path, sf):
    path = tmp_path / "in.jsonl"
    path.write_text('{"id": "a", "n": 3, "deep": {"x": [1]}}\nnot json\n{"id": "b", "deep": "s"}\n')
    got = readers.json_lines(spark, str(path), {"id": "string", "n": "int", "deep": "string"}, as_text=("deep",)).collect()
    assert [(r.id, r.n, r.deep) for r in got] == [("a", 3, '{"x":[1]}'), (None, None, None), ("b", None, "s")] and got[1]._corrupt == "not json"
    reg = readers.Registry().add(readers.Source("docs", {"small": f"{sf}/documents.parquet", "marks": f"{sf}/labels.parquet"}))
    assert reg.read(spark, "docs", ["small"]).count() == 200 and reg.read(spark, "docs").filter("config = 'marks'").count() == 87
    assert reg.read(spark, "docs", ["small"], most=5, pos="doc_id").count() == 5
    assert readers.first_existing(spark, [str(tmp_path / "no"), str(path)]) == str(path)
    tagged = spark.createDataFrame([(1, None, True), (2, "r", False)], "id int, _drop_reason string, _keep boolean")
    sinks.write_split(tagged, str(tmp_path / "x.kept.parquet"), str(tmp_path / "x.dropped.parquet"))
    assert readers.finished_files(spark, str(tmp_path)) == [f"file:{tmp_path}/x.kept.parquet"]
    assert spark.read.parquet(str(tmp_path / "x.dropped.parquet")).first()._drop_reason == "r"
    p = spark.createDataFrame([("e", "math", 0.123456, "s")], "example_id string, predicted_domain string, confidence double, subsource_raw string")
    sinks.write_predictions(p, str(tmp_path / "p.csv"))
    assert sinks.read_predictions(spark, str(tmp_path / "p.csv")).first().confidence == 0.1235
    assert "| e | math |" in sinks.markdown(p, "T")


def test_streams(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.createDataFrame([("1", "A", "Same text"), ("2", "B", "same text!"), ("3", "A", "other")], "id string, ds string, t string").coalesce(1).write.parquet(src)
    stream = spark.readStream.schema("id string, ds string, t string").parquet(src)
    q = S.write_kept_and_dropped(S.exact_cross_source(stream, F.col("t"), "ds", "id"), str(tmp_path / "kept"), str(tmp_path / "dropped"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert {r.key for r in spark.read.parquet(str(tmp_path / "kept")).collect()} == {"1", "3"}
    assert [r.key for r in spark.read.parquet(str(tmp_path / "dropped")).collect()] == ["2"]
