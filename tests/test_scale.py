"""What must hold at any size: long runs of white space, characters beyond ASCII, thresholds, places of rows, owners in streams."""

import random
import time

from pyspark.sql import functions as F

from tidemill.functions import text as X
from tidemill.functions.similarity import class_counts, indel_ratio, lcs_length, least_distance, levenshtein, levenshtein_ratio
from tidemill.operators import dedup as D
from tidemill.operators import post, quality
from tidemill.sources import readers, sinks
from tidemill.streaming import dedup as S


def plain(a, b, replace):
    """The distance by the whole table."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (0 if x == y else replace))
    return row[-1]


def test_white_space_inside_a_text_costs_one_pass(spark):
    df = spark.createDataFrame([("a" + " " * 1_000_000 + "b",), (" \t" * 500_000 + "　",), (None,), ("",), ("\x1c x ",)], "t string")
    df.select(X.strip("t"), X.blank("t")).collect()
    began = time.time()
    got = [(None if r.s is None else len(r.s), r.b) for r in df.select(X.strip("t").alias("s"), X.blank("t").alias("b")).collect()]
    assert time.time() - began < 5 and got == [(1_000_002, False), (0, True), (None, True), (0, True), (1, False)]


def test_distances_equal_the_whole_table_and_stop_below_a_threshold():
    rnd = random.Random(5)
    for _ in range(300):
        a = "".join(rnd.choice("abcé漢 ") for _ in range(rnd.randint(0, 150)))
        b = "".join(c if rnd.random() < 0.85 else rnd.choice(["", "x", "yy"]) for c in a) if rnd.random() < 0.7 else "".join(rnd.choice("abcé漢 ") for _ in range(rnd.randint(0, 150)))
        d, e, n, m = plain(a, b, 2), plain(a, b, 1), len(a) + len(b), max(len(a), len(b))
        assert lcs_length(a, b) * 2 == n - d and levenshtein(a, b) == e
        ratio, ratio_e = 100.0 if not n else 100.0 * (n - d) / n, 100.0 if a == b else 100.0 * (1.0 - e / m)
        for least in (0.0, 60.0, 78.0, 90.0):
            r, q = indel_ratio(a, b, least), levenshtein_ratio(a, b, least)
            assert (r is None) == (ratio < least) and (r is None or abs(r - ratio) < 1e-9)
            assert (q is None) == (ratio_e < least) and (q is None or q == ratio_e)


def test_class_counts_never_rule_out_a_near_pair(spark):
    rnd = random.Random(7)
    pairs = []
    for _ in range(200):
        a = "".join(rnd.choice("eanirstoudlc xyz漢") for _ in range(rnd.randint(1, 60)))
        pairs.append((a, "".join(rnd.choice([c, c, c, "", "e", "zz"]) for c in a)))
    df = spark.createDataFrame(pairs, "a string, b string")
    ca, cb = class_counts(F.col("a")), class_counts(F.col("b"))
    for r in df.select("a", "b", least_distance(ca, cb).alias("i"), least_distance(ca, cb, "levenshtein").alias("l")).collect():
        assert r.i <= plain(r.a, r.b, 2) and r.l <= plain(r.a, r.b, 1)


def test_texts_beyond_ascii_are_compared_by_their_characters(spark):
    df = spark.createDataFrame([(1, "A", "天地玄黃宇宙"), (2, "B", "日月盈昃辰宿"), (3, "B", "天地玄黃宇宙!"), (4, "C", None), (5, "C", " ")], "pos long, dataset_id string, t string")
    for metric in ("indel", "levenshtein"):
        got = {r.pos: r._drop_reason for r in D.fuzzy_set(df, F.col("t"), p=D.Blocking(metric=metric)).collect()}
        assert got == {1: None, 2: None, 3: "fuzzy_duplicate", 4: None, 5: None}


def test_languages_keep_their_texts_apart(spark):
    t = "the very same prompt of some length in both of the languages here"
    df = spark.createDataFrame([(1, "A", "en", t), (2, "B", "de", t), (3, "C", "en", t + " x"), (4, "D", None, t), (5, "E", None, t)], "pos long, dataset_id string, lang string, t string")
    got = {r.pos: r._drop_reason for r in D.fuzzy_set(df, F.col("t"), within=("lang",)).collect()}
    assert got == {1: None, 2: None, 3: "fuzzy_duplicate", 4: None, 5: "fuzzy_duplicate"}


def test_places_come_from_files(spark, tmp_path):
    for i in (1, 0):
        spark.range(i * 100, i * 100 + 50, 1, 1).write.parquet(str(tmp_path / f"p{i}"))
    df = spark.read.parquet(str(tmp_path / "p0"), str(tmp_path / "p1"))
    order = [r.id for r in readers.positioned(df).orderBy("pos").collect()]
    assert order == [*range(50), *range(100, 150)] and readers.positioned(df.withColumn("pos", F.lit(3))).first().pos == 3
    assert readers.positioned(spark.createDataFrame([(5,), (6,)], "x int")).select("x").count() == 2


def test_owners_in_streams_go_by_position(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.createDataFrame([(10, "B", "Same text"), (9, "A", "same text!"), (11, "B", "same, text")], "id long, ds string, t string").coalesce(1).write.parquet(src)
    stream = spark.readStream.schema("id long, ds string, t string").parquet(src)
    for ttl, trigger in ((None, {"availableNow": True}), ("30 days", {"processingTime": "1 second"})):
        at = str(tmp_path / str(ttl))
        q = S.write_kept_and_dropped(S.exact_cross_source(stream, F.col("t"), "ds", "id", ttl=ttl), f"{at}/kept", f"{at}/dropped", f"{at}/cp", **trigger)
        q.awaitTermination(1 if ttl else 60)
        for _ in range(60):  # with a ttl the stream goes on
            if any(p["numInputRows"] for p in q.recentProgress):
                break
            time.sleep(0.5)
        q.stop()
        assert [(r.key, r.owner) for r in spark.read.parquet(f"{at}/kept").collect()] == [("9", "A")]
        assert {r.key for r in spark.read.parquet(f"{at}/dropped").collect()} == {"10", "11"}


def test_reports_say_what_they_leave_out_and_empty_parts_are_not_written(spark, tmp_path):
    df = spark.range(5)
    assert "has more" in sinks.markdown(df, "T", 3) and "has more" not in sinks.markdown(df, "T", 5)
    tagged = spark.createDataFrame([(1, None, True)], "id int, _drop_reason string, _keep boolean")
    assert sinks.write_split(tagged, str(tmp_path / "kept"), str(tmp_path / "dropped")) == [str(tmp_path / "kept")]


def test_repeated_predictions_have_one_result(spark):
    df = spark.createDataFrame([("e", None), ("f", "math")], "example_id string, domain string")
    p = spark.createDataFrame([("e", "b", 0.2, 1), ("e", "a", 0.9, 0), ("e", "c", 0.1, 2)], "example_id string, predicted_domain string, confidence double, n int")
    told = lambda **k: {r.example_id: r.domain for r in post.apply_predictions(df, k.pop("p", p), **k).collect()}
    assert told() == {"e": "a", "f": "math"} and told(order="n")["e"] == "c" and told(p=p.drop("confidence"))["e"] == "c"


def test_language_profile(spark):
    rows = [("the cat and the dog",), ("der Hund und die Katze",), ("天地玄黃",), (None,), ("xyz",), ("the le",)]
    got = [tuple(r.p) for r in spark.createDataFrame(rows, "t string").select(quality.language_profile(F.col("t")).alias("p")).collect()]
    assert got[0] == ("en", 1.0, 1.0) and got[1][0] == "de" and got[2] == ("zh", 1.0, 0.0) and got[3] == (None, 0.0, 0.0) == got[4] and got[5][2] < 1


def test_labels_of_languages(spark):
    rows = [("__label__deu_Latn", "de"), ("zho_Hant", "zh"), ("__label__EN", "en"), ("xyz_Latn", "xy")]
    assert all(r.c == r.w for r in spark.createDataFrame(rows, "l string, w string").select(X.language_code("l").alias("c"), "w").collect())


def test_public_sets_that_are_there_are_registered(spark, tmp_path):
    name = "open-r1/Mixture-of-Thoughts"
    for part in ("math", "code", "unheard_of"):
        spark.range(3).write.parquet(str(tmp_path / readers.folder_of(name) / part))
    spark.range(2).write.parquet(str(tmp_path / readers.folder_of("nvidia/Nemotron-Post-Training-Dataset-v2") / "math"))
    reg = readers.public_registry(spark, str(tmp_path))
    assert sorted(reg.sources) == ["nvidia/Nemotron-Post-Training-Dataset-v2", name] and sorted(reg.sources[name].paths) == ["code", "math"]
    assert reg.read(spark, name).count() == 6 and {r.config for r in reg.read(spark, name).collect()} == {"math", "code"}
    assert not readers.public_registry(spark, str(tmp_path / "none")).sources
