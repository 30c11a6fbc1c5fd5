import math
from collections import Counter

from pyspark.sql import functions as F

from corpusprep.operators import quality as Q


def brute_repetition(text, n=10):
    grams = [text[i:i + n] for i in range(len(text) - n + 1)]
    if not grams:
        return 0.0
    counts = sorted(Counter(grams).values(), reverse=True)
    k = min(int(math.sqrt(len(counts))), sum(1 for c in counts if c > 1))
    return sum(counts[:k]) / sum(counts)


TEXTS = ["", "short", "abcdefghij" * 5, "the cat sat on the mat. " * 7, "𝕏y" * 30 + "zz", "no repeats here at all!",
         "² ½ ⅷ 一 ٣ " * 3]


def test_repetition_ratio_matches_brute_force(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id int, text string")
    got = {r.id: r.r for r in df.select("id", Q.character_repetition_ratio(F.col("text"), 10).alias("r")).collect()}
    for i, t in enumerate(TEXTS):
        assert abs(got[i] - brute_repetition(t)) < 1e-12, t


def test_alphanumeric_ratio(spark):
    rows = [(0, ""), (1, "!!!"), (2, "ab!!"), (3, "²½ⅷ一٣"), (4, "𝕏 x")]
    df = spark.createDataFrame(rows, "id int, text string")
    got = {r.id: r.r for r in df.select("id", Q.alphanumeric_ratio("text").alias("r")).collect()}
    for i, t in rows:
        want = (sum(c.isalnum() for c in t) / len(t)) if t else 0.0
        assert abs(got[i] - want) < 1e-12, t


def test_max_line_length_line_ends(spark):
    rows = [(0, "a\nbb\r\nccc\rdddd"), (1, "x" * 25 + "\n"), (2, ""), (3, "no newline")]
    df = spark.createDataFrame(rows, "id int, text string")
    got = {r.id: r.m for r in df.select("id", Q.maximum_line_length("text").alias("m")).collect()}
    assert got == {0: 4, 1: 25, 2: 0, 3: 10}


def test_flagged_words_ratio_and_aug(spark):
    df = spark.createDataFrame([(0, "Stupid idea, stupid!"), (1, ""), (2, "fine words only")], "id int, text string")
    got = {r.id: r.r for r in df.select("id", Q.flagged_words_ratio("text", ["stupid"]).alias("r")).collect()}
    assert got == {0: 2 / 3, 1: 0.0, 2: 0.0}
    # characters with adjacent pairs: "ab" is flagged, tokens a,b,c + ab,bc -> 1/5
    d2 = spark.createDataFrame([(0, "abc")], "id int, text string")
    r = d2.select(Q.flagged_words_ratio("text", ["ab"], mode="character", use_words_aug=True).alias("r")).first().r
    assert abs(r - 1 / 5) < 1e-12


def test_remove_null_text_and_missing_column(spark):
    df = spark.createDataFrame([(0, None), (1, "x")], "id int, text string")
    assert [r.id for r in Q.remove_null_text(df).collect()] == [1]
    no_text = spark.createDataFrame([(0,)], "id int")
    assert Q.remove_null_text(no_text).count() == 1


def test_filters_compose_in_one_stage(spark):
    df = spark.createDataFrame([(0, "x" * 40)], "id int, text string")
    out = Q.text_length_filter(Q.maximum_line_length_filter(df, min_len=20), min_len=30)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert out.count() == 1


def test_flagged_words_by_language_with_phrases(spark):
    words = [("en", "bad"), ("en", "Very Bad word"), ("en", "bad word thing"), ("en", None), (None, "x"), ("en", "..."), ("de", "schlimm"), ("zh", "坏人"), ("zh", "恶")]
    rows = [(1, "en", "a bad day", 1 / 3), (2, "en", "VERY bad, word thing!", 1.0), (3, "en", "very bad idea", 1 / 3), (4, "de", "bad schlimm", 0.5),
            (5, "zh", "他坏人 恶坏", 3 / 5), (6, "fr", "bad", 0.0), (7, None, "bad", 0.0), (8, "en", None, 0.0), (9, "en", "", 0.0), (10, "en", "bad bad", 1.0),
            (11, "en", "bad " + "x " * 50_000, 1 / 50_001)]
    df = spark.createDataFrame([r[:3] for r in rows], "id int, lang string, text string").withColumn("word", F.lit("clash"))
    listed = spark.createDataFrame(words, "lang string, word string")
    got = {r.id: r.flagged_ratio for r in Q.flagged_ratio_by_language(df, listed).collect()}
    assert got == {r[0]: r[3] for r in rows}
    kept = Q.flagged_words_filter_by_language(df, listed, max_ratio=0.34)
    assert sorted(r.id for r in kept.collect()) == [1, 3, 6, 7, 8, 9, 11] and kept.columns == df.columns
    assert Q.flagged_ratio_by_language(df, listed.limit(0)).where("flagged_ratio > 0").count() == 0


def test_a_list_of_100000_words_in_two_languages(spark):
    listed = spark.range(100_000).select(F.when(F.col("id") % 2 == 0, "en").otherwise("de").alias("lang"),
                                         F.concat(F.lit("w"), "id", F.when(F.col("id") % 3 == 0, F.concat(F.lit(" v"), "id")).otherwise("")).alias("word"))
    df = spark.createDataFrame([(1, "en", "w2 w3 w0 v0 zz"), (2, "de", "w2 w3 v3 w1"), (3, "en", " ".join(f"w{i}" for i in range(1000)))], "id int, lang string, text string")
    got = {r.id: r.flagged_ratio for r in Q.flagged_ratio_by_language(df, listed).collect()}
    assert got == {1: 3 / 5, 2: 3 / 4, 3: sum(i % 2 == 0 and i % 3 != 0 for i in range(1000)) / 1000}


def test_a_list_too_large_to_send_is_refused(spark, monkeypatch):
    import pytest
    monkeypatch.setattr(Q, "MAX_LIST_BYTES", 10)
    with pytest.raises(ValueError, match="over 10"):
        Q.flagged_ratio_by_language(spark.createDataFrame([("en", "t")], "lang string, text string"),
                                    spark.createDataFrame([("en", "a long enough word")], "lang string, word string"))


def test_a_long_plain_list_gives_the_ratio_of_a_short_one(spark, monkeypatch):
    df = spark.createDataFrame([("bad day bad",), ("x y",), ("",), (None,), ("b ad",)], "text string")
    short = [r.r for r in df.select(Q.flagged_words_ratio("text", ["bad", "X"]).alias("r")).collect()]
    aug = [r.r for r in df.select(Q.flagged_words_ratio("text", ["bad"], use_words_aug=True).alias("r")).collect()]
    monkeypatch.setattr(Q, "PLAN_WORDS", 0)
    assert [r.r for r in df.select(Q.flagged_words_ratio("text", ["bad", "X"]).alias("r")).collect()] == short == [2 / 3, 0.5, 0.0, 0.0, 0.0]
    assert [r.r for r in df.select(Q.flagged_words_ratio("text", ["bad"], use_words_aug=True).alias("r")).collect()] == aug
