import math

import pytest

from pyspark.sql import functions as F

from corpusprep.operators import metrics as M
from corpusprep.operators import splits as SP


def test_row_index_is_the_rank_under_any_partitioning(spark):
    df = spark.range(0, 400_000).withColumn("k", F.md5(F.col("id").cast("string")))
    for part in (df.repartition(2), df.repartition(7)):
        idx = SP.with_row_index(part, "k")
        rank = idx.select("id", "k", "row_idx").toPandas().sort_values("k")
        assert rank.row_idx.tolist() == list(range(400_000))


def test_row_index_nulls_small_and_empty(spark):
    df = spark.createDataFrame([(None, "n"), (5, "b"), (3, "a")], "k long, v string")
    assert sorted((r.row_idx, r.v) for r in SP.with_row_index(df, "k").collect()) == [(0, "n"), (1, "a"), (2, "b")]
    assert SP.with_row_index(df.limit(0), "k").count() == 0


def test_head_split_large(spark):
    df = spark.range(0, 400_000).withColumnRenamed("id", "doc_id").repartition(5)
    for pct, k in [(50, 200_000), (90, 360_000)]:
        r = SP.head_split(df, pct, "doc_id").where("split = 'validation'").agg(F.count("doc_id"), F.max("doc_id")).first()
        assert tuple(r) == (k, k - 1)


def test_head_split_edges(spark):
    df = spark.range(0, 21).withColumnRenamed("id", "doc_id")
    for pct, k in [(0, 0), (100, 21), (10, 2), (50, 10)]:  # round(10.5) = 10 (half to even)
        rows = SP.head_split(df, pct, "doc_id").collect()
        val = sorted(r.doc_id for r in rows if r.split == "validation")
        assert val == list(range(k)), pct
    one = spark.range(0, 1).withColumnRenamed("id", "doc_id")
    assert SP.head_split(one, 50, "doc_id").first().split == "train"


def test_random_split_stable_and_disjoint(spark):
    df = spark.range(0, 2000).withColumnRenamed("id", "doc_id")
    a = {r.doc_id: r.split for r in SP.random_split(df, 10, 42, "doc_id").collect()}
    b = {r.doc_id: r.split for r in SP.random_split(df.repartition(5), 10, 42, "doc_id").collect()}
    assert a == b and len(a) == 2000
    share = sum(v == "validation" for v in a.values()) / 2000
    assert 0.05 < share < 0.15


def test_take(spark):
    df = spark.range(10, 0, -1).withColumnRenamed("id", "doc_id")
    assert sorted(r.doc_id for r in SP.take(df, 3, "doc_id").collect()) == [1, 2, 3]
    assert SP.take(df, 0, "doc_id").count() == 10


def test_token_accuracy_ignored_labels_are_misses(spark):
    df = spark.createDataFrame([([1, 2, 3], [-100, 2, 9]), ([4], [4])], "preds array<int>, labels array<int>")
    # compare labels[1:] = [2, 9] with preds[:-1] = [1, 2]: no hit; length-1 row adds nothing
    assert M.token_accuracy(df).first().accuracy == 0.0
    df2 = spark.createDataFrame([([5, 7, 0], [-100, 5, 7])], "preds array<int>, labels array<int>")
    assert M.token_accuracy(df2).first().accuracy == 1.0
    assert M.token_accuracy(df2, normalize=False).first().accuracy == 2.0


def test_token_accuracy_weights_and_lengths(spark):
    df = spark.createDataFrame([([5, 7, 0], [-100, 5, 9], [0.5, 2.0], 3.0), ([1, 0], [-100, 1], [1.0], 1.0)],
                               "preds array<int>, labels array<int>, w array<double>, r double")
    # hits: (5 = 5, 7 != 9) and (1 = 1)
    assert M.token_accuracy(df).first().accuracy == 2 / 3
    assert M.token_accuracy(df, weight_col="w").first().accuracy == 1.5 / 3.5
    assert M.token_accuracy(df, weight_col="r", normalize=False).first().accuracy == 4.0
    bad = spark.createDataFrame([([1, 2, 3, 4, 5], [1, 2])], "preds array<int>, labels array<int>")
    with pytest.raises(Exception, match="differ in length"):
        M.token_accuracy(bad).collect()


def test_perplexity_overflow(spark):
    df = spark.createDataFrame([(800.0,), (800.0,)], "loss double")
    assert math.isinf(M.perplexity(df).first().perplexity)
    df2 = spark.createDataFrame([(1.0,), (3.0,)], "loss double")
    assert abs(M.perplexity(df2).first().perplexity - math.exp(2.0)) < 1e-12


def test_format_numel_by_hand(spark):
    want = [(0, 1000, "0"), (999, 1000, "999"), (1000, 1000, "1.00 K"), (1152, 1000, "1.15 K"), (12345, 1000, "12.35 K"),
            (1048576, 1000, "1.05 M"), (1500000, 1000, "1.50 M"), (2**31, 1000, "2.15 B"), (5 * 10**12, 1000, "5000.00 B"),
            (999, 1024, "999"), (1023, 1024, "1023"), (1024, 1024, "1.00 K"), (1152, 1024, "1.12 K"), (3456, 1024, "3.38 K"),
            (1048576, 1024, "1.00 M"), (2**31, 1024, "2.00 B")]
    df = spark.createDataFrame([(n, b) for n, b, _ in want], "n long, b int")
    got = {(r.n, b): r.s for b in (1000, 1024) for r in df.where(F.col("b") == b).select("n", M.format_numel("n", b).alias("s")).collect()}
    assert got == {(n, b): s for n, b, s in want}


def test_argmax_first_maximum(spark):
    df = spark.createDataFrame([([0.1, 0.9, 0.9],), ([3.0],)], "v array<float>")
    assert [r.a for r in df.select(M.argmax_last("v").alias("a")).collect()] == [1, 0]


def test_row_index_over_many_ranges_and_repeated_keys(spark, monkeypatch):
    monkeypatch.setattr(SP, "KEYS_PER_RANGE", 1000)
    df = spark.range(0, 20_000).select(F.md5(F.col("id").cast("string")).alias("k"), F.col("id").alias("v"))
    rank = SP.with_row_index(df.union(spark.createDataFrame([(None, -1)], "k string, v long")), "k").toPandas().sort_values("k", na_position="first")
    assert rank.row_idx.tolist() == list(range(20_001)) and rank.v.iloc[0] == -1
    # a repeated key, or a second null, raises; it never multiplies rows
    for more in ([("a", 1), ("a", 2)], [(None, 1), (None, 2)]):
        with pytest.raises(ValueError, match="unique keys"):
            SP.with_row_index(spark.createDataFrame(more, "k string, v int"), "k")


def test_perplexity_per_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 900.0), (None, 0.0), ("c", None)], "lang string, loss double")
    got = {r.lang: r.perplexity for r in M.perplexity(df, "loss", ("lang",)).collect()}
    assert abs(got["a"] - math.exp(2.0)) < 1e-12 and math.isinf(got["b"]) and got[None] == 1.0 and got["c"] is None
