from pyspark.sql import functions as F

from corpusprep.operators import tokens as TK


# Worked by hand with BOS 1, EOS 2 and limits 5 + 5: (ids of source0, target0, source1, ...), input_ids, labels,
# truncated, turns kept. -100 stands for an ignored label.
X = -100
CASES = [
    ([[5, 6], [7, 8]], [1, 5, 6, 7, 8, 2], [X, X, X, 7, 8, 2], False, 1),
    ([[5, 6, 7, 8], [9]], [1, 5, 6, 7, 8, 9, 2], [X, X, X, X, X, 9, 2], False, 1),       # 5 ids with BOS: just fits
    ([[5, 6, 7, 8, 9], [9]], [1, 5, 6, 7, 8, 9, 2], [X, X, X, X, X, 9, 2], True, 1),      # one more is cut
    ([[5], [6, 2]], [1, 5, 6, 2], [X, X, 6, 2], False, 1),                                # a target's own EOS is not doubled
    ([[5], [6, 7, 8], [5], [6, 7, 8, 9]], [1, 5, 6, 7, 8, 2], [X, X, 6, 7, 8, 2], False, 1),  # 6 + 6 > 10: turn 2 lost
    ([[5], [6], [5, 6, 7], [8, 9]], [1, 5, 6, 2, 5, 6, 7, 8, 9, 2], [X, X, 6, 2, X, X, X, 8, 9, 2], False, 2),
    ([[5], [6], [5, 6, 7], [8, 9, 10]], [1, 5, 6, 2], [X, X, 6, 2], False, 1),            # over by one: lost, not cut
    ([[5], [6], [5, 6, 7], [8, 9, 10, 11, 12]], [1, 5, 6, 2], [X, X, 6, 2], True, 1),     # cut, then lost: still marked
    ([[], []], [1, 2], [X, 2], False, 1),
    ([[5], [6], [2, 7], [8]], [1, 5, 6, 2, 7, 8, 2], [X, X, 6, 2, X, 8, 2], False, 2),    # a source's leading EOS goes
]


def test_encode_dialog_by_hand(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, ids array<array<int>>")
    out = df.select("i", TK.encode_dialog(F.col("ids"), 1, 2, 5, 5).alias("e")).collect()
    assert len(out) == len(CASES)
    for r in out:
        got = (list(r.e.input_ids), list(r.e.labels), r.e.truncated, r.e.n_turns_kept)
        assert got == CASES[r.i][1:], CASES[r.i]


def test_encoder_udf_and_separator(spark):
    enc = TK.encoder_udf(lambda: lambda texts: [[ord(c) for c in t] for t in texts])
    df = spark.createDataFrame([("ab",), (None,)], "text string")
    assert [list(r.i) for r in df.select(enc("text").alias("i")).collect()] == [[97, 98], []]
    v = TK.Vocabulary(["<unk>", "<s>", "</s>", "a", "b"])
    ids = spark.createDataFrame([([3, 4, 99],)], "x array<int>")
    assert TK.decode_ids(ids, v, F.col("x"), "t", sep="|").first().t == "a|b|<?>"


def test_preference_pad_id():
    assert TK.preference_pad_id(TK.Vocabulary(["a", "b"], specials=(), unk_token=None, bos_token=None, eos_token=None)) == 0
    assert TK.preference_pad_id(TK.Vocabulary(["a", "<p>"], pad_token="<p>")) == 1


def test_vocabulary_order_and_encode(spark):
    df = spark.createDataFrame([("b a b </s> c c c",)], "text string")
    v = TK.build_vocabulary(df, "text", size=6)
    assert v.tokens == ["<unk>", "<s>", "</s>", "c", "b", "a"]
    ids = df.select(v.encode(spark, F.col("text")).alias("i")).first().i
    assert list(ids) == [4, 5, 4, 2, 3, 3, 3]
    dec = TK.decode_ids(df.select(F.array(F.lit(4), F.lit(99)).alias("x")), v, F.col("x"), "t").first().t
    assert dec == "b <?>"


def test_tokenize_pair_masks_unless_empty_source(spark):
    v = TK.Vocabulary(["<unk>", "<s>", "</s>", "a", "b", "c"])
    df = spark.createDataFrame([("a b ", "c", None, "a b "), ("", "c", "geo", ""), ("a a a a", " b", None, "a a a a"),
                                ("a b", "c", None, "a b")], "source string, target string, category string, k string")
    rows = {r.k: r for r in TK.tokenize_pair(df, v, max_length=4).collect()}
    r = rows["a b "]
    assert list(r.input_ids) == [1, 3, 4, 5] and list(r.labels) == [-100, -100, -100, 5]
    assert r.seq_category == "unknown"
    assert list(rows[""].labels) == [1, 5, 2] and rows[""].seq_category == "geo"
    assert list(rows["a a a a"].labels) == [-100] * 4  # source longer than the limit
    # source and target are tokenized as one string: "a b" + "c" gives the unknown piece "bc"
    assert list(rows["a b"].input_ids) == [1, 3, 0, 2]


def test_filter_empty_labels(spark):
    df = spark.createDataFrame([([-100, -100],), ([],), ([-100, 5],)], "labels array<int>")
    assert TK.filter_empty_labels(df).count() == 1


def test_resolve_special_tokens_yi():
    from corpusprep.operators.templates import get_template
    v = TK.resolve_special_tokens(TK.Vocabulary(["<unk>", "<s>", "</s>"]), get_template("yi"))
    assert v.eos_token == "<|im_end|>" and v.eos_id == 3 and v.pad_id == 0


def test_top_pieces_are_exact_whatever_the_sketch_holds(spark):
    import random
    from collections import Counter

    from pyspark.sql import functions as F
    r = random.Random(4)
    words = [f"w{i:04d}" for i in range(3000)]
    toks = r.choices(words, [1 / (i + 1) ** 1.2 for i in range(3000)], k=40_000) + ["é", "日本", "w0001 x"] * 50
    r.shuffle(toks)
    df = spark.createDataFrame([(t,) for t in toks] + [(None,)] * 9, "tok string").repartition(6)
    order = [t for t, _ in sorted(Counter(toks).items(), key=lambda x: (-x[1], x[0]))]
    # no overflow; overflow with a recount of candidates; too many candidates; a k-th count below what the sketches lost
    for k, capacity, most in ((100, 1 << 20, 1 << 22), (20, 400, 1 << 22), (20, 400, 3), (1500, 60, 1 << 22), (5, 10, 1 << 22), (0, 10, 10), (9999, 1 << 20, 10), (9999, 50, 10)):
        assert TK.top_pieces(df, k, capacity, most) == order[:k], (k, capacity)
    assert TK.top_pieces(df.limit(0), 5) == []
    sketch = df.where("tok IS NOT NULL").mapInArrow(lambda it: TK._frequent(it, 400), "tok string, n long, lost long")
    true, lost = Counter(toks), sketch.agg(F.sum("lost")).first()[0]
    low = Counter({x["tok"]: x["n"] for x in sketch.groupBy("tok").agg(F.sum("n").alias("n")).collect()})
    assert lost > 0 and all(low[t] <= n <= low[t] + lost for t, n in true.items())
    assert sketch.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] <= 401
