"""Findings of round 3, each on rows of its own."""

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from corpusprep.operators import quality as Q
from corpusprep.operators import tokens as TK
from corpusprep.plans import cleaning_queries as CQ
from corpusprep.plans import stream_udf_queries as SU
from corpusprep.sources import json_records as J
from corpusprep.streaming import stateful as SF

TEXTS = ["the quick brown fox jumps over the lazy dog " * 3, "short", None, "a line that is long enough to stay here\nand one more"]


def _documents(spark, tmp_path, parts):
    rows = [(i, "en", TEXTS[i % len(TEXTS)]) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(parts)
    if parts > 1:
        df.write.parquet(f"{tmp_path}/documents.parquet")
    else:
        df.toPandas().to_parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("parts", [1, 3])
def test_stream_clean_reads_one_file_and_a_directory(spark, tmp_path, parts):
    sf = _documents(spark, tmp_path, parts)
    got = sorted(r["doc_id"] for r in SU.q_stream_clean(spark, sf).collect())
    assert got == [i for i in range(40) if i % 4 in (0, 3)]


@pytest.mark.parametrize("parts", [1, 3])
def test_stream_packed_reads_one_file_and_a_directory(spark, tmp_path, parts):
    sf = _documents(spark, tmp_path, parts)
    rows = SU.q_stream_packed(spark, sf).collect()
    assert {r["batch_id"] for r in rows} == {0} and sum(r["n_tokens"] for r in rows) == 10 * (27 + 1 + 12)


def test_a_flagged_table_of_any_size_is_joined_and_not_collected(spark, monkeypatch):
    words = [("en", "bad"), ("en", "Very Bad word"), ("en", "bad word thing"), ("en", "bad"), ("en", None), (None, "x"), ("en", "..."), ("zh", "坏人"), ("zh", "恶")]
    rows = [(1, "en", "a bad day", 1 / 3), (1, "en", "VERY bad, word thing!", 1.0), (None, "en", "very bad idea", 1 / 3), (4, "de", "bad", 0.0),
            (5, "zh", "他坏人 恶坏", 3 / 5), (7, None, "bad", 0.0), (8, "en", None, 0.0), (9, "en", "", 0.0), (10, "en", "bad bad", 1.0), (10, "en", "bad bad", 1.0),
            (11, "en", "bad " + "x " * 50_000, 1 / 50_001)]
    df = spark.createDataFrame([r[:3] for r in rows], "id int, lang string, text string")
    listed = spark.createDataFrame(words, "lang string, word string")
    monkeypatch.setattr(Q, "SENT_LIST_BYTES", 0)
    monkeypatch.setattr(Q, "GATHERED_TOKENS", 7)
    out = Q.flagged_ratio_by_language(df, listed)
    assert out.columns == ["id", "lang", "text", "flagged_ratio"]
    assert sorted(map(tuple, out.select("text", "flagged_ratio").collect()), key=str) == sorted(((r[2], r[3]) for r in rows), key=str)
    many = spark.range(200_000).select(F.lit("en").alias("lang"), F.concat(F.lit("w"), "id").alias("word"))
    monkeypatch.setattr(Q, "SENT_LIST_BYTES", 1 << 20)
    monkeypatch.setattr(Q, "_trie", None)  # a table of over a megabyte is sent to no worker
    assert Q.flagged_ratio_by_language(spark.createDataFrame([("en", "w5 w199999 y z")], "lang string, text string"), many).first()["flagged_ratio"] == 0.5


def test_stream_tokens_travel_and_stay_as_bytes(spark):
    df = spark.createDataFrame([(1, [5, None, -7, 2**31 - 1]), (2, []), (3, None)], "id int, ids array<int>")
    packed = df.select("id", SF._packed(F.col("ids")).alias("b"))
    assert {r["id"]: r["n"] for r in packed.select("id", F.octet_length("b").alias("n")).collect()} == {1: 16, 2: 0, 3: None}
    assert {r["id"]: r["ids"] for r in packed.select("id", SF._unpacked(F.col("b")).alias("ids")).collect()} == {1: [5, None, -7, 2**31 - 1], 2: [], 3: []}


def test_json_fragments_come_before_their_block_ends():
    def batches():
        for k in range(10):
            read.append(k)
            rows = [(f'{{"a": "{"x" * 2000}"', "f", 0, False, 0, True)] * 1000 if k < 9 else [("\n", "f", 0, False, 0, True)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["value", "path", "block", "inside", "depth", "open_end"])

    read: list[int] = []
    found = J._fragments(batches())
    assert next(found).num_rows and len(read) < 5
    assert sum(b.num_rows for b in found) > 0 and len(read) == 10


def test_flagged_characters_need_no_array_of_characters(spark):
    df = spark.createDataFrame([("Straße, rr",), ("l l",), ("",), (None,), ("l𝒳l l",)], "text string")
    out = df.select("text", Q.flagged_words_ratio("text", ["ß", "rr", "ll"], mode="character", use_words_aug=True).alias("r"))
    assert "regexp_like" not in out._jdf.queryExecution().toString()
    assert [r["r"] for r in out.collect()] == [2 / 15, 1 / 3, 0.0, 0.0, 1 / 7]


def test_ngram_ranks_are_equal_for_equal_ngrams_alone():
    rng = np.random.default_rng(1)
    for top in (3, 100, 0x10FFFF):
        cps = rng.integers(1, top, 3000).astype(np.uint32)
        cps[1500:1700] = cps[100:300]
        for n in (1, 2, 7, 10, 33):
            rank, below = Q._ngram_ranks(cps, n)
            grams = [tuple(cps[i:i + n].tolist()) for i in range(len(cps) - n + 1)]
            assert len(rank) == len(grams) and len(set(grams)) == len(set(rank.tolist())) == len(set(zip(grams, rank.tolist()))) and rank.max() < below


def test_near_pairs_hashes_every_text_once(spark, tmp_path):
    out = CQ.q_near_pairs(spark, _documents(spark, tmp_path, 3))
    assert "ArrowEvalPython" not in out._jdf.queryExecution().toString()


def test_an_encoder_gets_texts_in_slices(spark):
    def encoder():
        def encode(texts):
            assert sum(map(len, texts)) <= 1 << 20
            return [[len(t), ord(t[0])] if t else [] for t in texts]
        return encode

    df = spark.range(3000, numPartitions=1).select("id", F.when(F.col("id") % 7 > 0, F.repeat(F.char(F.lit(65) + F.col("id") % 7), 1000)).alias("text"))
    got = df.select("id", TK.encoder_udf(encoder)(F.col("text")).alias("ids")).collect()
    assert all(r["ids"] == ([1000, 65 + r["id"] % 7] if r["id"] % 7 else []) for r in got) and len(got) == 3000


def test_lookup_keeps_pieces_in_arrow_buffers():
    index = pa.array(["<unk>", "a", "b"])
    ends, ids = TK._lookup_flat(pa.array([["a", "x"], None, [], ["b", None]], pa.list_(pa.string())).slice(0), index, 0)
    assert ends.tolist() == [0, 2, 2, 2, 4] and ids.to_pylist() == [1, 0, 2, 0]
    assert TK._lookup_flat(pa.array([["a"], ["b", "a"]]).slice(1), index, 0)[1].to_pylist() == [2, 1]


def test_lookup_of_null_and_empty_lists(spark):
    vocab = TK.Vocabulary(["<unk>", "<s>", "</s>", "a", "b"])
    df = spark.createDataFrame([(1, "a b c", ["a", None, ""]), (2, None, None), (3, "", [])], "id int, text string, texts array<string>")
    got = {r["id"]: (r["x"], r["y"]) for r in df.select("id", vocab.encode(spark, F.col("text")).alias("x"), vocab.encode_many(spark, F.col("texts")).alias("y")).collect()}
    assert got == {1: ([3, 4, 0], [[3], [], []]), 2: (None, None), 3: ([], [])}
