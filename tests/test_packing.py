import pytest
from pyspark.sql import functions as F

from corpusprep.operators import packing as P


def test_group_texts_by_hand(spark):
    groups = {0: [[1, 2, 3], [], [4, 5, 6, 7, 8, 9, 10, 11], [12]], 1: [[1, 2]], 2: [[1, 2, 3, 4]], 3: [[1] * 9], 4: [[], []]}
    want = {0: [[1, 2, 3, 4], [5, 6, 7, 8], [9, 10, 11, 12]],
            1: [[1, 2]],                                  # less than a block: one short block
            2: [[1, 2, 3, 4]],
            3: [[1, 1, 1, 1], [1, 1, 1, 1]],              # the ninth token is dropped
            4: []}
    rows = [(g, i, ids, [-x for x in ids]) for g, docs in groups.items() for i, ids in enumerate(docs)]
    df = spark.createDataFrame(rows, "group_id long, row_idx long, input_ids array<int>, mask array<int>")
    got = {g: {} for g in groups}
    for r in P.group_texts(df, 4, also=("mask",)).collect():
        got[r.group_id][r.block_id] = list(r.input_ids)
        assert list(r.labels) == list(r.input_ids) and list(r.mask) == [-x for x in r.input_ids]
    assert {g: [b[k] for k in sorted(b)] for g, b in got.items()} == want


def test_group_texts_refuses_unequal_columns(spark):
    df = spark.createDataFrame([(0, 0, [1, 2], [1])], "group_id long, row_idx long, input_ids array<int>, mask array<int>")
    with pytest.raises(Exception, match="differ in length"):
        P.group_texts(df, 4, also=("mask",)).collect()


def test_pad_to_longest(spark):
    df = spark.createDataFrame([(0, [5, 6], [5, -100]), (0, [7], [7]), (1, [8], [8])],
                               "batch int, input_ids array<int>, labels array<int>")
    got = sorted((r.batch, list(r.input_ids), list(r.labels)) for r in P.pad_to_longest(df, "batch", 0).collect())
    assert got == [(0, [5, 6], [5, -100]), (0, [7, 0], [7, -100]), (1, [8], [8])]


def test_token_conservation_sf0001(spark):
    from corpusprep.plans import training_queries as T
    sf = "/root/testdata/sf0.001"
    toks = T.doc_tokens(spark, sf)
    total = toks.select(F.sum(F.size("input_ids"))).first()[0]
    blocks = P.group_texts(P.assign_groups(toks, "doc_id", 1000), 1024)
    packed = blocks.select(F.sum(F.size("input_ids"))).first()[0]
    assert packed == total // 1024 * 1024 if total >= 1024 else packed == total


def test_padding(spark):
    df = spark.createDataFrame([(0, [5, 0, 6], [5, -100, 6]), (0, [7], [7])], "batch int, input_ids array<int>, labels array<int>")
    left = {len(r.input_ids): r for r in P.pad_left(df, "batch", 8, 0).collect()}
    assert list(left[3].input_ids) in ([5, 0, 6], [0, 0, 7])
    rows = sorted(P.pad_left(df, "batch", 8, 0).collect(), key=lambda r: r.input_ids[-1])
    assert list(rows[0].input_ids) == [5, 0, 6] and list(rows[0].attention_mask) == [True, False, True]
    assert list(rows[1].input_ids) == [0, 0, 7] and list(rows[1].labels) == [-100, -100, 7]
    right = P.pad_right(df, 4, 0).collect()
    assert all(len(r.input_ids) == 4 and len(r.labels) == 4 for r in right)


def test_effective_block_size():
    assert P.effective_block_size(None, 4096) == 1024
    assert P.effective_block_size(4096, 2048) == 2048
    assert P.effective_block_size(512, None) == 512
