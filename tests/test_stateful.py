"""Shuffle buffer and packing with state: deliveries, restarts, replays."""

import tempfile
from collections import defaultdict

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusprep.operators import packing as P
from corpusprep.streaming import stateful as SF
from corpusprep.streaming import stream as ST


def _dir():
    return tempfile.mkdtemp(prefix="corpusprep-stateful-")


def plain_buffer(rows, seed, lane, size):
    """Rows of one lane in arrival order -> (rows that leave, in order; rows left by slot)."""
    slots, out = {}, []
    for n, r in enumerate(rows):
        s = n if n < size else SF.slot_of(seed, lane, n, size)
        if n >= size:
            out.append(slots[s])
        slots[s] = r
    return out, slots


def _deliver(spark, parts, transform, d, lanes, fail_at=None):
    """Write each part as a file and run the stream over it; ``fail_at``: that delivery's sink fails once after writing."""
    broken = set()
    for k, rows in enumerate(parts):
        rows.coalesce(2).write.mode("append").parquet(f"{d}/in")

        def sink(batch, n, k=k):
            batch.write.mode("overwrite").parquet(f"{d}/out/batch_id={n}")
            if k == fail_at and k not in broken:
                broken.add(k)
                raise RuntimeError("the sink was lost")

        def run():
            q = (transform(ST.stream_corpus(spark, f"{d}/in", rows.schema)).writeStream.foreachBatch(sink)
                 .option("checkpointLocation", f"{d}/state").trigger(availableNow=True).start())
            q.awaitTermination()

        with SF.state_settings(spark, lanes):
            if k == fail_at:
                with pytest.raises(Exception, match="the sink was lost"):
                    run()
            run()
    return spark.read.parquet(f"{d}/out").drop("batch_id")


def _lanes(df, lanes):
    return df.withColumn("lane", SF.lane_of("id", lanes))


def test_shuffle_buffer_over_deliveries_and_a_replay(spark):
    lanes, size, seed = 2, 7, 5
    everything = spark.range(90).select("id", F.when(F.col("id") % 11 != 0, F.concat(F.lit("t"), "id")).alias("text"),
                                        F.array("id", F.lit(None).cast("long")).alias("more"))
    parts = [everything.where(f"id % 3 = {k}") for k in range(3)]
    want = {}
    for lane in range(lanes):
        mine = _lanes(everything, lanes).where(F.col("lane") == lane).orderBy(F.col("id") % 3, "id").collect()
        want[lane] = plain_buffer([r.id for r in mine], seed, lane, size)
    for fail_at in (None, 1):
        d = _dir()
        out = _deliver(spark, parts, lambda s: SF.shuffle_buffered(s, seed, "id", size, lanes), d, lanes, fail_at)
        got = defaultdict(dict)
        for r in out.collect():
            assert (r.text is None) == (r.id % 11 == 0) and list(r.more) == [r.id, None]
            got[r.lane][r.position] = r.id
        rest = SF.buffer_rest(spark, f"{d}/state", seed).collect()
        for lane, (left, slots) in want.items():
            assert [got[lane][p] for p in sorted(got[lane])] == left
            held = sorted((r.position, r.id) for r in rest if r.lane == lane)
            assert [p for p, _ in held] == list(range(len(left), len(left) + len(slots))) and {i for _, i in held} == set(slots.values())
        assert sorted([r.id for r in out.collect()] + [r.id for r in rest]) == list(range(90))
        # rows of an earlier delivery leave in a later one
        assert any(got[0][p] % 3 < got[0][q] % 3 for p in got[0] for q in got[0] if p > q)


def test_blocks_over_deliveries_equal_one_static_packing(spark):
    lanes, block, group = 3, 16, 10
    docs = spark.range(95).select("id", F.when(F.col("id") % 13 != 5, F.expr("transform(sequence(1, cast(id * 7 % 29 as int)), x -> cast(id * 100 + x as int))"))
                                  .alias("ids0"))
    docs = docs.select("id", F.when(F.col("id") % 29 == 0, F.array().cast("array<int>")).otherwise(F.col("ids0")).alias("input_ids"))
    docs = docs.withColumn("mask", F.transform("input_ids", lambda x: -x))
    parts = [docs.where(f"id % 3 = {k}") for k in range(3)]
    order = F.row_number().over(Window.partitionBy("lane").orderBy(F.col("id") % 3, "id")) - 1
    static = _lanes(docs, lanes).withColumn("row_idx", order).withColumn("group_id", F.col("lane") * 1000 + F.floor(F.col("row_idx") / group))
    want = {(r.group_id, r.block_id): (list(r.input_ids), list(r["mask"])) for r in P.group_texts(static, block, also=("mask",)).collect()}
    for fail_at in (None, 2):
        d = _dir()
        out = _deliver(spark, parts, lambda s: SF.pack_stream(s, block, "id", rows_per_group=group, lanes=lanes, also=("mask",)), d, lanes, fail_at)
        out = out.unionByName(SF.open_blocks(spark, f"{d}/state", also=("mask",)))
        rows = out.collect()
        got = {(r.lane * 1000 + r.group_id, r.block_id): (list(r.input_ids), list(r["mask"])) for r in rows}
        assert len(got) == len(rows) and got == want and len(want) > 30
        assert all(r.labels == r.input_ids for r in rows)


def test_settings_come_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with SF.state_settings(spark, 3):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert SF.slot_of(1, 0, 10, 7) == SF.slot_of(1, 0, 10, 7) < 7
