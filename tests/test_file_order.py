"""Seeded file order: permutations, restarts, files that come later."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from corpusprep.sources import file_order as FO


def _files(d, names):
    os.makedirs(d, exist_ok=True)
    for n in names:
        os.makedirs(os.path.dirname(f"{d}/{n}"), exist_ok=True)
        with open(f"{d}/{n}", "w") as fh:
            fh.write(f"{n}\nsecond line of {n}\n")



def test_manifest_is_a_seeded_permutation(spark):
    d = tempfile.mkdtemp(prefix="corpusprep-order-") + "/in"
    names = [f"part{i % 3}/f{i:02d}.txt" for i in range(30)]
    _files(d, names)
    a, again, b = (FO.file_manifest(spark, d, seed, "*.txt") for seed in (1, 1, 2))
    rows = a.collect()
    assert sorted(r.position for r in rows) == list(range(30))
    order = [r.path.split("/in/")[1] for r in sorted(rows, key=lambda r: r.position)]
    assert sorted(order) == sorted(names) and order != sorted(names)
    assert order == [r.path.split("/in/")[1] for r in again.orderBy("position").collect()]
    assert order != [r.path.split("/in/")[1] for r in b.orderBy("position").collect()]
    got = FO.read_in_file_order(spark, d, 1, "text", glob="*.txt")
    assert {(r.file_position, r.value) for r in got.where("value NOT LIKE 'second%'").collect()} == set(enumerate(order))
    assert got.count() == 60


def test_stream_goes_on_after_a_failure_and_with_new_files(spark):
    base = tempfile.mkdtemp(prefix="corpusprep-order-")
    d, sink, state = f"{base}/in", f"{base}/out", f"{base}/state"
    names = [f"f{i:02d}.txt" for i in range(11)]
    _files(d, names)
    order = [r.path.split("/in/")[1] for r in FO.file_manifest(spark, d, 5, "*.txt").orderBy("position").collect()]
    calls = []

    def run(fail_at=None):
        def transform(rows):
            calls.append(len(calls))
            if fail_at is not None and len(calls) == fail_at:
                raise RuntimeError("lost")
            return rows.where("value NOT LIKE 'second%'")
        FO.stream_in_file_order(spark, d, 5, transform, "text", files_per_step=4, glob="*.txt", sink=sink, checkpoint=state)

    with pytest.raises(Exception, match="lost"):
        run(fail_at=2)
    run()
    assert len(calls) == 2 + 2  # the first step is not read again
    read = lambda: [(r.file_position, r.value) for r in spark.read.parquet(sink).orderBy("file_position").collect()]
    assert read() == list(enumerate(order))
    run()
    assert len(calls) == 4  # nothing new, nothing read
    _files(d, ["a.txt", "zz.txt"])
    run()
    got = read()
    assert got[:11] == list(enumerate(order)) and {v for _, v in got[11:]} == {"a.txt", "zz.txt"} and [p for p, _ in got[11:]] == [11, 12]
    assert spark.read.parquet(sink).select(F.col("step").cast("int")).distinct().count() == 4
