"""What several operators of this package share: Arrow batches of texts and table reading."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts are handled in slices of about this many bytes, so that numpy work arrays stay small.
SLICE_BYTES = 1 << 21


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_slices(batch: pa.RecordBatch, id_col: int = 0, text_col: int = 1,
                max_bytes: int = SLICE_BYTES) -> Iterator[tuple[list, list[bytes]]]:
    """(ids, texts as UTF-8 bytes) in slices; a null text is the empty text, one very long text is a slice of its own."""
    ids = batch.column(id_col).to_pylist()
    texts = batch.column(text_col).cast(pa.large_binary())
    out_ids, out, size = [], [], 0
    for i, t in zip(ids, texts):
        b = t.as_py() or b""
        if out and size + len(b) > max_bytes:
            yield out_ids, out
            out_ids, out, size = [], [], 0
        out_ids.append(i)
        out.append(b)
        size += len(b)
    if out:
        yield out_ids, out


def grouped_rows(batches: Iterable[pa.RecordBatch], key_cols: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by ``key_cols``: no group is cut, several may come together."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        change = np.zeros(batch.num_rows, dtype=bool)
        for k in key_cols:
            v = batch.column(k).to_numpy(zero_copy_only=False)
            change[1:] |= v[1:] != v[:-1]
            if held:
                change[0] |= held[-1].column(k)[-1].as_py() != batch.column(k)[0].as_py()
        starts = np.flatnonzero(change)
        if starts.size == 0:
            held.append(batch)
            continue
        cut = int(starts[-1])
        whole = held + ([batch.slice(0, cut)] if cut else [])
        if whole:
            yield pa.Table.from_batches(whole)
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)


#: A key with over this share of all rows is hot; there can be at most ``1 / share`` of them.
HOT_SHARE = 1 / 4096


def join_counted(rows: DataFrame, counted: DataFrame, key: str) -> DataFrame:
    """``rows`` left-joined to ``counted`` (one row per ``key``, with its number of rows in ``n``), no key in one task.

    Keys with over ``HOT_SHARE`` of all counted rows are at most 4,096, so they are broadcast; each of the
    others holds less than that share and is shuffled. Null keys match null. ``rows`` is read once.
    """
    total = counted.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") > int(total * HOT_SHARE)
    found = [c for c in counted.columns if c != key]
    table = lambda df, name: df.select(F.col(key).alias(f"__{name}_key"), F.struct(*found).alias(f"__{name}"))
    met = rows.join(F.broadcast(table(counted.where(is_hot), "hot")), F.col(key).eqNullSafe(F.col("__hot_key")), "left")
    # rows that are answered go on under many keys that nothing has, so one pass over ``rows`` does
    salt = F.when(F.col("__hot").isNull(), 0).otherwise(F.pmod(F.monotonically_increasing_id(), F.lit(1 << 16)) + 1).cast("int")
    # zero in every row, but no constant, which the optimizer would take out of the join's keys
    rest = table(counted.where(~is_hot), "rest").withColumn("__zero", (F.col("__rest.n") < 0).cast("int"))
    both = met.withColumn("__salt", salt).join(rest, F.col(key).eqNullSafe(F.col("__rest_key")) & (F.col("__salt") == F.col("__zero")), "left")
    return both.select(*rows.columns, F.coalesce("__hot", "__rest").alias("__found")).select(*rows.columns, "__found.*")
