"""Stateful streaming: a bounded shuffle buffer and packing that go on across micro-batches and restarts.

Both operators keep keyed state in Spark's state store (arbitrary stateful processing),
one key per *lane*. A lane is what a reader process is to a single-machine loader: it has
its own arrival order, its own buffer and its own open block. Rows are dealt to lanes by a
hash of their id, so lanes are even and no value of the data makes one hot; their number is
fixed for the life of a checkpoint. Arrival order in a lane is the order of the micro-batches,
and ``order_col`` inside a micro-batch, so a batch that runs again after a failure gives the
same rows.

State per lane is bounded: ``buffer_size`` rows, or less than one block of tokens. A task
holds one lane's rows of one micro-batch (``maxFilesPerTrigger`` bounds it) to sort them.
What is left in the state when the input ends is read with Spark's state reader:
``buffer_rest`` and ``open_blocks``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BUFFER_SIZE, LANES = 10_000, 8


@contextmanager
def state_settings(spark: SparkSession, lanes: int):
    """Session settings that a stateful query reads when it starts: the state store, and one state partition per lane."""
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, "spark.sql.shuffle.partitions": str(lanes)}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def lane_of(id_col: str | Column, lanes: int) -> Column:
    """The lane of a row: a hash of its id (a null id is lane 0's)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    h = F.conv(F.substring(F.md5(F.concat(c.cast("string"), F.lit(":lane"))), 1, 8), 16, 10).cast("long")
    return F.coalesce(F.pmod(h, F.lit(lanes)), F.lit(0)).cast("int")


def _in_order(rows: Iterator[Row], order_col: str) -> list[Row]:
    return sorted(rows, key=lambda r: (r[order_col] is not None, r[order_col]))


# ------------------------------------------------------------------ shuffle buffer

def slot_of(seed: int, lane: int, arrival: int, size: int) -> int:
    """The buffer slot that a lane's ``arrival``-th row (from 0) takes, once the buffer is full."""
    return int(hashlib.md5(f"{seed}:{lane}:{arrival}".encode()).hexdigest()[:12], 16) % size


class ShuffleBuffer(StatefulProcessor):
    """State: the number of arrivals, and the row in every slot.

    The first ``size`` rows fill the slots; each later one takes a seeded slot and sends the row in it out.
    """

    def __init__(self, row_type: T.StructType, order_col: str, size: int, seed: int):
        self.row_type, self.order_col, self.size, self.seed = row_type, order_col, size, seed

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.arrivals = handle.getValueState("arrivals", "n long")
        self.slots = handle.getMapState("slots", "slot int", self.row_type)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        lane, names = key[0], self.row_type.names
        n = self.arrivals.get()[0] if self.arrivals.exists() else 0
        held: dict[int, tuple] = {}  # slots touched by this batch: each is read and written once
        for row in _in_order(rows, self.order_col):
            slot = n if n < self.size else slot_of(self.seed, lane, n, self.size)
            if n >= self.size:
                out = held[slot] if slot in held else tuple(self.slots.getValue((slot,)))
                yield Row(lane=lane, position=n - self.size, **dict(zip(names, out)))
            held[slot] = tuple(row[c] for c in names)
            n += 1
        for slot, row in held.items():
            self.slots.updateValue((slot,), row)
        self.arrivals.update((n,))

    def close(self) -> None:
        pass


def shuffle_buffered(stream: DataFrame, seed: int, id_col: str, buffer_size: int = BUFFER_SIZE, lanes: int = LANES) -> DataFrame:
    """The stream's rows as they leave a seeded shuffle buffer: ``lane``, ``position`` (0-based, in the lane) and all columns.

    A row may leave in a later micro-batch than it came in; each leaves once. Start the query under
    ``state_settings``; ``buffer_rest`` gives the rows still held.
    """
    row_type = T.StructType([T.StructField(f.name, f.dataType, True) for f in stream.schema])
    out = T.StructType([T.StructField("lane", T.IntegerType()), T.StructField("position", T.LongType()), *row_type])
    keyed = stream.withColumn("__lane", lane_of(id_col, lanes))
    return keyed.groupBy("__lane").transformWithState(ShuffleBuffer(row_type, id_col, buffer_size, seed), out, "append", "none")


def state_table(spark: SparkSession, checkpoint: str, name: str) -> DataFrame:
    return spark.read.format("statestore").option("path", checkpoint).option("stateVarName", name).load()


def buffer_rest(spark: SparkSession, checkpoint: str, seed: int) -> DataFrame:
    """What the buffers of a stopped query hold, in a seeded order behind the rows that left: (lane, position, columns)."""
    slots = state_table(spark, checkpoint, "slots").select(F.col("key.__lane").alias("lane"), F.col("user_map_key.slot").alias("slot"), "user_map_value")
    arrivals = state_table(spark, checkpoint, "arrivals").select(F.col("key.__lane").alias("lane"), F.col("value.n").alias("n"))
    turn = F.md5(F.concat_ws(":", F.lit(seed), "lane", "slot", F.lit("rest")))
    ranked = slots.withColumn("place", F.row_number().over(Window.partitionBy("lane").orderBy(turn, "slot")))
    held = Window.partitionBy("lane")
    return (ranked.withColumn("held", F.count(F.lit(1)).over(held)).join(arrivals, "lane")
            .select("lane", (F.col("n") - F.col("held") + F.col("place") - 1).alias("position"), "user_map_value.*"))


# ------------------------------------------------------------------ packing

#: Bytes of a packed token, and what stands for a null one.
WIDTH, NULL_TOKEN = 4, -(1 << 31)


def _packed(ids: Column) -> Column:
    """array<int> -> its ints as bytes."""

    @F.arrow_udf(T.BinaryType())
    def pack(arrays: pa.Array) -> pa.Array:
        ends = np.cumsum([0, *pc.fill_null(pc.list_value_length(arrays), 0).to_numpy()])
        flat = memoryview(pc.fill_null(arrays.flatten(), NULL_TOKEN).cast(pa.int32()).to_numpy().astype("<i4")).cast("B")
        return pa.array([bytes(flat[WIDTH * lo:WIDTH * hi]) if ok else None for lo, hi, ok in zip(ends[:-1], ends[1:], arrays.is_valid().to_pylist())], pa.binary())

    return pack(ids)


def _unpacked(ids: Column) -> Column:
    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def unpack(packed: pa.Array) -> pa.Array:
        ends = np.cumsum([0, *pc.fill_null(pc.binary_length(packed), 0).to_numpy()]) // WIDTH
        flat = np.frombuffer(b"".join(b for b in packed.to_pylist() if b), "<i4")
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32(), mask=flat == NULL_TOKEN))

    return unpack(ids)


class PackBlocks(StatefulProcessor):
    """State: rows taken by the open group, its number, the blocks it gave, and the tokens of its open block.

    Token arrays come, are kept and leave as bytes (``_packed``): rows of thousands of ints cost far more to hand over.
    """

    def __init__(self, cols: list[str], order_col: str, block_size: int, rows_per_group: int):
        self.cols, self.order_col, self.block_size, self.rows_per_group = cols, order_col, block_size, rows_per_group

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("open", "rows long, group_id long, block_id long, tokens array<binary>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        lane = key[0]
        taken, group, block, held = self.open.get() if self.open.exists() else (0, 0, 0, [b""] * len(self.cols))
        held, size = [bytes(h) for h in held], WIDTH * self.block_size

        def give(parts: list[bytes]) -> Row:
            return Row(lane=lane, group_id=group, block_id=block, **dict(zip(self.cols, parts)))

        for row in _in_order(rows, self.order_col):
            arrays = [bytes(row[c] or b"") for c in self.cols]
            if len({len(a) for a in arrays}) > 1:
                raise ValueError(f"{', '.join(self.cols)} differ in length")
            held = [h + a for h, a in zip(held, arrays)]
            whole = len(held[0]) // size
            for b in range(whole):
                yield give([h[b * size:(b + 1) * size] for h in held])
                block += 1
            held = [h[whole * size:] for h in held]
            taken += 1
            if taken == self.rows_per_group:  # the group is whole: a short block only if it gave none
                if block == 0 and held[0]:
                    yield give(held)
                taken, group, block, held = 0, group + 1, 0, [b""] * len(self.cols)
        self.open.update((taken, group, block, held))

    def close(self) -> None:
        pass


def pack_stream(stream: DataFrame, block_size: int, id_col: str, order_col: str | None = None, rows_per_group: int = 1000, lanes: int = LANES,
                ids_col: str = "input_ids", also: tuple[str, ...] = (), lane_col: str | None = None) -> DataFrame:
    """Blocks (lane, group_id, block_id, token columns, labels) of a token stream, groups and blocks going on across micro-batches.

    A lane's blocks are those of ``packing.group_texts`` over its rows in arrival order, in groups of
    ``rows_per_group``. Rows that have a lane already (from ``shuffle_buffered``) name its column; ``order_col`` is the
    order inside a micro-batch, the id unless given. Start the query under ``state_settings``; ``open_blocks`` gives the
    short block of a group that the input's end leaves open.
    """
    cols, order_col = [ids_col, *also], order_col or id_col
    lane = F.col(lane_col) if lane_col else lane_of(id_col, lanes)
    out = T.StructType([T.StructField("lane", T.IntegerType()), T.StructField("group_id", T.LongType()), T.StructField("block_id", T.LongType()),
                        *[T.StructField(c, T.BinaryType()) for c in cols]])
    keyed = stream.select(lane.alias("__lane"), order_col, *[_packed(F.col(c)).alias(c) for c in cols])
    blocks = keyed.groupBy("__lane").transformWithState(PackBlocks(cols, order_col, block_size, rows_per_group), out, "append", "none")
    blocks = blocks.select("lane", "group_id", "block_id", *[_unpacked(F.col(c)).alias(c) for c in cols])
    return blocks.withColumn("labels", F.col(ids_col))


def open_blocks(spark: SparkSession, checkpoint: str, ids_col: str = "input_ids", also: tuple[str, ...] = ()) -> DataFrame:
    """The short block of every open group of a stopped query that gave no full one; of the others the rest is dropped."""
    s = state_table(spark, checkpoint, "open").select(F.col("key.__lane").alias("lane"), "value.*")
    s = s.where((F.col("block_id") == 0) & (F.octet_length(F.col("tokens")[0]) > 0))
    cols = [_unpacked(F.col("tokens")[i]).alias(c) for i, c in enumerate([ids_col, *also])]
    return s.select("lane", "group_id", "block_id", *cols).withColumn("labels", F.col(ids_col))
