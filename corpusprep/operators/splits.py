"""Row order, splits, sampling.

Spark rows have no order, so every operator that needs one takes an explicit
``id_col`` (unique). The distributed row index range-partitions and sorts the key
alone, in ranges whose number follows the row count, and writes the result; a key's
place in its written range and the sizes of the ranges before it give the index. The
written table is the order: whatever ran or was retried before, all later steps read it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: Keys that one range of the order (one task's sort) holds, by and large.
KEYS_PER_RANGE = 1 << 20
#: ``monotonically_increasing_id`` keeps the place in the partition in so many low bits.
_PLACE_BITS = 33


def smallest_hashes(df: DataFrame, limit: int, hashed: Column, *ties: str) -> DataFrame:
    """The ``limit`` rows with the smallest 64-bit hashes (``ties`` by these columns); the same for the same rows.

    A threshold from the row count goes first, so about twice ``limit`` rows leave their tasks in all, however many
    tasks there are. Rows that share one hash may make it fewer than ``limit``.
    """
    n = df.count()
    if n > 2 * limit:
        df = df.where(hashed < F.lit(int(-2**63 + 2**64 * (2 * limit / n))).cast("long"))
    return df.orderBy(hashed, *ties).limit(limit)


def _sorted_keys(keys: DataFrame, n: int) -> DataFrame:
    """(__key, __n, __at): the distinct keys of ``n`` rows in key order; ``__at`` is range number and place in the range.

    Range partitioning settles the grouping too, so keys are shuffled once. The table is written: later steps
    and retries read one and the same order.
    """
    ranges = max(1, -(-n // KEYS_PER_RANGE))
    each = (keys.repartitionByRange(ranges, "__key").groupBy("__key").agg(F.count(F.lit(1)).alias("__n"))
            .sortWithinPartitions("__key"))
    return materialize(each.withColumn("__at", F.monotonically_increasing_id()), "sorted-keys")


def with_row_index(df: DataFrame, order_col: str | Column, index_col: str = "row_idx") -> DataFrame:
    """Add a 0-based index in ``order_col`` order; a null key comes first.

    Keys must be unique (one null at most): a repeated key raises ``ValueError``. Only the
    key is sorted: the index is computed on it alone and joined back to the rows.
    """
    key = F.col(order_col) if isinstance(order_col, str) else order_col
    keys = df.select(key.alias("__key"))
    order = _sorted_keys(keys, keys.count())
    part = F.shiftright("__at", _PLACE_BITS)
    sizes = order.groupBy(part.alias("__range")).agg(F.count(F.lit(1)).alias("n"), F.max("__n").alias("most")).collect()
    if any(r["most"] > 1 for r in sizes):
        raise ValueError(f"the order key {order_col} repeats: a row index needs unique keys")
    place = F.col("__at").bitwiseAND((1 << _PLACE_BITS) - 1)
    if len(sizes) > 1:  # one row per range: row count / KEYS_PER_RANGE of them
        offsets, acc = [], 0
        for r in sorted(sizes, key=lambda r: r["__range"]):
            offsets.append((r["__range"], acc))
            acc += r["n"]
        first = df.sparkSession.createDataFrame(offsets, "__range long, __first long")
        order = order.withColumn("__range", part).join(F.broadcast(first), "__range")
        place = F.col("__first") + place
    indexed = order.select("__key", place.alias(index_col))
    if isinstance(order_col, str) and df.columns == [order_col]:
        return indexed.withColumnRenamed("__key", order_col)
    return df.join(indexed, key.eqNullSafe(F.col("__key"))).drop("__key")


def python_round(x: float) -> int:
    """Round half to even, as Python's round()."""
    return round(x)


def head_split(df: DataFrame, percentage: float, id_col: str, split_col: str = "split",
               head: str = "validation", tail: str = "train") -> DataFrame:
    """The first ``percentage`` % of rows in id order -> ``head``, the rest -> ``tail``.

    The boundary is round(n * percentage / 100), half to even.
    """
    n = df.count()
    k = python_round(n * percentage / 100.0)
    idx = with_row_index(df, id_col, "_row_idx")
    return idx.withColumn(split_col, F.when(F.col("_row_idx") < k, F.lit(head)).otherwise(F.lit(tail))) \
        .drop("_row_idx")


def hash_fraction(id_col: str | Column, seed: int) -> Column:
    """Deterministic value in [0, 10000) from md5 of (id, seed): stable under any repartitioning."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    h = F.conv(F.substring(F.md5(F.concat(c.cast("string"), F.lit(f":{seed}"))), 1, 8), 16, 10).cast("long")
    return F.pmod(h, F.lit(10000))


def random_split(df: DataFrame, test_percentage: float, seed: int, id_col: str, split_col: str = "split",
                 test: str = "validation", train: str = "train") -> DataFrame:
    """A seeded hash split: a row is in ``test`` when its hash bucket is below percentage * 100.

    The share is approximate (exact in expectation); ``head_split`` is the exact one.
    """
    return df.withColumn(split_col, F.when(hash_fraction(id_col, seed) < F.lit(test_percentage * 100),
                                           F.lit(test)).otherwise(F.lit(train)))


def shuffle_key(id_col: str | Column, seed: int) -> Column:
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(c.cast("string"), F.lit(f":{seed}")))


def shuffle(df: DataFrame, seed: int, id_col: str, key_col: str = "shuffle_key") -> DataFrame:
    """A seeded full permutation: rows ordered by md5(id, seed) (a range-partitioned sort)."""
    return df.withColumn(key_col, shuffle_key(id_col, seed)).orderBy(key_col)


def take(df: DataFrame, n: int | None, id_col: str) -> DataFrame:
    """The first ``n`` rows in id order when n > 0, else all rows; spread over tasks for any ``n``."""
    if n is None or n <= 0:
        return df
    return with_row_index(df, id_col, "__taken").where(F.col("__taken") < n).drop("__taken")
