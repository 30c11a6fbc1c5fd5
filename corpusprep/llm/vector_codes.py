"""Vector codes: product quantisation fitted exactly over Hilbert-sorted flat blocks.

Every vector becomes integers ``floor(scale * x)`` and is cut into equal parts; each part
position has a codebook of up to 256 entries, refined by rounds over *all* rows. The parts
are written once, sorted by part position and Hilbert index, as flat blocks of 64
neighbours that carry their box (least and greatest value of each dimension), their
component sums and their rows. A round reads the blocks and gets the codebooks, which are
bounded (parts x entries x dimensions): per block, the least and greatest distance of every
entry to the box give the shortlist of entries that can be nearest to any member; a
shortlist of one settles the block by its sums alone, otherwise a small integer kernel
compares members with the shortlist. Sums go back as one row per entry and task. So every
round is exact, equal to comparing all parts with all entries, and only the codebooks pass
through the driver.

The kernel works in float64 where all its integers stay below 2^53, in int64 below 2^63 and
in Python integers beyond, so the result is exact for any finite vector.

Equal vectors (a third of the table may be one vector) share a Hilbert index; a hash of the
row is the last sort key, so ranges and blocks cut such a run anywhere.

Defined results: vectors that are null or hold null or non-finite components are dropped,
and so are those of a length that is no multiple of ``parts`` or not the commonest such
length (the longest of these if several). Rows with a null id take part and come last
in the order that picks the first codebook; among equal ids the order is by vector, then
label. With fewer than ``entries`` kept rows the codebooks are that much shorter. Sums of
distances beyond a long are given as its greatest value; components beyond +-2^90 count as
that. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import join_counted

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Members of a block, and parts in a range of the sort (a range is one task's work).
BLOCK, RANGE = 64, 1 << 16
#: Bits per dimension of the Hilbert index, over at most so many dimensions (it only orders; results do not depend on it).
HILBERT_BITS, HILBERT_DIMS = 4, 16
CLAMP = 2 ** 90
LONG_MAX = 2 ** 63 - 1


class Codebooks(NamedTuple):
    """Per part position a list of entries, each a list of Python integers."""

    entries: list[list[list[int]]]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(x) for part in self.entries for e in part for x in e).encode()).hexdigest()


def integers(vector, scale: int) -> list[int]:
    """floor(scale * x) of each component, exactly."""
    return [max(-CLAMP, min(CLAMP, int(v))) for v in np.floor(scale * np.asarray(vector, dtype=np.float64))]


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index (uint64) of rows of cell numbers below ``2**bits``; dimensions times bits is at most 64."""
    x = cells.astype(np.uint64).T.copy()
    dims, one = len(x), np.uint64(1)
    for b in range(bits - 1, 0, -1):  # undo the rotations and reflections, from the coarsest level down
        low = np.uint64((1 << b) - 1)
        for d in range(dims):
            reflect = (x[d] >> np.uint64(b)) & one == one
            swap = np.where(reflect, np.uint64(0), (x[0] ^ x[d]) & low)
            x[0] = np.where(reflect, x[0] ^ low, x[0] ^ swap)
            x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip = np.where((x[-1] >> np.uint64(b)) & one == one, flip ^ np.uint64((1 << b) - 1), flip)
    x ^= flip
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            out = (out << one) | ((x[d] >> np.uint64(b)) & one)
    return out


def _kernel_dtype(bound: int, dims: int):
    """The fastest exact number type for squared distances of ``dims`` integers of magnitude up to ``bound``."""
    most = 4 * dims * bound * bound
    return np.float64 if most < 2 ** 53 else np.int64 if most < 2 ** 62 else object


def _typed(rows, bound: int, dims: int) -> np.ndarray:
    kind = _kernel_dtype(bound, dims)
    if kind is object and isinstance(rows, np.ndarray):
        return np.array([[int(v) for v in r] for r in rows], dtype=object).reshape(len(rows), dims)
    return np.asarray(rows, dtype=kind).reshape(len(rows), dims)


def shortlist(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Ascending indexes of the entries that can be nearest to a point of the box, ties included."""
    below, above = low - entries, entries - high
    outside = np.maximum(np.maximum(below, above), 0 * below)
    across = np.maximum(-below, -above)  # to the farther side, which is |.| as high >= low
    across = np.maximum(across, outside)
    least, most = (outside * outside).sum(axis=1), (across * across).sum(axis=1)
    return np.flatnonzero(least <= most.min())


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of each point's nearest entry, the lower index of equal ones; exact in the arrays' type."""
    d = (entries * entries).sum(axis=1) - 2 * (points @ entries.T)
    at = d.argmin(axis=1)
    return at, d[np.arange(len(points)), at] + (points * points).sum(axis=1)


# ------------------------------------------------------------------ blocks

def _parts(batches: Iterator[pa.RecordBatch], parts: int, scale: int, ranges: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Per row and part position: Hilbert index and integer components (exact in float64), next to the row's columns."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        flat = batch.column("__vec").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)
        v = np.clip(np.floor(scale * flat), -float(CLAMP), float(CLAMP))
        width = v.shape[1] // parts
        for p in range(parts):
            x = np.ascontiguousarray(v[:, p * width:(p + 1) * width])
            low, high = ranges[p]
            used = min(width, HILBERT_DIMS)
            cells = (x - low) / np.maximum(high - low, 1) * (1 << HILBERT_BITS)
            cells = np.clip(cells[:, :used], 0, (1 << HILBERT_BITS) - 1)
            index = hilbert_index(cells, HILBERT_BITS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, p, np.int32)), pa.array((index ^ np.uint64(1 << 63)).view(np.int64)), batch.column("__row"), batch.column("__id"),
                 batch.column("__label"), pa.array([r.tobytes() for r in x], pa.binary())],
                names=["part", "hilbert", "row", "id", "label", "comps"])


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Flat blocks of up to ``size`` neighbours of one part position from sorted parts."""
    held: pa.Table | None = None

    def flush(t: pa.Table) -> pa.RecordBatch:
        x = np.frombuffer(b"".join(t.column("comps").to_pylist()), np.float64).reshape(t.num_rows, -1)
        small = np.abs(x).max(initial=0) < 2 ** 31
        sums = [str(sum(map(int, c))) for c in x.T] if not small else [str(int(c)) for c in x.astype(np.int64).sum(axis=0)]
        first = t.column("part")[0].as_py()
        mine = lambda name: pa.array([t.column(name).to_pylist() if first == 0 else []], pa.list_(t.schema.field(name).type))
        return pa.RecordBatch.from_arrays(
            [pa.array([first], pa.int32()), pa.array([t.num_rows], pa.int32()), pa.array([bool(small)]),
             pa.array([x.min(axis=0).tobytes()], pa.binary()), pa.array([x.max(axis=0).tobytes()], pa.binary()), pa.array([sums], pa.list_(pa.string())),
             pa.array([(x.astype(np.int32) if small else x).tobytes()], pa.binary()),
             pa.array([t.column("row").to_pylist()], pa.list_(pa.int64())), mine("id"), mine("label")],
            names=["part", "n", "small", "low", "high", "sums", "comps", "rows", "ids", "labels"])

    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        held = t if held is None else pa.concat_tables([held, t])
        part = held.column("part").to_numpy()
        cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
        rest = 0
        for a, b in zip(cuts, cuts[1:]):
            whole = b if b < len(part) else a + (b - a) // size * size
            for k in range(a, whole, size):
                yield flush(held.slice(k, min(size, whole - k)))
            rest = whole
        held = held.slice(rest) if rest < len(part) else None
    if held is not None and held.num_rows:
        for k in range(0, held.num_rows, size):  # one part position is left: the loop above cut at every change
            yield flush(held.slice(k, min(size, held.num_rows - k)))


def _block_rows(batches: Iterator[pa.RecordBatch], books: Codebooks) -> Iterator[tuple[int, dict, np.ndarray, np.ndarray, np.ndarray]]:
    """(part position, block, its points, all entries, shortlist) of every block, in the block's exact type."""
    tops = [max((abs(c) for e in part for c in e), default=0) for part in books.entries]
    typed: dict = {}
    for batch in batches:
        for k in range(batch.num_rows):
            b = batch.slice(k, 1).to_pylist()[0]
            p, n = b["part"], b["n"]
            x = np.frombuffer(b["comps"], np.int32 if b["small"] else np.float64).reshape(n, -1)
            low, high = np.frombuffer(b["low"], np.float64), np.frombuffer(b["high"], np.float64)
            dims = x.shape[1]
            bound = max(tops[p], int(max(np.abs(low).max(initial=0), np.abs(high).max(initial=0))))
            kind = _kernel_dtype(bound, dims)
            if (p, kind) not in typed:
                typed[p, kind] = np.array(books.entries[p], dtype=kind).reshape(len(books.entries[p]), dims)
            entries = typed[p, kind]
            near = shortlist(_typed(low[None], bound, dims)[0], _typed(high[None], bound, dims)[0], entries)
            yield p, b, _typed(x, bound, dims), entries, near


def _assign_sums(batches: Iterator[pa.RecordBatch], books: Codebooks) -> Iterator[pa.RecordBatch]:
    """One row per entry that a task's blocks use: number of parts and component sums."""
    counts: dict[tuple[int, int], int] = {}
    sums: dict[tuple[int, int], np.ndarray] = {}
    for p, b, x, entries, near in _block_rows(batches, books):
        if len(near) == 1:
            groups = [(int(near[0]), b["n"], np.array([int(s) for s in b["sums"]], dtype=object))]
        else:
            at, _ = nearest(x, entries[near])
            groups = []
            for k in np.unique(at):
                mine = x[at == k]
                s = mine.sum(axis=0)  # exact: a block's sums are far below the kernel's bound
                groups.append((int(near[k]), len(mine), np.array([int(v) for v in s], dtype=object)))
        for e, n, s in groups:
            counts[p, e] = counts.get((p, e), 0) + n
            sums[p, e] = sums[p, e] + s if (p, e) in sums else s
    if counts:
        keys = list(counts)
        dims = len(next(iter(sums.values())))
        cols = [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), pa.array([counts[k] for k in keys], pa.int64())]
        names = ["part", "entry", "n"]
        for d in range(dims):
            cols.append(pa.array([Decimal(int(sums[k][d])) for k in keys], pa.decimal128(38, 0)))
            names.append(f"s{d}")
        yield pa.RecordBatch.from_arrays(cols, names=names)


def _assign_codes(batches: Iterator[pa.RecordBatch], books: Codebooks) -> Iterator[pa.RecordBatch]:
    """Per part: row, part position, code and squared distance; id and label go with part 0."""
    for p, b, x, entries, near in _block_rows(batches, books):
        at, d = nearest(x, entries[near])
        n = b["n"]
        yield pa.RecordBatch.from_arrays(
            [pa.array(b["rows"], pa.int64()), pa.array(np.full(n, p, np.int32)), pa.array(near[at].astype(np.int32)),
             pa.array([min(int(v), LONG_MAX) for v in d] if d.dtype == object else d.astype(np.int64), pa.int64()),
             pa.array(b["ids"] or [None] * n, pa.int64()), pa.array(b["labels"] or [None] * n, pa.int64())],
            names=["row", "part", "code", "error", "id", "label"])


# ------------------------------------------------------------------ the operator

def valid(vec: Column) -> Column:
    """Neither null nor empty, and no null or non-finite component."""
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.coalesce(vec.isNotNull() & (F.size(vec) > 0) & fine, F.lit(False))


def kept_vectors(vectors: DataFrame, id_col: str, vec_col: str, label_col: str, parts: int) -> DataFrame:
    """(__row, __id, __label, __vec) of the rows that take part."""
    rows = vectors.select(F.monotonically_increasing_id().alias("__row"), F.col(id_col).cast("long").alias("__id"),
                          F.col(label_col).cast("long").alias("__label"), F.col(vec_col).alias("__vec"))
    rows = rows.where(valid(F.col("__vec")) & (F.size("__vec") % parts == 0))
    common = rows.groupBy(F.size("__vec").alias("len")).count().orderBy(F.desc("count"), F.desc("len")).first()
    return rows.where(F.size("__vec") == (common["len"] if common else 0))


def fit(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame | None, Codebooks]:
    """(written blocks, codebooks after ``rounds`` rounds over all of ``kept``); no blocks if there are no rows."""
    first = (kept.orderBy(F.col("__id").asc_nulls_last(), F.transform("__vec", lambda x: x.cast("double")), F.col("__label").asc_nulls_last())
             .limit(entries).select("__vec").collect())
    start = [integers(r["__vec"], scale) for r in first]
    if not start:
        return None, Codebooks([[] for _ in range(parts)])
    width = len(start[0]) // parts
    books = Codebooks([[v[p * width:(p + 1) * width] for v in start] for p in range(parts)])
    ranges = [(np.array(b, dtype=np.float64).min(axis=0), np.array(b, dtype=np.float64).max(axis=0)) for b in books.entries]
    schema = "part int, hilbert long, row long, id long, label long, comps binary"
    made = kept.mapInArrow(lambda it: _parts(it, parts, scale, ranges), schema)
    n_ranges = int(min(max(kept.count() * parts // RANGE, 1) + parts - 1, 1 << 16))
    order = ["part", "hilbert", F.xxhash64("row")]
    block_schema = ("part int, n int, small boolean, low binary, high binary, sums array<string>, comps binary, rows array<long>, "
                    "ids array<long>, labels array<long>")
    blocks = made.repartitionByRange(n_ranges, *order).sortWithinPartitions(*order).mapInArrow(lambda it: _blocks(it, BLOCK), block_schema)
    blocks = materialize(blocks, "vector-blocks")
    dims = ", ".join(f"s{d} decimal(38,0)" for d in range(width))
    for _ in range(rounds):
        now = books
        sums = blocks.mapInArrow(lambda it, now=now: _assign_sums(it, now), f"part int, entry int, n long, {dims}")
        total = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(f"s{d}").alias(f"s{d}") for d in range(width)])
        new = [[list(e) for e in part] for part in books.entries]
        for r in total.collect():  # at most parts x entries rows
            new[r["part"]][r["entry"]] = [int(r[f"s{d}"]) // r["n"] for d in range(width)]
        books = Codebooks(new)
    return blocks, books


def compress(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """One row per kept vector: ``id_col``, code (two hex digits per part), error, label_error, codebooks_sha256."""
    if not 1 <= entries <= 256:
        raise ValueError("a code is two hex digits: 1 to 256 entries")
    kept = kept_vectors(vectors, id_col, vec_col, label_col, parts)
    blocks, books = fit(kept, parts, entries, rounds, scale)
    out = T.StructType([T.StructField(id_col, T.LongType()), *[T.StructField(n, t) for n, t in (
        ("code", T.StringType()), ("error", T.LongType()), ("label_error", T.LongType()), ("codebooks_sha256", T.StringType()))]])
    if blocks is None:
        return vectors.sparkSession.createDataFrame([], out)
    coded = blocks.mapInArrow(lambda it: _assign_codes(it, books), "row long, part int, code int, error long, id long, label long")
    digits = [F.max(F.when(F.col("part") == p, F.lower(F.lpad(F.hex("code"), 2, "0")))) for p in range(parts)]
    rows = coded.groupBy("row").agg(F.concat(*digits).alias("code"), F.sum(F.col("error").cast("decimal(38,0)")).alias("error"), F.max("id").alias("id"), F.max("label").alias("label"))
    rows = materialize(rows.select("id", "code", "error", "label"), "vector-codes")
    by_label = materialize(rows.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")), "label-errors")
    whole = lambda c: F.least(F.col(c), F.lit(LONG_MAX).cast("decimal(38,0)")).cast("long")
    return (join_counted(rows, by_label, "label")
            .select(F.col("id").alias(id_col), "code", whole("error").alias("error"), whole("label_error").alias("label_error"),
                    F.lit(books.sha256()).alias("codebooks_sha256")))
