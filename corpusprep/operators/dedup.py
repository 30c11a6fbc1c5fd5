"""Exact and near-duplicate removal.

Exact: one 128-bit key per document, the smallest id per key survives.
Near: 64-bit SimHash fingerprints, band keys (pigeonhole over blocks) to bring any
two distinct fingerprints within a Hamming distance together, connected components
over the links found, the smallest id per component survives.

Scale notes
* Keys are aggregated with ``groupBy(key).agg(min(id))``: the partial
  aggregate collapses a hot key (a third of all rows being one text) to one
  row per map task before the shuffle; survivors are joined back on the
  unique id, so no join key is skewed and the text never goes through a sort.
* Equal fingerprints are collapsed first, so copies never produce pairs.
* A band bucket of over ``CELL`` fingerprints is split again on its remaining bits
  (pigeonhole once more), as often as that at least halves the comparisons, which
  their counts tell before. What is left large, a ball of fingerprints that are all
  near each other, is dealt as a grid of cells, each a pair of its blocks, so the
  largest task does a bounded number of comparisons whatever the bucket.
* For components a cell returns a spanning forest of its links: a family of m
  near copies gives O(m) edges, not m squared. A large component of a cell is
  walked first: what it has reached is compared no more.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.digest import md5_prefixes
from ..functions.text import NON_CHARACTER_CLASS, col_, text_slices
from ..session import materialize
from .components import _forest, component_roots

#: Fingerprints of one bucket that a single task compares with each other: for pairs, and for links alone.
CELL, LINKED = 4096, 16384
#: Comparisons of cells at once: their work arrays stay in the processor's cache.
COMPARED = 1 << 17


# ================================================================ exact

def exact_key(text: str | Column, lowercase: bool = True, ignore_non_character: bool = True) -> Column:
    """md5 of the normalized, stripped text."""
    t = col_(text)
    if lowercase:
        t = F.lower(t)
    if ignore_non_character:
        t = F.regexp_replace(t, NON_CHARACTER_CLASS + "+", "")
    return F.md5(t)


def exact_survivors(df: DataFrame, id_col: str, text_col: str = "text", lowercase: bool = True,
                    ignore_non_character: bool = True) -> DataFrame:
    """(key, id_col) with the smallest id of every key."""
    return (df.select(exact_key(text_col, lowercase, ignore_non_character).alias("dedup_key"), F.col(id_col))
            .groupBy("dedup_key").agg(F.min(id_col).alias(id_col)))


def document_deduplicator(df: DataFrame, id_col: str, text_col: str = "text", lowercase: bool = True,
                          ignore_non_character: bool = True) -> DataFrame:
    """Keep the smallest-id document of every exact-duplicate group."""
    keep = exact_survivors(df, id_col, text_col, lowercase, ignore_non_character).select(id_col)
    return df.join(keep, id_col, "left_semi")


# ================================================================ simhash

#: A byte of ones and zeros per eighth bit; so many of them can be added in a byte.
_LANES, _ADDED = np.uint64(0x0101010101010101), 255


def _votes(h: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Bit votes over runs of ``sizes`` (1 or more) 64-bit hashes: a bit is set when over half of a run have it."""
    blocks = -(-sizes // _ADDED)
    run = np.cumsum(blocks) - blocks
    starts = np.repeat(np.cumsum(sizes) - sizes, blocks) + (np.arange(blocks.sum()) - np.repeat(run, blocks)) * _ADDED
    ends = np.append(starts[1:], len(h))
    counts = np.empty((len(starts), 8, 8), dtype=np.uint8)  # block, byte, bit
    lo = 0
    while lo < len(starts):  # so many that the work arrays stay in the processor's cache
        hi = max(lo + 1, int(ends.searchsorted(starts[lo] + (1 << 15), "right")))
        part, at = h[starts[lo]:ends[hi - 1]], starts[lo:hi] - starts[lo]
        for bit in range(8):
            counts[lo:hi, :, bit] = np.add.reduceat(part >> np.uint64(bit) & _LANES, at).astype("<u8").view(np.uint8).reshape(-1, 8)
        lo = hi
    votes = np.add.reduceat(counts.reshape(-1, 64), run, axis=0, dtype=np.int64)
    return np.packbits(votes * 2 > sizes[:, None], axis=1, bitorder="little").view("<i8").ravel()


def _vote(h: np.ndarray) -> int:
    return int(_votes(h, np.array([len(h)]))[0])


#: Bits of the slots in which equal shingles of a slice meet.
SLOT_BITS = 20


def _repeats(texts: list[str], window: int) -> np.ndarray | None:
    """Per shingle of characters the number of an equal one, itself if there is none known; None if they don't fit 64 bits.

    Of texts up to the window there is one shingle, which counts as equal to no other.
    """
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    cps = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    known = np.zeros(int(cps.max()) + 1, dtype=bool)
    known[cps] = True
    base = int(known.sum())
    if base ** window > 1 << 64 or len(cps) <= window:
        return None
    digit = (np.cumsum(known) - 1).astype(np.uint64)[cps]
    code = digit[:len(digit) - window + 1].copy()
    for k in range(1, window):
        code *= np.uint64(base)
        code += digit[k:len(digit) - window + 1 + k]
    number = np.where(size > window, size - window + 1, (size > 0).astype(np.int64))
    first = np.cumsum(size) - size
    own = np.repeat(first - np.cumsum(number) + number, number) + np.arange(number.sum())  # those that do not run into the next text
    code = code[np.minimum(own, len(code) - 1)]
    slot = (code * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
    whole = np.repeat(size > window, number)
    at, this = np.zeros(1 << SLOT_BITS, dtype=np.int64), np.arange(len(code))
    at[slot[whole]] = this[whole]
    there = at[slot]
    return np.where(whole & (code[there] == code), there, this)


def _shingles(text: str, by_word: bool, window: int) -> tuple[bytes, np.ndarray, np.ndarray]:
    """A text's bytes with the starts and ends of its shingles; words are joined by single spaces."""
    data = (" ".join(text.split()) if by_word else text).encode("utf-8", "surrogatepass")
    b = np.frombuffer(data, dtype=np.uint8)
    if not b.size:
        return data, np.empty(0, np.int64), np.empty(0, np.int64)
    if by_word:
        gaps = np.flatnonzero(b == 32)
        first, last = np.append(0, gaps + 1), np.append(gaps, len(b))
    else:
        first = np.flatnonzero((b & 0xC0) != 0x80)
        last = np.append(first[1:], len(b))
    if len(first) <= window:
        return data, first[:1], last[-1:]
    return data, first[:len(first) - window + 1], last[window - 1:]


def _fingerprints(texts: list[str], by_word: bool, window: int) -> list[int | None]:
    """SimHash of every text; the shingles of a slice of about a megabyte are hashed together, equal ones of characters once."""
    out: list[int | None] = []
    at = 0
    while at < len(texts):
        parts, size = [], 0
        while at < len(texts) and (not parts or size < 1 << 20):
            parts.append(_shingles(texts[at], by_word, window))
            size += len(parts[-1][0])
            at += 1
        offsets = np.cumsum([0, *(len(p[0]) for p in parts)])
        starts, ends = (np.concatenate([p[k] + o for p, o in zip(parts, offsets)]) for k in (1, 2))
        data = np.frombuffer(b"".join(p[0] for p in parts), dtype=np.uint8)
        same = None if by_word or not len(starts) else _repeats(texts[at - len(parts):at], window)
        if same is None:
            hashes = md5_prefixes(data, starts, ends)
        else:  # every shingle of characters once
            once = np.flatnonzero(same == np.arange(len(same)))
            hashes = np.empty(len(same), dtype=np.uint64)
            hashes[once] = md5_prefixes(data, starts[once], ends[once])
            hashes = hashes[same]
        sizes = np.array([len(p[1]) for p in parts])
        votes = iter(_votes(hashes, sizes[sizes > 0]).tolist() if len(hashes) else ())
        out += [next(votes) if n else None for n in sizes]
    return out


def fingerprint(text: str | Column, tokenization: str = "space", window_size: int = 6, lowercase: bool = True,
                ignore_pattern: str | None = None) -> Column:
    """64-bit SimHash (signed BIGINT) over the md5 of token shingles; null when the text has no tokens.

    Fewer tokens than the window make one shingle of all. Normalization runs in the JVM;
    one Arrow pass splits, hashes all shingles of a slice together and votes.
    """
    if tokenization not in ("space", "character"):
        raise ValueError(f"unsupported tokenization {tokenization!r}")
    t = col_(text)
    if lowercase:
        t = F.lower(t)
    if ignore_pattern:
        t = F.regexp_replace(t, ignore_pattern, "")
    by_word = tokenization == "space"

    @F.arrow_udf(T.LongType())
    def simhash(texts: pa.Array) -> pa.Array:
        return pa.array([f for t in text_slices(texts) for f in _fingerprints(t, by_word, window_size)], pa.int64())

    return simhash(t)


def fingerprints(df: DataFrame, id_col: str, text_col: str = "text", **args) -> DataFrame:
    """(id, fp) for every document; fp is null for documents without tokens."""
    return df.select(id_col, fingerprint(text_col, **args).alias("fp"))


# ================================================================ near pairs

def block_masks(num_blocks: int) -> list[int]:
    """Bit masks of ``num_blocks`` contiguous blocks covering bits 0..63 (cut at round(i*64/B))."""
    cuts = [round(i * 64 / num_blocks) for i in range(num_blocks + 1)]
    return [sum(1 << b for b in range(cuts[i], cuts[i + 1])) for i in range(num_blocks)]


def _signed(m: int) -> int:
    return m - (1 << 64) if m >= 1 << 63 else m


def _candidates(fp: np.ndarray, cell: np.ndarray, side: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs to compare, in blocks: all of a cell, or only across the two sides of one. Rows are sorted by cell."""
    n = len(fp)
    size = np.diff(np.append(np.flatnonzero(np.append(True, cell[1:] != cell[:-1])), n))
    end = np.repeat(np.cumsum(size), size)
    small = np.repeat(size, size) <= 64
    at = np.flatnonzero(small)
    step = 1
    while at.size:  # row i against row i + step of its cell
        at = at[at + step < end[at]]
        ok = (side[at] == side[at + step]) == (side[at] < 0)
        if ok.any():
            yield at[ok], at[ok] + step
        step += 1
    start = np.cumsum(size) - size
    for lo, m in zip(start[size > 64].tolist(), size[size > 64].tolist()):
        if side[lo] < 0:
            for a in range(lo, lo + m, 256):
                i, j = np.meshgrid(np.arange(a, min(a + 256, lo + m)), np.arange(a, lo + m), indexing="ij")
                keep = j > i
                yield i[keep], j[keep]
        else:
            left, right = lo + np.flatnonzero(side[lo:lo + m] == 0), lo + np.flatnonzero(side[lo:lo + m] == 1)
            for a in range(0, len(left), 256):
                i, j = np.meshgrid(left[a:a + 256], right, indexing="ij")
                yield i.ravel(), j.ravel()


def _walked(fp: np.ndarray, rest: list[np.ndarray], root: np.ndarray, near: int) -> None:
    """Large components of a cell get their ``root``; their rows leave ``rest`` (the rows of the cell, or of its two sides).

    Rows reached are compared with the rows left, not with each other, so a component of most of a cell costs little.
    """
    while min(map(len, rest)) and sum(map(len, rest)) > 256:
        most, side, seed = 0, 0, 0
        for s, rows in enumerate(rest):
            some = rows[::-(-len(rows) // 16)]
            n = (np.bitwise_count(fp[some][:, None] ^ fp[rest[s - 1]]) <= near).sum(axis=1)
            if n.max() > most:
                most, side, seed = int(n.max()), s, int(some[n.argmax()])
        if most * 64 < sum(map(len, rest)):
            return
        rest[side] = rest[side][rest[side] != seed]
        left = [fp[rows] for rows in rest]
        todo = [np.empty(0, np.int64) for _ in rest]
        todo[side] = np.array([seed])
        while any(map(len, todo)):
            s = int(np.argmax([len(rows) for rows in todo]))
            k = max(1, COMPARED // max(1, len(rest[s - 1])))
            now, todo[s] = todo[s][:k], todo[s][k:]
            if not len(rest[s - 1]):
                continue
            reached = np.bitwise_count(fp[now][:, None] ^ left[s - 1]).min(axis=0) <= near
            if reached.any():
                root[rest[s - 1][reached]] = seed
                todo[s - 1] = np.append(todo[s - 1], rest[s - 1][reached])
                rest[s - 1], left[s - 1] = rest[s - 1][~reached], left[s - 1][~reached]


def _cell_roots(fp: np.ndarray, side: np.ndarray, near: int) -> np.ndarray:
    """For every row of a large cell, one row of its component that all of them have; as ``_candidates``, all rows or across two sides."""
    root = np.arange(len(fp))
    rest = [root.copy()] if side[0] < 0 else [np.flatnonzero(side == 0), np.flatnonzero(side == 1)]
    _walked(fp, rest, root, near)
    a, b = rest[0], rest[-1]
    found = [(root[:0], root[:0])]
    lo = 0
    while lo < len(a):
        first = lo if len(rest) == 1 else 0
        hi = lo + max(1, COMPARED // max(1, len(b) - first))
        i, j = np.nonzero(np.bitwise_count(fp[a[lo:hi]][:, None] ^ fp[b[first:]]) <= near)
        found.append((a[i + lo], b[j + first]))
        lo = hi
    nodes, roots = _forest(*(np.concatenate(x) for x in zip(*found)))
    root[nodes] = roots
    return root


def _cell_links(fp: np.ndarray, cell: np.ndarray, side: np.ndarray, near: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, the smallest one of its component in its cell) where they differ. Rows are sorted by cell."""
    start = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
    size = np.diff(np.append(start, len(fp)))
    small = np.flatnonzero(np.repeat(size, size) <= 64)
    root = np.arange(len(fp))
    found = [(root[:0], root[:0])]
    for a, b in _candidates(fp[small], cell[small], side[small]) if small.size else ():
        close = np.bitwise_count(fp[small[a]] ^ fp[small[b]]) <= near
        found.append((small[a[close]], small[b[close]]))
    nodes, roots = _forest(*(np.concatenate(x) for x in zip(*found)))
    root[nodes] = roots
    for lo, m in zip(start[size > 64].tolist(), size[size > 64].tolist()):
        root[lo:lo + m] = lo + _cell_roots(fp[lo:lo + m], side[lo:lo + m], near)
    least = fp.copy()
    np.minimum.at(least, root, fp)
    least = least[root]
    linked = np.flatnonzero(least != fp)
    return fp[linked], least[linked]


class _Path(NamedTuple):
    """What fingerprints of a bucket share: the agreed bits, and block masks on which a pair must differ to be given there."""

    agreed: int
    differ: tuple[int, ...]


def _first_paths(num_blocks: int, hamming_distance: int) -> dict[int, _Path]:
    """The bands: ``num_blocks - hamming_distance`` agreeing blocks each; a pair is given by its lowest agreeing blocks."""
    masks = block_masks(num_blocks)
    out = {}
    for b, c in enumerate(combinations(range(num_blocks), num_blocks - hamming_distance)):
        out[b + 1] = _Path(sum(masks[i] for i in c), tuple(masks[i] for i in range(c[-1]) if i not in c))
    return out


def _longer_paths(code: int, path: _Path, hamming_distance: int) -> dict[int, _Path]:
    """The pigeonhole again: of h + 1 blocks of the bits left over, two near fingerprints agree on one."""
    free = [b for b in range(64) if not path.agreed >> b & 1]
    n = hamming_distance + 1
    blocks = [sum(1 << b for b in free[i * len(free) // n:(i + 1) * len(free) // n]) for i in range(n)]
    return {code * (n + 1) + i + 1: _Path(path.agreed | m, path.differ + tuple(blocks[:i])) for i, m in enumerate(blocks)}


def _keyed(rows: DataFrame, paths: dict[int, _Path], of: dict[int, int]) -> DataFrame:
    """Rows (path, key, fp) under every path that follows theirs (``of``: path -> the one before), with that one as ``before``."""
    table = [(c, before, _signed(paths[c].agreed), _signed(paths[before].agreed)) for c, before in of.items()]
    masks = rows.sparkSession.createDataFrame(table, "next long, path long, m long, old long")
    j = rows.join(F.broadcast(masks), "path")
    return j.select(F.col("next").alias("path"), F.col("fp").bitwiseAND(F.col("m")).alias("key"), "fp",
                    F.struct("path", F.col("fp").bitwiseAND(F.col("old")).alias("key")).alias("before"))


def _buckets(fps: DataFrame, num_blocks: int, hamming_distance: int, cell: int) -> tuple[DataFrame, dict[int, _Path]]:
    """(path, key, blocks, fp): every fingerprint in every bucket to compare, large ones split on their remaining bits.

    Buckets of over ``cell`` fingerprints are split as long as that at least halves the comparisons (it does not in a
    ball of fingerprints that are all near each other); the rest stays whole, with the number of ``blocks`` to deal it in.
    """
    if num_blocks <= hamming_distance:
        raise ValueError("num_blocks must exceed hamming_distance for an exact band search")
    paths = _first_paths(num_blocks, hamming_distance)
    bands = F.array(*[F.struct(F.lit(c).cast("long").alias("path"), F.lit(_signed(p.agreed)).cast("long").alias("m")) for c, p in paths.items()])
    rows = fps.select("fp", F.explode(bands).alias("k")).select("k.path", F.col("fp").bitwiseAND(F.col("k.m")).alias("key"), "fp")
    at, done = ["path", "key"], None
    while True:
        # only buckets over the limit are listed; written, so that AQE sees their number and can split a hot one
        large = materialize(rows.groupBy(*at).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cell), "large-buckets")
        codes = [r["path"] for r in large.select("path").distinct().collect()]  # of the paths made so far
        of = {}
        for code in codes:
            for longer, path in _longer_paths(code, paths[code], hamming_distance).items():
                paths[longer], of[longer] = path, code
        if of:
            parts = _keyed(rows.join(large.select(*at), at, "left_semi"), paths, of)
            after = (parts.groupBy("before", *at).agg(F.count(F.lit(1)).cast("double").alias("m")).groupBy("before")
                     .agg(F.sum(F.col("m") * F.col("m")).alias("after")).select("before.*", "after"))
            large = materialize(large.join(after, at).withColumn("split", F.col("after") * 2 < F.col("n").cast("double") * F.col("n")), "large-buckets")
        else:
            large = large.withColumn("split", F.lit(False))
        kept = (rows.join(large.select(*at, "split", F.ceil(F.col("n") / cell).cast("int").alias("blocks")), at, "left")
                .where("split IS NULL OR NOT split").select(*at, F.coalesce("blocks", F.lit(1)).alias("blocks"), "fp"))
        done = kept if done is None else done.unionByName(kept)
        if not of or large.where("split").isEmpty():
            return done, paths
        rows = materialize(_keyed(rows.join(large.where("split").select(*at), at, "left_semi"), paths, of).drop("before"), "split-buckets")


def _dealt(fps: DataFrame, num_blocks: int, hamming_distance: int, cell: int) -> tuple[DataFrame, dict[int, _Path]]:
    """(path, key, i, j, side, fp): every distinct fingerprint in every cell where it meets the ones it may be near to.

    ``side`` is -1 in a cell that is compared as a whole, 0 or 1 in one that holds two blocks of a bucket.
    """
    placed, paths = _buckets(fps, num_blocks, hamming_distance, cell)
    own = F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")).otherwise(F.lit(0))
    placed = placed.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return placed.select(
        "path", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        F.when(F.col("own") == F.col("other"), -1).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"), "fp"), paths


def _search(fps: DataFrame, num_blocks: int, hamming_distance: int, cell: int, spanning: bool) -> DataFrame:
    """(fp_a, fp_b, distance): all pairs, each once, or a spanning forest of the links of every cell."""
    cells_of, paths = _dealt(fps, num_blocks, hamming_distance, cell)
    codes = np.array(sorted(paths), dtype=np.int64)
    differ = np.full((len(codes), max(len(p.differ) for p in paths.values()) or 1), np.uint64(2**64 - 1), dtype=np.uint64)
    for row, code in enumerate(codes.tolist()):
        differ[row, :len(paths[code].differ)] = paths[code].differ

    def pairs(fp, cells, side):
        for a, b in _candidates(fp, cells, side):
            x = fp[a] ^ fp[b]
            d = np.bitwise_count(x)
            near = d <= hamming_distance
            if near.any():
                yield a[near], b[near], x[near], d[near]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole_cells(batches):
            fp = t["fp"].to_numpy().view(np.uint64)
            path, side = np.searchsorted(codes, t["path"].to_numpy()), t["side"].to_numpy()
            cells = _cell_numbers(t)
            if spanning:
                a, b = _cell_links(fp, cells, side, hamming_distance)
                if a.size:
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.nulls(len(a), pa.int32())],
                                                     names=["fp_a", "fp_b", "distance"])
                continue
            for a, b, x, d in pairs(fp, cells, side):
                # a pair is given only where its path takes the lowest agreeing blocks at every step
                first = ((x[:, None] & differ[path[a]]) != 0).all(axis=1)
                lo, hi = fp[a][first].view(np.int64), fp[b][first].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(lo, hi)), pa.array(np.maximum(lo, hi)), pa.array(d[first].astype(np.int32))],
                    names=["fp_a", "fp_b", "distance"])

    order = ["path", "key", "i", "j"]
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cells_of.repartition(n, *order).sortWithinPartitions(*order).mapInArrow(run, "fp_a long, fp_b long, distance int")


def _cell_numbers(t: pa.Table) -> np.ndarray:
    new = np.zeros(t.num_rows, dtype=np.int64)
    for c in ("path", "key", "i", "j"):
        v = t[c].to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.cumsum(new)


def _whole_cells(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches joined and cut so that no cell is split."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        t = pa.Table.from_batches(held)
        cells = _cell_numbers(t)
        cut = int(np.searchsorted(cells, cells[-1]))
        if cut:
            yield t.slice(0, cut).combine_chunks()
            held = t.slice(cut).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def near_pairs(fps: DataFrame, fp_col: str = "fp", num_blocks: int = 6, hamming_distance: int = 4,
               cell: int = CELL) -> DataFrame:
    """Every pair of distinct fingerprints within ``hamming_distance`` bits.

    Input: one row per distinct fingerprint (``fp_col``). Output: (fp_a, fp_b,
    distance) with fp_a < fp_b. Two fingerprints within h bits agree on at least
    B - h of the B blocks (pigeonhole), so they share the key (band, masked
    value) of at least one band of B - h blocks: the result is exact for any B.
    A pair is given only by the band made of its B - h lowest agreeing blocks, so
    the pairs need no distinct(). A bucket of over ``cell`` fingerprints is split
    on the bits it has left, by the same argument: of h + 1 blocks of these, one agrees.
    """
    fps = materialize(fps.select(F.col(fp_col).alias("fp")), "distinct-fingerprints")  # the search reads them several times
    return _search(fps, num_blocks, hamming_distance, cell, spanning=False)


def near_links(fps: DataFrame, num_blocks: int = 6, hamming_distance: int = 4, cell: int = LINKED) -> DataFrame:
    """(fp_a, fp_b): links whose components are those of ``near_pairs``, O(m) of them for a family of m."""
    return _search(fps, num_blocks, hamming_distance, cell, spanning=True).select("fp_a", "fp_b").distinct()


# ================================================================ simhash dedup

def cluster_fingerprints(keyed: DataFrame, num_blocks: int = 6, hamming_distance: int = 4, cell: int = LINKED) -> DataFrame:
    """(id, key) -> (id, kept_id): the smallest id of the near-duplicate component; null keys are left out."""
    keyed = keyed.where(F.col("key").isNotNull())
    reps = materialize(keyed.groupBy(F.col("key").alias("fp")).agg(F.min("id").alias("rep")), "fingerprints")
    links = near_links(reps.select("fp"), num_blocks, hamming_distance, cell)
    roots = component_roots(links, "fp_a", "fp_b").withColumnRenamed("node", "fp")
    rooted = reps.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    kept = rooted.groupBy("root").agg(F.min("rep").alias("kept_id"))
    names = rooted.join(kept, "root").select(F.col("fp").alias("key"), "kept_id")
    # joined on the fingerprint: AQE splits a hot one (many copies) on the big side
    return keyed.join(names, "key").select("id", "kept_id")


def simhash_clusters(df: DataFrame, id_col: str, text_col: str = "text", num_blocks: int = 6,
                     hamming_distance: int = 4, **args) -> DataFrame:
    """(id, cluster): the smallest id of the document's near-duplicate component; without tokens its own id."""
    keyed = materialize(df.select(F.col(id_col).alias("id"), fingerprint(text_col, **args).alias("key")), "simhash")
    kept = cluster_fingerprints(keyed, num_blocks, hamming_distance)
    alone = keyed.where(F.col("key").isNull()).select("id", F.col("id").alias("kept_id"))
    return kept.unionByName(alone).select(F.col("id").alias(id_col), F.col("kept_id").alias("cluster"))


def document_simhash_deduplicator(df: DataFrame, id_col: str, text_col: str = "text", num_blocks: int = 6,
                                  hamming_distance: int = 4, **args) -> DataFrame:
    """Keep the smallest-id document of every near-duplicate cluster."""
    keep = simhash_clusters(df, id_col, text_col, num_blocks, hamming_distance, **args)
    return df.join(keep.where(F.col("cluster") == F.col(id_col)).select(id_col), id_col, "left_semi")
