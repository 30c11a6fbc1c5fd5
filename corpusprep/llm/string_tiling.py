"""Benchmark decontamination by greedy string tiling over shared-token seeds.

Texts are read as tokens: maximal runs of ASCII letters, digits and bytes of
non-ASCII characters, after lower-casing. A seed is a run of ``min_match``
tokens. Documents and benchmark items are joined on the seeds they share; for
each pair the longest common runs of tokens that no earlier tile covers are
marked again and again, found by running Karp-Rabin hashes over the unmarked
tokens (Wise's RKR-GST). The item is covered by its marked tokens, in whatever
order the document has them, so a reordered passage counts like a straight one.
A pair is reported when the covered share reaches ``threshold``.

On Spark: the benchmark is a stated query set, joined in blocks of items with at most
``block_seeds`` seed places (24 bytes each, so the block's bound is checked). A block's
seeds go to the tasks that scan the documents: one pass hashes every document's seeds,
looks them up, and has, per item, the places that the document shares. The tokens that
those places cover are a bound of what tiles can mark, so a pair that cannot reach the
threshold (one phrase that hundreds of items and documents hold, say) ends there; only the
shared runs of the other pairs go on, with the item's text, to the tiling. Document texts
are never shuffled or broadcast, and no pair is built to be counted.

Defined results: a null or empty text has no tokens and matches nothing; an item
with fewer than ``min_match`` tokens is matched as a whole, in one run; every row of
either table is compared on its own, so equal rows never add up, and of rows that
repeat an id the best cover counts; rows with a null id, on either side, are compared
like others and reported under the null id. Ties between equally long matches go to
the smaller place in the item, then in the document. Extra columns are ignored, an
empty table on either side gives no pair.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import text_slices

#: Production parameters.
MIN_MATCH, THRESHOLD = 5, 0.5
BLOCK_SEEDS = 1 << 20
MAX_BROADCAST_BYTES = 8 << 20

_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_TOKEN = re.compile(rb"[0-9a-z\x80-\xff]+")
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_MIX = np.uint64(0xFF51AFD7ED558CCD)


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[:1] = 1
    out[1:] = base
    return np.multiply.accumulate(out)


_POW = _powers(1 << 8, _BASE)


def tokens(text: bytes) -> list[bytes]:
    return _TOKEN.findall(text)


def lowered(text: bytes) -> bytes:
    """Unicode lower case of UTF-8 bytes."""
    return text.lower() if text.isascii() else text.decode("utf-8", "surrogateescape").lower().encode(
        "utf-8", "surrogateescape")


def token_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, 64-bit hash) of the tokens in lower-cased bytes, without a loop over tokens."""
    word = np.concatenate(([False], _WORD[data], [False]))
    edge = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = edge[::2], edge[1::2]
    if starts.size == 0:
        return starts, ends, np.empty(0, np.uint64)
    # polynomial over the token's bytes: each byte is weighed by its place in the token
    begin = np.concatenate(([0], starts))
    place = np.arange(len(data)) - np.repeat(begin, np.diff(np.append(begin, len(data))))
    value = (data.astype(np.uint64) + np.uint64(1)) * _POW[place & 0xFF]
    value *= np.uint64(1) + (place >> 8).astype(np.uint64) * _MIX
    value[~word[1:-1]] = 0
    h = np.add.reduceat(value, starts)
    h ^= h >> np.uint64(31)
    h *= _MIX
    return starts, ends, h ^ (h >> np.uint64(29))


def seed_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` token hashes."""
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(m, dtype=np.uint64)
    for k in range(n):
        out = out * _BASE + h[k:k + m]
    out ^= out >> np.uint64(32)
    return out * _MIX + np.uint64(n)


# ------------------------------------------------------------------ tiling

def _running_matches(doc: list[bytes], item: list[bytes], free_d: list[bool], free_i: list[bool],
                     n: int) -> list[tuple[int, int, int]]:
    """Maximal matches (length, item place, document place) of ``n`` or more unmarked tokens, by running Karp-Rabin."""
    mod, base = (1 << 61) - 1, 1_000_003
    top = pow(base, n - 1, mod)

    def windows(seq, free):
        run, h = 0, 0
        for p, (tok, ok) in enumerate(zip(seq, free)):
            if not ok:
                run = h = 0
                continue
            if run >= n:
                h = (h - seq_hash[seq[p - n]] * top) % mod
            h = (h * base + seq_hash.setdefault(tok, xxhash.xxh3_64_intdigest(tok) % mod)) % mod
            run += 1
            if run >= n:
                yield h, p - n + 1

    seq_hash: dict[bytes, int] = {}
    at = defaultdict(list)
    for h, p in windows(item, free_i):
        at[h].append(p)
    out = []
    for h, d in windows(doc, free_d):
        for i in at.get(h, ()):
            if i and d and free_i[i - 1] and free_d[d - 1] and item[i - 1] == doc[d - 1]:
                continue  # part of the match that began one token earlier
            k = 0
            while (i + k < len(item) and d + k < len(doc) and free_i[i + k] and free_d[d + k]
                   and item[i + k] == doc[d + k]):
                k += 1
            if k >= n:
                out.append((k, i, d))
    return out


def greedy_tiles(doc: list[bytes | None], item: list[bytes], min_match: int) -> list[tuple[int, int, int]]:
    """Tiles (length, item place, document place) of greedy string tiling; ``None`` in ``doc`` matches nothing."""
    n = min(min_match, len(item))
    free_d, free_i = [t is not None for t in doc], [True] * len(item)
    tiles: list[tuple[int, int, int]] = []
    while n and (found := _running_matches(doc, item, free_d, free_i, n)):
        longest = max(k for k, _, _ in found)
        for k, i, d in sorted(m for m in found if m[0] == longest):
            if all(free_i[i:i + k]) and all(free_d[d:d + k]):
                tiles.append((k, i, d))
                free_i[i:i + k] = free_d[d:d + k] = [False] * k
    return tiles


# ------------------------------------------------------------------ Spark

def _hash_text(text: bytes) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    low = lowered(text)
    return low, *token_hashes(np.frombuffer(low, dtype=np.uint8))


def _item_seeds(items: DataFrame, min_match: int) -> DataFrame:
    """(item, n, size, seed, place): every seed of every item; n is the seed's length, size the item's, in tokens."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in text_slices(batch):
                hashes = [_hash_text(t)[3] for t in texts]
                seeds = [seed_hashes(h, min(min_match, len(h))).view(np.int64) if len(h) else np.empty(0, np.int64) for h in hashes]
                each = [len(v) for v in seeds]
                sizes = np.array([len(h) for h in hashes], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.array(ids, dtype=np.int64), each)), pa.array(np.repeat(np.minimum(sizes, min_match), each)),
                     pa.array(np.repeat(sizes, each)), pa.array(np.concatenate(seeds)),
                     pa.array(np.concatenate([np.arange(k) for k in each]).astype(np.int64))], names=["item", "n", "size", "seed", "place"])

    return items.select("item", "item_text").mapInArrow(run, "item long, n long, size long, seed long, place long")


class SeedIndex(NamedTuple):
    """A block of items: their seeds in ascending order, with the item's number, its place there and the seed's length."""

    seeds: np.ndarray
    item: np.ndarray
    place: np.ndarray
    n: np.ndarray
    keys: np.ndarray  # per item number: its key
    size: np.ndarray  # per item number: its tokens


def seed_index(t: pa.Table) -> SeedIndex:
    cols = {c: t.column(c).to_numpy() for c in ("item", "n", "size", "seed", "place")}
    keys, number = np.unique(cols["item"], return_inverse=True)
    size = np.zeros(len(keys), dtype=np.int64)
    size[number] = cols["size"]
    order = np.argsort(cols["seed"], kind="stable")
    return SeedIndex(cols["seed"][order], number[order], cols["place"][order], cols["n"][order], keys, size)


def _windows_within(item: np.ndarray, place: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Tokens that an item's windows (place, n) cover, per row its part; rows are distinct and sorted by item, then place."""
    step = np.full(len(item), np.iinfo(np.int64).max)
    step[:-1] = np.where(item[1:] == item[:-1], place[1:] - place[:-1], step[:-1])
    return np.minimum(n, step)


def reachable(found: np.ndarray, index: SeedIndex, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For a document's seeds: (items it may cover to the threshold, and as pairs which of ``found`` belongs to which item)."""
    distinct, back = np.unique(found, return_inverse=True)
    lo, hi = np.searchsorted(index.seeds, distinct), np.searchsorted(index.seeds, distinct, side="right")
    count = hi - lo
    at = np.repeat(lo - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
    owner = np.repeat(np.arange(len(distinct)), count)
    order = np.lexsort((index.place[at], index.item[at]))
    item, place = index.item[at][order], index.place[at][order]
    covered = np.bincount(item, _windows_within(item, place, index.n[at][order]), len(index.size))
    fine = np.flatnonzero((covered > 0) & (covered >= threshold * index.size))
    mine = np.isin(index.item[at], fine)
    pairs = np.unique(np.stack([index.item[at][mine], owner[mine]]), axis=1)
    # from distinct seeds back to the places of the document that hold them
    by_seed = np.argsort(back, kind="stable")
    first, last = np.searchsorted(back[by_seed], pairs[1]), np.searchsorted(back[by_seed], pairs[1], side="right")
    each = last - first
    spots = by_seed[np.repeat(first - np.concatenate([[0], np.cumsum(each)[:-1]]), each) + np.arange(each.sum())] if each.size else first
    return fine, np.repeat(pairs[0], each), spots


def _candidates(docs: DataFrame, id_col: str, text_col: str, index: SeedIndex, threshold: float) -> DataFrame:
    """(id, item, runs): per row and item it may cover, the runs of tokens that their shared seeds cover."""
    lengths = [int(n) for n in np.unique(index.n)]
    known = np.unique(index.seeds)

    def hits_of(h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        v = seed_hashes(h, n).view(np.int64)
        at = np.searchsorted(known, v)
        at[at == known.size] = 0
        return np.flatnonzero(known[at] == v), v

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in text_slices(batch):
                low = [lowered(t) for t in texts]
                joined = b" ".join(low)
                starts, ends, h = token_hashes(np.frombuffer(joined, dtype=np.uint8))
                sizes = np.fromiter(map(len, low), np.int64, len(low)) + 1
                bound = np.searchsorted(starts, np.concatenate(([0], np.cumsum(sizes))))
                shared = {n: hits_of(h, n) for n in lengths}
                out: tuple[list, list, list] = ([], [], [])
                for row in range(len(ids)):
                    lo, hi = int(bound[row]), int(bound[row + 1])
                    spots, spans, values = [], [], []
                    for n, (at, v) in shared.items():
                        own = at[np.searchsorted(at, lo):np.searchsorted(at, max(lo, hi - n + 1))]
                        spots.append(own)
                        spans.append(np.full(len(own), n))
                        values.append(v[own])
                    spot, span, value = np.concatenate(spots), np.concatenate(spans), np.concatenate(values)
                    if not spot.size:
                        continue
                    fine, item, which = reachable(value, index, threshold)
                    for k in fine:
                        own = which[item == k]
                        own = own[np.argsort(spot[own], kind="stable")]
                        begin, stop = spot[own], np.maximum.accumulate(spot[own] + span[own])
                        new = np.flatnonzero(np.append(True, begin[1:] > stop[:-1]))
                        last = np.append(new[1:], len(own)) - 1
                        out[0].append(ids[row])
                        out[1].append(int(index.keys[k]))
                        out[2].append([{"begin": int(a - lo), "tokens": [joined[x:y] for x, y in zip(starts[a:z], ends[a:z])]}
                                       for a, z in zip(begin[new], stop[last])])
                yield pa.RecordBatch.from_arrays([pa.array(out[0], batch.schema.field(0).type), pa.array(out[1], pa.int64()), pa.array(out[2], runs)],
                                                 names=["id", "item", "runs"])

    runs = pa.list_(pa.struct([("begin", pa.int64()), ("tokens", pa.list_(pa.binary()))]))
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("item", T.LongType()),
                           T.StructField("runs", T.ArrayType(T.StructType([T.StructField("begin", T.LongType()),
                                                                           T.StructField("tokens", T.ArrayType(T.BinaryType()))])))])
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def contaminated_pairs(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_id_col: str = "item_id",
                       text_col: str = "text", item_text_col: str = "text", min_match: int = MIN_MATCH,
                       threshold: float = THRESHOLD, block_seeds: int = BLOCK_SEEDS) -> DataFrame:
    """(id, item_id, n_item_tokens, n_covered, n_tiles, coverage) for every pair covered to ``threshold`` or more."""
    keyed = materialize(items.select(F.monotonically_increasing_id().alias("item"), F.col(item_id_col).alias("item_id"),
                                     F.col(item_text_col).alias("item_text")), "items")
    seeds = materialize(_item_seeds(keyed, min_match), "item-seeds")
    blocks = max(1, -(-seeds.count() // max(block_seeds, 1)))
    pairs = None
    for b in range(blocks):
        index = seed_index(seeds.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).toArrow())  # block_seeds rows, give or take an item
        if index.seeds.size:
            one = _candidates(docs, id_col, text_col, index, threshold)
            pairs = one if pairs is None else pairs.unionByName(one)
    size = keyed.agg(F.sum(F.octet_length("item_text").cast("long"))).first()[0] or 0
    if pairs is None:  # no item has a token
        pairs = _candidates(docs.limit(0), id_col, text_col, SeedIndex(*[np.empty(0, np.int64)] * 6), threshold)
    pairs = pairs.join(F.broadcast(keyed) if size <= MAX_BROADCAST_BYTES else keyed, "item")

    def tile(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for at in range(batch.num_rows):
                p = batch.slice(at, 1).to_pylist()[0]
                item = tokens(lowered((p["item_text"] or "").encode()))
                doc: list[bytes | None] = []
                for r in sorted(p["runs"], key=lambda r: r["begin"]):
                    doc += [*r["tokens"], None]
                tiles = greedy_tiles(doc, item, min_match)
                covered = sum(k for k, _, _ in tiles)
                if covered and covered >= threshold * len(item):
                    rows.append((p["id"], p["item_id"], len(item), covered, len(tiles), covered / len(item)))
            cols = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow)], schema=arrow)

    arrow = pa.schema([("id", _arrow(docs, id_col)), ("item_id", _arrow(items, item_id_col)),
                       ("n_item_tokens", pa.int64()), ("n_covered", pa.int64()), ("n_tiles", pa.int64()),
                       ("coverage", pa.float64())])
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType),
                           T.StructField("item_id", items.schema[item_id_col].dataType),
                           *[T.StructField(n, T.LongType()) for n in ("n_item_tokens", "n_covered", "n_tiles")],
                           T.StructField("coverage", T.DoubleType())])
    tiled = pairs.select("id", "item_id", "item_text", "runs").mapInArrow(tile, schema)
    best = tiled.groupBy("id", "item_id").agg(F.max(F.struct("n_covered", "n_tiles", "n_item_tokens", "coverage")).alias("b"))
    return best.select(F.col("id").alias(id_col), F.col("item_id").alias(item_id_col), "b.n_item_tokens", "b.n_covered",
                       "b.n_tiles", "b.coverage")


def _arrow(df: DataFrame, col: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[col].dataType)


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **params) -> DataFrame:
    """The rows of ``docs`` that cover no item to the threshold; a row without an id is kept unless a null-id row matched."""
    bad = contaminated_pairs(docs, items, id_col, **params).select(F.col(id_col).alias("__bad")).distinct()
    return docs.join(bad, F.col(id_col).eqNullSafe(F.col("__bad")), "left_anti")
