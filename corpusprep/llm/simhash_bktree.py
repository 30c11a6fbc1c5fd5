"""SimHash near-duplicates found with BK-trees over shards of fingerprints.

``fingerprints``: a 64-bit SimHash per text (lower-cased A-Z, words
``[^\\x20\\x09-\\x0D]+``, space-joined word shingles with repeats, XXH64).
``link_fingerprints``: the distinct fingerprints are dealt into shards such that
any two within the radius meet in one; each shard holds a BK-tree, whose children
are keyed by their integer Hamming distance to the parent, and a search follows
only edges within the radius.

Shards: the 64 bits are cut into blocks of 8; two fingerprints within r bits agree
on at least 8 - r whole blocks, so every choice of 8 - r blocks makes a shard key.
With r = 2 that is 28 keys of 48 bits: a shard cannot hold more than 2^16
distinct fingerprints, whatever the corpus, so a tree's size is bounded by
construction. Trees and queries meet by a shuffle on the shard key (their total
grows with the corpus, so no broadcast); a shard returns a spanning forest of its links, never its pairs,
which keeps every component whole.

Defined results: a null or empty text has fingerprint 0 and is linked like any
other; rows with a null id take part, and their component's id is the smallest
id that is not null (null if there is none). Repeated rows stay repeated. Extra
columns are ignored. An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.components import component_roots
from ..session import materialize
from .common import grouped_rows, text_slices

BLOCKS = 8
_VOTE_ROWS = 1 << 15  # shingles whose 64 bits are unpacked at a time


def simhash(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """The fingerprint of one text given as UTF-8 bytes (unsigned)."""
    words = text.lower().split()  # on bytes: lowers A-Z only, splits at 0x20 and 0x09-0x0D only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1:]
    h64 = xxhash.xxh64_intdigest
    votes = np.zeros(64, dtype=np.int64)
    for lo in range(0, n, _VOTE_ROWS):
        spans = zip(starts[lo:min(n, lo + _VOTE_ROWS)].tolist(), last[lo:lo + _VOTE_ROWS].tolist())
        h = np.array([h64(joined[s:e], seed) for s, e in spans], dtype=np.uint64)
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(votes * 2 > n, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                 seed: int = 42) -> DataFrame:
    """(id, fp) for every row; fp is the fingerprint's 64 bits as a signed long. No shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in text_slices(batch):
                fps = np.array([simhash(t, shingle, seed) for t in texts], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field(0).type), pa.array(fps)],
                                                 names=["id", "fp"])

    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", id_type), T.StructField("fp", T.LongType())])
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema).withColumnRenamed("id", id_col)


# ------------------------------------------------------------------ BK-trees

def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


class BKForest:
    """One BK-tree per shard, built level by level for many shards at once.

    ``fp[i]`` are distinct fingerprints, ``shard[i]`` their shard (any integers). Node i's
    children are found through the sorted keys ``parent * 65 + distance``.
    """

    def __init__(self, fp: np.ndarray, shard: np.ndarray):
        self.fp = fp.astype(np.uint64)
        n = len(fp)
        rest = np.argsort(shard, kind="stable")
        _, first = np.unique(shard[rest], return_index=True)
        self.root_of_shard = rest[first]
        group = np.repeat(self.root_of_shard, np.diff(np.append(first, n)))  # the node that each point descends from
        self.root = np.empty(n, dtype=np.int64)
        self.root[rest] = group
        keys, nodes = [], []
        while True:
            below = rest != group
            rest, group = rest[below], group[below]
            if rest.size == 0:
                break
            key = group * 65 + _distance(self.fp[rest], self.fp[group])
            order = np.argsort(key, kind="stable")
            rest, key = rest[order], key[order]
            uniq, first = np.unique(key, return_index=True)
            keys.append(uniq)
            nodes.append(rest[first])
            group = np.repeat(rest[first], np.diff(np.append(first, rest.size)))
        k = np.concatenate(keys) if keys else np.empty(0, np.int64)
        c = np.concatenate(nodes) if nodes else np.empty(0, np.int64)
        order = np.argsort(k)
        self.edge, self.child = k[order], c[order]

    def search(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) index pairs within ``radius``, for the points ``queries`` of the forest against their own tree."""
        q, node = queries, self.root[queries]
        found_q, found_n = [], []
        while q.size:
            d = _distance(self.fp[q], self.fp[node])
            hit = d <= radius
            found_q.append(q[hit])
            found_n.append(node[hit])
            next_q, next_n = [], []
            for off in range(-radius, radius + 1):
                want = node * 65 + np.clip(d + off, 0, 64)
                at = np.searchsorted(self.edge, want)
                ok = (at < self.edge.size) & (d + off >= 0) & (d + off <= 64)
                ok[ok] = self.edge[at[ok]] == want[ok]
                next_q.append(q[ok])
                next_n.append(self.child[at[ok]])
            q, node = np.concatenate(next_q), np.concatenate(next_n)
        return np.concatenate(found_q), np.concatenate(found_n)

    def spanning_links(self, radius: int, block: int = 1 << 12) -> tuple[np.ndarray, np.ndarray]:
        """Links that connect exactly what all links within ``radius`` connect: at most one per point."""
        comp = np.arange(len(self.fp))
        for lo in range(0, len(self.fp), block):
            a, b = self.search(np.arange(lo, min(lo + block, len(self.fp))), radius)
            while True:
                ra, rb = comp[a], comp[b]
                apart = ra != rb
                if not apart.any():
                    break
                np.minimum.at(comp, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])
                while not np.array_equal(up := comp[comp], comp):
                    comp = up
        linked = np.flatnonzero(comp != np.arange(len(comp)))
        return linked, comp[linked]


def shard_masks(radius: int) -> list[int]:
    """Bit masks (signed) of every choice of ``BLOCKS - radius`` of the byte-wide blocks."""
    if not 0 <= radius < BLOCKS:
        raise ValueError(f"radius must be 0 to {BLOCKS - 1}")
    out = []
    for blocks in combinations(range(BLOCKS), BLOCKS - radius):
        m = sum(0xFF << (8 * b) for b in blocks)
        out.append(m - (1 << 64) if m >= 1 << 63 else m)
    return out


def link_fingerprints(fps: DataFrame, radius: int = 2, fp_col: str = "fp") -> DataFrame:
    """(a, b): links between distinct fingerprints that span every component of "differs in ``radius`` bits or fewer"."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in grouped_rows(batches, ["shard", "key"]):
            fp = t["fp"].to_numpy()
            shard, key = t["shard"].to_numpy(), t["key"].to_numpy()
            new = np.ones(len(fp), dtype=np.int64)
            new[1:] = (shard[1:] != shard[:-1]) | (key[1:] != key[:-1])
            group = np.cumsum(new) - 1
            many = np.bincount(group)[group] > 1
            if not many.any():
                continue
            fp, group = fp[many], group[many]
            a, b = BKForest(fp.view(np.uint64), group).spanning_links(radius)
            yield pa.RecordBatch.from_arrays([pa.array(fp[a]), pa.array(fp[b])], names=["a", "b"])

    keys = F.array(*[F.struct(F.lit(i).alias("shard"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key"))
                     for i, m in enumerate(shard_masks(radius))])
    dealt = (fps.select(F.col(fp_col).alias("fp")).distinct().select("fp", F.explode(keys).alias("k"))
             .select("k.shard", "k.key", "fp"))
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (dealt.repartition(n, "shard", "key").sortWithinPartitions("shard", "key", "fp")
            .mapInArrow(run, "a long, b long"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                       radius: int = 2, seed: int = 42) -> DataFrame:
    """(id, fp, component_id) per row: component_id is the smallest id reachable over links of ``radius`` bits or fewer."""
    fps = materialize(fingerprints(docs, id_col, text_col, shingle, seed), "simhash")
    distinct = fps.groupBy("fp").agg(F.min(id_col).alias("rep"))
    roots = component_roots(link_fingerprints(fps, radius), "a", "b").withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    names = rooted.select("fp", "root").join(named, "root").select("fp", "component_id")
    return fps.join(names, "fp").select(id_col, "fp", "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                radius: int = 2, seed: int = 42) -> DataFrame:
    """The rows of ``docs`` that carry their component's smallest id; rows with a null id stay."""
    comp = simhash_components(docs, id_col, text_col, shingle, radius, seed)
    gone = comp.where(F.col(id_col) != F.col("component_id")).select(id_col)
    return docs.join(gone, id_col, "left_anti")
