"""Approximate nearest neighbours by an inverted multi-index.

Vectors are scaled to length one and cut in two halves; each half is quantised by
its own codebook of k centroids, so a vector lies in one of k x k cells. A query
walks the cells by the sum of its two squared centroid distances, smallest first,
with a heap over the two sorted lists (the multi-sequence algorithm), until the
cells it has passed hold ``candidate_share`` of all entries and ``min_candidates``
of them. The entries of these cells are reranked by their exact cosine in double
precision.

On Spark: codebooks are fitted on a bounded sample (``sample_rows``, the smallest
hashes of the ids); every row is indexed. The k x k cell sizes, bounded by k, are
the only thing that reaches the driver. Entries are dealt by their first centroid,
and each such list is cut into blocks of about ``block_rows``, so a cell that holds
a third of all vectors is many groups; a query goes once to every block of the
lists it probes, with the second centroids it wants there, and a block returns the
best k per query, so no pairs are kept beyond that.

Defined results: vectors that are null, zero, of another length than the table's
commonest, or that hold null or non-finite components take no part, neither as
query nor as candidate; so do rows with a null id. Repeated rows are candidates
each; ties go to the smaller id. A query's own id is never its neighbour. Extra
columns are ignored. An empty table, or one without queries, gives no row.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.splits import smallest_hashes
from ..session import materialize
from .common import grouped_rows

#: Production parameters.
CENTROIDS, SAMPLE_ROWS, ROUNDS = 64, 16384, 12
CANDIDATE_SHARE, MIN_CANDIDATES = 0.45, 2000
BLOCK_ROWS = 4096


@dataclass
class Codebooks:
    """``halves[h]``: the centroids of half h, one per row."""

    halves: tuple[np.ndarray, np.ndarray]

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of unit vectors' halves to the centroids, one matrix per half."""
        cut = self.halves[0].shape[1]
        return tuple((h * h).sum(1) - 2 * part @ h.T + (part * part).sum(1, keepdims=True)
                     for h, part in zip(self.halves, (x[:, :cut], x[:, cut:])))

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = self.distances(x)
        return a.argmin(1) * len(self.halves[1]) + b.argmin(1)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 5) -> np.ndarray:
    """Lloyd's algorithm from distinct sample rows; an emptied centroid keeps its place."""
    x = x[np.random.default_rng(seed).permutation(len(x))]
    c = np.unique(x[: 4 * k], axis=0)
    c = c[np.random.default_rng(seed).permutation(len(c))[:k]].copy()
    for _ in range(rounds):
        near = ((c * c).sum(1) - 2 * x @ c.T).argmin(1)
        n = np.bincount(near, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


def multi_sequence(da: np.ndarray, db: np.ndarray, sizes: np.ndarray, wanted: int) -> list[int]:
    """Cells by growing ``da[i] + db[j]`` until they hold ``wanted`` entries; ``sizes`` is the cells' entry count."""
    oa, ob = np.argsort(da, kind="stable"), np.argsort(db, kind="stable")
    sa, sb = da[oa].tolist(), db[ob].tolist()
    heap, seen, out, got = [(sa[0] + sb[0], 0, 0)], {(0, 0)}, [], 0
    while heap and got < wanted:
        _, i, j = heapq.heappop(heap)
        cell = int(oa[i]) * len(sb) + int(ob[j])
        if sizes[cell]:
            out.append(cell)
            got += int(sizes[cell])
        for p in ((i + 1, j), (i, j + 1)):
            if p[0] < len(sa) and p[1] < len(sb) and p not in seen:
                seen.add(p)
                heapq.heappush(heap, (sa[p[0]] + sb[p[1]], *p))
    return out


def _matrix(col: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(col), -1)


def clean(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): the rows that take part; components of other types than float and double become doubles."""
    v = F.col(vector_col)
    if vectors.schema[vector_col].dataType.simpleString() not in ("array<float>", "array<double>"):
        v = v.cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    ok = vectors.select(F.col(id_col).alias("id"), v.alias("v")).where(F.col("id").isNotNull() & finite)
    ok = ok.where(F.exists("v", lambda x: x != 0))
    width = ok.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return ok.where(F.size("v") == (width.n if width else 0))


def fit_codebooks(rows: DataFrame, centroids: int = CENTROIDS, sample_rows: int = SAMPLE_ROWS) -> Codebooks | None:
    """Codebooks from the ``sample_rows`` rows with the smallest id hashes; ``rows`` as ``clean`` gives them."""
    got = smallest_hashes(rows, sample_rows, F.xxhash64("id"), "id").toPandas().sort_values("id")
    if got.empty:
        return None
    x = unit(np.array(got["v"].tolist(), dtype=np.float64))
    cut = x.shape[1] // 2
    return Codebooks((kmeans(x[:, :cut], centroids), kmeans(x[:, cut:], centroids)))


def _with_cells(rows: DataFrame, books: Codebooks) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                cell = books.cells(unit(_matrix(b.column(1))))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell.astype(np.int32))], names=["id", "v", "cell"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("cell", T.IntegerType())]))


def _probes(queries: DataFrame, books: Codebooks, sizes: np.ndarray, wanted: int) -> DataFrame:
    """(id, v, list, second): per query and first centroid that it visits, the second centroids it wants there."""
    kb = len(books.halves[1])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                b = whole.slice(lo, 256)
                da, db = books.distances(unit(_matrix(b.column(1))))
                rows, first, second = [], [], []
                for r, (x, y) in enumerate(zip(da, db)):
                    cells = np.sort(np.array(multi_sequence(x, y, sizes, wanted), dtype=np.int64))
                    lists, at = np.unique(cells // kb, return_index=True)
                    rows += [r] * len(lists)
                    first += lists.tolist()
                    second += [(part % kb).astype(np.int32) for part in np.split(cells, at[1:])]
                take = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(take), b.column(1).take(take), pa.array(first, pa.int32()),
                     pa.array(second, pa.list_(pa.int32()))], names=["id", "v", "list", "second"])

    more = [T.StructField("list", T.IntegerType()), T.StructField("second", T.ArrayType(T.IntegerType()))]
    return queries.mapInArrow(run, T.StructType([*queries.schema.fields, *more]))


def exact_cosine(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosine of paired rows, summed the same way for every pair, so equal vectors get equal scores."""
    return (q * x).sum(1) / (np.sqrt((q * q).sum(1)) * np.sqrt((x * x).sum(1)))


def _best(q: np.ndarray, qid: np.ndarray, wants: np.ndarray, x: np.ndarray, xid: np.ndarray,
          k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, entry row, score): each query's k best wanted entries, exact, ties to the smaller id."""
    approx = unit(q) @ unit(x).T
    approx[~wants | (qid[:, None] == xid[None, :])] = -np.inf
    near = np.isfinite(approx)
    if x.shape[0] > k:
        floor = np.partition(approx, -k, axis=1)[:, -k]
        near &= approx >= np.maximum(floor, -2)[:, None] - 1e-9  # a margin for rounding keeps every tie
    qi, xi = np.nonzero(near)
    s = np.empty(len(qi))
    for lo in range(0, len(qi), 1 << 15):
        part = slice(lo, lo + (1 << 15))
        s[part] = exact_cosine(q[qi[part]], x[xi[part]])
    order = np.lexsort((xid[xi], -s, qi))
    qi, xi, s = qi[order], xi[order], s[order]
    keep = np.arange(len(qi)) - np.searchsorted(qi, qi) < k
    return qi[keep], xi[keep], s[keep]


def search(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
           centroids: int = CENTROIDS, candidate_share: float = CANDIDATE_SHARE, min_candidates: int = MIN_CANDIDATES,
           sample_rows: int = SAMPLE_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each row where ``is_query`` holds (over ``id_col``)."""
    spark = vectors.sparkSession
    id_type = vectors.schema[id_col].dataType.simpleString()
    out = f"query_id {id_type}, rank int, vec_id {id_type}, score double"
    rows = clean(vectors, id_col, vector_col)
    books = fit_codebooks(rows, centroids, sample_rows)
    if books is None:
        return spark.createDataFrame([], out)
    index = materialize(_with_cells(rows, books), "multi-index")
    sizes = np.zeros(len(books.halves[0]) * len(books.halves[1]), dtype=np.int64)
    for r in index.groupBy("cell").count().collect():  # at most centroids ** 2 rows
        sizes[r["cell"]] = r["count"]
    wanted = max(min_candidates, int(np.ceil(candidate_share * sizes.sum())))
    kb = len(books.halves[1])
    blocks = np.maximum(1, -(-sizes.reshape(-1, kb).sum(1) // block_rows))

    n_blocks = F.element_at(F.lit([int(b) for b in blocks]), F.col("list") + 1)
    entries = index.withColumn("list", F.floor(F.col("cell") / kb).cast("int")).select(
        "list", F.pmod(F.xxhash64("id", "v"), n_blocks).cast("int").alias("block"), F.lit(1).alias("kind"), "id", "v",
        F.array((F.col("cell") % kb).cast("int")).alias("second"))
    queries = index.select(F.col("id").alias(id_col), "v").where(is_query).select(F.col(id_col).alias("id"), "v").distinct()
    probes = _probes(queries, books, sizes, wanted).select(
        "list", F.explode(F.sequence(F.lit(0), n_blocks.cast("int") - 1)).alias("block"), F.lit(0).alias("kind"),
        "id", "v", "second")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in grouped_rows(batches, ["list", "block"]):
            group = t["list"].to_numpy().astype(np.int64) * (1 << 32) + t["block"].to_numpy()
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(group)) + 1)).tolist()
            for begin, stop in zip(cuts, [*cuts[1:], len(group)]):
                part = t.slice(begin, stop - begin).combine_chunks()
                n_q = int((part["kind"].to_numpy() == 0).sum())
                if n_q in (0, part.num_rows):
                    continue
                ids, second = part["id"].to_numpy(), part["second"].combine_chunks()
                x, of = _matrix(part["v"].slice(n_q)), second.slice(n_q).flatten().to_numpy()
                for lo in range(0, n_q, 512):
                    hi = min(n_q, lo + 512)
                    own = second.slice(lo, hi - lo)
                    wants = np.zeros((hi - lo, kb), dtype=bool)
                    wants[np.repeat(np.arange(hi - lo), own.value_lengths().to_numpy()), own.flatten().to_numpy()] = True
                    qi, xi, s = _best(_matrix(part["v"].slice(lo, hi - lo)), ids[lo:hi], wants[:, of], x, ids[n_q:], k)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[lo:hi][qi]), pa.array(ids[n_q:][xi]), pa.array(s)],
                                                     names=["query_id", "vec_id", "score"])

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = (probes.unionByName(entries).repartition(n, "list", "block").sortWithinPartitions("list", "block", "kind")
             .mapInArrow(run, f"query_id {id_type}, vec_id {id_type}, score double"))
    # a filter on row_number keeps k rows per query and task before the shuffle
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def brute_force(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, k: int = 5) -> dict[int, list[int]]:
    """The exact answer on a small table, to measure recall against."""
    at = {int(i): r for r, i in enumerate(ids)}
    out = {}
    for q in query_ids.tolist():
        s = exact_cosine(np.broadcast_to(x[at[q]], x.shape), x)
        s[ids == q] = -np.inf
        out[q] = ids[np.lexsort((ids, -s))[: min(k, len(ids) - 1)]].tolist()
    return out
