"""Ranked lexical search by presence-mask grouping.

The items are a stated query set, taken in blocks of bounded text; per block:

1. One pass over all whole documents keeps, of each, its number of terms and the block's
   terms it holds with their counts (a narrow written table: no term is exploded).
2. Statistics over all documents: N, L, the terms' document frequencies and the number of
   postings. The terms' integer weights are made from them on the driver; the block bounds
   their number.
3. Documents are dealt by a hash of their row to chunks of bounded rows and postings (no key
   of the data decides, so no frequent word or copied text fills a chunk). In a chunk every
   term has a bitmap of the documents that hold it. Per item the bitmaps of its terms give
   each document's presence mask; documents are grouped by mask, a mask's greatest score is
   the sum of its terms' greatest contributions in the chunk, and masks are scored in
   descending order of it until the k-th score found exceeds all that is left.
4. Each chunk reports at most k documents per item; a rank window takes the best k of all.

Defined results: a null text has no term; an item without terms, or with none that occurs,
has no row; items are told apart by row, so repeated items each get their documents, and a
null ``item_id`` is kept; equal scores go by ascending doc_id, nulls last, then by row;
repeated documents are ranked each; other columns are ignored; empty tables give an empty
result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import materialize
from .common import grouped_rows

TOP = 20
#: Text bytes of a block of items (their terms go to every task), and rows and postings of a chunk of documents.
ITEM_BYTES = 1 << 24
CHUNK_ROWS, CHUNK_POSTINGS = 1 << 14, 1 << 22
#: Fixed values of the score: all in thousandths or as the formula has them.
WEIGHT_SCALE, TF_SCALE, TF_PER, LENGTH_PER = 1000, 1_000_000_000, 1000, 12
LENGTH_PERCENT = 25

_SEPARATOR = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
#: Every ASCII byte that is no letter or digit becomes a space, A-Z become a-z; UTF-8 bytes of other characters stay.
_FOLD = bytes(32 if _SEPARATOR.match(bytes([b])) else b + 32 if 65 <= b <= 90 else b for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order, with repeats (bytes from 0x80 on are never white space to ``split``)."""
    return text.translate(_FOLD).split()


class Items(NamedTuple):
    """A block of the query set: per item the id, and its distinct terms (numbers) with their counts; the terms' numbers."""

    ids: list
    terms: list[tuple[np.ndarray, np.ndarray]]
    numbers: dict[bytes, int]


def read_items(rows: list) -> Items:
    numbers: dict[bytes, int] = {}
    ids, terms = [], []
    for item_id, text in rows:
        count = Counter(terms_of((text or "").encode()))
        at = np.array([numbers.setdefault(t, len(numbers)) for t in count], dtype=np.int32)
        ids.append(item_id)
        terms.append((at, np.array(list(count.values()), dtype=np.int64)))
    return Items(ids, terms, numbers)


def _postings(batches: Iterator[pa.RecordBatch], numbers: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, terms, counts = [], [], []
        for text in batch.column("__text"):
            count = Counter(terms_of((text.as_py() or "").encode()))
            held = [(numbers[t], c) for t, c in count.items() if t in numbers]
            n.append(sum(count.values()))
            terms.append(np.array([t for t, _ in held], dtype=np.int32).tobytes())
            counts.append(np.array([c for _, c in held], dtype=np.int64).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("__row"), batch.column("__id"), pa.array(n, pa.int64()), pa.array(terms, pa.binary()), pa.array(counts, pa.binary())],
            names=["row", "id", "n", "terms", "counts"])


def _frequencies(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    df = np.zeros(size, dtype=np.int64)
    for batch in batches:
        df += np.bincount(np.frombuffer(b"".join(batch.column("terms").to_pylist()), np.int32), minlength=size)
    at = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(df[at])], names=["term", "df"])


def best_by_masks(present: Iterable[np.ndarray], most: np.ndarray, score_of, k: int, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of the best ``k``, by score descending then ``order``, found mask by mask.

    ``present`` gives one bitmap (0/1 per document, unpacked) per term, ``most`` each term's
    greatest contribution, ``score_of(documents)`` their exact scores, ``order`` the documents' ranks by id.
    """
    words = np.zeros(((len(most) + 63) // 64, len(order)), dtype=np.uint64)
    for t, bits in enumerate(present):
        words[t // 64] |= bits.astype(np.uint64) << np.uint64(t % 64)
    some = np.flatnonzero(words.any(axis=0))
    if not some.size:
        return some, np.zeros(0, dtype=np.int64)
    words = words[:, some]
    by_mask = np.lexsort(words)
    new = np.ones(len(some), dtype=bool)
    new[1:] = (words[:, by_mask[1:]] != words[:, by_mask[:-1]]).any(axis=0)
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(some)))
    masks = words[:, by_mask[starts]]
    bound = np.zeros(len(starts), dtype=np.int64)
    for t, m in enumerate(most):
        bound += ((masks[t // 64] >> np.uint64(t % 64)) & np.uint64(1)).astype(np.int64) * m
    turn = np.argsort(-bound, kind="stable")
    docs, scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    at, step = 0, k
    while at < len(turn):
        if len(scores) == k and scores[-1] > bound[turn[at]]:
            break  # no document of this or a later mask can reach the k-th
        take, room = [], step
        while at < len(turn) and room > 0:
            g = turn[at]
            take.append(by_mask[starts[g]:starts[g] + sizes[g]])
            room -= sizes[g]
            at += 1
        found = some[np.concatenate(take)]
        docs, scores = np.concatenate([docs, found]), np.concatenate([scores, score_of(found)])
        best = np.lexsort((order[docs], -scores))[:k]
        docs, scores = docs[best], scores[best]
        step *= 2
    fine = scores > 0
    return docs[fine], scores[fine]


def _search_chunk(t: pa.Table, items: Items, weight: np.ndarray, n_docs: int, n_terms: int, k: int) -> pa.RecordBatch:
    parts = [np.frombuffer(b, np.int32) for b in t.column("terms").to_pylist()]
    sizes = np.array([len(p) for p in parts])
    term = np.concatenate(parts)
    tf = np.frombuffer(b"".join(t.column("counts").to_pylist()), np.int64)
    length = t.column("n").to_numpy()
    m = 100 - LENGTH_PERCENT + (LENGTH_PERCENT * length * n_docs) // n_terms
    doc = np.repeat(np.arange(t.num_rows), sizes)
    gain = weight[term] * ((TF_SCALE * tf) // (TF_PER * tf + LENGTH_PER * m[doc]))
    first = np.concatenate([[0], np.cumsum(sizes)])
    by_term = np.argsort(term, kind="stable")
    held, begin = np.unique(term[by_term], return_index=True)
    end = np.append(begin[1:], len(term))
    most = np.maximum.reduceat(gain[by_term], begin)
    packed: dict[int, np.ndarray] = {}

    def bitmap(j: int) -> np.ndarray:
        """The documents of a term; those of frequent terms are kept packed for the next items."""
        if j in packed:
            return np.unpackbits(packed[j], count=t.num_rows)
        bits = np.zeros(t.num_rows, dtype=np.uint8)
        bits[doc[by_term[begin[j]:end[j]]]] = 1
        if (end[j] - begin[j]) * 64 >= t.num_rows:  # at most 64 x postings / rows terms are so frequent
            packed[j] = np.packbits(bits)
        return bits

    place = np.full(len(weight), -1, dtype=np.int64)
    place[held] = np.arange(len(held))
    ids = t.column("id").to_pylist()
    rank = sorted(range(len(ids)), key=lambda d: (ids[d] is None, ids[d] or 0, d))
    order = np.empty(len(ids), dtype=np.int64)
    order[rank] = np.arange(len(ids))
    row = t.column("row").to_numpy()
    out_item, out_doc, out_score = [], [], []
    factor = np.zeros(len(weight), dtype=np.int64)  # how often the item at hand holds each term

    def score_of(docs: np.ndarray) -> np.ndarray:
        n = first[docs + 1] - first[docs]
        begins = np.concatenate([[0], np.cumsum(n)[:-1]])
        at = np.repeat(first[docs] - begins, n) + np.arange(n.sum())
        return np.add.reduceat(gain[at] * factor[term[at]], begins)

    for i, (terms, times) in enumerate(items.terms):
        here = place[terms]
        known = here >= 0
        if not known.any():
            continue
        here, times_here = here[known], times[known]
        factor[terms] = times
        docs, scores = best_by_masks(map(bitmap, here.tolist()), most[here] * times_here, score_of, k, order)
        factor[terms] = 0
        out_item.append(np.full(len(docs), i, dtype=np.int32))
        out_doc.append(docs)
        out_score.append(scores)
    item = np.concatenate(out_item) if out_item else np.zeros(0, dtype=np.int32)
    docs = np.concatenate(out_doc).astype(np.int64) if out_doc else np.zeros(0, dtype=np.int64)
    score = np.concatenate(out_score) if out_score else np.zeros(0, dtype=np.int64)
    return pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(row[docs]), t.column("id").take(pa.array(docs)).combine_chunks(),
                                       pa.array(score, pa.int64())], names=["item", "row", "id", "score"])


def _search(batches: Iterator[pa.RecordBatch], items: Items, weight: np.ndarray, n_docs: int, n_terms: int, k: int) -> Iterator[pa.RecordBatch]:
    for several in grouped_rows(batches, ["chunk"]):
        chunk = several.column("chunk").to_numpy()
        cuts = [0, *(np.flatnonzero(chunk[1:] != chunk[:-1]) + 1).tolist(), len(chunk)]
        for a, b in zip(cuts, cuts[1:]):
            yield _search_chunk(several.slice(a, b - a), items, weight, n_docs, n_terms, k)


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(WEIGHT_SCALE * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _search_block(docs: DataFrame, items: Items, k: int, id_type: str) -> DataFrame:
    """(item number, rank, id, score) of one block of items against all rows of ``docs`` (__row, __id, __text)."""
    numbers = items.numbers
    table = materialize(docs.mapInArrow(lambda it: _postings(it, numbers), f"row long, id {id_type}, n long, terms binary, counts binary"), "postings")
    s = table.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms"), F.count_if(F.octet_length("terms") > 0).alias("rows"),
                  F.sum(F.octet_length("terms").cast("long")).alias("bytes")).first()
    matched = table.where(F.octet_length("terms") > 0)
    size = max(len(numbers), 1)
    df = dict(matched.mapInArrow(lambda it: _frequencies(it, size), "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
              .collect())  # at most one row per term of the block
    n_docs, n_terms = s["docs"], max(s["terms"] or 0, 1)
    weight = np.array([term_weight(n_docs, df.get(t, 0)) for t in range(size)], dtype=np.int64)
    chunks = max(1, -(-s["rows"] // CHUNK_ROWS), -(-(s["bytes"] or 0) // 4 // CHUNK_POSTINGS))
    dealt = matched.withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(chunks)).cast("int")).repartitionByRange(int(min(chunks, 1 << 16)), "chunk")
    found = dealt.sortWithinPartitions("chunk").mapInArrow(lambda it: _search(it, items, weight, n_docs, n_terms, k),
                                                           f"item int, row long, id {id_type}, score long")
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"), F.asc("row"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("item", "rank", "id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The ``k`` best documents of every item: item_id, rank, doc_id, score (above 0)."""
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    out = T.StructType([T.StructField("item_id", items.schema[item_id_col].dataType), T.StructField("rank", T.IntegerType()),
                        T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("score", T.LongType())])
    asked = materialize(items.select(F.col(item_id_col).alias("id"), F.col(item_text_col).alias("text")), "items")
    total = asked.agg(F.sum(F.octet_length("text").cast("long")).alias("b"), F.count(F.lit(1)).alias("n")).first()
    blocks = max(1, -(-((total["b"] or 0) + 16 * total["n"]) // ITEM_BYTES))
    rows = docs.select(F.monotonically_increasing_id().alias("__row"), F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    asked = asked.withColumn("__item", F.monotonically_increasing_id())
    results = []
    for b in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("__item"), F.lit(blocks)) == b)
        block = read_items([(r["id"], r["text"]) for r in mine.select("id", "text").collect()])  # ITEM_BYTES, give or take a row
        if block.numbers:
            ids = spark.createDataFrame([(i, v) for i, v in enumerate(block.ids)], T.StructType([T.StructField("item", T.IntegerType()), out["item_id"]]))
            results.append(_search_block(rows, block, k, id_type).join(F.broadcast(ids), "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score"))
    if not results:
        return spark.createDataFrame([], out)
    found = results[0]
    for r in results[1:]:
        found = found.unionByName(r)
    return found
