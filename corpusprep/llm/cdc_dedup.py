"""Substring deduplication by content-defined chunking with a gear rolling hash.

A text's UTF-8 bytes are cut where the gear hash of the last ``window`` bytes has
its mask bits zero, so an insertion moves only the cuts around it. Every variable
chunk is named by a 128-bit digest. A digest's first holder is the smallest
document id that has it (and its first place in that document); every other
occurrence is a duplicate. Neighbouring duplicate chunks form runs, and a run of
at least ``min_run_bytes`` is removed from its text: a passage that repeats across
documents survives once, while a chance agreement of a few words stays. The bytes of
a passage before its first and after its last cut share a chunk with other text and
stay, so a second copy is removed but for its ends, and a short one now and then whole
stays: the README gives the recall measured for passages of 51 and 80 words.

On Spark: one pass emits a row per distinct chunk of a document; an aggregation
on the digest (combined map-side, so a digest held by a third of all documents
is no burden) finds the digests held by several; a join marks the later holders
(AQE splits a hot digest); the places go back to their document by its id. No
text leaves its row until that last join.

Defined results: a null text counts as empty and stays null; rows with a null id
take no part and keep their text; rows that repeat an id are told apart by their
text, and equal rows get equal results. Cuts never split a UTF-8 character.
Extra columns pass through ``deduplicate`` untouched, but for those named like the added
ones. An empty table gives no row.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import text_slices

#: Production parameters: chunks of 16 to 192 bytes, about 31 on average, small enough that a passage of 51 words holds several.
MIN_BYTES, MAX_BYTES, MASK_BITS, WINDOW = 16, 192, 4, 16
MIN_RUN_BYTES = 80

#: Gear table: a random-looking 32-bit value per byte, by rule.
GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), 0x9E37) for b in range(256)], dtype=np.uint32)
_SEGMENT = 1 << 20


def gear_cuts(data: np.ndarray, window: int = WINDOW, mask_bits: int = MASK_BITS) -> np.ndarray:
    """Offsets after which the content allows a cut: the gear hash of the last ``window`` bytes has its mask bits zero.

    The hash ``h = (h << 1) + GEAR[byte]`` keeps byte i - k shifted left by k, so its bits below
    ``window`` depend on ``window`` bytes; it is computed for all places at once by doubling.
    """
    if not mask_bits <= window <= 32:
        raise ValueError("mask_bits <= window <= 32")
    mask = np.uint32(((1 << mask_bits) - 1) << (window - mask_bits))
    out = []
    for lo in range(0, len(data), _SEGMENT):
        back = min(lo, 31)
        h = GEAR[data[lo - back:lo + _SEGMENT]]
        for k in (1, 2, 4, 8, 16):
            if k < window:
                more = h[:-k] << np.uint32(k)
                h = h.copy()
                h[k:] += more
        at = np.flatnonzero((h[back:] & mask) == 0) + lo + 1
        out.append(at[at < len(data)])
    at = np.concatenate(out) if out else np.empty(0, np.int64)
    return at[(data[at] & 0xC0) != 0x80]  # a cut before a continuation byte would split a character


def chunk_ends(data: np.ndarray, cuts: list[int], start: int, end: int, min_bytes: int, max_bytes: int) -> list[int]:
    """Ends of the chunks of ``data[start:end]``: the next allowed cut that leaves a chunk of min to max bytes."""
    ends, pos, k, n = [], start, bisect_left(cuts, start + min_bytes), len(cuts)
    while end - pos > min_bytes:
        while k < n and cuts[k] < pos + min_bytes:
            k += 1
        at = cuts[k] if k < n else end
        if at - pos > max_bytes or at > end:
            at = min(end, pos + max_bytes)
            while at < end and data[at] & 0xC0 == 0x80:
                at -= 1
        ends.append(at)
        pos = at
    if pos < end:
        ends.append(end)
    return ends


class Chunker:
    """Chunks of many texts at once; ``digest=False`` leaves digests to the caller."""

    def __init__(self, min_bytes: int = MIN_BYTES, max_bytes: int = MAX_BYTES, mask_bits: int = MASK_BITS,
                 window: int = WINDOW):
        if not window <= min_bytes <= max_bytes - 4:
            raise ValueError("window <= min_bytes <= max_bytes - 4")
        self.min_bytes, self.max_bytes, self.mask_bits, self.window = min_bytes, max_bytes, mask_bits, window

    def __call__(self, texts: list[bytes]) -> Iterator[tuple[list[int], list[bytes]]]:
        """Per text: the chunks' start offsets and their 16-byte digests."""
        joined = b"".join(texts)
        data = np.frombuffer(joined, dtype=np.uint8)
        cuts = gear_cuts(data, self.window, self.mask_bits).tolist()
        base = 0
        for t in texts:
            ends = chunk_ends(data, cuts, base, base + len(t), self.min_bytes, self.max_bytes)
            starts = [base, *ends[:-1]] if ends else []
            yield ([s - base for s in starts],
                   [blake2b(joined[s:e], digest_size=16).digest() for s, e in zip(starts, ends)])
            base += len(t)


def chunk_rows(docs: DataFrame, id_col: str, text_col: str, chunker: Chunker) -> DataFrame:
    """(id, d1, d2, loc): one row per distinct chunk of a document; loc = text check sum << 32 | start of its first place."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in text_slices(batch):
                n, locs, digests = [], [], []
                for t, (starts, names) in zip(texts, chunker(texts)):
                    check = (zlib.crc32(t) & 0x7FFFFFFF) << 32
                    first = dict(zip(reversed(names), reversed(starts)))
                    n.append(len(first))
                    locs.extend(check | s for s in first.values())
                    digests.extend(first)
                d = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
                who = pa.array(ids, batch.schema.field(0).type).take(pa.array(np.repeat(np.arange(len(ids)), n)))
                yield pa.RecordBatch.from_arrays([who, pa.array(d[:, 0]), pa.array(d[:, 1]),
                                                  pa.array(np.array(locs, dtype=np.int64))],
                                                 names=["id", "d1", "d2", "loc"])

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("d1", T.LongType()),
                           T.StructField("d2", T.LongType()), T.StructField("loc", T.LongType())])
    return docs.where(F.col(id_col).isNotNull()).select(id_col, text_col).mapInArrow(run, schema)


def duplicate_places(docs: DataFrame, id_col: str, text_col: str, chunker: Chunker) -> DataFrame:
    """(id, locs): the chunks of a document whose digest a smaller id holds."""
    rows = chunk_rows(docs, id_col, text_col, chunker)
    held = rows.groupBy("d1", "d2").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    # written, so that both sides of the join are plain exchanges and AQE can split a hot digest
    held = materialize(held.where("n > 1").select("d1", "d2", "first"), "digests")
    later = rows.join(held, ["d1", "d2"]).where(F.col("id") != F.col("first"))
    return later.groupBy("id").agg(F.collect_list("loc").alias("locs"))


def _spans(starts: list[int], names: list[bytes], size: int, gone: set[int], min_run: int) -> list[tuple[int, int]]:
    """Maximal runs of duplicate chunks (places in ``gone``, or names seen before in the text) of ``min_run`` bytes or more."""
    seen: set[bytes] = set()
    spans: list[list[int]] = []
    for s, e, name in zip(starts, [*starts[1:], size], names):
        dup = s in gone or name in seen
        seen.add(name)
        if dup and spans and spans[-1][1] == s:
            spans[-1][1] = e
        elif dup:
            spans.append([s, e])
    return [(s, e) for s, e in spans if e - s >= min_run]


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunker: Chunker | None = None,
                min_run_bytes: int = MIN_RUN_BYTES, stats: bool = True) -> DataFrame:
    """``docs`` with repeated passages removed from ``text_col``, all other columns as they were.

    ``stats`` adds ``cdc_bytes``, ``cdc_chunks``, ``cdc_duplicates`` (chunks), ``cdc_removed`` (bytes) and ``cdc_spans``.
    A document whose every chunk in a run repeats elsewhere may end up empty; it stays as an empty text.
    """
    chunker = chunker or Chunker()
    added = [f"cdc_{n}" for n in ("bytes", "chunks", "duplicates", "removed", "spans")] if stats else []
    docs = docs.drop(*added)
    places = duplicate_places(docs, id_col, text_col, chunker).select(
        F.col("id").alias("__cdc_id"), F.col("locs").alias("__cdc_locs"))
    joined = docs.join(places, F.col(id_col) == F.col("__cdc_id"), "left").drop("__cdc_id")
    names = docs.columns
    fields = list(docs.schema.fields)
    fields += [T.StructField(n, T.LongType()) for n in added]
    text_at, id_at = names.index(text_col), names.index(id_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for ids, texts in text_slices(batch, id_at, text_at):
                part = batch.slice(at, len(ids))
                at += len(ids)
                locs = part.column(len(names)).to_pylist()
                out, counts = [], []
                for row, (who, t, (starts, digests), loc) in enumerate(zip(ids, texts, chunker(texts), locs)):
                    check = zlib.crc32(t) & 0x7FFFFFFF
                    gone = {x & 0xFFFFFFFF for x in loc or () if x >> 32 == check}
                    spans = _spans(starts, digests, len(t), gone, min_run_bytes) if who is not None else []
                    kept, pos = [], 0
                    for s, e in spans:
                        kept.append(t[pos:s])
                        pos = e
                    kept.append(t[pos:])
                    out.append(b"".join(kept) if part.column(text_at)[row].is_valid else None)
                    dups = sum(s in gone for s in starts) + len(digests) - len(set(digests))
                    counts.append((len(t), len(starts), dups, sum(e - s for s, e in spans), len(spans)))
                cols = [part.column(i) for i in range(len(names))]
                kind = batch.schema.field(text_at).type
                raw = pa.large_binary() if pa.types.is_large_string(kind) else pa.binary()
                cols[text_at] = pa.array(out, raw).view(kind)
                if stats:
                    c = np.array(counts, dtype=np.int64).reshape(-1, 5)
                    cols += [pa.array(c[:, i]) for i in range(5)]
                yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in fields])

    return joined.mapInArrow(run, T.StructType(fields))
