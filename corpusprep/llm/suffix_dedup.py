"""Repeated substrings removed by a distributed suffix sort that knows its common prefixes.

A byte of a text goes if a string of ``length`` bytes that covers it starts anywhere
else too, in the same text or another one; strings are judged on the input, overlaps
count, and matches never cross texts.

Not every suffix is sorted. A window of ``length`` bytes is anchored at the smallest
hash among its ``anchor``-byte strings (leftmost on a tie), so equal windows have the
same anchor at the same offset, and neighbouring windows mostly share one: the windows
of one anchor are an interval, and their text a "superstring" around the anchor. Only
suffixes that begin at anchors are sorted, about one in 70:

1. Anchors that occur once in the corpus are dropped (their windows cannot repeat).
   If all superstrings of an anchor are the same, all its windows repeat.
2. The rest are the suffixes to sort. Each task sorts its own into a run, drops equal
   ones but one, front-codes the run and cuts it at splitters taken from a bounded
   sample. The runs' pieces are exchanged and merged by loser trees that never compare
   a known prefix again (``suffix_runs``). In the merged order an anchor's suffixes are
   neighbours, and their common prefixes, with those of the text to the left of the
   anchor, tell exactly which windows repeat.
   Equal superstrings are counted by digest before, so a string is sorted once however
   many texts hold it.
3. An anchor with more than ``hot`` different superstrings (the ends of a passage that a
   third of all texts hold) would be one large group: their windows are counted by digest
   instead, first in blocks of 16, then one by one where a block is alone; these are
   aggregations with map-side combine.

The repeated windows of a text go back to it by its row key. Anchors' hashes are kept
out of the plan by two bit maps, which only save work: what they let through too much is
dropped by an exact join. They have eight bits per repeated anchor, within ``FILTER_BITS``
(128 MB at most, which is enough for some 10^8 repeated anchors; beyond that they fill up
and superstrings travel that the join drops). Where counts go back to anchors,
superstrings or blocks, those in over 1/4096 of the rows are joined by broadcast
(``join_counted``), so no passage that a third of all texts hold meets in one task.

Texts are bytes: a null text is empty. Rows are counted as they are, so repeated rows
repeat each other, whatever their ids; a null id is an id like any other. Texts shorter
than ``length`` keep everything. Extra columns are ignored; an empty table gives no row.
Equal means equal 64-bit hash for anchors together with equal 64-bit digest of the whole
superstring in step 1, bytes in the sorted runs, and a 128-bit digest where strings are counted.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.splits import smallest_hashes
from ..session import materialize
from .common import grouped_rows, join_counted, text_slices
from .suffix_runs import front_code, front_decode, merge_runs, repeated_offsets

#: Production parameters.
LENGTH, ANCHOR = 200, 64
HOT, FILTER_BITS = 2000, (20, 30)
#: Bytes of a run and of a part, and the sample that splitters come from: at least, per part, and at most.
RUN_BYTES, PART_BYTES, SPLITTER_SAMPLE = 32 << 20, 8 << 20, (8192, 4, 1 << 20)
_SEGMENT_BITS = 20

_BYTE = np.array([xxhash.xxh64_intdigest(bytes([b]), 0x5A) for b in range(256)], dtype=np.uint64)
_ODD = np.uint64(0xD6E8FEB86659FD93)


def anchor_hashes(data: np.ndarray, anchor: int) -> np.ndarray:
    """64-bit hash of every ``anchor``-byte string, by doubling: a string's hash mixes those of its two halves."""
    n = len(data) - anchor + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h, size, out, done = _BYTE[data], 1, None, 0
    need = anchor
    while True:
        if need & 1:  # the parts of the binary expansion, from small to large, one after the other
            part = h[done:done + n]
            if out is None:
                out = part.copy()
            else:
                out *= _ODD
                out += part
                out ^= out >> np.uint64(29)
            done += size
        need >>= 1
        if not need:
            out *= _ODD
            return out ^ (out >> np.uint64(32))
        more = h[:-size] * _ODD
        more += h[size:]
        more ^= more >> np.uint64(31)
        h, size = more, size * 2


def superstrings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int,
                 anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, anchor place, first window, last window) in place order, for texts ``data[starts:ends]``.

    At most 2^20 bytes are handled at a time; an interval may be cut there, which loses no window.
    """
    out: list[list[np.ndarray]] = [[], [], [], []]
    width = length - anchor + 1
    room = (1 << _SEGMENT_BITS) - length
    keep_high = ~np.uint64((1 << _SEGMENT_BITS) - 1)
    last = len(data) - length + 1  # windows start before this
    if last <= 0 or width < 1:
        return tuple(np.empty(0, t) for t in (np.uint64, np.int64, np.int64, np.int64))
    owner = np.repeat(np.arange(len(starts)), ends - starts)
    for lo in range(0, last, room):
        hi = min(last, lo + room)
        h = anchor_hashes(data[lo:hi + length - 1], anchor)
        key = (h & keep_high) | np.arange(len(h), dtype=np.uint64)
        low, size = key, 1
        while size * 2 <= width:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        n = hi - lo
        if size < width:
            low = np.minimum(low[:n], low[width - size:width - size + n])
        at = (low[:n] & ~keep_high).astype(np.int64)
        s = np.arange(lo, hi)
        whole = s + length <= ends[owner[s]]
        s, at, who = s[whole], at[whole], owner[s[whole]]
        if s.size == 0:
            continue
        new = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (who[1:] != who[:-1])))
        stop = np.append(new[1:], len(s)) - 1
        for c, v in zip(out, (h[at[new]], at[new] + lo, s[new], s[stop])):
            c.append(v)
    return tuple(np.concatenate(c) if c else np.empty(0, t)
                 for c, t in zip(out, (np.uint64, np.int64, np.int64, np.int64)))


class _Filter:
    """Set of hashes as a bit map of 2^bits: may say yes too often, never no too often."""

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.bits = words, bits

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & np.uint64((1 << self.bits) - 1)  # low bits: anchors are minima, their high bits are mostly zero
        return (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1

    @classmethod
    def of(cls, hashes: DataFrame, col: str, bits: tuple[int, int]) -> _Filter:
        bits = min(max(bits[0], (8 * hashes.count()).bit_length()), bits[1])
        at = F.col(col).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))
        rows = hashes.groupBy(F.shiftrightunsigned(at, 6).alias("w")).agg(
            F.expr(f"bit_or(shiftleft(1L, int({col} & 63)))").alias("b"))
        got = rows.toArrow()  # at most 2^(bits - 6) rows
        words = np.zeros(max(1, 1 << (bits - 6)), dtype=np.uint64)
        words[got["w"].to_numpy()] = got["b"].to_numpy().view(np.uint64)
        return cls(words, bits)


def _slices(batches: Iterable[pa.RecordBatch]):
    """(row keys, data, starts, ends, joined bytes) per slice of texts."""
    for batch in batches:
        for keys, texts in text_slices(batch, max_bytes=1 << _SEGMENT_BITS):
            joined = b"".join(texts)
            ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
            yield (np.array(keys, dtype=np.int64), np.frombuffer(joined, dtype=np.uint8), np.append(0, ends[:-1]), ends, joined)


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def repeated_spans(rows: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, hot: int = HOT,
                   filter_bits: tuple[int, int] = FILTER_BITS) -> DataFrame:
    """(row_key, first, last): closed intervals of window starts that repeat. ``rows``: (row_key long, text)."""
    spark = rows.sparkSession
    sc = spark.sparkContext

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, starts, ends, joined in _slices(batches):
            h, _, first, last = superstrings(data, starts, ends, length, anchor)
            digest = np.fromiter((xxhash.xxh3_64_intdigest(joined[a:b + length]) for a, b in zip(first.tolist(), last.tolist())),
                                 np.uint64, len(h))
            yield pa.RecordBatch.from_arrays([_signed(h), _signed(digest)], names=["anchor", "digest"])

    counted = rows.select("row_key", "text").mapInArrow(count, "anchor long, digest long").groupBy("anchor").agg(
        F.count(F.lit(1)).alias("n"), F.min("digest").alias("lo"), F.max("digest").alias("hi"))
    again = materialize(counted.where("n > 1").select("anchor", "n", (F.col("lo") == F.col("hi")).alias("same")), "anchors")
    # two bit maps of bounded size go to the tasks
    repeats = sc.broadcast(_Filter.of(again, "anchor", filter_bits))
    mixed = sc.broadcast(_Filter.of(again.where("NOT same"), "anchor", filter_bits))

    def candidates(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, data, starts, ends, joined in _slices(batches):
            h, at, first, last = superstrings(data, starts, ends, length, anchor)
            ok = repeats.value(h)
            h, at, first, last = h[ok], at[ok], first[ok], last[ok]
            who = np.searchsorted(ends, first, side="right")
            text = mixed.value(h)
            strings = [joined[a:b + length] if t else None for t, a, b in zip(text.tolist(), first.tolist(), last.tolist())]
            base = starts[who]
            yield pa.RecordBatch.from_arrays(
                [_signed(h), pa.array(keys[who]), pa.array(at - base), pa.array(first - base), pa.array(last - base),
                 pa.array(strings, pa.binary())], names=["anchor", "row_key", "at", "first", "last", "string"])

    found = rows.select("row_key", "text").mapInArrow(
        candidates, "anchor long, row_key long, at long, first long, last long, string binary")
    # written once: both the spans that are settled and the suffixes to sort are read from it
    found = materialize(join_counted(found, again, "anchor").where("same IS NOT NULL").drop("n").withColumn(
        "string", F.expr("CASE WHEN NOT same THEN string END")), "superstrings")
    settled = found.where("same").select("row_key", "first", "last")
    todo = found.where("NOT same").select("anchor", "row_key", "at", "first", "last", "string")
    return settled.unionByName(_mixed_spans(todo, length, anchor, hot))


def _mixed_spans(todo: DataFrame, length: int, anchor: int, hot: int) -> DataFrame:
    """The repeated window intervals among superstrings whose anchor has several different ones."""
    named = todo.withColumn("name", F.unhex(F.md5(F.concat((F.col("at") - F.col("first")).cast("string").cast("binary"), "string"))))
    classes = materialize(named.groupBy("name").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("row_key", "at", "first", "last")).alias("m"),
        F.first("string").alias("string"), F.first("anchor").alias("anchor")).select(
        "name", "n", "anchor", "string", "m.*"), "classes")
    again = join_counted(named.select("name", "row_key", "first", "last"), classes.where("n > 1").select("name", "n"), "name").where("n IS NOT NULL")
    crowded = materialize(classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > hot).select("anchor"),
                          "crowded")
    single = F.col("n") == 1
    few = classes.join(crowded, "anchor", "left_anti").withColumn("single", single)
    many = classes.join(crowded, "anchor", "left_semi").withColumn("single", single)
    keep = ["string", "single", "row_key", "at", "first", "last"]
    return (again.select("row_key", "first", "last")
            .unionByName(_sorted_out(few.select(*keep), length, anchor)).unionByName(_counted_out(many.select(*keep), length)))


BLOCK = 16


def _counted_out(units: DataFrame, length: int) -> DataFrame:
    """Repeated windows found by counting digests, of whole blocks of ``BLOCK`` windows first."""
    out = None
    for size in (BLOCK, 1):
        def cut(batches: Iterable[pa.RecordBatch], size: int = size) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lo in range(0, batch.num_rows, 512):
                    rows = []
                    for u in batch.slice(lo, 512).to_pylist():
                        # window w stands at - w before the anchor: blocks are cut by that offset, alike in all strings
                        w = u["first"]
                        while w <= u["last"]:
                            stop = min(u["last"], u["at"] - (u["at"] - w) // size * size)
                            text = u["string"][w - u["first"]:stop - u["first"] + length]
                            name = blake2b(text, digest_size=16, salt=(u["at"] - w).to_bytes(4, "little")).digest()
                            rows.append((int.from_bytes(name[:8], "little", signed=True), int.from_bytes(name[8:], "little", signed=True),
                                         text if size > 1 else None, u["single"], u["row_key"], u["at"], w, stop))
                            w = stop + 1
                    cols = list(zip(*rows)) or [()] * 8
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, block_schema)], schema=block_schema)

        block_schema = pa.schema([("d1", pa.int64()), ("d2", pa.int64()), ("string", pa.binary()), ("single", pa.bool_()),
                                  *[(c, pa.int64()) for c in ("row_key", "at", "first", "last")]])
        blocks = materialize(units.mapInArrow(
            cut, "d1 long, d2 long, string binary, single boolean, row_key long, at long, first long, last long"), "blocks")
        # a string that stands for several counts as two
        often = materialize(blocks.groupBy("d1", "d2").agg(F.sum(F.when(F.col("single"), 1).otherwise(2)).alias("times"), F.count(F.lit(1)).alias("n"))
                            .where("times > 1").select(F.struct("d1", "d2").alias("d"), "n"), "often")
        judged = join_counted(blocks.withColumn("d", F.struct("d1", "d2")), often, "d")
        hit = judged.where("n IS NOT NULL")
        spans = hit.where("single").select("row_key", "first", "last")
        out = spans if out is None else out.unionByName(spans)
        # what is alone goes on in smaller pieces, and one of each kind that is not, to be compared with
        rest = judged.where("n IS NULL").select("string", "single", "row_key", "at", "first", "last")
        kinds = hit.dropDuplicates(["d1", "d2"]).select("string", F.lit(False).alias("single"), "row_key", "at", "first", "last")
        units = rest.unionByName(kinds)
    return out


def _sorted_out(todo: DataFrame, length: int, anchor: int) -> DataFrame:
    """Repeated windows of different superstrings, found by merging sorted runs of their suffixes from the anchor on."""
    spark = todo.sparkSession
    size = todo.agg(F.sum(F.length("string"))).first()[0] or 0
    n_parts = int(size // PART_BYTES) + 1
    sample = todo.select(F.expr(f"substring(string, int(at - first) + 1, {anchor})").alias("s"), "row_key", "at")
    least, each, most = SPLITTER_SAMPLE
    sample = smallest_hashes(sample, min(most, max(least, each * n_parts)), F.xxhash64("row_key", "at"), "row_key", "at")
    points = sorted(bytes(r.s) for r in sample.collect())
    splitters = sorted({points[len(points) * i // n_parts] for i in range(1, n_parts)} if points else set())

    def runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each task's sorted runs, front-coded and cut at the splitters."""

        def emit(held: list[dict]) -> Iterator[pa.RecordBatch]:
            held.sort(key=lambda r: (r["right"], r["left"]))
            parts = [bisect_right(splitters, r["right"][:anchor]) for r in held]
            k = 0
            while k < len(held):
                stop = min(len(held), k + 4096, bisect_right(parts, parts[k]))
                recs = held[k:stop]
                lcp, rest = front_code([r["right"] for r in recs])
                left_lcp, left_rest = front_code([r["left"] for r in recs])
                yield pa.RecordBatch.from_pylist([{
                    "part": parts[k], "lcp": lcp, "rest": rest, "left_lcp": left_lcp, "left_rest": left_rest,
                    "single": [r["single"] for r in recs], "row_key": [r["row_key"] for r in recs],
                    "at": [r["at"] for r in recs], "before": [r["at"] - r["first"] for r in recs],
                    "windows": [r["last"] - r["first"] for r in recs]}], schema=piece)
                k = stop

        held, held_bytes = [], 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                for r in batch.slice(lo, 2048).to_pylist():
                    cut = r["at"] - r["first"]
                    r["right"], r["left"] = r["string"][cut:], r["string"][:cut][::-1]
                    held.append(r)
                    held_bytes += 2 * len(r["string"]) + 400
                if held_bytes >= RUN_BYTES:
                    yield from emit(held)
                    held, held_bytes = [], 0
        if held:
            yield from emit(held)

    piece = pa.schema([("part", pa.int32()), ("lcp", pa.list_(pa.int32())), ("rest", pa.list_(pa.binary())),
                       ("left_lcp", pa.list_(pa.int32())), ("left_rest", pa.list_(pa.binary())), ("single", pa.list_(pa.bool_())),
                       *[(c, pa.list_(pa.int64())) for c in ("row_key", "at", "before", "windows")]])
    made = todo.mapInArrow(runs, "part int, lcp array<int>, rest array<binary>, left_lcp array<int>, left_rest array<binary>, "
                                 "single array<boolean>, row_key array<bigint>, at array<bigint>, before array<bigint>, "
                                 "windows array<bigint>")

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped_rows(batches, ["part"]):
            parts = table["part"].to_numpy()
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(parts)) + 1)).tolist()
            for lo, hi in zip(cuts, [*cuts[1:], len(parts)]):
                pieces = table.slice(lo, hi - lo).to_pylist()
                lefts = [[s for _, s in front_decode(p["left_lcp"], p["left_rest"])] for p in pieces]
                spans: list[tuple[int, int, int]] = []
                group: list[tuple[int, bytes, int, int]] = []

                def close():
                    if len(group) > 1:
                        own = [(pieces[r], k) for _, _, r, k in group]
                        low = [p["before"][k] - p["windows"][k] for p, k in own]
                        high = [p["before"][k] for p, k in own]
                        got = repeated_offsets([s for _, s, _, _ in group], [k for k, _, _, _ in group],
                                               [lefts[r][k] for _, _, r, k in group], low, high, length)
                        for (p, k), offsets in zip(own, got):
                            if p["single"][k]:
                                spans.extend((p["row_key"][k], p["at"][k] - b, p["at"][k] - a) for a, b in offsets)

                for rec in merge_runs([(p["lcp"], p["rest"]) for p in pieces]):
                    if rec[0] < anchor:
                        close()
                        group = []
                    group.append(rec)
                close()
                cols = list(zip(*spans)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["row_key", "first", "last"])

    n = max(n_parts, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return (made.repartition(n, "part").sortWithinPartitions("part")
            .mapInArrow(merge, "row_key long, first long, last long"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   anchor: int = ANCHOR, hot: int = HOT, filter_bits: tuple[int, int] = FILTER_BITS) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, kept) per row; ``kept`` is the remaining bytes."""
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(id_col, text_col).alias("row_key"), F.col(text_col).alias("text"))
    spans = repeated_spans(keyed, length, anchor, hot, filter_bits)
    per_row = spans.groupBy("row_key").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    joined = keyed.join(per_row, "row_key", "left").select("id", "text", "spans")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for ids, texts in text_slices(batch):
                part = batch.slice(at, len(ids))
                at += len(ids)
                out = []
                for t, spans in zip(texts, part.column(2).to_pylist()):
                    kept, pos, removed, runs = [], 0, 0, 0
                    # windows -> bytes: [first, last + length), joined where they touch
                    for s in sorted(spans or (), key=lambda s: s["first"]):
                        a, b = s["first"], s["last"] + length
                        if a > pos or not runs:
                            kept.append(t[pos:a])
                            runs += 1
                            removed += b - a
                            pos = b
                        elif b > pos:
                            removed += b - pos
                            pos = b
                    kept.append(t[pos:])
                    rest = b"".join(kept)
                    out.append((len(t), removed, runs, hashlib.sha256(rest).hexdigest(), rest))
                cols = list(zip(*out)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string()),
                     pa.array(cols[4], pa.binary())], names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType),
                           *[T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")],
                           T.StructField("kept_sha256", T.StringType()), T.StructField("kept", T.BinaryType())])
    return joined.mapInArrow(cut, schema).withColumnRenamed("id", id_col)
