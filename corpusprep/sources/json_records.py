"""JSON files cut into records by byte range: a top-level array of any size is read by many tasks.

Spark's text reader splits a file at every ``}`` by byte range, so no task holds more than a
piece, whatever the layout: one array on one line, a pretty-printed array, one object, or an
object per line. Whether a piece starts inside a string, and how deep in braces, follows
from what lies before it. Pass 1 reduces each file block to what it does to that state for
both ways it may start (parity of quotes, braces opened and closed); sums over the blocks
of a file give every block's true start. Pass 2 walks the pieces again and gives each
record, that is each object that closes at depth 0. Records across block borders come as
fragments and are put together by a grouping of fragments alone.

Files must be well-formed JSON up to their end; a last record that the file cuts short comes
as it is (and parses to nulls). What stands between records (brackets, commas, white space,
numbers) is left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_ESCAPE = re.compile(r"\\.", re.DOTALL)
_BETWEEN = "\ufeff \t\r\n,[]"


def _opened(piece: str) -> tuple[bool, int, int]:
    """(odd number of quotes, braces opened outside strings if the piece starts outside one, the same if inside)."""
    parts = (_ESCAPE.sub("", piece) if "\\" in piece else piece).split('"')
    return len(parts) % 2 == 0, sum(p.count("{") for p in parts[0::2]), sum(p.count("{") for p in parts[1::2])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict | None, str, bool]]:
    """(columns of the block if its first piece, piece, whether it is its last) in file order; a partition holds whole blocks.

    One piece is held back to tell a block's last.
    """
    key, held = None, None
    for batch in batches:
        others = batch.schema.names[1:]
        paths, blocks = batch.column("path"), batch.column("block").to_numpy()
        for i, value in enumerate(batch.column("value")):
            now = (paths[i].as_py(), int(blocks[i]))
            if held is not None:
                yield *held, now != key
            held = ({c: batch.column(c)[i].as_py() for c in others} if now != key else None, value.as_py())
            key = now
    if held is not None:
        yield *held, True


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block: its effect on (inside a string, depth) for both starts, and the bytes of its pieces with their ends."""
    state: dict[tuple[str, int], list] = {}
    for batch in batches:  # pieces are reduced as they come: nothing of a block is kept
        paths, blocks, sizes = batch.column("path"), batch.column("block").to_numpy(), batch.column("size").to_numpy()
        for i, value in enumerate(batch.column("value")):
            piece = value.as_py()
            s = state.setdefault((paths[i].as_py(), int(blocks[i])), [int(sizes[i]), 0, False, 0, 0])
            odd, outside, inside = _opened(piece)
            s[1] += len(piece.encode("utf-8", "surrogatepass")) + 1
            for k in (0, 1):  # k: the block starts inside a string
                within = s[2] ^ bool(k)
                s[3 + k] += (inside if within else outside) - (0 if within ^ odd else 1)
            s[2] ^= odd
    cols = list(zip(*[(*k, *s) for k, s in state.items()])) or [()] * 7
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                     names=["path", "block", "size", "bytes", "odd", "from_outside", "from_inside"])


def _fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per record or part of one: path, block, place (0 goes on, 1 opens, 2 a whole record), text."""
    rows: list[tuple] = []
    size = 0

    def flush() -> pa.RecordBatch:
        cols = list(zip(*rows)) or [()] * 4
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int32(), pa.string()))],
                                         names=["path", "block", "place", "text"])
        rows.clear()
        return out

    for first, piece, last in _pieces(batches):
        if first is not None:
            b, inside, depth, text = first, first["inside"], first["depth"], []
            place = 0 if inside or depth > 0 else 2
        odd, outside, within = _opened(piece)
        depth += within if inside else outside
        inside ^= odd
        if b["open_end"] and last:  # behind the file's last brace
            text.append(piece)
            if depth <= 0 and not inside:
                text = []
        else:
            text.append(piece + "}")
            if not inside:
                depth -= 1
                if depth == 0:
                    rows.append((b["path"], b["block"], place, "".join(text)))
                    size += len(rows[-1][3])
                    text, place = [], 2
        if last and text:
            rows.append((b["path"], b["block"], 0 if place == 0 else 1, "".join(text)))
            size += len(rows[-1][3])
        if len(rows) >= 4096 or size >= 1 << 22:
            yield flush()
            size = 0
    yield flush()


def json_pieces(spark: SparkSession, data_dir: str, glob: str) -> DataFrame:
    """(value, path, block, size): the text between closing braces, in byte ranges of the session's split size."""
    return (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).option("lineSep", "}").text(data_dir)
            .select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
                    F.col("_metadata.file_size").alias("size")))


def json_records(spark: SparkSession, data_dir: str, glob: str = "*.json") -> DataFrame:
    """(path, record): every record of the ``.json`` files below ``data_dir``, as one line of JSON text."""
    pieces = json_pieces(spark, data_dir, glob)
    blocks = pieces.mapInArrow(_summaries, "path string, block long, size long, bytes long, odd boolean, from_outside long, from_inside long")
    file = Window.partitionBy("path")
    before = file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    quotes = F.coalesce(F.sum(F.col("odd").cast("int")).over(before), F.lit(0))
    starts = blocks.withColumn("inside", quotes % 2 == 1)
    delta = F.when(F.col("inside"), F.col("from_inside")).otherwise(F.col("from_outside"))
    starts = starts.withColumn("depth", F.coalesce(F.sum(delta).over(before), F.lit(0)))
    last = (F.col("block") == F.max("block").over(file)) & (F.sum("bytes").over(file) > F.col("size"))
    starts = starts.select(F.col("path").alias("p"), F.col("block").alias("b"), "inside", "depth", last.alias("open_end"))
    # one row per file block (the split size, 128 MB as a rule) keeps the order of the pieces when broadcast
    joined = pieces.join(F.broadcast(starts), (F.col("path") == F.col("p")) & (F.col("block") == F.col("b")))
    found = joined.select("value", "path", "block", "inside", "depth", "open_end").mapInArrow(
        _fragments, "path string, block long, place int, text string")
    whole = found.where("place = 2").select("path", "text")
    parts = found.where("place < 2")
    opened = F.sum("place").over(Window.partitionBy("path").orderBy("block", "place"))
    joined_up = (parts.withColumn("record", opened).groupBy("path", "record")
                 .agg(F.array_sort(F.collect_list(F.struct("block", "place", "text"))).alias("t"))
                 .select("path", F.array_join(F.col("t.text"), "").alias("text")))
    # a raw line end cannot stand inside a JSON string, so a record becomes one line
    line = F.regexp_replace(F.ltrim(F.col("text"), F.lit(_BETWEEN)), r"[\r\n]+", " ")
    return whole.unionByName(joined_up).select("path", line.alias("record")).where(F.col("record").contains("{"))
