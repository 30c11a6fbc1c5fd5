"""Incremental corpus preparation with Structured Streaming.

The stateless part of preparation (null filter, per-row quality filters,
tokenization) runs on the stream itself. Shuffling and packing need a whole
set of rows, so they run per micro-batch inside ``foreachBatch``: randomness
and packing groups are bounded by the micro-batch (its size is set with
``maxFilesPerTrigger`` / ``maxBytesPerTrigger``), as the original's are by its
shuffle buffer. With ``trigger(availableNow=True)`` and one micro-batch the
result equals the static run.

Sinks and checkpoints live under the session's shared checkpoint folder
unless given. Each micro-batch has a folder of its own in the packed sink, which a
replay overwrites, so a restart after a lost driver or executor neither loses nor
doubles rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators import packing as P
from ..operators import quality as Q
from ..operators import splits as SP
from ..operators import tokens as TK
from ..session import drop_materialized, materialize, scratch_path


def stream_corpus(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None, path_glob_filter: str | None = None) -> DataFrame:
    """A file-source stream (parquet or json lines) over the directory ``path``, optionally one file pattern, or over one file."""
    r = spark.readStream.schema(schema).format(fmt)
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isFile():  # a source's base path must be a directory
        path, path_glob_filter = p.getParent().toString(), p.getName()
    if path_glob_filter:
        r = r.option("pathGlobFilter", path_glob_filter)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def shuffle_batch(batch: DataFrame, seed: int, batch_id: int, id_col: str) -> DataFrame:
    """A seeded random order of one micro-batch as ``shuffle_key`` (the seed varies with the batch id)."""
    return batch.withColumn("shuffle_key", SP.shuffle_key(id_col, seed * 1_000_003 + batch_id))


def run_to_parquet(stream: DataFrame, sink: str | None = None, checkpoint: str | None = None,
                   name: str = "stream") -> str:
    """Drain every available input into a parquet sink (trigger availableNow); returns the sink path."""
    spark = stream.sparkSession
    tag = f"{name}-{uuid.uuid4().hex[:8]}"
    sink = sink or scratch_path(spark, f"streams/{tag}/out")
    checkpoint = checkpoint or scratch_path(spark, f"streams/{tag}/checkpoint")
    q = (stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return sink


def stream_prepare(stream: DataFrame, vocab: TK.Vocabulary, block_size: int, id_col: str,
                   rows_per_group: int = 1000, sink: str | None = None, checkpoint: str | None = None,
                   text_col: str = "text", seed: int | None = None) -> str:
    """Streaming pre-training preparation: null filter -> tokenize -> per micro-batch shuffle and packing.

    Each micro-batch is numbered in ``id_col`` order, or in a seeded random order
    (``seed``), cut into groups of ``rows_per_group`` rows and packed into
    ``block_size`` blocks. A batch is written to ``batch_id=N`` below the sink and
    overwrites it, so a batch that runs again after a failure adds no rows.
    """
    spark = stream.sparkSession
    tag = f"prepare-{uuid.uuid4().hex[:8]}"
    sink = sink or scratch_path(spark, f"streams/{tag}/out")
    checkpoint = checkpoint or scratch_path(spark, f"streams/{tag}/checkpoint")
    toks = TK.tokenize_text(Q.remove_null_text(stream, text_col).select(id_col, text_col), vocab).drop(text_col)
    q = (toks.writeStream.foreachBatch(lambda batch, n: pack_batch(batch, n, sink, block_size, id_col, rows_per_group, seed))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return sink


def pack_batch(batch: DataFrame, batch_id: int, sink: str, block_size: int, id_col: str, rows_per_group: int,
               seed: int | None) -> None:
    """Pack one micro-batch of tokenized rows into its own folder of the sink, replacing what is there."""
    order = id_col
    if seed is not None:
        batch, order = shuffle_batch(batch, seed, batch_id, id_col), "shuffle_key"
    batch = materialize(batch, "micro-batch")  # numbered and packed from one written copy
    blocks = P.group_texts(P.assign_groups(batch, order, rows_per_group), block_size)
    blocks.write.mode("overwrite").parquet(f"{sink}/batch_id={int(batch_id)}")
    drop_materialized(batch)
