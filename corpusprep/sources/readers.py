"""Sources and sinks: JSON/JSONL and Parquet corpora, plain text, catalogue tables.

Schemas are declared when known, so no inference pass reads the data twice.
Output is never written under an input directory (a ``train*.parquet`` sink
there would match the ``train*`` input glob of the next run).
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.splits import random_split
from ..session import scratch_path
from .json_records import json_records

CONVERSATION_TYPE = T.ArrayType(T.StructType([
    T.StructField("from", T.StringType()),
    T.StructField("value", T.StringType()),
]))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables (``<sf_dir>/<name>.parquet``): a plain scan, so columns and filters reach it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _load(spark: SparkSession, data_dir: str, glob: str, fmt: str, schema, **options) -> DataFrame | None:
    """Every file below ``data_dir`` that matches, or None if there is none."""
    r = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).options(**options)
    if schema is not None:
        r = r.schema(schema)
    try:
        df = r.format(fmt).load(data_dir)
        return df if df.inputFiles() else None
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _union(frames: list[DataFrame | None], what: str) -> DataFrame:
    found = [f for f in frames if f is not None]
    if not found:
        raise FileNotFoundError(what)
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def read_json_split(spark: SparkSession, data_dir: str, split: str = "train",
                    schema: T.StructType | str | None = None) -> DataFrame:
    """Every ``<split>*.jsonl`` (one record a line) and ``<split>*.json`` (a list, an object or lines) below ``data_dir``.

    A ``.json`` file is cut into records by byte range (``json_records``), so one list of any size is read by many
    tasks. Without a schema its records are written as lines once, for Spark to infer one. Columns that only some
    files have are null elsewhere.
    """
    lines = _load(spark, data_dir, f"{split}*.jsonl", "json", schema)
    whole = None
    if _load(spark, data_dir, f"{split}*.json", "text", None) is not None:
        records = json_records(spark, data_dir, f"{split}*.json")
        if schema is not None:
            whole = records.select(F.from_json("record", schema).alias("r")).select("r.*")
        else:
            path = scratch_path(spark, f"json-{split}")
            records.select("record").write.text(path)
            whole = spark.read.json(path)
    return _union([lines, whole], f"no {split}*.json or {split}*.jsonl under {data_dir}")


def read_corpus_split(spark: SparkSession, data_dir: str, split: str = "train",
                      schema: T.StructType | str | None = None) -> DataFrame:
    """Pre-training corpus: ``<split>*.parquet`` and ``<split>*.jsonl`` below ``data_dir``.

    Both formats may be present; they are unioned by column name and missing
    columns become null.
    """
    return _union([_load(spark, data_dir, f"{split}*.parquet", "parquet", schema),
                   _load(spark, data_dir, f"{split}*.jsonl", "json", schema)],
                  f"no {split}*.parquet or {split}*.jsonl under {data_dir}")


def with_validation(read: Callable[[str], DataFrame], id_col: str | None = None, percentage: float = 5,
                    seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, validation) from a reader of a split by name; without validation files a seeded share of train is carved.

    Rows are told apart by ``id_col``, or by their whole content when there is no id.
    """
    train = read("train")
    try:
        return train, read("validation")
    except FileNotFoundError:
        key = F.col(id_col) if id_col else F.to_json(F.struct(*train.columns))
        both = random_split(train.withColumn("__key", key), percentage, seed, "__key", "__split")
        part = lambda name: both.where(F.col("__split") == name).drop("__key", "__split")
        return part("train"), part("validation")


def read_text_lines(spark: SparkSession, data_dir: str, split: str = "train", keep_linebreaks: bool = True) -> DataFrame:
    """Plain-text files, one row per line in ``text``; ``keep_linebreaks`` keeps each line's own end.

    With it a line is what stands up to and with ``\\n`` (so ``\\r\\n`` stays as it is), and a last line without an
    end gets none: the bytes of a file's lines tell whether its last one has an end.
    """
    r = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", f"{split}*.txt")
    if not keep_linebreaks:
        return r.text(data_dir).select(F.col("value").alias("text"))
    lines = r.option("lineSep", "\n").text(data_dir).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at")).alias("place"))
    sizes = lines.groupBy("path").agg(F.sum(F.octet_length("value").cast("long") + 1).alias("bytes"), F.max("size").alias("size"),
                                      F.max("place").alias("place"))
    unended = sizes.where(F.col("bytes") > F.col("size")).select("path", "place", F.lit("").alias("end"))
    # one row per file without a last line end
    ended = lines.join(F.broadcast(unended), ["path", "place"], "left")
    return ended.select(F.concat("value", F.coalesce("end", F.lit("\n"))).alias("text"))


def read_named(spark: SparkSession, name: str) -> DataFrame:
    """A dataset registered in the catalogue (table or view) by name."""
    return spark.table(name)


def read_recipe_input(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """A recipe's ``dataset_path``: one file or a directory; format from the extension."""
    if fmt is None:
        ext = os.path.splitext(path.rstrip("/"))[1].lower()
        fmt = {".jsonl": "json", ".json": "json", ".parquet": "parquet", ".txt": "text"}.get(ext, "parquet")
    df = spark.read.format(fmt).load(path)
    if fmt == "text":
        df = df.withColumnRenamed("value", "text")
    return df


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Recipe ``export_path``: JSON lines (one part file per task)."""
    df.write.mode(mode).json(path)
