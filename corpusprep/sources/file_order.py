"""Files in a seeded random order, in batch and as a stream that goes on where it stopped.

The order is a manifest: every file below a directory, by the hash of (seed, key of its
path). Spark lists the files and reads them, so any store that it can read will do. In batch the
rows get their file's place in the manifest. The stream is a Python data source that serves
(position, path) rows from the manifest and keeps the number served as its offset; a step of
files is read by Spark's own reader. The manifest is a written table: files that turn up
later are appended in seeded order behind the known ones, so a restart, even after
new deliveries, never reorders what was served.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..operators.splits import with_row_index
from ..session import materialize, scratch_path

#: Paths of one input partition of the manifest stream.
PATHS_PER_PARTITION = 10_000


def relative_path(data_dir: str) -> Callable[[Column], Column]:
    """What stands behind the directory's last name in a path: the same wherever the directory is mounted."""
    name = data_dir.rstrip("/").rsplit("/", 1)[-1]
    return lambda path: F.substring_index(path, f"/{name}/", -1)


def file_manifest(spark: SparkSession, data_dir: str, seed: int, glob: str = "*", key: Callable[[Column], Column] | None = None,
                  known: DataFrame | None = None) -> DataFrame:
    """(path, position): the files below ``data_dir`` by md5 of ``seed:key(path)``, then path; ``known`` ones keep their places.

    Only names are listed: no file is opened.
    """
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(data_dir)
              .select(F.col("_metadata.file_path").alias("path")))
    first = 0
    if known is not None:
        listed, first = listed.join(known, "path", "left_anti"), known.count()
    of = key or relative_path(data_dir)
    turn = F.struct(F.md5(F.concat_ws(":", F.lit(seed), of(F.col("path")))).alias("turn"), "path")
    return with_row_index(listed.withColumn("turn", turn), "turn", "place").select("path", (F.col("place") + first).alias("position"))


def read_in_file_order(spark: SparkSession, data_dir: str, seed: int, fmt: str = "parquet", schema: T.StructType | str | None = None,
                       glob: str = "*", key: Callable[[Column], Column] | None = None) -> DataFrame:
    """The files' rows with ``file_position``, their file's 0-based place in the seeded order."""
    r = spark.read.format(fmt).option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    rows = (r.schema(schema) if schema is not None else r).load(data_dir)
    manifest = materialize(file_manifest(spark, data_dir, seed, glob, key), "manifest").withColumnRenamed("position", "file_position")
    return rows.withColumn("path", F.col("_metadata.file_path")).join(manifest, "path").select("file_position", *rows.columns)


class ManifestSource(DataSource):
    """A stream of (position, path) from the option ``paths``, a JSON list in manifest order; the offset is the number served."""

    @classmethod
    def name(cls) -> str:
        return "corpusprep_manifest"

    def schema(self) -> str:
        return "position long, path string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return ManifestReader(json.loads(self.options["paths"]))


class ManifestReader(DataSourceStreamReader):
    def __init__(self, paths: list[str]):
        self.paths = paths

    def initialOffset(self) -> dict:
        return {"served": 0}

    def latestOffset(self) -> dict:
        return {"served": len(self.paths)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        a, b = start["served"], end["served"]
        return [InputPartition((k, self.paths[k:min(k + PATHS_PER_PARTITION, b)])) for k in range(a, b, PATHS_PER_PARTITION)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        first, paths = partition.value
        return iter([(first + i, p) for i, p in enumerate(paths)])

    def commit(self, end: dict) -> None:
        pass


def _written(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def stream_in_file_order(spark: SparkSession, data_dir: str, seed: int, transform: Callable[[DataFrame], DataFrame], fmt: str = "parquet",
                         schema: T.StructType | str | None = None, files_per_step: int = 64, glob: str = "*",
                         key: Callable[[Column], Column] | None = None, sink: str | None = None, checkpoint: str | None = None) -> str:
    """Read the files not read yet, ``files_per_step`` at a time in seeded order, and write ``transform(rows)`` per step; the sink's path.

    A step's rows have ``file_position`` and go to ``step=N`` below the sink, N the position of its first file. A step is
    whole or missing: one that is there already is passed over, one that failed is overwritten, so a restart reads
    every file once.
    """
    sink, checkpoint = sink or scratch_path(spark, "file-order-out"), checkpoint or scratch_path(spark, "file-order-state")
    known = _written(spark, f"{checkpoint}/manifest")
    file_manifest(spark, data_dir, seed, glob, key, known).write.mode("append").parquet(f"{checkpoint}/manifest")
    # the paths of all files are on the driver in any Spark reader's file index too
    paths = [r["path"] for r in spark.read.parquet(f"{checkpoint}/manifest").orderBy("position").collect()]
    spark.dataSource.register(ManifestSource)

    def steps(batch: DataFrame, _: int) -> None:
        served = sorted((r["position"], r["path"]) for r in batch.collect())
        for k in range(0, len(served), files_per_step):
            part = served[k:k + files_per_step]
            out = f"{sink}/step={part[0][0]:012d}"
            if _done(spark, out):
                continue
            r = spark.read.format(fmt)
            rows = (r.schema(schema) if schema is not None else r).load([p for _, p in part])
            places = F.broadcast(spark.createDataFrame(part, "file_position long, path string"))
            step = rows.withColumn("path", F.col("_metadata.file_path")).join(places, "path").drop("path")
            transform(step).write.mode("overwrite").parquet(out)

    q = (spark.readStream.format("corpusprep_manifest").option("paths", json.dumps(paths)).load().writeStream.foreachBatch(steps)
         .option("checkpointLocation", f"{checkpoint}/stream").trigger(availableNow=True).start())
    q.awaitTermination()
    return sink


def _done(spark: SparkSession, out: str) -> bool:
    """Whether a write to ``out`` has ended: Spark marks that with a file of its own."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/_SUCCESS")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
