"""Session helpers: a local session for tests/bench and the checkpoint folder.

On a cluster the platform creates the session and names the shared folder in
``spark.checkpoint.dir``; only a local master may go without.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "corpusprep") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CORPUSPREP_DRIVER_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by the cluster, if any."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder of ``spark.checkpoint.dir``.

    Only a local master may go without the setting: driver and executors are one
    process there, so a scratch folder is made. Anywhere else the folder must be
    named, because the executors' local disks are not shared.
    """
    d = checkpoint_dir(spark)
    if not d:
        master = spark.sparkContext.master or ""
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="corpusprep-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared folder, for a written intermediate table."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back.

    Cuts the lineage like ``checkpoint()``, but runs the plan once and keeps columns prunable.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: While a table is written that spares the disk: its shuffle files go when it is there, and Python gets batches of a few large values.
SPARING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}


def materialize_sparing(df: DataFrame, name: str) -> DataFrame:
    """``materialize`` for large tables: compressed further, and the shuffle files of ``df`` don't stay beside it."""
    conf = df.sparkSession.conf
    before = {k: conf.get(k, None) for k in SPARING}
    for k, v in SPARING.items():
        conf.set(k, v)
    try:
        path = scratch_path(df.sparkSession, name)
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_materialized(df: DataFrame) -> None:
    """Delete the written table behind ``df`` (only one that ``materialize`` made and nobody reads any more)."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    for f in {os.path.dirname(f) for f in df.inputFiles()}:
        if re.sub(r"^file:/+", "/", f).startswith(re.sub(r"^file:/+", "/", base) + "/"):
            path = spark._jvm.org.apache.hadoop.fs.Path(f)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
