"""Training-data pipeline over ``documents``: quality filter, near-dedup, substring dedup, decontamination, mixing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read back as the next stage's ``docs``. All
but the last return the columns of ``documents``; the last adds ``block`` and
``mix_key`` (a document may be taken several times, or not at all, as its source's
weight asks). ``run`` writes every stage to a folder of its own in the shared
checkpoint folder, so a lost executor repeats at most one stage's tasks.

Stages decide by row, not by ``doc_id``: the dedup and decontamination stages give every
row its own key, the id (null ids last) and digests of all its columns, so rows that repeat an id
or have none are judged one by one. Fully equal rows share a key and are interchangeable;
the dedup stages keep one of them.

Null and empty texts go through every stage as the operators define it; a document that
substring dedup leaves without text is dropped there (its words are all in earlier
documents), one that had no text before stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.llm import cdc_dedup, pu_quality, simhash_bktree, string_tiling, temperature_mixing
from corpusprep.llm.common import read_table
from corpusprep.session import drop_materialized, materialize


ROW = "__row"


def with_row_key(docs: DataFrame) -> DataFrame:
    """``docs`` with a key per row that sorts by id, null ids last; only fully equal rows share one."""
    cols = [c for name in docs.columns for c in (F.col(name).isNull(), F.col(name))]
    return docs.withColumn(ROW, F.struct(
        F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"),
        F.xxhash64(*cols).alias("h1"), F.xxhash64(F.lit(1), *cols).alias("h2")))


def one_of_equal(keyed: DataFrame, repeated: DataFrame) -> DataFrame:
    """``keyed`` with one row per key of ``repeated``, and every row of the other keys."""
    once = keyed.join(repeated, ROW, "left_semi").dropDuplicates([ROW])
    return keyed.join(repeated, ROW, "left_anti").unionByName(once)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier scores 0.7 or more."""
    net = pu_quality.fit(docs, read_table(spark, sf_dir, "labels"))
    return pu_quality.filter_quality(docs, net)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that of the smallest id, of each group linked by SimHash (3-word shingles, 2 bits)."""
    keyed = with_row_key(docs)
    comp = materialize(simhash_bktree.simhash_components(keyed, ROW).select(ROW, "component_id"), "components")
    gone = comp.where(F.col(ROW) != F.col("component_id")).select(ROW).distinct()
    kept = comp.where(F.col(ROW) == F.col("component_id")).groupBy(ROW).agg(F.count(F.lit(1)).alias("n"))
    repeated = materialize(kept.where("n > 1").select(ROW), "repeated")
    return one_of_equal(keyed.join(gone, ROW, "left_anti"), repeated).select(docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier row holds are cut out of the text; of equal rows long enough to cut, one is left."""
    keyed = with_row_key(docs)
    long = keyed.where(F.octet_length("text") >= cdc_dedup.MIN_RUN_BYTES)
    repeated = materialize(long.groupBy(ROW).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(ROW), "repeated")
    out = cdc_dedup.deduplicate(one_of_equal(keyed, repeated), ROW)
    left = out.where((F.col("cdc_removed") == 0) | (F.length(F.trim("text")) > 0))
    changed = F.when(F.col("cdc_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", changed.cast("long")).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that cover no benchmark item by half or more."""
    clean = string_tiling.decontaminate(with_row_key(docs), read_table(spark, sf_dir, "benchmark"), ROW)
    return clean.select(docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to 95 % of the largest entropy, within the tokens that are there."""
    return temperature_mixing.mix(docs)


STAGES = [("quality classifier", quality), ("SimHash near-dedup", near_dedup), ("substring dedup", substring_dedup),
          ("benchmark decontamination", decontamination), ("mixing sources to target weights", mixing)]

#: A trained classifier and hashing decide the rows: no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        before, docs = docs, materialize(stage(spark, docs, sf_dir), f"pipeline-{k}")
        if k:  # the stage before is read no more; the table itself is not ours
            drop_materialized(before)
    return docs
