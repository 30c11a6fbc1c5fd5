"""Packing token sequences into fixed blocks, padding, attention masks.

``group_texts`` concatenates the id arrays of each group of rows (in row
order) and cuts them into ``block_size`` blocks. Tokens are never exploded:
each document is cut into at most ceil(len / block) + 1 *pieces* (slices that
fall into one block), and a block is reassembled from its pieces. A block
holds at most ``block_size`` tokens, so no task ever collects more than that
per key; groups have a fixed number of rows, so there is no hot group. The
token arrays are shuffled once, by group, and computed once: ``df`` is not
read twice, so a lazy tokenizer below it runs once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .splits import with_row_index
from .tokens import IGNORE_INDEX


def effective_block_size(block_size: int | None, model_max_length: int | None, default_cap: int = 1024) -> int:
    """block_size capped by the model's maximum; without a block size, min(model max, 1024)."""
    mml = model_max_length if model_max_length is not None else default_cap
    if block_size is None:
        return min(mml, default_cap)
    return min(block_size, mml)


def group_texts(df: DataFrame, block_size: int, ids_col: str = "input_ids", group_col: str = "group_id",
                order_col: str = "row_idx", also: tuple[str, ...] = ()) -> DataFrame:
    """(group_id, block_id, input_ids, labels, ...): concatenation per group cut into blocks.

    The remainder of a group is dropped only when the group holds at least one
    full block; otherwise the group gives one short block. ``labels`` is a copy
    of ``input_ids``. ``also`` names further array columns of the same lengths
    (an attention mask, say) that are cut alike.
    """
    cols = [ids_col, *also]
    n = F.coalesce(F.size(ids_col), F.lit(0))
    for c in also:
        n = F.when(F.size(c).eqNullSafe(F.size(ids_col)), n).otherwise(
            F.raise_error(F.lit(f"{c} and {ids_col} differ in length")).cast("int"))
    # one shuffle by group serves the running sums and the blocks: a block's pieces already lie in its group's task
    w = Window.partitionBy(group_col)
    upto = w.orderBy(order_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offs = (df.select(group_col, order_col, *cols, n.cast("long").alias("_len"))
            .withColumn("_end", F.sum("_len").over(upto)).withColumn("_total", F.sum("_len").over(w))
            .withColumn("_start", F.col("_end") - F.col("_len")).where(F.col("_len") > 0))
    keep_upto = F.when(F.col("_total") >= block_size, (F.col("_total") / block_size).cast("long") * block_size) \
        .otherwise(F.col("_total"))
    first_b = (F.col("_start") / block_size).cast("long")
    last_b = ((F.col("_end") - 1) / block_size).cast("long")
    pieces = offs.select(group_col, *cols, "_start", "_end", keep_upto.alias("_keep"),
                         F.explode(F.sequence(first_b, last_b)).alias("block_id"))
    lo = F.greatest(F.col("block_id") * block_size, F.col("_start"))
    hi = F.least((F.col("block_id") + 1) * block_size, F.col("_end"), F.col("_keep"))
    cut = [F.slice(c, (lo - F.col("_start") + 1).cast("int"), (hi - lo).cast("int")).alias(c) for c in cols]
    pieces = pieces.where(hi > lo).select(group_col, "block_id", lo.alias("_from"), *cut)
    blocks = pieces.groupBy(group_col, "block_id").agg(
        F.array_sort(F.collect_list(F.struct("_from", *cols))).alias("_p"))

    def whole(c: str):
        return F.flatten(F.transform("_p", lambda p: p[c]))

    return blocks.select(group_col, "block_id", whole(ids_col).alias("input_ids"), whole(ids_col).alias("labels"),
                         *[whole(c).alias(c) for c in also])


def assign_groups(df: DataFrame, order_col: str, rows_per_group: int = 1000, group_col: str = "group_id",
                  index_col: str = "row_idx") -> DataFrame:
    """Row index in ``order_col`` order and group = floor(index / rows_per_group)."""
    idx = with_row_index(df, order_col, index_col)
    return idx.withColumn(group_col, F.floor(F.col(index_col) / rows_per_group).cast("long"))


def attention_mask(ids_col: str = "input_ids", pad_id: int = 0):
    """``id != pad`` per position (a real token equal to pad is masked too)."""
    return F.transform(F.col(ids_col), lambda x: x != F.lit(pad_id))


def pad_right(df: DataFrame, max_length: int, pad_id: int, ignore_index: int = IGNORE_INDEX,
              ids_col: str = "input_ids", labels_col: str = "labels") -> DataFrame:
    """Right padding: cut to max_length, pad to the batch's longest, then to max_length.

    Every row therefore ends at exactly ``max_length``, independent of the batch.
    """
    ids = F.slice(ids_col, 1, max_length)
    lab = F.slice(labels_col, 1, max_length)
    pad_ids = F.concat(ids, F.array_repeat(F.lit(pad_id), F.lit(max_length) - F.size(ids)))
    pad_lab = F.concat(lab, F.array_repeat(F.lit(ignore_index), F.lit(max_length) - F.size(lab)))
    out = df.withColumn(ids_col, pad_ids).withColumn(labels_col, pad_lab)
    return out.withColumn("attention_mask", attention_mask(ids_col, pad_id))


def pad_left(df: DataFrame, batch_col: str, max_length: int, pad_id: int, ignore_index: int = IGNORE_INDEX,
             ids_col: str = "input_ids", labels_col: str = "labels") -> DataFrame:
    """Left padding to the longest row of each batch (after cutting to max_length).

    The batch maximum is one aggregate per batch joined back on the batch id;
    batches have a fixed number of rows, so no key is hot.
    """
    cut = df.withColumn(ids_col, F.slice(ids_col, 1, max_length)).withColumn(labels_col,
                                                                              F.slice(labels_col, 1, max_length))
    longest = cut.groupBy(batch_col).agg(F.max(F.size(ids_col)).alias("_ids_max"),
                                         F.max(F.size(labels_col)).alias("_lab_max"))
    j = cut.join(longest, batch_col)
    pad_ids = F.concat(F.array_repeat(F.lit(pad_id), F.col("_ids_max") - F.size(ids_col)), F.col(ids_col))
    pad_lab = F.concat(F.array_repeat(F.lit(ignore_index), F.col("_lab_max") - F.size(labels_col)),
                       F.col(labels_col))
    out = j.withColumn(ids_col, pad_ids).withColumn(labels_col, pad_lab).drop("_ids_max", "_lab_max")
    return out.withColumn("attention_mask", attention_mask(ids_col, pad_id))


def pad_to_longest(df: DataFrame, batch_col: str, pad_id: int, ignore_index: int = IGNORE_INDEX,
                   ids_col: str = "input_ids", labels_col: str = "labels") -> DataFrame:
    """Dynamic right padding to each batch's longest row (SFT collator)."""
    longest = df.groupBy(batch_col).agg(F.max(F.size(ids_col)).alias("_m"))
    j = df.join(longest, batch_col)
    return (j.withColumn(ids_col, F.concat(F.col(ids_col), F.array_repeat(F.lit(pad_id), F.col("_m") - F.size(ids_col))))
            .withColumn(labels_col, F.concat(F.col(labels_col),
                                             F.array_repeat(F.lit(ignore_index), F.col("_m") - F.size(labels_col))))
            .drop("_m").withColumn("attention_mask", attention_mask(ids_col, pad_id)))
