"""Dataset statistics and evaluation metrics as aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col_


def tokens_by_split(df: DataFrame, split_col: str = "split", ids_col: str = "input_ids") -> DataFrame:
    """(split, n_rows, n_tokens): summed id-array lengths per split (partial aggregates map-side)."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n_rows"),
                                     F.sum(F.size(ids_col)).cast("long").alias("n_tokens"))


def count_before_after(df: DataFrame, keep: Column) -> DataFrame:
    """(n_before, n_after) of a filter in one pass."""
    return df.agg(F.count(F.lit(1)).alias("n_before"), F.count_if(keep).alias("n_after"))


def argmax_last(values: str | Column) -> Column:
    """0-based index of the first largest element of an array (arg-max over the last dimension)."""
    v = col_(values)
    return (F.array_position(v, F.array_max(v)) - 1).cast("int")


def shifted_matches(preds: str | Column, labels: str | Column) -> Column:
    """One 0/1 per position: labels[1:] against preds[:-1]. Arrays of unequal length are an error."""
    p, l = col_(preds), col_(labels)
    n = F.greatest(F.size(p) - 1, F.lit(0))
    same = F.when(F.size(p) == F.size(l), n).otherwise(
        F.raise_error(F.lit("predictions and labels differ in length")).cast("int"))
    return F.zip_with(F.slice(p, 1, same), F.slice(l, 2, same),
                      lambda a, b: F.when(a == b, F.lit(1)).otherwise(F.lit(0)))


def token_accuracy(df: DataFrame, preds_col: str = "preds", labels_col: str = "labels", normalize: bool = True,
                   weight_col: str | None = None) -> DataFrame:
    """Next-token accuracy over all rows: labels[1:] vs preds[:-1], flattened.

    Ignored labels (-100) are compared too and count as misses. ``normalize``
    gives the share, else the (weighted) number of hits; ``weight_col`` holds one
    weight per compared position (array of that length) or per row (number).
    """
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)
    hits = df.select(shifted_matches(preds_col, labels_col).alias("h"), *([weight_col] if weight_col else []))
    if weight_col is None:
        m = hits.select(total(F.col("h").cast("array<double>")).alias("hit"), F.size("h").cast("double").alias("all"))
    elif hits.schema[weight_col].dataType.typeName() == "array":
        w = F.when(F.size(weight_col) == F.size("h"), F.col(weight_col).cast("array<double>")).otherwise(
            F.raise_error(F.lit("one weight per compared position is needed")).cast("array<double>"))
        m = hits.select(total(F.zip_with("h", w, lambda x, y: x * y)).alias("hit"), total(w).alias("all"))
    else:
        w = F.col(weight_col).cast("double")
        m = hits.select((total(F.col("h").cast("array<double>")) * w).alias("hit"), (F.size("h") * w).alias("all"))
    agg = m.agg(F.sum("hit").alias("hit"), F.sum("all").alias("all"))
    return agg.select((F.col("hit") / F.col("all") if normalize else F.col("hit")).cast("double").alias("accuracy"))


def perplexity(df: DataFrame, loss_col: str = "loss", group_cols: tuple[str, ...] = ()) -> DataFrame:
    """exp(mean loss), of all rows or per group (a split, a language); an overflowing mean gives Infinity.

    One aggregate whatever the number of groups. A null group value is a group; a group
    whose losses are all null, like an empty table without groups, has a null perplexity.
    """
    return df.groupBy(*group_cols).agg(F.exp(F.avg(loss_col)).alias("perplexity"))


def format_numel(n: str | Column, base: int = 1000) -> Column:
    """"1.50 K" / "2.00 M" / "3.10 B" with two decimals (half-even on the exact value), else the integer."""
    x = col_(n).cast("long")
    b1, b2, b3 = base, base ** 2, base ** 3

    def fmt(div, unit):
        return F.concat(F.regexp_replace(F.format_number(x / F.lit(div), 2), ",", ""), F.lit(" " + unit))

    return (F.when(x >= b3, fmt(b3, "B")).when(x >= b2, fmt(b2, "M")).when(x >= b1, fmt(b1, "K"))
            .otherwise(x.cast("string")))
