"""Mixing sources to target weights by temperature, with DataFrame and SQL functions only.

A source's weight is its token share raised to an exponent a and normalised. The
exponent is bisected in [0, 1]: the largest a whose mix has at least
``target_entropy`` of the largest possible entropy (1 keeps the natural shares, 0
makes all sources equal), or, with ``max_repeats``, the smallest a at which no source
is repeated more often than that. Weights become budgets of tokens, and a source's
budget is realised as block permutations: block e holds all its documents once, in
the order of a hash seeded with e; whole blocks are taken while they fit, then the
leading documents of one more, as many as fit the rest of the budget. ``mix_key``
spreads every source evenly over [0, 1): sorted by it, any stretch holds the sources
in their weights.

On Spark: all sums are aggregations with map-side partials; bisection works on one
written row per source and returns two numbers a step. A source of any size is cut
in 4096 hash buckets: bucket sums tell in which bucket its budget ends, and only that
bucket is ranked row by row. Rows carry no text until the last join.

Defined results: a null source and the empty one are one source, ''; null and empty
texts have no tokens and take part at no cost; rows that repeat an id are one unit of
the permutation, ordered by content, and each is kept or left on its own; a row with
a null id is hashed as the text 'null'. With no tokens at all every document is taken
once. Extra columns pass through; the added ones replace columns of the same names.
An empty table gives no row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

#: Production parameters.
TARGET_ENTROPY, SEED, STEPS = 0.95, 11, 40
_BUCKET_HEX = 3  # leading hex digits of the permutation hash: 4096 buckets a source and block
WORDS = "[^ \\t\\n\\x0B\\f\\r]+"


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def _permutation_key(seed: int, block: Column, source: Column, id_: Column) -> Column:
    """Sort key of a document inside a block: 32 hex digits."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), block.cast("string"), source,
                             F.coalesce(id_.cast("string"), F.lit("null"))))


def _mix(sources: DataFrame, a: float, budget: int, n: int) -> tuple[float, float]:
    """(entropy over its largest value, most repeats) of the mix with exponent ``a``."""
    w = F.pow(F.col("tokens").cast("double"), F.lit(a))
    r = sources.agg(F.sum(w).alias("z"), F.sum(w * F.log("tokens") * a).alias("wl"),
                    F.max(w / F.col("tokens")).alias("rep")).first()
    entropy = (math.log(r.z) - r.wl / r.z) / math.log(n) if n > 1 else 1.0
    return entropy, budget * r.rep / r.z


def find_exponent(sources: DataFrame, budget: int, target_entropy: float | None, max_repeats: float | None,
                  steps: int = STEPS) -> float:
    """The exponent, to the multiple of 1e-6 that still holds the target; ``sources`` has (source, tokens) with tokens > 0."""
    if (target_entropy is None) == (max_repeats is None):
        raise ValueError("give either target_entropy or max_repeats")
    n = sources.count()
    # true from some exponent on downwards (entropy) or upwards (repeats): both are monotone in the exponent
    if target_entropy is not None:
        low_ok, fits = True, lambda a: _mix(sources, a, budget, n)[0] >= target_entropy - 1e-12
        if fits(1.0):
            return 1.0
    else:
        low_ok, fits = False, lambda a: _mix(sources, a, budget, n)[1] <= max_repeats + 1e-12
        if fits(0.0):
            return 0.0
        if not fits(1.0):
            raise ValueError(f"a budget of {budget} tokens repeats every mix more than {max_repeats} times")
    lo, hi = 0.0, 1.0
    for _ in range(steps):
        mid = (lo + hi) / 2
        if fits(mid) == low_ok:
            lo = mid
        else:
            hi = mid
    return math.floor(lo * 1e6) / 1e6 if low_ok else math.ceil(hi * 1e6) / 1e6


def plan_mix(units: DataFrame, budget_tokens: int | None = None, target_entropy: float | None = TARGET_ENTROPY,
             max_repeats: float | None = None) -> tuple[DataFrame, float]:
    """(source, tokens, weight, budget, whole_blocks, rest) per source, and the exponent. ``units``: (source, tokens, ...)."""
    per_source = materialize(units.groupBy("source").agg(F.sum("tokens").alias("tokens")), "sources")
    total = per_source.agg(F.sum("tokens")).first()[0] or 0
    full = per_source.where("tokens > 0")
    budget = int(total if budget_tokens is None else budget_tokens)
    a = find_exponent(full, budget, target_entropy, max_repeats) if total else 1.0
    w = F.pow(F.col("tokens").cast("double"), F.lit(a))
    z = float(full.agg(F.sum(w)).first()[0] or 1.0)
    weight = F.when(F.col("tokens") > 0, F.round(w / F.lit(z), 9)).otherwise(F.lit(0.0))
    plan = per_source.withColumn("weight", weight).withColumn(
        "budget", F.floor(F.col("weight") * F.lit(float(budget))).cast("long"))
    blocks = F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(F.lit(1)).cast("long")
    plan = plan.withColumn("whole_blocks", blocks).withColumn(
        "rest", F.when(F.col("tokens") > 0, F.col("budget") - F.col("whole_blocks") * F.col("tokens")).otherwise(F.lit(-1)))
    return materialize(plan, "mix-plan"), a


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        budget_tokens: int | None = None, target_entropy: float | None = TARGET_ENTROPY,
        max_repeats: float | None = None, seed: int = SEED) -> DataFrame:
    """``docs``, each row as often as the mix takes it, with ``block`` (0, 1, ...) and ``mix_key`` in [0, 1)."""
    source = F.coalesce(F.col(source_col), F.lit(""))
    units = materialize(docs.select(source.alias("source"), F.col(id_col).alias("id"), token_count(F.col(text_col)).alias("tokens"),
                                    F.xxhash64(F.col(text_col)).alias("content")), "mix-units")
    plan, _ = plan_mix(units.select("source", "tokens"), budget_tokens, target_entropy, max_repeats)
    # the last block: where each source's rest ends, by bucket and then by row
    partial = plan.where("rest >= 0").select("source", "whole_blocks", "rest")
    keyed = units.join(partial, "source").withColumn(
        "key", _permutation_key(seed, F.col("whole_blocks"), F.col("source"), F.col("id")))
    bucketed = keyed.withColumn("bucket", F.substring("key", 1, _BUCKET_HEX))
    sums = bucketed.groupBy("source", "bucket").agg(F.sum("tokens").alias("t"), F.first("rest").alias("rest"))
    run = Window.partitionBy("source").orderBy("bucket")  # at most 4096 rows a source
    ends = sums.withColumn("upto", F.sum("t").over(run)).where("upto > rest").groupBy("source").agg(
        F.min(F.struct("bucket", (F.col("upto") - F.col("t")).alias("before"))).alias("e"))
    ends = materialize(ends.select("source", "e.*"), "mix-ends")
    inside = bucketed.join(ends, ["source", "bucket"]).withColumn("upto", F.col("before") + F.sum("tokens").over(
        Window.partitionBy("source").orderBy("key", "content").rowsBetween(Window.unboundedPreceding, 0)))
    # the first row that no longer fits: everything before it in (key, content) order is taken
    stop = inside.where("upto > rest").groupBy("source").agg(F.min(F.struct("key", "content")).alias("stop"))
    cuts = plan.join(stop, "source", "left").select(
        F.col("source").alias("__source"), F.col("whole_blocks").alias("__whole"), F.col("rest").alias("__rest"),
        F.col("stop").alias("__stop"),
        F.when(F.col("tokens") > 0, F.col("budget") / F.col("tokens")).otherwise(F.lit(1.0)).alias("__length"))

    cuts = materialize(cuts, "mix-cuts")  # one row per source: its written size decides how it is joined
    own = docs.drop("block", "mix_key")
    joined = own.join(cuts, source == F.col("__source"))
    last = _permutation_key(seed, F.col("__whole"), F.col("__source"), F.col(id_col))
    taken = (F.col("__rest") >= 0) & (F.col("__stop").isNull() | (
        F.struct(last.alias("key"), F.xxhash64(F.col(text_col)).alias("content")) < F.col("__stop")))
    n = F.col("__whole") + F.when(taken, 1).otherwise(0)
    out = joined.withColumn("__n", n).where("__n > 0").withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1)))
    place = F.conv(F.substring(_permutation_key(seed, F.col("block"), F.col("__source"), F.col(id_col)), 1, 12),
                   16, 10).cast("double") / F.lit(float(16 ** 12))
    # a whole block takes one part in length of [0, 1), the last one its share of such a part
    key = F.least((F.col("block") + place) / F.greatest("__length", F.lit(1e-9)), F.lit(1.0 - 2.0 ** -40))
    return out.withColumn("mix_key", F.round(key, 12)).select(*own.columns, "block", "mix_key")
