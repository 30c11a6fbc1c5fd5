"""Cleaning recipes: an ordered list of ``{operator: arguments}`` applied to a corpus.

The text is read once: one projection gives every document's filter outcomes and
deduplication keys, and this narrow table (no text in it) is written to the shared
folder. All decisions are set logic on it, step by step, because a filter must not
move across a deduplicator (that could change which copy survives). ``run_recipe``
then joins the survivors' ids with the rows once; ``trace`` names, per document, the
first operator that removed it (and for deduplicators the id that was kept instead);
``funnel`` turns the trace into rows remaining after each step, the numbers the
published recipes carry as comments. All three rest on the same decisions.

Null texts: a filter whose statistic is null removes the row; for a deduplicator a null
text is a copy of every other null text (exact) or has no fingerprint and is no copy
(SimHash). Ids must be unique and not null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..operators import dedup as D
from ..operators import quality as Q
from ..session import materialize

Step = tuple[str, dict[str, Any]]


@dataclass
class RecipeContext:
    id_col: str = "id"
    text_col: str = "text"
    flagged_words: Mapping[str, Iterable[str]] = field(default_factory=dict)


# ------------------------------------------------------------------ registry

FilterFn = Callable[[RecipeContext, dict[str, Any]], Column]
KeyFn = Callable[[RecipeContext, dict[str, Any]], Column]
MappingFn = Callable[[DataFrame, dict[str, Any]], DataFrame]

FILTERS: dict[str, FilterFn] = {}
DEDUPS: dict[str, tuple[KeyFn, MappingFn]] = {}


def register_filter(name: str, fn: FilterFn) -> None:
    """A row predicate ``(ctx, args) -> Column`` (True keeps the row)."""
    FILTERS[name] = fn


def register_deduplicator(name: str, key: KeyFn, mapping: MappingFn) -> None:
    """``key(ctx, args)`` is a column of a row's text; ``mapping(keyed, args)`` turns (id, key) rows into (id, kept_id).

    Rows that ``mapping`` leaves out keep themselves.
    """
    DEDUPS[name] = (key, mapping)


def register_operator(name: str, fn, mapping: MappingFn | None = None) -> None:
    """A user's operator for recipes: a filter, or with ``mapping`` a deduplicator whose key ``fn`` gives."""
    if mapping is None:
        register_filter(name, fn)
    else:
        register_deduplicator(name, fn, mapping)


def _t(ctx: RecipeContext) -> Column:
    return F.col(ctx.text_col)


def _between(x: Column, a: dict, lo: str, hi: str, lo_default, hi_default) -> Column:
    """lo <= x <= hi, with a bound left out when it cannot bite (each statistic is evaluated once)."""
    lo_v, hi_v = a.get(lo, lo_default), a.get(hi, hi_default)
    conds = []
    if lo_v not in (None, float("-inf"), 0) or lo_default is None:
        conds.append(x >= F.lit(lo_v))
    if hi_v not in (None, float("inf"), 2**31 - 1):
        conds.append(x <= F.lit(hi_v))
    if not conds:
        return F.lit(True)
    return conds[0] if len(conds) == 1 else (conds[0] & conds[1])


def _words(ctx: RecipeContext, lang: str) -> Iterable[str]:
    if lang not in ctx.flagged_words:
        raise ValueError(f"no flagged-word list for language {lang!r}")
    return ctx.flagged_words[lang]


def _no_tokenizer(a: dict) -> dict:
    if a.get("tokenization", False):
        raise NotImplementedError("token-based alphanumeric ratio needs a tokenizer; use tokenization=False")
    return a


register_filter("alphanumeric_filter", lambda ctx, a: _between(
    Q.alphanumeric_ratio(_t(ctx)), _no_tokenizer(a), "min_ratio", "max_ratio", 0.25, float("inf")))
register_filter("character_repetition_filter", lambda ctx, a: _between(
    Q.character_repetition_ratio(_t(ctx), a.get("rep_len", 10)), a, "min_ratio", "max_ratio", 0.0, 0.5))
register_filter("flagged_words_filter", lambda ctx, a: Q.flagged_words_ratio(
    _t(ctx), _words(ctx, a.get("lang", "en")),
    mode="character" if a.get("lang", "en") == "zh" else "word",
    use_words_aug=a.get("use_words_aug", False)) <= F.lit(a.get("max_ratio", 0.045)))
register_filter("maximum_line_length_filter", lambda ctx, a: _between(
    Q.maximum_line_length(_t(ctx)), a, "min_len", "max_len", 10, 2**31 - 1))
register_filter("text_length_filter", lambda ctx, a: _between(
    F.length(_t(ctx)), a, "min_len", "max_len", 10, 2**31 - 1))


def _exact_args(a):
    return dict(lowercase=a.get("lowercase", False), ignore_non_character=a.get("ignore_non_character", False))


def _simhash_args(a):
    return dict(tokenization=a.get("tokenization", "space"), window_size=a.get("window_size", 6),
                lowercase=a.get("lowercase", True), ignore_pattern=a.get("ignore_pattern"))


def _first_of_key(keyed: DataFrame, args: dict) -> DataFrame:
    first = keyed.groupBy("key").agg(F.min("id").alias("kept_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # written, so that the join is between two plain exchanges and AQE can split a key that many copies share
    first = materialize(first.select(F.col("key").alias("k"), "kept_id"), "copies")
    return keyed.join(first, F.col("key").eqNullSafe(F.col("k"))).select("id", "kept_id")


register_deduplicator(
    "document_deduplicator", lambda ctx, a: D.exact_key(_t(ctx), **_exact_args(a)), _first_of_key)
register_deduplicator(
    "document_simhash_deduplicator",
    lambda ctx, a: D.fingerprint(_t(ctx), **_simhash_args(a)),
    lambda keyed, a: D.cluster_fingerprints(keyed, a.get("num_blocks", 6), a.get("hamming_distance", 4)))


# ------------------------------------------------------------------ recipes
# Operator lists and arguments of the two published cleaning recipes (fixed values).

EN_RECIPE: list[Step] = [
    ("document_deduplicator", {"lowercase": True, "ignore_non_character": True}),
    ("alphanumeric_filter", {"tokenization": False, "min_ratio": 0.1}),
    ("character_repetition_filter", {"rep_len": 10, "max_ratio": 0.6}),
    ("flagged_words_filter", {"lang": "en", "tokenization": True, "max_ratio": 0.017}),
    ("maximum_line_length_filter", {"min_len": 20}),
    ("text_length_filter", {"min_len": 30}),
    ("document_simhash_deduplicator", {"tokenization": "space", "window_size": 3, "lowercase": True,
                                       "ignore_pattern": r"\p{P}", "num_blocks": 9, "hamming_distance": 7}),
]

ZH_RECIPE: list[Step] = [
    ("document_deduplicator", {"lowercase": True, "ignore_non_character": True}),
    ("alphanumeric_filter", {"tokenization": False, "min_ratio": 0.10}),
    ("character_repetition_filter", {"rep_len": 10, "max_ratio": 0.6}),
    ("flagged_words_filter", {"lang": "zh", "tokenization": True, "use_words_aug": True, "max_ratio": 0.017}),
    ("text_length_filter", {"min_len": 10}),
    ("document_simhash_deduplicator", {"tokenization": "character", "window_size": 4, "lowercase": True,
                                       "ignore_pattern": r"\p{P}", "num_blocks": 10, "hamming_distance": 8}),
]


def parse_recipe(process: list[Mapping[str, Any]]) -> list[Step]:
    """The ``process`` list of a recipe document (already loaded, e.g. by a YAML library)."""
    steps: list[Step] = []
    for item in process:
        if len(item) != 1:
            raise ValueError(f"each recipe step names one operator: {item!r}")
        (name, args), = item.items()
        if name not in FILTERS and name not in DEDUPS:
            raise KeyError(f"unknown operator {name!r}")
        steps.append((name, dict(args or {})))
    return steps


def load_recipe(path: str) -> tuple[dict[str, Any], list[Step]]:
    """Read a YAML recipe file: (global settings, steps)."""
    import yaml  # optional dependency

    with open(path, encoding="utf-8") as fh:
        doc = yaml.safe_load(fh)
    return {k: v for k, v in doc.items() if k != "process"}, parse_recipe(doc.get("process", []))


# ------------------------------------------------------------------ execution

def _assess(df: DataFrame, recipe: list[Step], ctx: RecipeContext) -> DataFrame:
    """(id, s1, s2, ...): per step a filter's outcome or a deduplicator's key; one pass over the text, written."""
    cols = []
    for i, (name, args) in enumerate(recipe, start=1):
        if name in FILTERS:
            cols.append(F.coalesce(FILTERS[name](ctx, args), F.lit(False)).alias(f"s{i}"))
        elif name in DEDUPS:
            cols.append(DEDUPS[name][0](ctx, args).alias(f"s{i}"))
        else:
            raise KeyError(f"unknown operator {name!r}")
    return materialize(df.select(F.col(ctx.id_col).alias("id"), *cols), "assessed")


def decide(df: DataFrame, recipe: list[Step], ctx: RecipeContext) -> DataFrame:
    """(id, removed_step, kept_id) for every row; null in both for the survivors."""
    state = _assess(df, recipe, ctx)
    state = state.withColumn("removed_step", F.lit(None).cast("int")).withColumn(
        "kept_id", F.lit(None).cast(state.schema["id"].dataType))
    for i, (name, args) in enumerate(recipe, start=1):
        alive = F.col("removed_step").isNull()
        if name in FILTERS:
            state = state.withColumn("removed_step", F.when(alive & ~F.col(f"s{i}"), F.lit(i)).otherwise(F.col("removed_step")))
        else:
            keyed = state.where(alive).select("id", F.col(f"s{i}").alias("key"))
            gone = DEDUPS[name][1](keyed, args).where(F.col("kept_id") != F.col("id")).select(
                F.col("id").alias("gone_id"), F.col("kept_id").alias("instead"))
            hit = F.col("gone_id").isNotNull()
            state = materialize(state.join(gone, F.col("id") == F.col("gone_id"), "left").withColumn(
                "removed_step", F.when(hit, F.lit(i)).otherwise(F.col("removed_step"))).withColumn(
                "kept_id", F.when(hit, F.col("instead")).otherwise(F.col("kept_id"))).drop("gone_id", "instead"), "decided")
    return state.select("id", "removed_step", "kept_id")


def run_recipe(df: DataFrame, recipe: list[Step], ctx: RecipeContext) -> DataFrame:
    """Apply the steps in order; returns the surviving rows with all input columns."""
    keep = decide(df, recipe, ctx).where("removed_step IS NULL").select(F.col("id").alias(ctx.id_col))
    return df.join(keep, ctx.id_col, "left_semi")


def trace(df: DataFrame, recipe: list[Step], ctx: RecipeContext) -> DataFrame:
    """(id, removed_step, removed_by, kept_id): the first step that removed each row; null in all three for survivors."""
    names = F.create_map(*[x for i, (n, _) in enumerate(recipe, start=1) for x in (F.lit(i), F.lit(n))])
    return decide(df, recipe, ctx).select(
        F.col("id").alias(ctx.id_col), "removed_step", F.element_at(names, F.col("removed_step")).alias("removed_by"), "kept_id")


def funnel(traced: DataFrame, recipe: list[Step]) -> DataFrame:
    """(step, operator, remaining): rows left after each step of the recipe.

    The trace is reduced to one count per step first (map-side partial
    aggregation); the running sum then runs over at most len(recipe) + 1 rows.
    """
    spark = traced.sparkSession
    counts = traced.groupBy("removed_step").agg(F.count(F.lit(1)).alias("n"))
    steps = spark.createDataFrame([(i, n) for i, (n, _) in enumerate(recipe, start=1)], "step int, operator string")
    j = steps.join(counts, steps.step == counts.removed_step, "full")
    whole = Window.partitionBy()
    running = Window.orderBy(F.coalesce("step", F.lit(2**31 - 1))).rowsBetween(Window.unboundedPreceding,
                                                                             Window.currentRow)
    removed_so_far = F.sum(F.when(F.col("step").isNotNull(), F.coalesce("n", F.lit(0))).otherwise(0)).over(running)
    return (j.select("step", "operator", (F.sum("n").over(whole) - removed_so_far).cast("long").alias("remaining"))
            .where(F.col("step").isNotNull()))
