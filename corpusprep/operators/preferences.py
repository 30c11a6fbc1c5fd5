"""Preference (prompt, chosen, rejected) triples for DPO."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import py_strip
from .splits import shuffle, take

# --- fixed values: the chat frame wrapped around the prompt -------------------
PROMPT_PREFIX = "<|im_start|>user\n"
PROMPT_SUFFIX = "<|im_end|>\n<|im_start|>assistant\n"
# -------------------------------------------------------------------------------


def preference_pairs(df: DataFrame, prompt_col: str = "prompt", chosen_col: str = "chosen",
                     rejected_col: str = "rejected", keep: tuple[str, ...] = ()) -> DataFrame:
    """Strip the three texts and wrap the prompt in the chat frame; other columns dropped."""
    return df.select(*keep,
                     F.concat(F.lit(PROMPT_PREFIX), py_strip(prompt_col), F.lit(PROMPT_SUFFIX)).alias("prompt"),
                     py_strip(chosen_col).alias("chosen"), py_strip(rejected_col).alias("rejected"))


def preference_length_filter(df: DataFrame, max_length: int) -> DataFrame:
    """0 < len(prompt + chosen) <= max and the same for rejected, in characters."""
    lc = F.length(F.col("prompt")) + F.length(F.col("chosen"))
    lr = F.length(F.col("prompt")) + F.length(F.col("rejected"))
    return df.where(lc.between(1, max_length) & lr.between(1, max_length))


def prepare_preferences(df: DataFrame, id_col: str, max_source_length: int, max_target_length: int,
                        max_samples: int | None = None, seed: int | None = 42, train: bool = True) -> DataFrame:
    """take -> shuffle (train only) -> chat frame -> length filter.

    The limit is source + target length, counted in characters. Shuffled rows carry
    their ``shuffle_key``, so the order survives a later exchange or write.
    """
    out = take(df, max_samples, id_col)
    keep: tuple[str, ...] = (id_col,)
    if train and seed is not None:
        out = shuffle(out, seed, id_col)
        keep = (id_col, "shuffle_key")
    out = preference_pairs(out, keep=keep)
    return preference_length_filter(out, max_source_length + max_target_length)
