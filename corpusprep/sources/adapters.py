"""Adapters from the driver's tables to the record shapes the operators read.

``conversations`` holds one row per turn (conv_id, turn, role, text). The
chat record of the surveyed scripts is one row per conversation, so turns are
gathered per conversation. A conversation is a single record; gathering its
turns is bounded by that record, not by the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def conversations_as_records(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(conv_id, conversations: array<struct<from, value>>) ordered by turn; ``user`` -> ``human``."""
    msg = F.struct(F.col("turn"),
                   F.when(F.col("role") == "user", F.lit("human")).otherwise(F.col("role")).alias("from"),
                   F.col("text").alias("value"))
    return (turns.groupBy(id_col).agg(F.array_sort(F.collect_list(msg)).alias("_m"))
            .select(id_col, F.transform("_m", lambda m: F.struct(m["from"].alias("from"),
                                                                 m["value"].alias("value"))).alias("conversations")))


def paired_text(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(conv_id, turn, source, target, category): a user turn and the assistant turn right after it.

    Equi-join on (conversation, turn + 1): the composite key is unique, so a
    long conversation is not a hot key.
    """
    u = turns.where(F.col("role") == "user").select(id_col, "turn", F.col("text").alias("source"))
    a = turns.where(F.col("role") == "assistant").select(id_col, (F.col("turn") - 1).alias("turn"),
                                                          F.col("text").alias("target"))
    return u.join(a, [id_col, "turn"]).withColumn("category", F.lit(None).cast("string"))


def preference_triples(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(conv_id, prompt, chosen, rejected): first user turn, first and last assistant turn.

    Conversations with fewer than two assistant turns give no triple. One
    aggregation with map-side partial aggregates (min_by/max_by), no sort.
    """
    is_user = F.col("role") == "user"
    is_asst = F.col("role") == "assistant"
    g = turns.groupBy(id_col).agg(
        F.min_by(F.when(is_user, F.col("text")), F.when(is_user, F.col("turn"))).alias("prompt"),
        F.min_by(F.when(is_asst, F.col("text")), F.when(is_asst, F.col("turn"))).alias("chosen"),
        F.max_by(F.when(is_asst, F.col("text")), F.when(is_asst, F.col("turn"))).alias("rejected"),
        F.count_if(is_user).alias("_n_user"),
        F.count_if(is_asst).alias("_n_asst"),
    )
    return g.where((F.col("_n_asst") >= 2) & (F.col("_n_user") >= 1)).drop("_n_user", "_n_asst")
