"""Registered queries for the streaming path and the user-function surface, with SQL oracles."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from ..functions import udf as U
from ..operators import quality as Q
from ..operators import tokens as TK
from ..session import scratch_path
from ..sources.readers import read_table
from ..streaming import stateful as SF
from ..streaming import stream as ST
from . import training_queries as TQ
from .sql_oracle import WS_CLASS, alnum_ratio_sql, max_line_sql, q


def _doc_stream(spark, sf):
    path = f"{sf}/documents.parquet"  # one file, or a directory of part files
    return ST.stream_corpus(spark, path, spark.read.parquet(path).schema)


def q_stream_clean(spark, sf):
    """The stateless cleaning filters on a file stream, drained into parquet."""
    s = _doc_stream(spark, sf)
    t = F.col("text")
    s = Q.remove_null_text(s).where((Q.alphanumeric_ratio(t) >= 0.1) & (Q.maximum_line_length(t) >= 20)
                                    & (F.length(t) >= 30))
    sink = ST.run_to_parquet(s.select("doc_id", "lang"), name="clean")
    return spark.read.parquet(sink)


def _stream_blocks(spark, sink):
    b = spark.read.parquet(sink)
    return b.select(F.col("batch_id").cast("long").alias("batch_id"), "group_id", "block_id",
                    F.size("input_ids").cast("long").alias("n_tokens"), TQ._ids_digest(F.col("input_ids")).alias("ids_md5"))


def q_stream_packed(spark, sf):
    """Streaming pre-training prep in id order; one micro-batch holds the whole table, so it equals the static packing."""
    vocab = TQ.doc_vocab(spark, sf)
    return _stream_blocks(spark, ST.stream_prepare(_doc_stream(spark, sf), vocab, TQ.BLOCK_SIZE, "doc_id", TQ.ROWS_PER_GROUP))


def q_stream_pretrain(spark, sf):
    """The shuffled path over two deliveries: even ids arrive first, odd ids later, and the stream is started again."""
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    vocab = TQ.doc_vocab(spark, sf)
    inbox, sink, state = (scratch_path(spark, f"deliveries-{x}") for x in ("in", "out", "state"))
    for part in (0, 1):
        docs.where(F.col("doc_id") % 2 == part).write.mode("append").parquet(inbox)
        ST.stream_prepare(ST.stream_corpus(spark, inbox, docs.schema), vocab, TQ.BLOCK_SIZE, "doc_id", TQ.ROWS_PER_GROUP,
                          sink=sink, checkpoint=state, seed=TQ.SEED)
    return _stream_blocks(spark, sink)


#: Deliveries, lanes, buffer and group sizes of the stateful streams: small, so that rows and blocks cross deliveries at any scale.
DELIVERIES, LANES, BUFFER, STREAM_GROUP = 3, 4, 100, 150


def _over_deliveries(spark, rows, transform, name):
    """``rows`` (with doc_id) arrive as files in ``DELIVERIES`` parts by ``doc_id``; the query is started anew for each: (sink, checkpoint)."""
    inbox, sink, checkpoint = (scratch_path(spark, f"{name}-{x}") for x in ("in", "out", "state"))
    for part in range(DELIVERIES):
        rows.where(F.col("doc_id") % DELIVERIES == part).write.mode("append").parquet(inbox)
        with SF.state_settings(spark, LANES):
            ST.run_to_parquet(transform(ST.stream_corpus(spark, inbox, rows.schema)), sink, checkpoint, name)
    return sink, checkpoint


def q_stream_shuffled(spark, sf):
    """A bounded shuffle buffer whose rows go on across deliveries, and what it holds at the end."""
    docs = read_table(spark, sf, "documents").select("doc_id", "lang")
    sink, checkpoint = _over_deliveries(spark, docs, lambda s: SF.shuffle_buffered(s, TQ.SEED, "doc_id", BUFFER, LANES), "shuffled")
    return spark.read.parquet(sink).unionByName(SF.buffer_rest(spark, checkpoint, TQ.SEED))


def q_stream_blocks(spark, sf):
    """Blocks packed over three deliveries as if they were one arrival."""
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    vocab = TQ.doc_vocab(spark, sf)

    def pack(s):
        toks = TK.tokenize_text(Q.remove_null_text(s), vocab).select("doc_id", "input_ids")
        return SF.pack_stream(toks, TQ.BLOCK_SIZE, "doc_id", rows_per_group=STREAM_GROUP, lanes=LANES)

    sink, checkpoint = _over_deliveries(spark, docs, pack, "blocks")
    blocks = spark.read.parquet(sink).unionByName(SF.open_blocks(spark, checkpoint))
    return TQ._block_columns(blocks, "lane")


def _word_counts(batch: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"doc_id": batch["doc_id"],
                         "n_words": batch["text"].fillna("").str.split().str.len().astype("int64")})


def q_map_batches_word_counts(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    return U.map_batches(docs, _word_counts, "doc_id long, n_words long")


def _long_english(frame: pd.DataFrame) -> pd.Series:
    return (frame["lang"] == "en") & (frame["n_chars"] > 1000)


def q_filter_rows_pandas(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return U.filter_rows(docs, _long_english, ["lang", "n_chars"]).select("doc_id")


QUERIES = {
    "stream_clean": q_stream_clean,
    "stream_packed": q_stream_packed,
    "stream_pretrain": q_stream_pretrain,
    "stream_shuffled": q_stream_shuffled,
    "stream_blocks": q_stream_blocks,
    "map_batches_word_counts": q_map_batches_word_counts,
    "filter_rows_pandas": q_filter_rows_pandas,
}

ORACLES = {
    "stream_clean": f"""SELECT doc_id, lang FROM documents WHERE text IS NOT NULL AND {alnum_ratio_sql()} >= 0.1
  AND {max_line_sql()} >= 20 AND length(text) >= 30""",
    "stream_packed": TQ.ORACLES["packed_blocks"].replace("SELECT group_id, block_id", "SELECT 0::BIGINT AS batch_id, group_id, block_id"),
    "stream_pretrain": f"""WITH {TQ._doc_tokens_sql()},
  bt AS (SELECT doc_id % 2 AS batch, md5(doc_id::VARCHAR || ':' || ({TQ.SEED} * 1000003 + doc_id % 2)) AS sk, ids FROM dtok),
{TQ._pack_cte("sk", "bt", "batch")}
SELECT batch::BIGINT AS batch_id, group_id, block_id, len(ids)::BIGINT AS n_tokens, {TQ._digest("ids")} AS ids_md5 FROM blocks""",
    "stream_shuffled": f"""WITH arrivals AS (
  SELECT doc_id, lang, lane, row_number() OVER (PARTITION BY lane ORDER BY doc_id % {DELIVERIES}, doc_id) - 1 AS n
  FROM (SELECT *, (CAST('0x' || substr(md5(doc_id::VARCHAR || ':lane'), 1, 8) AS BIGINT) % {LANES})::INT AS lane FROM documents)),
slots AS (SELECT *, CASE WHEN n < {BUFFER} THEN n
                    ELSE CAST('0x' || substr(md5('{TQ.SEED}:' || lane || ':' || n), 1, 12) AS BIGINT) % {BUFFER} END AS slot FROM arrivals),
leaving AS (SELECT *, lead(n) OVER (PARTITION BY lane, slot ORDER BY n) AS pushed_by, count(*) OVER (PARTITION BY lane) AS total FROM slots)
SELECT lane, pushed_by - {BUFFER} AS position, doc_id, lang FROM leaving WHERE pushed_by IS NOT NULL
UNION ALL
SELECT lane, total - count(*) OVER (PARTITION BY lane)
             + row_number() OVER (PARTITION BY lane ORDER BY md5('{TQ.SEED}:' || lane || ':' || slot || ':rest'), slot) - 1 AS position, doc_id, lang
FROM leaving WHERE pushed_by IS NULL""",
    "stream_blocks": f"""WITH {TQ._doc_tokens_sql()},
  bt AS (SELECT (CAST('0x' || substr(md5(doc_id::VARCHAR || ':lane'), 1, 8) AS BIGINT) % {LANES})::INT AS lane,
                doc_id % {DELIVERIES} * 1000000000 + doc_id AS arrival, ids FROM dtok),
{TQ._pack_cte("arrival", "bt", "lane", STREAM_GROUP)}
SELECT lane, group_id, block_id, len(ids)::BIGINT AS n_tokens, {TQ._digest("ids")} AS ids_md5 FROM blocks""",
    "map_batches_word_counts": f"""SELECT doc_id,
  len(list_filter(regexp_split_to_array(coalesce(text, ''), {q(WS_CLASS + '+')}), lambda x: x <> ''))::BIGINT AS n_words
FROM documents""",
    "filter_rows_pandas": "SELECT doc_id FROM documents WHERE lang = 'en' AND n_chars > 1000",
}
