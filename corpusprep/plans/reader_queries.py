"""Registered queries over the readers and sinks: a table is written, read back by the reader, and compared with the table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ..functions.digest import md5_prefixes
from ..operators import quality as Q
from ..operators import tokens as TK
from ..session import scratch_path
from ..sources import file_order as FO
from ..sources import readers as S
from ..sources.json_records import json_records
from .sql_oracle import WORD_RE, q

SEED, BUCKETS = 42, 16


def _docs(spark, sf):
    return S.read_table(spark, sf, "documents").select("doc_id", "lang", "text")


def _digest(df):
    return df.select("doc_id", "lang", F.md5("text").alias("text_md5"), F.length("text").cast("long").alias("n"))


def q_reader_json_lines(spark, sf):
    """JSON lines written by ``write_jsonl``, read as a split: the files' records are cut by byte range."""
    path = scratch_path(spark, "jsonl")
    S.write_jsonl(_docs(spark, sf), path)
    return _digest(S.read_json_split(spark, path, "part", "doc_id long, lang string, text string"))


def q_reader_json_arrays(spark, sf):
    """Records separated by commas, as in one large array, cut at record borders."""
    path = scratch_path(spark, "json-array")
    record = F.to_json(F.struct("doc_id", "lang", "text", F.array(F.struct("lang")).alias("more")))
    _docs(spark, sf).select(F.concat(F.when(F.col("doc_id") % 2 == 0, F.lit("[")).otherwise(F.lit(" , ")), record).alias("value")) \
        .write.option("lineSep", "\n,\n").text(path)
    records = json_records(spark, path, "part*.txt").select(F.from_json("record", "doc_id long, lang string, text string").alias("r"))
    return _digest(records.select("r.*"))


def q_reader_corpus(spark, sf):
    """Parquet and JSON lines below one directory, and the recipe's input path."""
    path = scratch_path(spark, "corpus")
    docs = _docs(spark, sf)
    S.write_parquet(docs.where("doc_id % 2 = 0"), f"{path}/even")
    S.write_jsonl(docs.where("doc_id % 2 = 1"), f"{path}/odd.jsonl")
    even = S.read_corpus_split(spark, f"{path}/even", "part")
    odd = S.read_recipe_input(spark, f"{path}/odd.jsonl")
    return _digest(even.unionByName(odd))


def q_reader_lines(spark, sf):
    """Every line of the documents as plain text, with and without its end."""
    path = scratch_path(spark, "lines")
    lines = _docs(spark, sf).select(F.explode(F.split(F.regexp_replace("text", "\r", " "), "\n")).alias("value"))
    lines.write.text(path)
    kept, bare = (S.read_text_lines(spark, path, "part", keep) for keep in (True, False))
    both = kept.select(F.lit(True).alias("kept"), "text").unionByName(bare.select(F.lit(False).alias("kept"), "text"))
    return both.groupBy("kept", F.md5("text").alias("line_md5")).agg(F.count(F.lit(1)).alias("n"))


def q_file_order(spark, sf):
    """Documents in 16 files, read in two seeded file orders."""
    path = scratch_path(spark, "files")
    docs = _docs(spark, sf).select("doc_id", (F.col("doc_id") % BUCKETS).alias("bucket"))
    docs.repartition(BUCKETS, "bucket").write.partitionBy("bucket").parquet(path)
    bucket = lambda p: F.regexp_extract(p, "/bucket=([0-9]+)/", 1)
    out = None
    for seed in (SEED, SEED + 1):
        one = FO.read_in_file_order(spark, path, seed, schema="doc_id long", glob="*.parquet", key=bucket)
        one = one.select(F.lit(seed).alias("seed"), "file_position", "doc_id")
        out = one if out is None else out.unionByName(one)
    return out


def q_file_order_stream(spark, sf):
    """The same files as a stream, five at a time; even buckets are there at first, odd ones come later."""
    path, sink, state = (scratch_path(spark, f"file-stream-{x}") for x in ("in", "out", "state"))
    docs = _docs(spark, sf).select("doc_id", (F.col("doc_id") % BUCKETS).alias("bucket"))
    bucket = lambda p: F.regexp_extract(p, "/bucket=([0-9]+)/", 1)
    for part in (0, 1):
        docs.where(F.col("bucket") % 2 == part).repartition(BUCKETS, "bucket").write.mode("append").partitionBy("bucket").parquet(path)
        FO.stream_in_file_order(spark, path, SEED, lambda rows: rows.select("file_position", "doc_id"), schema="doc_id long", files_per_step=5,
                                glob="*.parquet", key=bucket, sink=sink, checkpoint=state)
    return spark.read.parquet(sink).select(F.col("step").cast("long").alias("step"), "file_position", "doc_id")


def _code_points():
    """A user's encoder: a text's code points as its ids."""
    return lambda texts: [[ord(c) for c in t] for t in texts]


def q_encoder_tokens(spark, sf):
    ids = TK.encoder_udf(_code_points)(F.col("text"))
    toks = _docs(spark, sf).select("doc_id", ids.alias("input_ids"))
    return toks.select("doc_id", F.size("input_ids").cast("long").alias("n_tokens"),
                       F.md5(F.array_join(F.col("input_ids").cast("array<string>"), ",")).alias("ids_md5"))


def flagged_table(spark, sf):
    """(lang, word): a sixteenth of the words and half of the adjacent word pairs of every language's documents."""
    texts = _docs(spark, sf).where("text IS NOT NULL").select("lang", Q.token_text(F.col("text")).alias("t"))
    return texts.mapInArrow(lambda it: _by_digit(Q.distinct_runs(it, (1, 2))), "lang string, word string").distinct()


def _by_digit(batches):
    """The words whose MD5 starts with 0 and the pairs whose MD5 starts with 0 to 7."""
    for batch in batches:
        text = batch.column(1).cast(pa.large_binary())
        ends = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
        digit = md5_prefixes(np.frombuffer(text.buffers()[2] or b"", np.uint8), ends[:-1], ends[1:]) >> np.uint64(60)
        yield batch.select(["lang", "word"]).filter(pa.array(digit < np.where(batch.column(2).to_numpy() == 1, 1, 8)))


def q_flagged_by_language(spark, sf):
    out = Q.flagged_ratio_by_language(_docs(spark, sf), flagged_table(spark, sf))
    return out.select("doc_id", "lang", F.round("flagged_ratio", 9).alias("flagged_ratio"))


QUERIES = {
    "reader_json_lines": q_reader_json_lines,
    "reader_json_arrays": q_reader_json_arrays,
    "reader_corpus": q_reader_corpus,
    "reader_lines": q_reader_lines,
    "file_order": q_file_order,
    "file_order_stream": q_file_order_stream,
    "encoder_tokens": q_encoder_tokens,
    "flagged_by_language": q_flagged_by_language,
}

_DIGEST = "SELECT doc_id, lang, md5(text) AS text_md5, length(text) AS n FROM documents"

ORACLES = {
    "reader_json_lines": _DIGEST,
    "reader_json_arrays": _DIGEST,
    "reader_corpus": _DIGEST,
    "reader_lines": """WITH lines AS (SELECT unnest(string_split(replace(text, chr(13), ' '), chr(10))) AS line FROM documents)
SELECT kept, md5(CASE WHEN kept THEN line || chr(10) ELSE line END) AS line_md5, count(*) AS n
FROM lines, (VALUES (true), (false)) k(kept) GROUP BY ALL""",
    "file_order": f"""SELECT seed::INT AS seed, dense_rank() OVER (PARTITION BY seed ORDER BY md5(seed || ':' || (doc_id % {BUCKETS}))) - 1 AS file_position, doc_id
FROM documents, (VALUES ({SEED}), ({SEED + 1})) s(seed)""",
    "file_order_stream": f"""WITH places AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY doc_id % 2, md5('{SEED}:' || (doc_id % {BUCKETS}))) - 1 AS file_position FROM documents)
SELECT CASE WHEN file_position < {BUCKETS // 2} THEN file_position // 5 * 5 ELSE {BUCKETS // 2} + (file_position - {BUCKETS // 2}) // 5 * 5 END AS step,
       file_position, doc_id FROM places""",
    "encoder_tokens": """SELECT doc_id, len(c)::BIGINT AS n_tokens, md5(array_to_string(list_transform(c, lambda x: unicode(x)::VARCHAR), ',')) AS ids_md5
FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '(?s)(.)', 1) AS c FROM documents)""",
    "flagged_by_language": f"""WITH t AS (SELECT doc_id, lang, regexp_extract_all(lower(text), {q(WORD_RE)}, 1) AS t FROM documents),
tok AS (SELECT doc_id, unnest(t) AS tok, unnest(range(1, len(t) + 1)) AS i FROM t),
two AS (SELECT doc_id, i, tok, tok || ' ' || lead(tok) OVER (PARTITION BY doc_id ORDER BY i) AS pair FROM tok),
hit AS (SELECT doc_id, i FROM two WHERE substr(md5(tok), 1, 1) = '0'
        UNION SELECT doc_id, unnest([i, i + 1]) FROM two WHERE substr(md5(pair), 1, 1) < '8')
SELECT t.doc_id, lang, round(CASE WHEN len(t) > 0 THEN coalesce(n, 0) / len(t) ELSE 0.0 END, 9) AS flagged_ratio
FROM t LEFT JOIN (SELECT doc_id, count(*) AS n FROM hit GROUP BY doc_id) h ON t.doc_id = h.doc_id""",
}
