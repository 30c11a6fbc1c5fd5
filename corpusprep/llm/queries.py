"""Registered queries of this package, one per operator, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import (bigru_toxicity, cdc_dedup, inverted_multi_index, mask_search, page_differencing, pu_quality, revisits, secret_scan, simhash_bktree,
               string_tiling, suffix_dedup, temperature_mixing, vector_codes)
from .common import read_table


def archive_records(pages: DataFrame) -> DataFrame:
    """Two captures per page: a response (every 13th a 404) and, days later, a 304 at another spelling of its URL.

    By the page id's last digit the 304 repeats the tag (most), changes it (0), weakens it (1, 2), has a date only
    (3: equal, 5: changed) or no validator (4); every 17th page's first capture is missing.
    """
    digit = F.col("page_id") % 10
    tag = F.concat(F.lit('"'), F.substring(F.md5("html"), 1, 16), F.lit('"'))
    day = F.concat(F.lit("Mon, "), F.lpad((F.col("page_id") % 28 + 1).cast("string"), 2, "0"), F.lit(" Jan 2024 00:00:00 GMT"))
    start = F.lit(1_704_067_200).cast("long") + F.col("page_id") * 37
    later = start + F.lit(86_400) * (digit + 1)
    first = F.struct(
        (F.col("page_id") * 2).alias("record_id"), F.col("url").alias("target_uri"), F.timestamp_seconds(start).alias("captured_at"),
        F.when(F.col("page_id") % 17 == 16, "missing").otherwise("response").alias("record_type"),
        F.when(F.col("page_id") % 13 == 12, 404).otherwise(200).alias("status"),
        F.create_map(
            F.lit("Content-Type"), F.lit("text/html; charset=utf-8"),
            F.lit("Content-Length"), F.octet_length("html").cast("string"),
            F.lit("ETag"), F.when(digit == 3, F.lit("")).otherwise(tag), F.lit("Last-Modified"), day,
            F.lit("Cache-Control"), F.lit("max-age=60"), F.lit("Server"), F.lit("a")).alias("headers"))
    second = F.struct(
        (F.col("page_id") * 2 + 1).alias("record_id"),
        F.concat(F.regexp_replace(F.regexp_replace("url", "#.*$", ""), "^https?://", "HTTP://"), F.lit("#again")).alias("target_uri"),
        F.timestamp_seconds(later).alias("captured_at"), F.lit("revisit").alias("record_type"), F.lit(304).alias("status"),
        F.create_map(
            F.lit("date"), day, F.lit("cache-control"), F.lit("max-age=120"), F.lit("content-length"), F.lit("0"),
            F.lit("connection"), F.lit("keep-alive, X-Hop"), F.lit("x-hop"), F.lit("1"), F.lit("Expires"), F.lit("0"),
            F.lit("etag"), F.when(digit == 0, F.lit('"other"')).when(digit <= 2, F.concat(F.lit("W/"), tag))
            .when(digit <= 5, F.lit("")).otherwise(tag),
            F.lit("last-modified"), F.when(digit == 5, F.lit("Tue, 01 Jan 1980 00:00:00 GMT")).when(digit == 4, F.lit(""))
            .otherwise(day)).alias("headers"))
    return pages.select(F.explode(F.array(first, second)).alias("r")).select("r.*")


def op1_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = revisits.resolve_revisits(archive_records(read_table(spark, sf_dir, "pages")))
    lines = F.array_join(F.transform("headers", lambda h: F.concat(h["name"], F.lit(": "), h["value"])), "\n")
    return out.select("record_id", "canonical_url", F.unix_seconds("captured_at").alias("captured_s"), "response_id",
                      F.unix_seconds("response_at").alias("response_s"), "resolution", lines.alias("merged_headers"))


#: The as-of join by DuckDB's own ASOF JOIN; headers merged as rows.
OP1_SQL = r"""
WITH parts AS (
  SELECT page_id, html, page_id % 10 AS digit,
         regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)(?::[0-9]*)?([^?#]*)(?:\?([^#]*))?(?:#.*)?$',
                        ['host', 'path', 'query']) AS u
  FROM pages),
keyed AS (
  SELECT page_id, html, digit,
         regexp_replace(lower(u.host), '^www\.', '')
           || CASE WHEN regexp_replace(u.path, '/+$', '') = '' THEN '/' ELSE regexp_replace(u.path, '/+$', '') END
           || CASE WHEN len(q) > 0 THEN '?' || array_to_string(list_sort(q), '&') ELSE '' END AS k
  FROM (SELECT *, list_filter(string_split(u.query, '&'), lambda p: p <> '' AND NOT regexp_matches(lower(p),
          '^(utm_[^=]*|gclid|fbclid|msclkid|sessionid|phpsessid|jsessionid|sid|ref)(=|$)')) AS q FROM parts)),
facts AS (
  SELECT *, '"' || substr(md5(html), 1, 16) || '"' AS tag, strlen(html) AS size,
         'Mon, ' || lpad((page_id % 28 + 1)::VARCHAR, 2, '0') || ' Jan 2024 00:00:00 GMT' AS day,
         1704067200 + page_id * 37 AS t0, 1704067200 + page_id * 37 + 86400 * (digit + 1) AS t1 FROM keyed),
responses AS (
  SELECT page_id * 2 AS response_id, k, t0, CASE WHEN digit = 3 THEN '' ELSE tag END AS etag, day, size
  FROM facts WHERE page_id % 17 <> 16 AND page_id % 13 <> 12),
visits AS (
  SELECT page_id * 2 + 1 AS record_id, k, t1, day,
         CASE WHEN digit = 0 THEN '"other"' WHEN digit <= 2 THEN 'W/' || tag WHEN digit <= 5 THEN '' ELSE tag END AS etag,
         CASE WHEN digit = 5 THEN 'Tue, 01 Jan 1980 00:00:00 GMT' WHEN digit = 4 THEN '' ELSE day END AS modified FROM facts),
joined AS (
  SELECT v.*, r.response_id, r.t0, r.etag AS r_etag, r.day AS r_modified, r.size
  FROM visits v ASOF LEFT JOIN responses r ON v.k = r.k AND v.t1 > r.t0),
judged AS (
  SELECT *, CASE WHEN response_id IS NULL THEN 'no_response'
                 WHEN etag <> '' AND r_etag <> '' THEN
                   CASE WHEN replace(etag, 'W/', '') = r_etag THEN 'resolved' ELSE 'etag_mismatch' END
                 WHEN modified <> '' THEN CASE WHEN modified = r_modified THEN 'resolved' ELSE 'date_mismatch' END
                 ELSE 'no_validator' END AS resolution FROM joined)
SELECT record_id, k AS canonical_url, t1 AS captured_s, response_id, t0 AS response_s, resolution,
       CASE WHEN resolution = 'resolved' THEN
         'cache-control: max-age=120' || chr(10) || 'content-length: ' || size || chr(10)
         || 'content-type: text/html; charset=utf-8' || chr(10) || 'date: ' || day || chr(10)
         || coalesce('etag: ' || coalesce(nullif(etag, ''), nullif(r_etag, '')) || chr(10), '')
         || 'expires: 0' || chr(10) || 'last-modified: ' || coalesce(nullif(modified, ''), r_modified) || chr(10)
         || 'server: a' END AS merged_headers
FROM judged
"""


def op2_cdc_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = cdc_dedup.deduplicate(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("cdc_bytes").alias("n_bytes"), F.col("cdc_chunks").alias("n_chunks"),
                      F.col("cdc_duplicates").alias("n_duplicate_chunks"), F.col("cdc_removed").alias("n_removed"),
                      F.col("cdc_spans").alias("n_spans"), "text")


def op3_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return string_tiling.contaminated_pairs(read_table(spark, sf_dir, "documents"),
                                            read_table(spark, sf_dir, "benchmark"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op5_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temperature_mixing.mix(read_table(spark, sf_dir, "documents"))


#: Bisection as two searches on grids of the exponent, prefix sums over whole sources.
OP5_SQL = r"""
WITH units AS (
  SELECT *, coalesce(source, '') AS src,
         len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+')) AS tokens FROM documents),
sources AS (SELECT src, sum(tokens)::BIGINT AS tokens FROM units GROUP BY src),
total AS (SELECT sum(tokens)::BIGINT AS budget FROM sources),
coarse AS (
  SELECT max(a) AS a0 FROM (
    SELECT i / 1000.0::DOUBLE AS a, sum(pow(tokens, i / 1000.0::DOUBLE)) AS z,
           sum(pow(tokens, i / 1000.0::DOUBLE) * ln(tokens) * (i / 1000.0::DOUBLE)) AS wl, count(*) AS n
    FROM sources, range(0, 1001) g(i) WHERE tokens > 0 GROUP BY i)
  WHERE CASE WHEN n > 1 THEN (ln(z) - wl / z) / ln(n) ELSE 1 END >= 0.95 - 1e-12),
fine AS (
  SELECT least(1.0, max(a)) AS a FROM (
    SELECT round(a0 + j / 1000000.0::DOUBLE, 6) AS a, sum(pow(tokens, round(a0 + j / 1000000.0::DOUBLE, 6))) AS z,
           sum(pow(tokens, round(a0 + j / 1000000.0::DOUBLE, 6)) * ln(tokens) * round(a0 + j / 1000000.0::DOUBLE, 6)) AS wl,
           count(*) AS n
    FROM sources, coarse, range(0, 1001) g(j) WHERE tokens > 0 GROUP BY j, a0)
  WHERE CASE WHEN n > 1 THEN (ln(z) - wl / z) / ln(n) ELSE 1 END >= 0.95 - 1e-12),
norm AS (SELECT sum(pow(tokens, a)) AS z FROM sources, fine WHERE tokens > 0),
budgets AS (
  SELECT src, tokens, CASE WHEN tokens > 0 THEN floor(round(pow(tokens, a) / z, 9) * budget)::BIGINT ELSE 0 END AS budget
  FROM sources, fine, norm, total),
plan AS (
  SELECT src, tokens, budget, CASE WHEN tokens > 0 THEN budget // tokens ELSE 1 END AS whole,
         CASE WHEN tokens > 0 THEN budget % tokens ELSE -1 END AS rest FROM budgets),
ranked AS (
  SELECT u.*, p.tokens AS all_tokens, p.budget, p.whole, p.rest,
         sum(u.tokens) OVER (PARTITION BY u.src ORDER BY md5('11:' || p.whole || ':' || u.src || ':' || u.doc_id)
                             ROWS UNBOUNDED PRECEDING) AS upto
  FROM units u JOIN plan p USING (src)),
copies AS (
  SELECT *, unnest(range(0, whole + CASE WHEN rest >= 0 AND upto <= rest THEN 1 ELSE 0 END)) AS block FROM ranked)
SELECT doc_id, text, lang, source, n_chars, block,
       round(least((block + CAST('0x' || substr(md5('11:' || block || ':' || src || ':' || doc_id), 1, 12) AS BIGINT)
                    / 281474976710656.0::DOUBLE)
                   / greatest(CASE WHEN all_tokens > 0 THEN budget / all_tokens::DOUBLE ELSE 1 END, 1e-9),
                   1 - pow(2, -40)), 12) AS mix_key
FROM copies
"""


def op6_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    net = pu_quality.fit(docs, read_table(spark, sf_dir, "labels"))
    scored = pu_quality.score(docs, net).select("doc_id", pu_quality.held_out().alias("held_out"), "score")
    return scored.withColumn("predicted", (F.col("score") >= pu_quality.THRESHOLD).cast("int"))


def op7_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_differencing.extract_main_text(read_table(spark, sf_dir, "pages"))


def op8_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = simhash_bktree.simhash_components(read_table(spark, sf_dir, "documents"))
    return c.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_bigru_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = bigru_toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    out = pu_quality.held_out("doc_id", 5, 0).alias("held_out")
    scored = bigru_toxicity.score(docs, model).select("doc_id", out, "score")
    return scored.withColumn("predicted", (F.col("score") >= bigru_toxicity.THRESHOLD).cast("int"))


def op10_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return inverted_multi_index.search(vectors, F.col("vec_id") % 50 == 0, k=5)


def op11_ownership_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(read_table(spark, sf_dir, "documents"))


#: Matches with their places: each step of a scan takes what is before a match and the match; places are running sums.
OP11_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
scans AS (
  SELECT r, source, 1 AS kind, 12 AS least, 2 AS part, regexp_extract_all(t, p, 0) AS steps, regexp_extract_all(t, p, 2) AS found, regexp_extract_all(t, p, 3) AS val
  FROM docs, (SELECT '(?s)(.*?)((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+))' AS p)
  UNION ALL SELECT r, source, 2, 18, 0, regexp_extract_all(t, '(?s)(.*?)(AKIA[A-Z0-9]+)', 0), regexp_extract_all(t, '(?s)(.*?)(AKIA[A-Z0-9]+)', 2), NULL FROM docs
  UNION ALL SELECT r, source, 3, 16, 0, regexp_extract_all(t, '(?s)(.*?)([0-9a-f]+)', 0), regexp_extract_all(t, '(?s)(.*?)([0-9a-f]+)', 2), NULL FROM docs
  UNION ALL SELECT r, source, 4, 20, 0, regexp_extract_all(t, '(?s)(.*?)([A-Za-z0-9+/_=-]+)', 0), regexp_extract_all(t, '(?s)(.*?)([A-Za-z0-9+/_=-]+)', 2), NULL FROM docs),
steps AS (SELECT r, source, kind, least, unnest(steps) AS step, unnest(found) AS found, unnest(coalesce(val, found)) AS val, generate_subscripts(steps, 1) AS i FROM scans),
ends AS (SELECT *, sum(length(step)) OVER (PARTITION BY r, kind ORDER BY i ROWS UNBOUNDED PRECEDING)::BIGINT AS e FROM steps),
places AS (SELECT r, source, kind, e - length(found) AS s, e, val,
                  regexp_matches(val, '[A-Za-z]') AND regexp_matches(val, '[0-9]') AND len(list_distinct(string_split(val, ''))) >= 10 AS alive
           FROM ends WHERE length(val) >= least),
base AS (SELECT * FROM places WHERE kind < 4),
bare AS (SELECT * FROM places p WHERE kind = 4 AND alive AND NOT EXISTS (SELECT 1 FROM base b WHERE b.r = p.r AND b.s < p.e AND b.e > p.s)),
candidates AS (SELECT * FROM base UNION ALL SELECT * FROM bare),
owners AS (SELECT val, count(DISTINCT coalesce(source, chr(1))) <= 3 AND count(DISTINCT coalesce(regexp_extract(source, '^([^/]*)', 1), chr(1))) <= 2 AS own
           FROM candidates GROUP BY val),
judged AS (SELECT c.*, ['assign', 'access', 'hex', 'live'][kind] || ':' || s || ':' || e AS span, own AND alive AS live, NOT own AS copied
           FROM candidates c JOIN owners USING (val)),
per_doc AS (
  SELECT r, count(*) FILTER (kind = 1) AS n_assign, count(*) FILTER (kind = 2) AS n_access, count(*) FILTER (kind = 3) AS n_hex,
         string_agg(span, ',' ORDER BY s, kind) FILTER (kind < 4) AS base, string_agg(span, ',' ORDER BY s, kind) FILTER (kind < 4 OR live) AS spans,
         count(*) FILTER (live) AS n_live, count(*) FILTER (copied) AS n_copied FROM judged GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
FROM docs LEFT JOIN per_doc USING (r)
"""


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(read_table(spark, sf_dir, "embeddings"))


def _op12_sql() -> str:
    """Every part against every entry, round by round."""
    def assigned(k: int) -> str:
        return f"""
a{k} AS MATERIALIZED (
  SELECT r, part, min_by(entry, d * 1000 + entry) AS entry, min(d) AS d FROM (
    SELECT x.r, x.part, b.entry, list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM parts x JOIN b{k} b USING (part)) GROUP BY r, part),"""

    def refined(k: int) -> str:
        return f"""
s{k} AS (SELECT part, entry, list(v ORDER BY dim) AS v FROM (
    SELECT part, entry, dim, floor(sum(u)::DOUBLE / count(*))::BIGINT AS v FROM (
      SELECT part, entry, unnest(v) AS u, generate_subscripts(v, 1) AS dim FROM a{k} JOIN parts USING (r, part)) GROUP BY part, entry, dim)
  GROUP BY part, entry),
b{k + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(s.v, b.v) AS v FROM b{k} b LEFT JOIN s{k} s USING (part, entry)),"""

    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS r, vec_id, label,
         list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT r, part, v[(part * len(v) // 4 + 1):((part + 1) * len(v) // 4)] AS v FROM kept, range(4) g(part)),
b0 AS (SELECT part, r AS entry, v FROM parts WHERE r < 256),
{"".join(assigned(k) + refined(k) for k in range(4))}{assigned(4)}
hashed AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS h FROM b4),
coded AS (SELECT r, string_agg(lower(lpad(to_hex(entry), 2, '0')), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a4 GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
FROM coded JOIN kept USING (r), hashed
"""


OP12_SQL = _op12_sql()


def op13_mask_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mask_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


#: All documents with any term of an item, scored and ranked.
OP13_SQL = r"""
WITH terms AS (
  SELECT r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)),
lengths AS (SELECT r, count(*) AS n FROM terms GROUP BY r),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS len FROM lengths),
tf AS (SELECT r, doc_id, term, count(*) AS tf FROM terms GROUP BY r, doc_id, term),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY term, docs),
asked AS (
  SELECT q, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS q, item_id, text FROM benchmark)),
wanted AS (SELECT q, item_id, term, count(*) AS times FROM asked GROUP BY q, item_id, term),
scores AS (
  SELECT q, item_id, r, doc_id,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // len))))::BIGINT AS score
  FROM wanted JOIN tf USING (term) JOIN weights USING (term) JOIN lengths USING (r), total GROUP BY q, item_id, r, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id, r)::INT AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""


QUERIES = {"op1_revisits": op1_revisits, "op2_cdc_dedup": op2_cdc_dedup, "op3_string_tiling": op3_string_tiling,
           "op4_suffix_dedup": op4_suffix_dedup, "op5_temperature_mixing": op5_temperature_mixing, "op6_pu_quality": op6_pu_quality,
           "op7_page_differencing": op7_page_differencing, "op8_simhash_bktree": op8_simhash_bktree,
           "op9_bigru_toxicity": op9_bigru_toxicity, "op10_inverted_multi_index": op10_inverted_multi_index, "op11_ownership_secrets": op11_ownership_secrets,
           "op12_vector_codes": op12_vector_codes, "op13_mask_search": op13_mask_search, "pipeline": corpus_pipeline.run}
ORACLES: dict[str, str] = {"op1_revisits": OP1_SQL, "op5_temperature_mixing": OP5_SQL, "op11_ownership_secrets": OP11_SQL,
                           "op12_vector_codes": OP12_SQL, "op13_mask_search": OP13_SQL}
