"""Registered queries for corpus cleaning (sources: ``documents``) and their SQL oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dedup as D
from ..operators import quality as Q
from ..session import materialize
from ..sources.readers import read_table
from . import recipe as R
from . import sql_oracle as S

# Flagged-word list handed to the flagged-words filter in the registered
# queries (the recipes take it from the user; these are the insults planted in
# the test corpus).
EN_FLAGGED_WORDS = ["trash", "worthless", "idiot", "scum", "moron", "pathetic", "clown", "disgusting",
                    "loser", "stupid"]

# For the character mode: entries of one and two characters, as a list for Chinese has them; these occur in some
# of the test corpus' languages and not in others.
CHARACTER_FLAGGED_WORDS = ["ß", "ö", "rr", "ll"]

EN_SIMHASH = dict(R.EN_RECIPE[-1][1])
ZH_SIMHASH = dict(R.ZH_RECIPE[-1][1])


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "documents")


def _ctx() -> R.RecipeContext:
    return R.RecipeContext(id_col="doc_id", text_col="text",
                           flagged_words={"en": EN_FLAGGED_WORDS, "zh": CHARACTER_FLAGGED_WORDS})


# ------------------------------------------------------------------ queries

def q_dedup_length_by_lang(spark, sf):
    """Minimum slice: exact dedup -> text length >= 30 -> documents per language."""
    d = D.document_deduplicator(_docs(spark, sf), "doc_id", lowercase=True, ignore_non_character=True)
    d = Q.text_length_filter(d, min_len=30)
    return d.groupBy("lang").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_chars").alias("n_chars"))


def q_remove_null_text(spark, sf):
    return Q.remove_null_text(_docs(spark, sf)).select("doc_id")


def q_exact_dedup(spark, sf):
    return D.document_deduplicator(_docs(spark, sf), "doc_id", lowercase=True,
                                   ignore_non_character=True).select("doc_id", "lang")


def q_quality_stats(spark, sf):
    """Per-document statistics of the row filters (one pass, no shuffle)."""
    t = F.col("text")
    return _docs(spark, sf).select(
        "doc_id",
        Q.alphanumeric_ratio(t).alias("alnum_ratio"),
        Q.maximum_line_length(t).cast("long").alias("max_line_len"),
        F.length(t).cast("long").alias("text_len"),
        Q.flagged_words_ratio(t, EN_FLAGGED_WORDS, mode="word").alias("flagged_ratio_en"),
        Q.flagged_words_ratio(t, CHARACTER_FLAGGED_WORDS, mode="character", use_words_aug=True).alias("flagged_ratio_chars"),
    )


def q_char_repetition(spark, sf):
    return _docs(spark, sf).select("doc_id", Q.character_repetition_ratio(F.col("text"), 10).alias("rep_ratio"))


def q_quality_filters(spark, sf):
    """The en recipe's row filters, alone, on all documents."""
    d = _docs(spark, sf)
    d = Q.alphanumeric_filter(d, min_ratio=0.1)
    d = Q.character_repetition_filter(d, rep_len=10, max_ratio=0.6)
    d = Q.flagged_words_filter(d, EN_FLAGGED_WORDS, lang="en", max_ratio=0.017)
    d = Q.maximum_line_length_filter(d, min_len=20)
    d = Q.text_length_filter(d, min_len=30)
    return d.select("doc_id")


def _fp_args(a):
    return dict(tokenization=a["tokenization"], window_size=a["window_size"], lowercase=a["lowercase"],
                ignore_pattern=a["ignore_pattern"])


def q_simhash_en(spark, sf):
    return D.fingerprints(_docs(spark, sf), "doc_id", **_fp_args(EN_SIMHASH))


def q_simhash_zh(spark, sf):
    return D.fingerprints(_docs(spark, sf), "doc_id", **_fp_args(ZH_SIMHASH))


def q_near_pairs(spark, sf):
    fp = materialize(D.fingerprints(_docs(spark, sf), "doc_id", **_fp_args(EN_SIMHASH)), "simhash")  # or the null filter hashes once more
    distinct = fp.where(F.col("fp").isNotNull()).select("fp").distinct()
    return D.near_pairs(distinct, "fp", EN_SIMHASH["num_blocks"], EN_SIMHASH["hamming_distance"])


def q_duplicate_clusters(spark, sf):
    return D.simhash_clusters(_docs(spark, sf), "doc_id", **_fp_args(EN_SIMHASH),
                              num_blocks=EN_SIMHASH["num_blocks"], hamming_distance=EN_SIMHASH["hamming_distance"])


def q_simhash_dedup(spark, sf):
    return D.document_simhash_deduplicator(_docs(spark, sf), "doc_id", **_fp_args(EN_SIMHASH),
                                           num_blocks=EN_SIMHASH["num_blocks"],
                                           hamming_distance=EN_SIMHASH["hamming_distance"]).select("doc_id")


def q_recipe_en(spark, sf):
    """Flagship: the whole en cleaning recipe; survivors per language."""
    out = R.run_recipe(_docs(spark, sf), R.EN_RECIPE, _ctx())
    return out.select("doc_id", "lang")


def q_recipe_zh(spark, sf):
    out = R.run_recipe(_docs(spark, sf), R.ZH_RECIPE, _ctx())
    return out.select("doc_id", "lang")


def q_recipe_trace(spark, sf):
    return R.trace(_docs(spark, sf), R.EN_RECIPE, _ctx())


def q_recipe_funnel(spark, sf):
    return R.funnel(R.trace(_docs(spark, sf), R.EN_RECIPE, _ctx()), R.EN_RECIPE)


QUERIES = {
    "dedup_length_by_lang": q_dedup_length_by_lang,
    "remove_null_text": q_remove_null_text,
    "exact_dedup": q_exact_dedup,
    "quality_stats": q_quality_stats,
    "char_repetition": q_char_repetition,
    "quality_filters": q_quality_filters,
    "simhash_en": q_simhash_en,
    "simhash_zh": q_simhash_zh,
    "near_pairs": q_near_pairs,
    "duplicate_clusters": q_duplicate_clusters,
    "simhash_dedup": q_simhash_dedup,
    "recipe_en": q_recipe_en,
    "recipe_zh": q_recipe_zh,
    "recipe_trace": q_recipe_trace,
    "recipe_funnel": q_recipe_funnel,
}


# ------------------------------------------------------------------ oracle SQL

_EXACT = f"""
  ex_keep AS (SELECT min(doc_id) AS doc_id FROM documents GROUP BY {S.exact_key_sql()}),
  ex AS (SELECT d.* FROM documents d JOIN ex_keep k USING (doc_id))"""


def _filters_sql(src: str, rep: str = "rep") -> str:
    """Predicate of the en recipe's filters over ``src`` joined with the repetition CTE ``rep``."""
    return (f"{S.alnum_ratio_sql()} >= 0.1 AND {rep}.rep_ratio <= 0.6 AND "
            f"{S.flagged_ratio_sql(EN_FLAGGED_WORDS)} <= 0.017 AND "
            f"{S.max_line_sql()} >= 20 AND length(text) >= 30")


def _recipe_en_sql(select: str) -> str:
    return f"""WITH {_EXACT},
{S.repetition_ratio_cte('ex')},
  flt AS (SELECT ex.* FROM ex JOIN rep ON ex.doc_id = rep.id WHERE {_filters_sql('ex')}),
{S.simhash_cte('flt', 'en_', window=3)},
{S.clusters_cte('en_', 7)}
{select}"""


_TRACE_SQL = f"""WITH {_EXACT},
  ex_map AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY {S.exact_key_sql()}) AS kept FROM documents),
{S.repetition_ratio_cte('ex')},
  tagged AS (SELECT ex.doc_id, ex.text, CASE
        WHEN NOT ({S.alnum_ratio_sql()} >= 0.1) THEN 2
        WHEN NOT (rep.rep_ratio <= 0.6) THEN 3
        WHEN NOT ({S.flagged_ratio_sql(EN_FLAGGED_WORDS)} <= 0.017) THEN 4
        WHEN NOT ({S.max_line_sql()} >= 20) THEN 5
        WHEN NOT (length(ex.text) >= 30) THEN 6 END AS step
      FROM ex JOIN rep ON ex.doc_id = rep.id),
  flt AS (SELECT doc_id, text FROM tagged WHERE step IS NULL),
{S.simhash_cte('flt', 'en_', window=3)},
{S.clusters_cte('en_', 7)},
  tr AS (
    SELECT doc_id, 1 AS removed_step, kept AS kept_id FROM ex_map WHERE kept <> doc_id
    UNION ALL SELECT doc_id, step, NULL FROM tagged WHERE step IS NOT NULL
    UNION ALL SELECT id, 7, cluster FROM en_cl WHERE cluster <> id
    UNION ALL SELECT id, NULL, NULL FROM en_cl WHERE cluster = id)
SELECT doc_id, removed_step::INTEGER AS removed_step,
       CASE removed_step WHEN 1 THEN 'document_deduplicator' WHEN 2 THEN 'alphanumeric_filter'
         WHEN 3 THEN 'character_repetition_filter' WHEN 4 THEN 'flagged_words_filter'
         WHEN 5 THEN 'maximum_line_length_filter' WHEN 6 THEN 'text_length_filter'
         WHEN 7 THEN 'document_simhash_deduplicator' END AS removed_by,
       kept_id::BIGINT AS kept_id
FROM tr"""


def _zh_recipe_sql() -> str:
    zh_flag = S.flagged_ratio_sql(CHARACTER_FLAGGED_WORDS, mode="character", aug=True)
    return f"""WITH {_EXACT},
{S.repetition_ratio_cte('ex')},
  flt AS (SELECT ex.* FROM ex JOIN rep ON ex.doc_id = rep.id
          WHERE {S.alnum_ratio_sql()} >= 0.1 AND rep.rep_ratio <= 0.6 AND {zh_flag} <= 0.017
            AND length(text) >= 10),
{S.simhash_cte('flt', 'zh_', tokenization='character', window=4)},
{S.clusters_cte('zh_', 8)}
SELECT f.doc_id, f.lang FROM flt f JOIN zh_cl c ON f.doc_id = c.id WHERE c.cluster = c.id"""


ORACLES = {
    "dedup_length_by_lang": f"""WITH {_EXACT}
SELECT lang, count(*) AS n_docs, sum(n_chars)::BIGINT AS n_chars FROM ex WHERE length(text) >= 30 GROUP BY lang""",
    "remove_null_text": "SELECT doc_id FROM documents WHERE text IS NOT NULL",
    "exact_dedup": f"WITH {_EXACT} SELECT doc_id, lang FROM ex",
    "quality_stats": f"""SELECT doc_id, {S.alnum_ratio_sql()} AS alnum_ratio, {S.max_line_sql()}::BIGINT AS max_line_len,
       length(text)::BIGINT AS text_len, {S.flagged_ratio_sql(EN_FLAGGED_WORDS)} AS flagged_ratio_en,
       {S.flagged_ratio_sql(CHARACTER_FLAGGED_WORDS, mode='character', aug=True)} AS flagged_ratio_chars
FROM documents""",
    "char_repetition": f"WITH {S.repetition_ratio_cte('documents')} SELECT id AS doc_id, rep_ratio FROM rep",
    "quality_filters": f"""WITH {S.repetition_ratio_cte('documents')}
SELECT doc_id FROM documents JOIN rep ON documents.doc_id = rep.id WHERE {_filters_sql('documents')}""",
    "simhash_en": f"WITH {S.simhash_cte('documents', 'en_', window=3)} SELECT id AS doc_id, fp FROM en_fp",
    "simhash_zh": f"""WITH {S.simhash_cte('documents', 'zh_', tokenization='character', window=4)}
SELECT id AS doc_id, fp FROM zh_fp""",
    "near_pairs": f"""WITH {S.simhash_cte('documents', 'en_', window=3)},
  d AS (SELECT DISTINCT fp FROM en_fp WHERE fp IS NOT NULL)
SELECT a.fp AS fp_a, b.fp AS fp_b, bit_count(xor(a.fp, b.fp))::INTEGER AS distance
FROM d a JOIN d b ON a.fp < b.fp AND bit_count(xor(a.fp, b.fp)) <= 7""",
    "duplicate_clusters": f"""WITH {S.simhash_cte('documents', 'en_', window=3)},
{S.clusters_cte('en_', 7)}
SELECT id AS doc_id, cluster FROM en_cl""",
    "simhash_dedup": f"""WITH {S.simhash_cte('documents', 'en_', window=3)},
{S.clusters_cte('en_', 7)}
SELECT id AS doc_id FROM en_cl WHERE cluster = id""",
    "recipe_en": _recipe_en_sql("SELECT f.doc_id, f.lang FROM flt f JOIN en_cl c ON f.doc_id = c.id "
                                "WHERE c.cluster = c.id"),
    "recipe_zh": _zh_recipe_sql(),
    "recipe_trace": _TRACE_SQL,
    "recipe_funnel": f"""WITH t AS ({_TRACE_SQL}),
  steps AS (SELECT * FROM (VALUES (1, 'document_deduplicator'), (2, 'alphanumeric_filter'),
        (3, 'character_repetition_filter'), (4, 'flagged_words_filter'), (5, 'maximum_line_length_filter'),
        (6, 'text_length_filter'), (7, 'document_simhash_deduplicator')) v(step, operator))
SELECT step::INTEGER AS step, operator,
       ((SELECT count(*) FROM t) - (SELECT count(*) FROM t WHERE removed_step <= s.step))::BIGINT AS remaining
FROM steps s""",
}
