"""DuckDB SQL for the correctness oracle, written from the operator definitions.

Each function returns a SQL fragment (CTE bodies or full statements) over the
pre-registered views (documents, conversations, embeddings, ...). Nothing is taken
from the code under test: character classes, frames and templates are written out
here a second time.
"""

from __future__ import annotations

# White space of Python's str.isspace, the exact key's dropped characters, line ends.
WS_CLASS = r"[\t\n\x0B\f\r\x1C-\x1F\x{85}\p{Z}]"
NON_CHARACTER_CLASS = r"""[\t\n\x0B\f\r\x1C-\x1F\x{85}\p{Z}\p{Nd}!"#$%&'()*+,\-./:;<=>?@\[\\\]\^_`{|}~]"""
LINE_END = r"\r\n|\n|\r"
PIECE = r"(<unk>|</s>|<s>|[\p{L}\p{N}]+|[^\p{L}\p{N}\t\n\x0B\f\r\x1C-\x1F\x{85}\p{Z}])"
CHAT_PREFIX, CHAT_SUFFIX = "<|im_start|>user\n", "<|im_end|>\n<|im_start|>assistant\n"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


WORD_RE = r"([\p{L}\p{N}]+)"


def exact_key_sql(text: str = "text") -> str:
    return f"md5(regexp_replace(lower({text}), {q(NON_CHARACTER_CLASS)}, '', 'g'))"


def alnum_ratio_sql(text: str = "text") -> str:
    return (f"CASE WHEN length({text}) > 0 THEN length(regexp_replace({text}, '[^\\p{{L}}\\p{{N}}]', '', 'g'))"
            f" / length({text}) ELSE 0.0 END")


def max_line_sql(text: str = "text") -> str:
    return (f"coalesce(list_max(list_transform(regexp_split_to_array({text}, {q(LINE_END)}), "
            f"lambda l: length(l))), 0)")


def flagged_ratio_sql(words: list[str], text: str = "text", mode: str = "word", aug: bool = False) -> str:
    wl = "[" + ", ".join(q(w.lower()) for w in sorted(set(words))) + "]::VARCHAR[]"
    if mode == "word":
        toks = f"regexp_extract_all(lower({text}), {q(WORD_RE)}, 1)"
    else:
        toks = (f"list_filter(regexp_extract_all(lower({text}), '(?s)(.)', 1), "
                f"lambda c: regexp_matches(c, '[\\p{{L}}\\p{{N}}]'))")
    if aug:
        toks = (f"(SELECT CASE WHEN len(t) > 1 THEN list_concat(t, list_transform(range(1, len(t)), "
                f"lambda i: t[i] || t[i + 1])) ELSE t END FROM (SELECT {toks} AS t))")
    return (f"(SELECT CASE WHEN len(t) > 0 THEN least(len(list_filter(t, lambda x: list_contains({wl}, x))) "
            f"/ len(t), 1.0) ELSE 0.0 END FROM (SELECT {toks} AS t))")


def repetition_ratio_cte(src: str, id_col: str = "doc_id", text: str = "text", n: int = 10) -> str:
    """CTE body: (id, rep_ratio) for every row of ``src``."""
    return f"""
  rr_pos AS (SELECT {id_col} AS id, {text} AS x, unnest(range(1, length({text}) - {n - 2})) AS i
             FROM {src} WHERE length({text}) >= {n}),
  rr_grams AS (SELECT id, substring(x, i, {n}) AS g FROM rr_pos),
  rr_counts AS (SELECT id, g, count(*) AS cnt FROM rr_grams GROUP BY id, g),
  rr_ranked AS (SELECT id, cnt, row_number() OVER (PARTITION BY id ORDER BY cnt DESC) AS rk,
                       count(*) OVER (PARTITION BY id) AS n_distinct,
                       count(*) FILTER (WHERE cnt > 1) OVER (PARTITION BY id) AS n_rep,
                       sum(cnt) OVER (PARTITION BY id) AS total
                FROM rr_counts),
  rr_ratio AS (SELECT id, sum(CASE WHEN rk <= least(floor(sqrt(n_distinct))::BIGINT, n_rep) THEN cnt ELSE 0 END)
                      / max(total) AS rep_ratio
               FROM rr_ranked GROUP BY id),
  rep AS (SELECT s.{id_col} AS id, coalesce(r.rep_ratio, 0.0) AS rep_ratio FROM {src} s LEFT JOIN rr_ratio r
          ON s.{id_col} = r.id)"""


def simhash_cte(src: str, prefix: str, id_col: str = "doc_id", text: str = "text", tokenization: str = "space",
                window: int = 3) -> str:
    """CTE bodies ending in ``{prefix}fp(id, fp)``; fp is NULL for texts without tokens."""
    cleaned = f"regexp_replace(lower({text}), '\\p{{P}}', '', 'g')"
    if tokenization == "space":
        toks = f"list_filter(regexp_split_to_array({cleaned}, {q(WS_CLASS + '+')}), lambda x: x <> '')"
        sep = "' '"
    else:
        toks = f"regexp_extract_all({cleaned}, '(?s)(.)', 1)"
        sep = "''"
    if tokenization == "space":
        tok_sh = f"""
  {prefix}tok AS (SELECT {id_col} AS id, {toks} AS t FROM {src}),
  {prefix}sh AS (SELECT id, unnest(list_transform(range(1, greatest(len(t) - {window - 1}, 1) + 1),
                                                 lambda i: array_to_string(t[i:i + {window - 1}], {sep}))) AS s
                 FROM {prefix}tok WHERE len(t) > 0),"""
    else:
        # characters: a shingle is a substring of the cleaned text
        tok_sh = f"""
  {prefix}tok AS (SELECT {id_col} AS id, {cleaned} AS x FROM {src}),
  {prefix}pos AS (SELECT id, x, unnest(range(1, greatest(length(x) - {window - 1}, 1) + 1)) AS i
                  FROM {prefix}tok WHERE length(x) > 0),
  {prefix}sh AS (SELECT id, substring(x, i, {window}) AS s FROM {prefix}pos),"""
    return tok_sh + f"""
  {prefix}h AS (SELECT id, ('0x' || substr(md5(s), 1, 16))::UBIGINT AS h FROM {prefix}sh),
  {prefix}hb AS (SELECT id, h, unnest(range(0, 64)) AS b FROM {prefix}h),
  {prefix}votes AS (SELECT id, b, sum(CASE WHEN (h >> b) & 1 = 1 THEN 1 ELSE -1 END) AS v
                    FROM {prefix}hb GROUP BY id, b),
  {prefix}u AS (SELECT id, sum(CASE WHEN v > 0 THEN (1::UBIGINT << b) ELSE 0::UBIGINT END)::UBIGINT AS fu
                FROM {prefix}votes GROUP BY id),
  {prefix}fp AS (SELECT t.id, CASE WHEN u.fu IS NULL THEN NULL
                      WHEN u.fu >= 9223372036854775808::UBIGINT THEN (u.fu::HUGEINT - 18446744073709551616::HUGEINT)::BIGINT
                      ELSE u.fu::BIGINT END AS fp
                 FROM {prefix}tok t LEFT JOIN {prefix}u u ON t.id = u.id)"""


def clusters_cte(prefix: str, distance: int) -> str:
    """CTE bodies over ``{prefix}fp`` ending in ``{prefix}cl(id, cluster)`` (brute-force pairs, recursive closure)."""
    return f"""
  {prefix}reps AS (SELECT fp, min(id) AS rep FROM {prefix}fp WHERE fp IS NOT NULL GROUP BY fp),
  {prefix}pairs AS (SELECT a.rep AS src, b.rep AS dst FROM {prefix}reps a JOIN {prefix}reps b
                    ON a.fp < b.fp AND bit_count(xor(a.fp, b.fp)) <= {distance}),
  {prefix}edges AS (SELECT src, dst FROM {prefix}pairs UNION ALL SELECT dst, src FROM {prefix}pairs),
  {prefix}reach AS (SELECT reach_node, reach_label FROM (
        WITH RECURSIVE r(reach_node, reach_label) AS (
          SELECT rep, rep FROM {prefix}reps
          UNION
          SELECT e.dst, r.reach_label FROM r JOIN {prefix}edges e ON r.reach_node = e.src)
        SELECT * FROM r)),
  {prefix}label AS (SELECT reach_node AS rep, min(reach_label) AS label FROM {prefix}reach GROUP BY reach_node),
  {prefix}cl AS (SELECT f.id, coalesce(l.label, f.id) AS cluster
                 FROM {prefix}fp f LEFT JOIN {prefix}reps r ON f.fp = r.fp LEFT JOIN {prefix}label l ON r.rep = l.rep)"""
