"""Registered queries for SFT, pre-training, DPO preparation, splits and metrics, with SQL oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dialog as DL
from ..operators import metrics as M
from ..operators import packing as P
from ..operators import preferences as PR
from ..operators import quality as Q
from ..operators import splits as SP
from ..operators import tokens as TK
from ..operators.templates import TEMPLATES, get_template
from ..session import materialize
from ..sources.adapters import conversations_as_records, paired_text, preference_triples
from ..sources.readers import read_table
from .sql_oracle import CHAT_PREFIX, CHAT_SUFFIX, PIECE, WS_CLASS, q

# Query parameters: the limits of real runs, which cut none of the test texts, and tight ones that cut some.
TEMPLATE = "vicuna"
VOCAB_SIZE_CHAT = 2000
VOCAB_SIZE_DOCS = 5000
MAX_SOURCE, MAX_TARGET = 4096, 512
TIGHT_SOURCE, TIGHT_TARGET = 128, 288
PAIR_MAX_LENGTH, TIGHT_PAIR = 4096, 48
BLOCK_SIZE = 1024
ROWS_PER_GROUP = 1000
SEED = 42
VALIDATION_PCT = 5
DPO_MAX_SOURCE, DPO_MAX_TARGET = 4096, 2048
DPO_TIGHT_SOURCE, DPO_TIGHT_TARGET = 1024, 512
RIGHT_PAD = 1024
PAD_BATCH = 8


def _ids_digest(c) -> F.Column:
    return F.md5(F.array_join(F.transform(c, lambda x: x.cast("string")), ","))


# ------------------------------------------------------------------ shared plan pieces

def chat_vocab(spark: SparkSession, sf: str) -> TK.Vocabulary:
    conv = read_table(spark, sf, "conversations")
    return TK.build_vocabulary(conv, "text", VOCAB_SIZE_CHAT)


def doc_vocab(spark: SparkSession, sf: str) -> TK.Vocabulary:
    return TK.build_vocabulary(read_table(spark, sf, "documents"), "text", VOCAB_SIZE_DOCS)


def sft_dialogs(spark, sf) -> DataFrame:
    rec = conversations_as_records(read_table(spark, sf, "conversations"))
    return DL.build_dialogs(rec, template=TEMPLATE)


def sft_tokenized(spark, sf, max_source: int = MAX_SOURCE, max_target: int = MAX_TARGET) -> DataFrame:
    vocab = TK.resolve_special_tokens(chat_vocab(spark, sf), get_template(TEMPLATE))
    return TK.tokenize_dialogs(sft_dialogs(spark, sf), vocab, "dialog", max_source, max_target)


def doc_tokens(spark, sf, vocab=None) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    vocab = vocab or doc_vocab(spark, sf)
    return TK.tokenize_text(docs.select("doc_id", "lang", "text"), vocab).drop("text")


def packed_blocks(spark, sf) -> DataFrame:
    toks = doc_tokens(spark, sf)
    grouped = P.assign_groups(toks, "doc_id", ROWS_PER_GROUP)
    return P.group_texts(grouped, BLOCK_SIZE)


# ------------------------------------------------------------------ queries

def q_sft_dialogs(spark, sf):
    d = sft_dialogs(spark, sf)
    return d.select("conv_id", F.size("dialog").cast("long").alias("n_turns"),
                    F.md5(DL.render_prompt("dialog")).alias("prompt_md5"))


def _sft_columns(t: DataFrame) -> DataFrame:
    return t.select("conv_id", F.col("seq_length").cast("long").alias("seq_length"), "truncated",
                    F.col("n_turns_kept").cast("long").alias("n_turns_kept"),
                    _ids_digest(F.col("input_ids")).alias("ids_md5"), _ids_digest(F.col("labels")).alias("labels_md5"))


def q_sft_tokenized(spark, sf):
    return _sft_columns(sft_tokenized(spark, sf))


def q_sft_truncation(spark, sf):
    """Limits that cut some rows and not others, and lose turns without a cut."""
    return _sft_columns(sft_tokenized(spark, sf, TIGHT_SOURCE, TIGHT_TARGET))


def q_sft_train_rows(spark, sf):
    t = TK.filter_empty_labels(TK.drop_truncated(sft_tokenized(spark, sf, TIGHT_SOURCE, TIGHT_TARGET)))
    return t.select("conv_id", F.col("seq_length").cast("long").alias("seq_length"))


def q_sft_filter_counts(spark, sf):
    t = sft_tokenized(spark, sf, TIGHT_SOURCE, TIGHT_TARGET)
    keep = F.exists("labels", lambda x: x != F.lit(TK.IGNORE_INDEX)) & ~F.col("truncated")
    return M.count_before_after(t, keep)


def _pairs(spark, sf, max_length: int) -> DataFrame:
    return TK.tokenize_pair(paired_text(read_table(spark, sf, "conversations")), chat_vocab(spark, sf), max_length)


def _pair_columns(t: DataFrame) -> DataFrame:
    return t.select("conv_id", "turn", F.col("seq_length").cast("long").alias("seq_length"), "seq_category",
                    _ids_digest(F.col("input_ids")).alias("ids_md5"), _ids_digest(F.col("labels")).alias("labels_md5"))


def q_pair_tokenized(spark, sf):
    return _pair_columns(_pairs(spark, sf, PAIR_MAX_LENGTH))


def q_pair_train_rows(spark, sf):
    """A limit that leaves some pairs nothing but their masked source: those drop."""
    return _pair_columns(TK.filter_empty_labels(_pairs(spark, sf, TIGHT_PAIR)))


def _pairs_of(dialogs: DataFrame) -> DataFrame:
    return dialogs.select("conv_id", F.size("dialog").cast("long").alias("n_turns"),
                          F.md5(DL.render_prompt("dialog")).alias("prompt_md5"))


def q_sft_instructions(spark, sf):
    """Instruction records (instruction, input, output) built from every user turn and its answer."""
    pairs = paired_text(read_table(spark, sf, "conversations"))
    rec = pairs.select("conv_id", "turn", F.col("source").alias("instruction"),
                       F.when(F.col("turn") % 2 == 0, F.concat(F.lit(" note "), "turn")).alias("input"),
                       F.concat(F.lit(" "), "target", F.lit("\n")).alias("output"))
    d = DL.build_dialogs(rec, template=TEMPLATE)
    return d.select("conv_id", "turn", F.md5(DL.render_prompt("dialog")).alias("prompt_md5"))


def q_sft_json_strings(spark, sf):
    """The same conversations as JSON text, every seventh one cut short and so unreadable."""
    rec = conversations_as_records(read_table(spark, sf, "conversations"))
    text = F.to_json("conversations")
    text = F.when(F.col("conv_id") % 7 == 6, F.expr("substring(to_json(conversations), 2, 20)")).otherwise(text)
    return _pairs_of(DL.build_dialogs(rec.select("conv_id", text.alias("conversations")), template=TEMPLATE))


def q_sft_templates(spark, sf):
    """Every registered template over all dialogs."""
    rec = conversations_as_records(read_table(spark, sf, "conversations"))
    pairs = rec.select("conv_id", DL.normalize_dialog("conversations").alias("p")).where("p IS NOT NULL")
    prompts = F.array(*[F.struct(F.lit(n).alias("template"), F.md5(DL.render_prompt(DL.render_dialog("p", n))).alias("prompt_md5"))
                        for n in sorted(TEMPLATES)])
    return pairs.select("conv_id", F.explode(prompts).alias("x")).select("conv_id", "x.template", "x.prompt_md5")


def q_sft_appended(spark, sf):
    """A last question appended to every dialog."""
    rec = conversations_as_records(read_table(spark, sf, "conversations"))
    pairs = rec.select("conv_id", DL.normalize_dialog("conversations").alias("p")).where("p IS NOT NULL")
    more = DL.append_message("p", F.concat(F.lit("and "), F.col("conv_id").cast("string"), F.lit("?")), F.lit("yes"))
    d = pairs.select("conv_id", DL.render_dialog(more, TEMPLATE).alias("dialog"))
    return _pairs_of(d)


def _block_columns(b: DataFrame, *also) -> DataFrame:
    return b.select("group_id", "block_id", F.size("input_ids").cast("long").alias("n_tokens"),
                    _ids_digest(F.col("input_ids")).alias("ids_md5"), *also)


def q_packed_blocks(spark, sf):
    return _block_columns(packed_blocks(spark, sf))


def pretrain_blocks(spark, sf) -> DataFrame:
    """The pre-training path: null filter -> seeded shuffle -> tokenize -> pack, with every token column."""
    docs = Q.remove_null_text(read_table(spark, sf, "documents").select("doc_id", "text"))
    toks = TK.tokenize_text(docs, doc_vocab(spark, sf)).select(
        "doc_id", SP.shuffle_key("doc_id", SEED).alias("shuffle_key"), "input_ids")
    toks = toks.withColumn("attention_mask", F.transform("input_ids", lambda x: F.lit(1)))
    return P.group_texts(P.assign_groups(toks, "shuffle_key", ROWS_PER_GROUP), BLOCK_SIZE, also=("attention_mask",))


def q_pretrain_blocks(spark, sf):
    attended = F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).cast("long").alias("n_attended")
    return _block_columns(pretrain_blocks(spark, sf), attended)


def q_tokens_by_split(spark, sf):
    t = SP.random_split(doc_tokens(spark, sf), VALIDATION_PCT, SEED, "doc_id")
    return M.tokens_by_split(t)


def q_head_split(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id")
    return SP.head_split(d, VALIDATION_PCT, "doc_id")


def q_shuffle_order(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id")
    s = d.withColumn("shuffle_key", SP.shuffle_key("doc_id", SEED))
    return SP.with_row_index(s, "shuffle_key", "shuffle_pos").select("doc_id", "shuffle_pos")


def q_take_docs(spark, sf):
    return SP.take(read_table(spark, sf, "documents").select("doc_id", "lang"), 100, "doc_id")


def q_preferences(spark, sf):
    trip = preference_triples(read_table(spark, sf, "conversations"))
    p = PR.prepare_preferences(trip, "conv_id", DPO_MAX_SOURCE, DPO_MAX_TARGET, max_samples=None, seed=SEED)
    return p.select("conv_id", F.length("prompt").cast("long").alias("prompt_len"),
                    F.md5("prompt").alias("prompt_md5"), F.md5("chosen").alias("chosen_md5"),
                    F.md5("rejected").alias("rejected_md5"))


def _preference_columns(p: DataFrame) -> DataFrame:
    return p.select("conv_id", F.length("prompt").cast("long").alias("prompt_len"), F.md5("prompt").alias("prompt_md5"),
                    F.md5("chosen").alias("chosen_md5"), F.md5("rejected").alias("rejected_md5"))


def q_preferences_tight(spark, sf):
    """Limits that drop some triples; the training order is kept as its rank."""
    trip = preference_triples(read_table(spark, sf, "conversations"))
    p = PR.prepare_preferences(trip, "conv_id", DPO_TIGHT_SOURCE, DPO_TIGHT_TARGET, seed=SEED)
    rank = SP.with_row_index(p.select("shuffle_key"), "shuffle_key", "rank")
    return _preference_columns(p).join(p.join(rank, "shuffle_key").select("conv_id", "rank"), "conv_id")


def q_preferences_eval(spark, sf):
    """The evaluation path: the first 20 triples, in id order, no shuffle."""
    trip = preference_triples(read_table(spark, sf, "conversations"))
    return _preference_columns(PR.prepare_preferences(trip, "conv_id", DPO_MAX_SOURCE, DPO_MAX_TARGET, max_samples=20,
                                                      train=False))


def q_argmax_embeddings(spark, sf):
    e = read_table(spark, sf, "embeddings")
    return e.select("vec_id", M.argmax_last("embedding").alias("argmax"))


def q_token_accuracy(spark, sf):
    """Accuracy of the repeat-the-previous-token predictor on the packed blocks."""
    b = packed_blocks(spark, sf)
    return M.token_accuracy(b.select(F.col("input_ids").alias("preds"), "labels"))


def q_unigram_perplexity(spark, sf):
    """Perplexity of each language's documents under a unigram model estimated on the whole corpus."""
    toks = doc_tokens(spark, sf)
    # counts per document first, then per id: a token is one row only inside its document
    counts = toks.select("doc_id", "lang", F.explode("input_ids").alias("id")).groupBy("doc_id", "lang", "id").agg(
        F.count(F.lit(1)).alias("n"))
    counts = materialize(counts, "token-counts")
    total = counts.agg(F.sum("n")).first()[0] or 1
    logp = counts.groupBy("id").agg((F.log(F.sum("n").cast("double")) - F.log(F.lit(float(total)))).alias("logp"))
    # the table has at most len(vocab) rows: a proven bound for the broadcast
    loss = counts.join(F.broadcast(logp), "id").groupBy("doc_id", "lang").agg(
        (-F.sum(F.col("n") * F.col("logp")) / F.sum("n")).alias("loss"))
    by_lang = M.perplexity(loss, "loss", ("lang",))
    return by_lang.select("lang", F.round("perplexity", 6).alias("perplexity"))


def q_format_token_counts(spark, sf):
    t = doc_tokens(spark, sf)
    agg = t.groupBy("lang").agg(F.sum(F.size("input_ids")).cast("long").alias("n_tokens"))
    return agg.select("lang", "n_tokens", M.format_numel("n_tokens", 1000).alias("tokens_1000"),
                      M.format_numel("n_tokens", 1024).alias("tokens_1024"))


def q_pad_left(spark, sf):
    t = sft_tokenized(spark, sf)
    b = SP.with_row_index(t, "conv_id", "row_idx").withColumn("batch", F.floor(F.col("row_idx") / PAD_BATCH))
    vocab_pad = 0  # pad = unk for the built-in vocabulary
    return _padded(P.pad_left(b, "batch", MAX_SOURCE + MAX_TARGET, vocab_pad))


def _padded(p: DataFrame) -> DataFrame:
    return p.select("conv_id", F.size("input_ids").cast("long").alias("padded_len"),
                    _ids_digest(F.col("input_ids")).alias("ids_md5"), _ids_digest(F.col("labels")).alias("labels_md5"),
                    F.size(F.filter("attention_mask", lambda x: x)).cast("long").alias("n_attended"))


def q_pad_right(spark, sf):
    """Right padding to the block size that a model of 1024 positions allows; longer rows are cut."""
    return _padded(P.pad_right(sft_tokenized(spark, sf), P.effective_block_size(MAX_SOURCE, RIGHT_PAD), 0))


def q_pad_to_longest(spark, sf):
    t = sft_tokenized(spark, sf)
    b = SP.with_row_index(t, "conv_id", "row_idx").withColumn("batch", F.floor(F.col("row_idx") / PAD_BATCH))
    return _padded(P.pad_to_longest(b, "batch", 0))


def q_decode_labels(spark, sf):
    vocab = TK.resolve_special_tokens(chat_vocab(spark, sf), get_template(TEMPLATE))
    t = TK.tokenize_dialogs(sft_dialogs(spark, sf), vocab, "dialog", MAX_SOURCE, MAX_TARGET)
    pad = vocab.pad_id
    lab = F.transform("labels", lambda x: F.when(x == F.lit(TK.IGNORE_INDEX), F.lit(pad)).otherwise(x))
    return TK.decode_ids(t, vocab, lab, "decoded", sep="|").select("conv_id", F.md5("decoded").alias("decoded_md5"))


QUERIES = {
    "sft_dialogs": q_sft_dialogs,
    "sft_tokenized": q_sft_tokenized,
    "sft_train_rows": q_sft_train_rows,
    "sft_filter_counts": q_sft_filter_counts,
    "pair_tokenized": q_pair_tokenized,
    "packed_blocks": q_packed_blocks,
    "tokens_by_split": q_tokens_by_split,
    "head_split": q_head_split,
    "shuffle_order": q_shuffle_order,
    "take_docs": q_take_docs,
    "preferences": q_preferences,
    "argmax_embeddings": q_argmax_embeddings,
    "token_accuracy": q_token_accuracy,
    "unigram_perplexity": q_unigram_perplexity,
    "format_token_counts": q_format_token_counts,
    "pad_left": q_pad_left,
    "decode_labels": q_decode_labels,
    "sft_truncation": q_sft_truncation,
    "sft_instructions": q_sft_instructions,
    "sft_json_strings": q_sft_json_strings,
    "sft_templates": q_sft_templates,
    "sft_appended": q_sft_appended,
    "pair_train_rows": q_pair_train_rows,
    "pretrain_blocks": q_pretrain_blocks,
    "preferences_tight": q_preferences_tight,
    "preferences_eval": q_preferences_eval,
    "pad_right": q_pad_right,
    "pad_to_longest": q_pad_to_longest,
}


# ------------------------------------------------------------------ oracle SQL

def _vocab_cte(name: str, table: str, size: int) -> str:
    return f"""
  {name}_cnt AS (SELECT tok, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, {q(PIECE)}, 1)) AS tok
                 FROM {table}) WHERE tok NOT IN ('<unk>', '<s>', '</s>') GROUP BY tok),
  {name} AS (SELECT * FROM (VALUES ('<unk>', 0), ('<s>', 1), ('</s>', 2)) v(tok, id)
             UNION ALL
             SELECT tok, (row_number() OVER (ORDER BY n DESC, tok ASC) + 2)::INTEGER FROM {name}_cnt
             QUALIFY row_number() OVER (ORDER BY n DESC, tok ASC) <= {size - 3})"""


def _encode_cte(name: str, src: str, keys: str, text: str, vocab: str) -> str:
    """CTE ``name``(keys..., ids INTEGER[]) encoding ``text`` of every row of ``src``."""
    key_list = [k.strip() for k in keys.split(",")]
    kj = " AND ".join(f"p.{k} IS NOT DISTINCT FROM s.{k}" for k in key_list)
    return f"""
  {name}_l AS (SELECT {keys}, regexp_extract_all({text}, {q(PIECE)}, 1) AS l FROM {src}),
  {name}_p AS (SELECT {keys}, unnest(l) AS tok, unnest(range(1, len(l) + 1)) AS pos FROM {name}_l),
  {name}_i AS (SELECT {', '.join('p.' + k for k in key_list)}, list(coalesce(v.id, 0) ORDER BY p.pos) AS ids
               FROM {name}_p p LEFT JOIN {vocab} v ON p.tok = v.tok GROUP BY ALL),
  {name} AS (SELECT {', '.join('s.' + k for k in key_list)}, coalesce(p.ids, []::INTEGER[]) AS ids
             FROM {src} s LEFT JOIN {name}_i p ON {kj})"""


# Per template its system prompt with the separator, the text around the query, the separator.
_TEMPLATE_SQL = {
    "vicuna": ("A chat between a curious user and an artificial intelligence assistant. The assistant gives helpful, "
               "detailed, and polite answers to the user's questions.</s>", "USER: ", " ASSISTANT: ", "</s>"),
    "alpaca": ("Below is an instruction that describes a task. Write a response that appropriately completes the "
               "request.\n\n", "### Instruction:\n", "\n\n### Response:\n", "\n\n"),
    "baichuan": ("", " <reserved_102> ", " <reserved_103> ", "</s>"),
    "baichuan2": ("", " <reserved_106> ", " <reserved_107> ", "</s>"),
    "ziya": ("", "<human>:", "\n<bot>:", "\n"),
    "linly": ("", "User: ", "\nBot: ", "\n"),
    "chatglm": ("", "问：", "\n答：", "\n"),
    "chatglm2": ("", "问：", "\n\n答：", "\n\n"),
    "phoenix": ("A chat between a curious human and an artificial intelligence assistant. The assistant gives helpful, "
                "detailed, and polite answers to the human's questions.\n\n</s>", "Human: <s>", "</s>Assistant: ", "</s>"),
    "belle": ("", "Human: ", "\n\nBelle: ", "\n\n"),
    "aquila": ("A chat between a curious human and an artificial intelligence assistant. The assistant gives helpful, "
               "detailed, and polite answers to the human's questions.###", "Human: ", "###Assistant: ", "###"),
    "intern": ("", "<|User|>:", "<eoh>\n<|Bot|>:", "<eoa>\n"),
    "starchat": ("<system>\n<|end|>\n", "<|user|>\n", "<|end|>\n<|assistant|>\n", "<|end|>\n"),
    "llama2": ("<<SYS>>\nYou are a helpful, respectful and honest assistant. Always answer as helpfully as possible, "
               "while being safe. Your answers should not include any harmful, unethical, racist, sexist, toxic, "
               "dangerous, or illegal content. Please ensure that your responses are socially unbiased and positive in "
               "nature.\n\nIf a question does not make any sense, or is not factually coherent, explain why instead of "
               "answering something not correct. If you don't know the answer to a question, please don't share false "
               "information.\n<</SYS>>\n\n</s>", " [INST] ", " [/INST] ", "</s>"),
    "llama2-zh": ("<<SYS>>\nYou are a helpful assistant. 你是一个乐于助人的助手。\n<</SYS>>\n\n</s>", " [INST] ", " [/INST] ",
                  "</s>"),
    "xverse": ("", "Human: ", "\n\nAssistant: ", "</s>"),
    "chatml": ("You are a helpful assistant.<|im_end|>\n", "<|im_start|>user\n", "<|im_end|>\n<|im_start|>assistant\n",
               "<|im_end|>\n"),
    "yi": ("", "<|im_start|>user\n", "<|im_end|>\n<|im_start|>assistant\n", "\n"),
}


def _dialog_cte(turns: str = "conversations") -> str:
    first_prefix, before, after, sep = _TEMPLATE_SQL["vicuna"]
    return f"""
  msgs AS (SELECT conv_id, list({{'from': CASE WHEN role = 'user' THEN 'human' ELSE role END, 'value': text}}
                               ORDER BY turn) AS m FROM {turns} GROUP BY conv_id),
  d1 AS (SELECT conv_id, CASE WHEN coalesce(m[1]['from'] = 'human', false) THEN m ELSE m[2:] END AS t
         FROM msgs WHERE len(m) >= 2),
  d2 AS (SELECT conv_id, t, coalesce(list_position(list_transform(t, lambda x: coalesce(x['from'] IN ('human', 'assistant'), false)), false), 0) AS stop
         FROM d1 WHERE len(t) >= 2),
  d3 AS (SELECT conv_id, CASE WHEN stop > 0 THEN t[1:stop - 1] ELSE t END AS k FROM d2),
  d4 AS (SELECT conv_id, list_transform(list_filter(k, lambda x, j: x['from'] =
                   CASE WHEN (j - 1) % 2 = 0 THEN 'human' ELSE 'assistant' END), lambda x: x['value']) AS v FROM d3),
  dlg AS (SELECT conv_id, v FROM d4 WHERE len(v) >= 2 AND len(v) % 2 = 0),
  turns AS (SELECT conv_id, k,
                   (CASE WHEN k = 0 THEN {q(first_prefix)} ELSE {q(sep)} END) || {q(before)} || v[2 * k + 1]
                     || {q(after)} AS source,
                   v[2 * k + 2] AS target
            FROM (SELECT conv_id, v, unnest(range(0, len(v) // 2)) AS k FROM dlg))"""


def _sft_sql(select: str, max_source: int = MAX_SOURCE, max_target: int = MAX_TARGET) -> str:
    return f"""WITH {_vocab_cte('vocab', 'conversations', VOCAB_SIZE_CHAT)},
{_dialog_cte()},
  parts AS (SELECT conv_id, k, 0 AS part, source AS x FROM turns UNION ALL SELECT conv_id, k, 1, target FROM turns),
{_encode_cte('enc', 'parts', 'conv_id, k, part', 'x', 'vocab')},
  t1 AS (SELECT s.conv_id, s.k,
           CASE WHEN s.k = 0 THEN [1] || s.ids ELSE s.ids END AS src_raw, g.ids AS tgt_raw
         FROM enc s JOIN enc g ON s.conv_id = g.conv_id AND s.k = g.k AND s.part = 0 AND g.part = 1),
  t2 AS (SELECT conv_id, k, src_raw[1:{max_source}] AS src, tgt_raw[1:{max_target - 1}] AS tgt,
                len(src_raw) > {max_source} OR len(tgt_raw) > {max_target - 1} AS cut FROM t1),
  t3 AS (SELECT conv_id, k, cut,
                CASE WHEN len(src) > 0 AND src[1] = 2 THEN src[2:] ELSE src END AS src,
                CASE WHEN len(tgt) > 0 AND tgt[len(tgt)] = 2 THEN tgt[1:len(tgt) - 1] ELSE tgt END AS tgt FROM t2),
  t4 AS (SELECT *, len(src) + len(tgt) + 1 AS l,
                sum(len(src) + len(tgt) + 1) OVER (PARTITION BY conv_id ORDER BY k) AS cum FROM t3),
  sft AS (SELECT conv_id,
            coalesce(flatten(list(src || tgt || [2] ORDER BY k) FILTER (WHERE cum <= {max_source + max_target})),
                     []::INTEGER[]) AS input_ids,
            coalesce(flatten(list(list_transform(src, lambda x: -100) || tgt || [2] ORDER BY k)
                             FILTER (WHERE cum <= {max_source + max_target})), []::INTEGER[]) AS labels,
            bool_or(cum - l <= {max_source + max_target} AND cut) AS truncated,
            count(*) FILTER (WHERE cum <= {max_source + max_target}) AS n_turns_kept
          FROM t4 GROUP BY conv_id)
{select}"""


def _digest(col: str) -> str:
    return f"md5(array_to_string(list_transform({col}, lambda x: x::VARCHAR), ','))"


def _pair_sql(max_length: int, where: str = "") -> str:
    return f"""WITH {_vocab_cte('vocab', 'conversations', VOCAB_SIZE_CHAT)},
  u AS (SELECT conv_id, turn, text AS source FROM conversations WHERE role = 'user'),
  a AS (SELECT conv_id, turn - 1 AS turn, text AS target FROM conversations WHERE role = 'assistant'),
  pr AS (SELECT u.conv_id, u.turn, u.source, a.target FROM u JOIN a ON u.conv_id = a.conv_id AND u.turn = a.turn),
  parts AS (SELECT conv_id, turn, 0 AS part, '<s>' || coalesce(source, '') AS x FROM pr
            UNION ALL SELECT conv_id, turn, 1, '<s>' || coalesce(source, '') || coalesce(target, '') || '</s>' FROM pr),
{_encode_cte('enc', 'parts', 'conv_id, turn, part', 'x', 'vocab')},
  t AS (SELECT s.conv_id, s.turn, q.ids AS seq,
               CASE WHEN length(coalesce(pr.source, '')) = 0 THEN q.ids
                    ELSE list_transform(q.ids, lambda x, i: CASE WHEN i <= len(s.ids) THEN -100 ELSE x END) END AS lab
        FROM enc s JOIN enc q ON s.conv_id = q.conv_id AND s.turn = q.turn AND s.part = 0 AND q.part = 1
        JOIN pr ON pr.conv_id = s.conv_id AND pr.turn = s.turn)
SELECT conv_id, turn, len(seq[1:{max_length}])::BIGINT AS seq_length, 'unknown' AS seq_category,
       {_digest(f'seq[1:{max_length}]')} AS ids_md5, {_digest(f'lab[1:{max_length}]')} AS labels_md5 FROM t {where}"""


def _doc_tokens_sql() -> str:
    return f"""{_vocab_cte('vocab', 'documents', VOCAB_SIZE_DOCS)},
{_encode_cte('dtok', 'documents', 'doc_id', 'text', 'vocab')}"""


def _pack_cte(order: str = "doc_id", src: str = "dtok", batch: str = "", rows: int = ROWS_PER_GROUP) -> str:
    extra = f"{batch}, " if batch else ""
    part = f"PARTITION BY {batch} " if batch else ""
    return f"""
  g AS (SELECT {extra}{order} AS ord, d.ids, ((row_number() OVER ({part}ORDER BY {order}) - 1) // {rows}) AS group_id
        FROM {src} d),
  o AS (SELECT *, sum(len(ids)) OVER (PARTITION BY {extra}group_id ORDER BY ord) - len(ids) AS start,
               sum(len(ids)) OVER (PARTITION BY {extra}group_id) AS total FROM g),
  tk AS (SELECT {extra}group_id, total, start + i - 1 AS p, ids[i] AS id
         FROM (SELECT {extra}group_id, total, start, ids, unnest(range(1, len(ids) + 1)) AS i FROM o)),
  blocks AS (SELECT {extra}group_id::BIGINT AS group_id, (p // {BLOCK_SIZE})::BIGINT AS block_id, list(id ORDER BY p) AS ids
             FROM tk WHERE total < {BLOCK_SIZE} OR p < (total // {BLOCK_SIZE}) * {BLOCK_SIZE}
             GROUP BY ALL)"""


_PACK_CTE = _pack_cte()

_TRIPLES = f"""
  tri AS (SELECT conv_id, arg_min(text, turn) FILTER (WHERE role = 'user') AS prompt,
                 arg_min(text, turn) FILTER (WHERE role = 'assistant') AS chosen,
                 arg_max(text, turn) FILTER (WHERE role = 'assistant') AS rejected,
                 count(*) FILTER (WHERE role = 'user') AS nu, count(*) FILTER (WHERE role = 'assistant') AS na
          FROM conversations GROUP BY conv_id),
  pp AS (SELECT conv_id, {q(CHAT_PREFIX)} || {{strip_p}} || {q(CHAT_SUFFIX)} AS prompt,
                {{strip_c}} AS chosen, {{strip_r}} AS rejected FROM tri WHERE na >= 2 AND nu >= 1)"""


def _strip(col: str) -> str:
    return f"regexp_replace({col}, {q(chr(92) + 'A' + WS_CLASS + '+|' + WS_CLASS + '+' + chr(92) + 'z')}, '', 'g')"


def _fmt(n: str, base: int) -> str:
    def one(div, unit):
        return f"printf('%.2f {unit}', {n} / {float(div)})"
    return (f"CASE WHEN {n} >= {base ** 3} THEN {one(base ** 3, 'B')} WHEN {n} >= {base ** 2} THEN {one(base ** 2, 'M')} "
            f"WHEN {n} >= {base} THEN {one(base, 'K')} ELSE {n}::VARCHAR END")


ORACLES = {
    "sft_dialogs": f"""WITH {_dialog_cte()}
SELECT conv_id, count(*)::BIGINT AS n_turns,
       md5(string_agg(source || target, '' ORDER BY k)) AS prompt_md5 FROM turns GROUP BY conv_id""",
    "sft_tokenized": _sft_sql(f"""SELECT conv_id, len(input_ids)::BIGINT AS seq_length, truncated,
       n_turns_kept::BIGINT AS n_turns_kept, {_digest('input_ids')} AS ids_md5, {_digest('labels')} AS labels_md5
FROM sft"""),
    "sft_train_rows": _sft_sql("""SELECT conv_id, len(input_ids)::BIGINT AS seq_length FROM sft
WHERE len(list_filter(labels, lambda x: x <> -100)) > 0 AND NOT truncated""", TIGHT_SOURCE, TIGHT_TARGET),
    "sft_truncation": _sft_sql(f"""SELECT conv_id, len(input_ids)::BIGINT AS seq_length, truncated,
       n_turns_kept::BIGINT AS n_turns_kept, {_digest('input_ids')} AS ids_md5, {_digest('labels')} AS labels_md5
FROM sft""", TIGHT_SOURCE, TIGHT_TARGET),
    "sft_filter_counts": _sft_sql("""SELECT count(*) AS n_before,
       count(*) FILTER (WHERE len(list_filter(labels, lambda x: x <> -100)) > 0 AND NOT truncated) AS n_after FROM sft""",
                                 TIGHT_SOURCE, TIGHT_TARGET),
    "pair_tokenized": _pair_sql(PAIR_MAX_LENGTH),
    "pair_train_rows": _pair_sql(TIGHT_PAIR, f"WHERE len(list_filter(lab[1:{TIGHT_PAIR}], lambda x: x <> -100)) > 0"),
    "packed_blocks": f"""WITH {_doc_tokens_sql()},
{_PACK_CTE}
SELECT group_id, block_id, len(ids)::BIGINT AS n_tokens, {_digest('ids')} AS ids_md5 FROM blocks""",
    "tokens_by_split": f"""WITH {_doc_tokens_sql()},
  s AS (SELECT ids, CASE WHEN ('0x' || substr(md5(doc_id::VARCHAR || ':{SEED}'), 1, 8))::BIGINT % 10000
                       < {VALIDATION_PCT * 100} THEN 'validation' ELSE 'train' END AS split FROM dtok)
SELECT split, count(*) AS n_rows, sum(len(ids))::BIGINT AS n_tokens FROM s GROUP BY split""",
    "head_split": f"""SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY doc_id) - 1 <
       (SELECT round_even(count(*) * {VALIDATION_PCT} / 100.0, 0) FROM documents) THEN 'validation' ELSE 'train' END AS split
FROM documents""",
    "shuffle_order": f"""SELECT doc_id, row_number() OVER (ORDER BY md5(doc_id::VARCHAR || ':{SEED}')) - 1 AS shuffle_pos
FROM documents""",
    "take_docs": "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 100",
    "preferences": "WITH " + _TRIPLES.format(strip_p=_strip("prompt"), strip_c=_strip("chosen"),
                                               strip_r=_strip("rejected")) + f"""
SELECT conv_id, length(prompt)::BIGINT AS prompt_len, md5(prompt) AS prompt_md5, md5(chosen) AS chosen_md5,
       md5(rejected) AS rejected_md5 FROM pp
WHERE length(prompt) + length(chosen) BETWEEN 1 AND {DPO_MAX_SOURCE + DPO_MAX_TARGET}
  AND length(prompt) + length(rejected) BETWEEN 1 AND {DPO_MAX_SOURCE + DPO_MAX_TARGET}""",
    "preferences_tight": "WITH " + _TRIPLES.format(strip_p=_strip("prompt"), strip_c=_strip("chosen"),
                                                     strip_r=_strip("rejected")) + f"""
SELECT conv_id, length(prompt)::BIGINT AS prompt_len, md5(prompt) AS prompt_md5, md5(chosen) AS chosen_md5,
       md5(rejected) AS rejected_md5, row_number() OVER (ORDER BY md5(conv_id::VARCHAR || ':{SEED}')) - 1 AS rank FROM pp
WHERE length(prompt) + length(chosen) BETWEEN 1 AND {DPO_TIGHT_SOURCE + DPO_TIGHT_TARGET}
  AND length(prompt) + length(rejected) BETWEEN 1 AND {DPO_TIGHT_SOURCE + DPO_TIGHT_TARGET}""",
    "preferences_eval": "WITH " + _TRIPLES.format(strip_p=_strip("prompt"), strip_c=_strip("chosen"),
                                                    strip_r=_strip("rejected")) + f"""
SELECT conv_id, length(prompt)::BIGINT AS prompt_len, md5(prompt) AS prompt_md5, md5(chosen) AS chosen_md5,
       md5(rejected) AS rejected_md5 FROM (SELECT * FROM pp ORDER BY conv_id LIMIT 20)
WHERE length(prompt) + length(chosen) BETWEEN 1 AND {DPO_MAX_SOURCE + DPO_MAX_TARGET}
  AND length(prompt) + length(rejected) BETWEEN 1 AND {DPO_MAX_SOURCE + DPO_MAX_TARGET}""",
    "pretrain_blocks": f"""WITH {_doc_tokens_sql()},
{_pack_cte(f"md5(doc_id::VARCHAR || ':{SEED}')")}
SELECT group_id, block_id, len(ids)::BIGINT AS n_tokens, {_digest('ids')} AS ids_md5, len(ids)::BIGINT AS n_attended
FROM blocks""",
    "sft_instructions": f"""WITH u AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user'),
  a AS (SELECT conv_id, turn - 1 AS turn, text FROM conversations WHERE role = 'assistant'),
  r AS (SELECT u.conv_id, u.turn, u.text || chr(10) || chr(10) || CASE WHEN u.turn % 2 = 0 THEN ' note ' || u.turn ELSE '' END AS h,
               ' ' || a.text || chr(10) AS b FROM u JOIN a ON u.conv_id = a.conv_id AND u.turn = a.turn)
SELECT conv_id, turn, md5({q(_TEMPLATE_SQL['vicuna'][0] + 'USER: ')} || {_strip('h')} || ' ASSISTANT: ' || {_strip('b')}) AS prompt_md5
FROM r""",
    "sft_json_strings": f"""WITH readable AS (SELECT * FROM conversations WHERE conv_id % 7 <> 6),
{_dialog_cte('readable').lstrip()}
SELECT conv_id, count(*)::BIGINT AS n_turns,
       md5(string_agg(source || target, '' ORDER BY k)) AS prompt_md5 FROM turns GROUP BY conv_id""",
    "sft_templates": f"""WITH {_dialog_cte()},
  tpl(template, first, before, after, sep) AS (VALUES {', '.join('(' + ', '.join(q(x) for x in (n, *v)) + ')' for n, v in _TEMPLATE_SQL.items())}),
  pr AS (SELECT conv_id, v, unnest(range(0, len(v) // 2)) AS k FROM dlg)
SELECT conv_id, template, md5(string_agg(CASE WHEN k = 0 THEN first ELSE sep END || before || v[2 * k + 1] || after
                                         || v[2 * k + 2], '' ORDER BY k)) AS prompt_md5
FROM pr, tpl GROUP BY conv_id, template""",
    "sft_appended": f"""WITH {_dialog_cte()}
SELECT conv_id, count(*)::BIGINT + 1 AS n_turns, md5(string_agg(source || target, '' ORDER BY k)
       || '</s>USER: and ' || conv_id || '? ASSISTANT: yes') AS prompt_md5 FROM turns GROUP BY conv_id""",
    "pad_right": _sft_sql(f"""SELECT conv_id, {RIGHT_PAD}::BIGINT AS padded_len,
       {_digest(f'list_resize(input_ids[1:{RIGHT_PAD}], {RIGHT_PAD}, 0)')} AS ids_md5,
       {_digest(f'list_resize(labels[1:{RIGHT_PAD}], {RIGHT_PAD}, -100)')} AS labels_md5,
       len(list_filter(input_ids[1:{RIGHT_PAD}], lambda x: x <> 0))::BIGINT AS n_attended FROM sft"""),
    "pad_to_longest": _sft_sql(f""", b AS (SELECT conv_id, input_ids, labels,
           (row_number() OVER (ORDER BY conv_id) - 1) // {PAD_BATCH} AS batch FROM sft),
  mx AS (SELECT *, max(len(input_ids)) OVER (PARTITION BY batch) AS m FROM b)
SELECT conv_id, m::BIGINT AS padded_len, {_digest('list_resize(input_ids, m, 0)')} AS ids_md5,
       {_digest('list_resize(labels, m, -100)')} AS labels_md5,
       len(list_filter(input_ids, lambda x: x <> 0))::BIGINT AS n_attended FROM mx""").replace("\n, b AS", ",\n  b AS"),
    "argmax_embeddings": """SELECT vec_id, (list_position(embedding, list_max(embedding)) - 1)::INTEGER AS argmax
FROM embeddings""",
    "token_accuracy": f"""WITH {_doc_tokens_sql()},
{_PACK_CTE},
  m AS (SELECT len(ids) - 1 AS total,
               len(list_filter(range(1, len(ids)), lambda i: ids[i] = ids[i + 1])) AS hits FROM blocks)
SELECT sum(hits) / sum(total) AS accuracy FROM m""",
    "unigram_perplexity": f"""WITH {_doc_tokens_sql()},
  flat AS (SELECT d.doc_id, unnest(d.ids) AS id FROM dtok d),
  c AS (SELECT id, count(*) AS n FROM flat GROUP BY id),
  lp AS (SELECT id, ln(n) - ln(sum(n) OVER ()) AS logp FROM c),
  loss AS (SELECT f.doc_id, -avg(lp.logp) AS loss FROM flat f JOIN lp USING (id) GROUP BY f.doc_id)
SELECT d.lang, round(exp(avg(loss.loss)), 6) AS perplexity FROM loss JOIN documents d USING (doc_id) GROUP BY d.lang""",
    "format_token_counts": f"""WITH {_doc_tokens_sql()},
  agg AS (SELECT d.lang, sum(len(t.ids))::BIGINT AS n_tokens FROM dtok t JOIN documents d USING (doc_id) GROUP BY d.lang)
SELECT lang, n_tokens, {_fmt('n_tokens', 1000)} AS tokens_1000, {_fmt('n_tokens', 1024)} AS tokens_1024 FROM agg""",
    "pad_left": _sft_sql(f""", b AS (SELECT conv_id, input_ids, labels,
           (row_number() OVER (ORDER BY conv_id) - 1) // {PAD_BATCH} AS batch FROM sft),
  mx AS (SELECT *, max(len(input_ids)) OVER (PARTITION BY batch) AS mi, max(len(labels)) OVER (PARTITION BY batch) AS ml
         FROM b),
  pd AS (SELECT conv_id, list_resize([]::INTEGER[], mi - len(input_ids), 0) || input_ids AS ids,
                list_resize([]::INTEGER[], ml - len(labels), -100) || labels AS lab FROM mx)
SELECT conv_id, len(ids)::BIGINT AS padded_len, {_digest('ids')} AS ids_md5, {_digest('lab')} AS labels_md5,
       len(list_filter(ids, lambda x: x <> 0))::BIGINT AS n_attended FROM pd""").replace("\n, b AS", ",\n  b AS"),
    "decode_labels": _sft_sql(""", vv AS (SELECT tok, id FROM vocab),
  lab AS (SELECT conv_id, unnest(labels) AS id, unnest(range(1, len(labels) + 1)) AS pos FROM sft),
  dec AS (SELECT l.conv_id, string_agg(v.tok, '|' ORDER BY l.pos) AS txt
          FROM lab l JOIN vv v ON v.id = CASE WHEN l.id = -100 THEN 0 ELSE l.id END GROUP BY l.conv_id)
SELECT s.conv_id, md5(coalesce(d.txt, '')) AS decoded_md5 FROM sft s LEFT JOIN dec d ON s.conv_id = d.conv_id"""
                              ).replace("\n, vv AS", ",\n  vv AS"),
}
