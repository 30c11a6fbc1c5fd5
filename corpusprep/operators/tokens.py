"""Tokenization, vocabularies, label masking and turn budgets.

The tokenizer is pluggable. The built-in one cuts text into pieces with one
regular expression evaluated JVM-side (special tokens, letter/digit runs,
single symbols; or single characters), and maps pieces to ids with a
vocabulary built from the corpus. Only the piece -> id lookup crosses to
Python: an Arrow-batched iterator UDF that flattens a whole batch and does one
vectorized hash lookup (the vocabulary is a broadcast variable, loaded once
per task). A user's own encoder plugs in the same way (``encoder_udf``).

Everything after the ids (BOS/EOS handling, truncation, turn budget, label
masking) is array arithmetic in higher-order functions, row-local.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import WS_CLASS, col_, let, materialize_column, text_slices
from ..session import materialize

IGNORE_INDEX = -100
DEFAULT_SPECIALS = ("<unk>", "<s>", "</s>")


def _re_escape(s: str) -> str:
    return "".join("\\" + c if c in r"\.^$|?*+()[]{}" else c for c in s)


def piece_pattern(specials: Sequence[str] = DEFAULT_SPECIALS, mode: str = "word") -> str:
    """Regex whose successive matches are the pieces of a text."""
    alts = [_re_escape(s) for s in sorted(set(specials), key=lambda x: (-len(x), x))]
    ws_inner = WS_CLASS[1:-1]
    if mode == "word":
        alts += [r"[\p{L}\p{N}]+", rf"[^\p{{L}}\p{{N}}{ws_inner}]"]
    elif mode == "character":
        alts += [rf"[^{ws_inner}]"]
    else:
        raise ValueError(mode)
    return "(" + "|".join(alts) + ")"


def pieces(text: str | Column, specials: Sequence[str] = DEFAULT_SPECIALS, mode: str = "word") -> Column:
    return F.regexp_extract_all(col_(text), F.lit(piece_pattern(specials, mode)), 1)


# ------------------------------------------------------------------ vocabulary

@dataclass
class Vocabulary:
    """id -> token (index = id); specials first."""

    tokens: list[str]
    specials: tuple[str, ...] = DEFAULT_SPECIALS
    mode: str = "word"
    unk_token: str | None = "<unk>"
    bos_token: str | None = "<s>"
    eos_token: str | None = "</s>"
    pad_token: str | None = None

    def __post_init__(self):
        self._index = {t: i for i, t in enumerate(self.tokens)}
        self._bcast = None

    def __len__(self) -> int:
        return len(self.tokens)

    def id_of(self, token: str | None) -> int | None:
        return None if token is None else self._index.get(token)

    @property
    def unk_id(self) -> int | None:
        return self.id_of(self.unk_token)

    @property
    def bos_id(self) -> int | None:
        return self.id_of(self.bos_token)

    @property
    def eos_id(self) -> int | None:
        return self.id_of(self.eos_token)

    @property
    def pad_id(self) -> int | None:
        return self.id_of(self.pad_token)

    def add_special(self, token: str) -> int:
        """Append a special token (e.g. a template's stop string) and return its id."""
        if token not in self._index:
            self._index[token] = len(self.tokens)
            self.tokens.append(token)
            self.specials = tuple(self.specials) + (token,)
            self._bcast = None
        return self._index[token]

    def pieces(self, text: str | Column) -> Column:
        return pieces(text, self.specials, self.mode)

    def broadcast(self, spark):
        if self._bcast is None:
            self._bcast = spark.sparkContext.broadcast(list(self.tokens))
        return self._bcast

    # -- encode / decode ------------------------------------------------------
    def encode(self, spark, text: str | Column) -> Column:
        """text -> array<int> (unknown pieces -> unk id)."""
        return _lookup_udf(self.broadcast(spark), self.unk_id if self.unk_id is not None else -1)(self.pieces(text))

    def encode_many(self, spark, texts: Column) -> Column:
        """array<string> of texts -> array<array<int>> (one id array per text)."""
        return _lookup_nested_udf(self.broadcast(spark), self.unk_id if self.unk_id is not None else -1)(
            F.transform(texts, lambda t: self.pieces(t)))

    def decode(self, spark, ids: str | Column, sep: str = " ") -> Column:
        """array<int> -> text (pieces joined by ``sep``); ids outside the vocabulary give ``<?>``."""
        return _decode_udf(self.broadcast(spark), sep)(col_(ids))


def decode_ids(df: DataFrame, vocab: Vocabulary, ids: Column, out_col: str = "text", sep: str = " ") -> DataFrame:
    """Add the decoded text of an id-array expression (ids materialized first, then one Arrow stage)."""
    staged = materialize_column(df, "_dec_ids", ids)
    return staged.withColumn(out_col, vocab.decode(df.sparkSession, F.col("_dec_ids"), sep)).drop("_dec_ids")


#: Pieces that one task's sketch counts, and candidates that a recount may have.
SKETCH_PIECES, MAX_CANDIDATES = 1 << 20, 1 << 22


def _frequent(batches: Iterator[pa.RecordBatch], capacity: int) -> Iterator[pa.RecordBatch]:
    """(tok, n, lost): lower bounds of the counts of at most ``capacity`` pieces of a task, and by how much they may be short.

    Misra-Gries with batched decrements: above twice the capacity, the count after the ``capacity`` largest is taken
    off all, which is what a piece outside the sketch may have had at most. A null ``tok`` row carries ``lost``.
    """
    counts: dict[str, int] = {}
    lost = 0

    def shrink() -> int:
        cut = int(np.partition(np.fromiter(counts.values(), np.int64, len(counts)), len(counts) - capacity - 1)[len(counts) - capacity - 1])
        for t in [t for t, n in counts.items() if n <= cut]:
            del counts[t]
        for t in counts:
            counts[t] -= cut
        return cut

    for batch in batches:
        found = pc.value_counts(batch.column(0))
        for t, n in zip(found.field(0).to_pylist(), found.field(1).to_pylist()):
            counts[t] = counts.get(t, 0) + n
        if len(counts) > 2 * capacity:
            lost += shrink()
    if len(counts) > capacity:
        lost += shrink()
    yield pa.RecordBatch.from_arrays([pa.array([None, *counts], pa.string()), pa.array([0, *counts.values()], pa.int64()),
                                      pa.array([lost] + [0] * len(counts), pa.int64())], names=["tok", "n", "lost"])


def top_pieces(toks: DataFrame, k: int, capacity: int = SKETCH_PIECES, max_candidates: int = MAX_CANDIDATES) -> list[str]:
    """The ``k`` most frequent values of the string column ``tok``, by (count desc, value asc); exact.

    A sketch per task bounds what is shuffled. Where no sketch overflowed its counts are exact. Else the bounds give
    the candidates, which are counted again; where the bounds cannot tell (the k-th count is no larger than what the
    sketches lost, or there are too many candidates) all values are counted.
    """
    best = lambda df: df.orderBy(F.desc("n"), F.asc("tok")).limit(k)
    if k <= 0:
        return []
    sketch = materialize(toks.where(F.col("tok").isNotNull()).mapInArrow(lambda it: _frequent(it, capacity), "tok string, n long, lost long"), "frequent")
    lost = sketch.agg(F.sum("lost")).first()[0] or 0
    lower = sketch.where(F.col("tok").isNotNull()).groupBy("tok").agg(F.sum("n").alias("n"))
    if not lost:
        return [r["tok"] for r in best(lower).collect()]
    lower = materialize(lower, "lower-bounds")
    top = best(lower).agg(F.min("n"), F.count(F.lit(1))).first()
    counted = toks
    if top[1] == k and top[0] > lost:
        candidates = lower.where(F.col("n") + lost >= top[0]).select("tok")
        if candidates.count() <= max_candidates:  # a bound for the broadcast
            counted = toks.join(F.broadcast(candidates), "tok", "left_semi")
    return [r["tok"] for r in best(counted.where(F.col("tok").isNotNull()).groupBy("tok").agg(F.count(F.lit(1)).alias("n"))).collect()]


def build_vocabulary(df: DataFrame, text_col: str = "text", size: int = 32000,
                     specials: Sequence[str] = DEFAULT_SPECIALS, mode: str = "word") -> Vocabulary:
    """The ``size - len(specials)`` most frequent pieces (count desc, piece asc) after the specials.

    Only those pieces reach the driver; see ``top_pieces`` for how they are counted.
    """
    k = size - len(specials)
    if k < 0:
        raise ValueError("size must cover the special tokens")
    toks = df.select(F.explode(pieces(text_col, specials, mode)).alias("tok")).where(~F.col("tok").isin(list(specials)))
    return Vocabulary(list(specials) + top_pieces(toks, k), tuple(specials), mode)


# ------------------------------------------------------------------ UDFs

def _lookup_flat(lists: pa.Array, index: pa.Array, unk: int) -> tuple[np.ndarray, pa.Array]:
    """(ends of the lists from 0, ids of all their pieces); a null list is empty. Pieces stay in Arrow's buffers."""
    ends = np.cumsum([0, *pc.fill_null(pc.list_value_length(lists), 0).to_numpy()]).astype(np.int32)
    return ends, pc.fill_null(pc.index_in(lists.flatten(), value_set=index), unk).cast(pa.int32())


def _lists(ends: np.ndarray, values: pa.Array, null: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends), values, mask=null if len(null) else None)


def _lookup_udf(bc, unk: int):
    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def lookup(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = pa.array(bc.value, pa.string())
        for a in batches:
            yield _lists(*_lookup_flat(a, index, unk), a.is_null())

    # non-deterministic only so that Catalyst keeps the UDF in its own projection
    # instead of inlining it into a consumer's lambda, where it cannot run
    return lookup.asNondeterministic()


def _lookup_nested_udf(bc, unk: int):
    @F.arrow_udf(T.ArrayType(T.ArrayType(T.IntegerType())))
    def lookup(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = pa.array(bc.value, pa.string())
        for a in batches:
            ends, ids = _lookup_flat(a.flatten(), index, unk)
            outer = np.cumsum([0, *pc.fill_null(pc.list_value_length(a), 0).to_numpy()]).astype(np.int32)
            yield _lists(outer, pa.ListArray.from_arrays(pa.array(ends), ids), a.is_null())

    return lookup.asNondeterministic()


def _decode_udf(bc, sep: str):
    @F.pandas_udf(T.StringType())
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        toks = np.array(list(bc.value) + ["<?>"], dtype=object)
        n = len(toks) - 1
        for s in batches:
            out = []
            for a in s:
                if a is None:
                    out.append(None)
                    continue
                ids = np.asarray(a, dtype=np.int64)
                ids = np.where((ids >= 0) & (ids < n), ids, n)
                out.append(sep.join(toks[ids]))
            yield pd.Series(out, dtype=object)

    return decode


def encoder_udf(make_encoder: Callable[[], Callable[[list[str]], list[list[int]]]]):
    """Wrap a user's batch encoder (built once per task, e.g. a BPE tokenizer) as a column function."""

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def enc(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = make_encoder()
        for a in batches:
            # an encoder's lists of ints take many times the text's memory: only a slice's are held as such
            done = [pa.array(encode(t), pa.list_(pa.int32()), from_pandas=True) for t in text_slices(a)]
            yield pa.concat_arrays(done) if done else pa.array([], pa.list_(pa.int32()))

    return enc


# ------------------------------------------------------------------ special tokens

def preference_pad_id(vocab: Vocabulary) -> int:
    """The pad id of preference training: the vocabulary's own, 0 where it has none."""
    return 0 if vocab.pad_id is None else vocab.pad_id


def resolve_special_tokens(vocab: Vocabulary, template=None) -> Vocabulary:
    """EOS = the template's stop string when missing (or for ``yi``); pad = unk, else EOS."""
    if template is not None and (vocab.eos_id is None or template.name == "yi"):
        vocab.add_special(template.stop_str)
        vocab.eos_token = template.stop_str
    if vocab.pad_id is None:
        vocab.pad_token = vocab.unk_token if vocab.unk_id is not None else vocab.eos_token
    return vocab


# ------------------------------------------------------------------ SFT encoding

def encode_dialog(ids: Column, bos_id: int | None, eos_id: int, max_source_length: int,
                  max_target_length: int, ignore_index: int = IGNORE_INDEX) -> Column:
    """Token ids and labels of a rendered dialog.

    ``ids``: array<array<int>> = [source0, target0, source1, target1, ...] (encoded
    without special tokens). Per turn: BOS before source 0 only; source cut to
    ``max_source_length``, target to ``max_target_length - 1`` (either cut sets
    ``truncated``); a leading EOS leaves the source and a trailing EOS leaves the
    target. Turns are appended while the running length (source + target + 1)
    stays within ``max_source_length + max_target_length``: since the running
    sum only grows, ``cum <= max`` is the first-overflow break. ``truncated``
    counts cuts of every turn that was reached, the breaking one included.
    Result: struct<input_ids, labels, seq_length, truncated, n_turns_kept>.
    """
    max_len = max_source_length + max_target_length
    bos = F.array(F.lit(bos_id)) if bos_id is not None else F.array().cast("array<int>")
    eos = F.lit(eos_id)

    def cut_turn(k, all_ids):
        src_raw = F.element_at(all_ids, (2 * k + 1).cast("int"))
        src_raw = F.when(k == 0, F.concat(bos, src_raw)).otherwise(src_raw)
        tgt_raw = F.element_at(all_ids, (2 * k + 2).cast("int"))
        return F.struct(
            F.slice(src_raw, 1, max_source_length).alias("src"),
            F.slice(tgt_raw, 1, max_target_length - 1).alias("tgt"),
            ((F.size(src_raw) > max_source_length) | (F.size(tgt_raw) > max_target_length - 1)).alias("cut"))

    def strip_eos(t):
        src, tgt = t["src"], t["tgt"]
        src2 = F.when((F.size(src) > 0) & (F.element_at(src, 1) == eos), F.slice(src, 2, F.size(src) - 1)) \
            .otherwise(src)
        tgt2 = F.when((F.size(tgt) > 0) & (F.element_at(tgt, -1) == eos), F.slice(tgt, 1, F.size(tgt) - 1)) \
            .otherwise(tgt)
        return F.struct(src2.alias("src"), tgt2.alias("tgt"), t["cut"].alias("cut"))

    def with_budget(turns):
        # one fold carries the running length; a turn is reached if the turns before it fit
        def step(acc, t):
            upto = acc["upto"] + F.size(t["src"]) + F.size(t["tgt"]) + 1
            kept = (upto <= max_len).alias("kept")
            reached = (acc["upto"] <= max_len).alias("reached")
            return F.struct(upto.alias("upto"), F.concat(acc["flags"], F.array(F.struct(kept, reached))).alias("flags"))

        start = F.struct(F.lit(0).alias("upto"), F.expr("array()").cast("array<struct<kept:boolean,reached:boolean>>").alias("flags"))
        flags = F.aggregate(F.transform(turns, lambda t: F.struct(t["src"].alias("src"), t["tgt"].alias("tgt"))), start, step,
                            lambda acc: acc["flags"])
        return let(flags, lambda f: F.zip_with(turns, f, lambda t, x: F.struct(
            t["src"].alias("src"), t["tgt"].alias("tgt"), t["cut"].alias("cut"),
            x["kept"].alias("kept"), x["reached"].alias("reached"))))

    def assemble(turns):
        kept = F.filter(turns, lambda t: t["kept"])
        input_ids = F.flatten(F.transform(kept, lambda t: F.concat(t["src"], t["tgt"], F.array(eos))))
        labels = F.flatten(F.transform(kept, lambda t: F.concat(
            F.array_repeat(F.lit(ignore_index), F.size(t["src"])), t["tgt"], F.array(eos))))
        truncated = F.exists(turns, lambda t: t["reached"] & t["cut"])
        return F.struct(input_ids.alias("input_ids"), labels.alias("labels"),
                        F.size(input_ids).alias("seq_length"), truncated.alias("truncated"),
                        F.size(kept).alias("n_turns_kept"))

    def body(all_ids):
        n_turns = (F.size(all_ids) / 2).cast("int")
        turns = F.transform(F.sequence(F.lit(0), n_turns - 1), lambda k: strip_eos(cut_turn(k, all_ids)))
        return let(let(turns, with_budget), assemble)

    return let(ids, body)


def tokenize_dialogs(df: DataFrame, vocab: Vocabulary, dialog_col: str = "dialog", max_source_length: int = 256,
                     max_target_length: int = 256, ignore_index: int = IGNORE_INDEX) -> DataFrame:
    """Rendered dialogs -> (input_ids, labels, seq_length, truncated, n_turns_kept) plus the other columns."""
    spark = df.sparkSession
    texts = F.flatten(F.transform(F.col(dialog_col), lambda d: F.array(d["source"], d["target"])))
    staged = materialize_column(df, "_texts", texts)
    staged = staged.withColumn("_ids", vocab.encode_many(spark, F.col("_texts"))).drop("_texts")
    enc = encode_dialog(F.col("_ids"), vocab.bos_id, vocab.eos_id, max_source_length, max_target_length,
                        ignore_index)
    return staged.withColumn("_enc", enc).select(
        *[c for c in df.columns if c != dialog_col], "_enc.input_ids", "_enc.labels", "_enc.seq_length",
        "_enc.truncated", "_enc.n_turns_kept")


def drop_truncated(df: DataFrame, flag: bool = True) -> DataFrame:
    return df.where(~F.col("truncated")) if flag else df


def filter_empty_labels(df: DataFrame, ignore_index: int = IGNORE_INDEX) -> DataFrame:
    """Drop rows whose labels are all ignored (an empty label list drops too)."""
    return df.where(F.exists("labels", lambda x: x != F.lit(ignore_index)))


# ------------------------------------------------------------------ paired text

def tokenize_pair(df: DataFrame, vocab: Vocabulary, max_length: int = 4096, source_col: str = "source",
                  target_col: str = "target", category_col: str = "category",
                  ignore_index: int = IGNORE_INDEX) -> DataFrame:
    """Pre-training pairs: ids of BOS+source+target+EOS; labels mask the BOS+source ids unless source is empty.

    Emits input_ids, labels, seq_length, seq_category.
    """
    spark = df.sparkSession
    bos, eos = vocab.bos_token or "", vocab.eos_token or ""
    src, tgt = F.coalesce(F.col(source_col), F.lit("")), F.coalesce(F.col(target_col), F.lit(""))
    texts = F.array(F.concat(F.lit(bos), src), F.concat(F.lit(bos), src, tgt, F.lit(eos)))
    staged = df.withColumn("_ids", vocab.encode_many(spark, texts)).withColumn("_null_src", F.length(src) == 0)

    def body(ids):
        src_ids, seq = F.element_at(ids, 1), F.element_at(ids, 2)
        n_src = F.size(src_ids)
        labels = F.when(F.col("_null_src"), seq).otherwise(
            F.transform(seq, lambda x, i: F.when(i < n_src, F.lit(ignore_index)).otherwise(x)))
        return F.struct(F.slice(seq, 1, max_length).alias("input_ids"),
                        F.slice(labels, 1, max_length).alias("labels"))

    cat = F.coalesce(F.col(category_col), F.lit("unknown")) if category_col in df.columns else F.lit("unknown")
    out = staged.withColumn("_t", let(F.col("_ids"), body))
    return out.select(F.col("_t.input_ids").alias("input_ids"), F.col("_t.labels").alias("labels"),
                      F.size("_t.input_ids").alias("seq_length"), cat.alias("seq_category"),
                      *[c for c in df.columns if c not in (source_col, target_col, category_col)])


def tokenize_text(df: DataFrame, vocab: Vocabulary, text_col: str = "text", out_col: str = "input_ids") -> DataFrame:
    """Plain text -> ids (no special tokens)."""
    return df.withColumn(out_col, vocab.encode(df.sparkSession, F.col(text_col)))
