"""Per-document quality statistics and filters (recipe operators).

Every statistic is a column expression evaluated row-locally, so a chain of
filters fuses into one scan stage and never shuffles. The character
repetition ratio is the one statistic that needs a per-document histogram;
it runs as an Arrow-batched pandas UDF with numpy inside.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import code_points, col_, slices, text_slices
from ..session import drop_materialized, materialize_sparing


# ---------------------------------------------------------------- null text

def remove_null_text(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Keep rows whose text is a non-null string; everything passes without the column."""
    if text_col not in df.columns:
        return df
    if not isinstance(df.schema[text_col].dataType, T.StringType):
        return df.where(F.lit(False))
    return df.where(F.col(text_col).isNotNull())


# ---------------------------------------------------------------- alphanumeric

def alphanumeric_ratio(text: str | Column) -> Column:
    """Alphanumeric characters / characters; 0.0 for empty text."""
    t = col_(text)
    n = F.length(t)
    others = F.length(F.regexp_replace(t, r"[\p{L}\p{N}]+", ""))  # the few that are left are cheaper to write
    return F.when(n > 0, (n - others) / n).otherwise(F.lit(0.0)).cast("double")


def alphanumeric_filter(df: DataFrame, text_col: str = "text", min_ratio: float = 0.25,
                        max_ratio: float = float("inf"), tokenization: bool = False) -> DataFrame:
    if tokenization:
        raise NotImplementedError("token-based alphanumeric ratio needs a tokenizer; use tokenization=False")
    r = alphanumeric_ratio(text_col)
    return df.where((r >= F.lit(min_ratio)) & (r <= F.lit(max_ratio)))


# ---------------------------------------------------------------- repetition

def _ranked(v: np.ndarray) -> tuple[np.ndarray, int]:
    distinct, rank = np.unique(v, return_inverse=True)
    return rank.astype(np.int64), len(distinct)


def _ngram_ranks(cps: np.ndarray, rep_len: int) -> tuple[np.ndarray, int]:
    """An integer per n-gram, equal for equal n-grams, and what all are below.

    Numbers of two halves are put together as digits; they are ranked (a sort) only where that would overflow.
    """
    known = np.zeros(int(cps.max()) + 1, dtype=bool)
    known[cps] = True
    rank, below, size = (np.cumsum(known) - 1)[cps], int(known.sum()), 1
    while size < rep_len:
        step = min(size, rep_len - size)  # the halves overlap where this is below size
        if below * below >= 1 << 62:
            rank, below = _ranked(rank)
        rank, below, size = rank[:-step] * below + rank[step:], below * below, size + step
    return rank, below


def _top_shares(doc: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
    """The ratio of each of ``n`` texts, from its n-grams' counts (a text's lie together)."""
    distinct, total = np.bincount(doc, minlength=n), np.bincount(doc, count, n)
    more = np.flatnonzero(count > 1)  # the top k are all among these
    doc, count = doc[more], count[more]
    repeated = np.bincount(doc, minlength=n)
    k = np.minimum(np.floor(np.sqrt(distinct)).astype(np.int64), repeated)
    order = np.lexsort((-count, doc))
    doc, count = doc[order], count[order]
    place = np.arange(len(doc)) - np.repeat(np.cumsum(repeated) - repeated, repeated)
    top = np.bincount(doc, np.where(place < k[doc], count, 0), n)
    return np.divide(top, total, out=np.zeros(n), where=total > 0)


def _ratios_by_rank(texts: list[str], rep_len: int) -> np.ndarray:
    """The ratio of every text, whatever its characters, in one pass over all their code points."""
    out = np.zeros(len(texts))
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    cps = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if cps.size < rep_len:
        return out
    rank, below = _ngram_ranks(cps, rep_len)
    if below * len(texts) >= 1 << 62:
        rank, below = _ranked(rank)
    doc = np.repeat(np.arange(len(texts)), size)[:len(rank)]
    end = np.cumsum(size)
    own = np.arange(len(rank)) + rep_len <= end[doc]  # n-grams that do not run into the next text
    doc, rank = doc[own], rank[own]
    if doc.size == 0:
        return out
    gram, count = np.unique(doc * below + rank, return_counts=True)
    return _top_shares(gram // below, count, len(texts))


#: Bytes of the texts whose n-grams are counted together: their work arrays, of eight times that, stay in the processor's cache.
COUNTED = 1 << 17
#: Entries (texts times characters) of the table that gives every text's characters numbers of their own.
NUMBERED = 1 << 23


def _repetition_ratios(texts: list[str], rep_len: int) -> np.ndarray:
    """The ratio of every text of a slice.

    An n-gram of a text with few enough different characters is one 64-bit number, its characters' numbers in that
    text as digits; these are sorted text by text. Other texts have their n-grams ranked.
    """
    out = np.zeros(len(texts))
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    cps = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if cps.size < rep_len:
        return out
    known = np.zeros(int(cps.max()) + 1, dtype=bool)
    known[cps] = True
    number, n = (np.cumsum(known) - 1)[cps], int(known.sum())
    if n * len(texts) > NUMBERED:
        return _ratios_by_rank(texts, rep_len)
    doc = np.repeat(np.arange(len(texts)), size)
    seen = np.zeros((len(texts), n), dtype=bool)
    seen.ravel()[doc * n + number] = True
    digit = (np.cumsum(seen, axis=1, dtype=np.int64) - 1).ravel()[doc * n + number].astype(np.uint64)
    base = seen.sum(axis=1).astype(np.uint64)
    most = int(2 ** (64 / rep_len)) + 1  # digits up to here make n-grams of under 2**64
    while most ** rep_len > 1 << 64:
        most -= 1
    radix = base[doc]
    code, times, done = digit, radix, 1
    for bit in bin(rep_len)[3:]:  # numbers of two halves put together, and one digit more where the length is odd
        code = code[:-done] * times[:len(code) - done] + code[done:]
        times, done = times * times, done * 2
        if bit == "1":
            code = code[:-1] * radix[:len(code) - 1] + digit[done:]
            times, done = times * radix, done + 1
    packed = (base <= most) & (size >= rep_len)
    start = np.cumsum(size) - size
    for lo, hi in zip(start[packed].tolist(), (start + size - rep_len + 1)[packed].tolist()):
        code[lo:hi].sort()
    grams = np.where(packed, size - rep_len + 1, 0)
    own = np.repeat(start - np.cumsum(grams) + grams, grams) + np.arange(grams.sum())  # n-grams that do not run into the next text
    code, doc = code[own], np.repeat(np.arange(len(texts)), grams)
    if code.size:
        first = np.flatnonzero(np.append(True, (code[1:] != code[:-1]) | (doc[1:] != doc[:-1])))
        out = _top_shares(doc[first], np.diff(np.append(first, len(code))), len(texts))
    ranked = np.flatnonzero((base > most) & (size >= rep_len))
    if ranked.size:
        out[ranked] = _ratios_by_rank([texts[i] for i in ranked], rep_len)
    return out


def character_repetition_ratio(text: str | Column, rep_len: int = 10) -> Column:
    """Share of character n-gram occurrences held by the top-k most frequent n-grams.

    k = min(floor(sqrt(#distinct n-grams)), #n-grams seen more than once); text
    shorter than ``rep_len`` characters has ratio 0.
    """

    @F.arrow_udf(T.DoubleType())
    def _ratio(texts: pa.Array) -> pa.Array:
        done = [_repetition_ratios(t, rep_len) for t in text_slices(texts, COUNTED)]
        return pa.array(np.concatenate(done) if done else [], pa.float64())

    return _ratio(col_(text))


def character_repetition_filter(df: DataFrame, text_col: str = "text", rep_len: int = 10,
                                min_ratio: float = 0.0, max_ratio: float = 0.5) -> DataFrame:
    r = character_repetition_ratio(text_col, rep_len)
    return df.where((r >= F.lit(min_ratio)) & (r <= F.lit(max_ratio)))


# ---------------------------------------------------------------- flagged words

#: Kept for callers that set it: lists of any length take the same lookup.
PLAN_WORDS = 1000


def word_tokens(text: str | Column, mode: str = "word") -> Column:
    """Tokens for the flagged-word ratio: lower-cased letter/digit runs, or characters."""
    t = F.lower(col_(text))
    if mode == "character":
        return F.filter(code_points(t), lambda c: F.regexp_like(c, F.lit(r"[\p{L}\p{N}]")))
    return F.regexp_extract_all(t, F.lit(r"([\p{L}\p{N}]+)"), 1)


def _shares(hits: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.minimum(np.divide(hits, n, out=np.zeros(len(n)), where=n > 0), 1.0)


def _word_shares(texts: pa.Array, known: pa.Array, use_words_aug: bool) -> np.ndarray:
    """The ratio of every row of an Arrow array of texts whose tokens are parted by single spaces, on all their tokens at once."""
    tokens = pc.split_pattern(texts, " ")
    n = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy().astype(np.int64)
    n[pc.fill_null(pc.equal(texts, ""), False).to_numpy(zero_copy_only=False)] = 0  # no tokens, not an empty one
    flat = tokens.flatten()
    flat, row = flat.filter(pc.not_equal(flat, "")), np.repeat(np.arange(len(n)), n)
    hits = np.bincount(row[pc.is_in(flat, value_set=known).to_numpy(zero_copy_only=False)], minlength=len(n))
    if use_words_aug:
        first = np.flatnonzero(row[1:] == row[:-1])
        pairs = pc.binary_join_element_wise(flat.take(pa.array(first)), flat.take(pa.array(first + 1)), "")
        hits = hits + np.bincount(row[first][pc.is_in(pairs, value_set=known).to_numpy(zero_copy_only=False)], minlength=len(n))
        n = n + np.maximum(n - 1, 0)
    return _shares(hits, n)


def _character_shares(texts: list[str], words: list[str], use_words_aug: bool) -> np.ndarray:
    """The ratio of texts whose every character is a token."""
    n = np.fromiter(map(len, texts), np.int64, len(texts))
    cps = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    row = np.repeat(np.arange(len(texts)), n)
    hits = np.bincount(row[np.isin(cps, np.array([ord(w) for w in words if len(w) == 1], np.uint64))], minlength=len(n))
    if use_words_aug:
        first = np.flatnonzero(row[1:] == row[:-1])
        pairs = cps[first] << np.uint64(32) | cps[first + 1]
        two = np.array([ord(w[0]) << 32 | ord(w[1]) for w in words if len(w) == 2], np.uint64)
        hits = hits + np.bincount(row[first][np.isin(pairs, two)], minlength=len(n))
        n = n + np.maximum(n - 1, 0)
    return _shares(hits, n)


def flagged_words_ratio(text: str | Column, words: Iterable[str], mode: str = "word",
                        use_words_aug: bool = False) -> Column:
    """Flagged tokens / tokens, capped at 1; 0.0 without tokens. ``use_words_aug``: adjacent pairs, joined, are tokens too.

    Lower-casing and tokenizing run in the JVM; the tokens go by Arrow to one vectorized
    lookup of a slice in the list, whatever its length. They travel as one text, words
    parted by spaces and characters by nothing, not as arrays.
    For a (lang, word) table with a language per row see ``flagged_ratio_by_language``.
    """
    word_list = sorted({w.lower() for w in words if w})
    between, lower = r"[^\p{L}\p{N}]+", F.lower(col_(text))

    if mode == "character":
        @F.arrow_udf(T.DoubleType())
        def share_of_characters(texts: pa.Array) -> pa.Array:
            done = [_character_shares(t, word_list, use_words_aug) for t in text_slices(texts)]
            return pa.array(np.concatenate(done) if done else [], pa.float64())

        return share_of_characters(F.regexp_replace(lower, between, ""))

    @F.arrow_udf(T.DoubleType())
    def share(texts: pa.Array) -> pa.Array:
        known = pa.array(word_list, texts.type)
        done = [_word_shares(t, known, use_words_aug) for t in slices(texts)]
        return pa.array(np.concatenate(done) if done else [], pa.float64())

    return share(F.trim(F.regexp_replace(lower, between, " ")))


def flagged_words_filter(df: DataFrame, words: Iterable[str], text_col: str = "text", lang: str = "en",
                         max_ratio: float = 0.045, use_words_aug: bool = False,
                         tokenization: bool = False) -> DataFrame:
    mode = "character" if lang == "zh" else "word"
    r = flagged_words_ratio(text_col, words, mode=mode, use_words_aug=use_words_aug)
    return df.where(r <= F.lit(max_ratio))


#: Bytes of one entry of a (lang, word) table; a longer one is refused. The table may have any size.
MAX_LIST_BYTES = 256 << 20
#: Bytes of a (lang, word) table that go to every worker; a larger table is joined with the texts' words and word runs.
SENT_LIST_BYTES = 1 << 20
#: Tokens (or, at eight bytes each, texts) whose word runs are gathered together, each distinct run once.
GATHERED_TOKENS = 1 << 19
#: Listed runs that one group of the join holds in memory, and runs that are looked up in them together.
LOOKED_UP = 1 << 20
#: Languages whose tokens are characters.
CHARACTER_LANGUAGES = ("zh", "ja", "th")


def _trie(phrases: Iterable[list[str]]) -> dict:
    """Nested dicts by token; a phrase ends where the key None is."""
    root: dict = {}
    for tokens in phrases:
        node = root
        for t in tokens:
            node = node.setdefault(t, {})
        if tokens:
            node[None] = True
    return root


def _covered(tokens, trie: dict) -> int:
    """Tokens that lie in an occurrence of a phrase of the trie; overlapping occurrences count each token once."""
    n, reach = 0, 0
    for i, t in enumerate(tokens):
        node, k, end = trie.get(t), i + 1, 0
        while node is not None:
            if None in node:
                end = k
            if k == len(tokens):
                break
            node, k = node.get(tokens[k]), k + 1
        if end > reach:
            n += end - max(reach, i)
            reach = end
    return n


def flagged_ratio_by_language(df: DataFrame, words: DataFrame, text_col: str = "text", lang_col: str = "lang", out_col: str = "flagged_ratio",
                              lang_word_cols: tuple[str, str] = ("lang", "word"), character_languages: Iterable[str] = CHARACTER_LANGUAGES) -> DataFrame:
    """``df`` with the share of tokens that lie in a word or phrase listed for the row's language; 0.0 without tokens.

    ``words`` is a table of (language, word); a word may be a phrase of several tokens. Both sides are tokenized alike:
    letter/digit runs, or characters for ``character_languages``. A table of up to ``SENT_LIST_BYTES`` is looked up in a
    trie per language that each worker builds once; a larger one is never collected but joined with the word runs of
    the listed lengths, packed. A row of a language without words, or of no language, has ratio 0.0; list entries without
    language, word or token count for nothing.
    """
    lang, word = lang_word_cols
    by_character = list(character_languages)

    def tokens(text: Column, language: Column) -> Column:
        return F.when(language.isin(by_character), word_tokens(text, "character")).otherwise(word_tokens(text, "word")) if by_character \
            else word_tokens(text, "word")

    listed = words.select(F.col(lang).alias("lang"), F.col(word).alias("word")).where("lang IS NOT NULL AND word IS NOT NULL")
    listed = listed.withColumn("bytes", F.octet_length("word").cast("long") + F.octet_length("lang"))
    listed = materialize_sparing(listed.select("lang", token_text(F.col("word"), F.col("lang"), by_character).alias("t"), "bytes"), "flagged-words")
    size, longest = listed.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.max("bytes"), F.lit(0))).first()
    if longest > MAX_LIST_BYTES:
        raise ValueError(f"the flagged-word table has an entry of {longest} bytes, over {MAX_LIST_BYTES}")
    if size > SENT_LIST_BYTES:
        return _flagged_ratio_by_join(df, listed, text_col, lang_col, out_col, by_character)

    phrases: dict[str, list[list[str]]] = {}
    for r in listed.where("t != ''").select("lang", "t").distinct().collect():  # SENT_LIST_BYTES at most
        phrases.setdefault(r["lang"], []).append(list(r["t"]) if r["lang"] in by_character else r["t"].split(" "))
    sent = df.sparkSession.sparkContext.broadcast(phrases)

    @F.pandas_udf(T.DoubleType())
    def ratio(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        tries = {k: _trie(v) for k, v in sent.value.items()}
        for toks, langs in batches:
            yield pd.Series([0.0 if t is None or len(t) == 0 or k not in tries else _covered(t, tries[k]) / len(t) for t, k in zip(toks, langs)],
                            dtype="float64")

    return df.withColumn(out_col, ratio(tokens(F.col(text_col), F.col(lang_col)), F.col(lang_col)))


def token_text(text: Column, language: Column | None = None, by_character: Iterable[str] = ()) -> Column:
    """The tokens of ``word_tokens`` as one text: words parted by single spaces, characters (of these languages) by nothing."""
    t, between, by_character = F.lower(text), r"[^\p{L}\p{N}]+", list(by_character)
    words = F.trim(F.regexp_replace(t, between, " "))
    return F.when(language.isin(by_character), F.regexp_replace(t, between, "")).otherwise(words) if by_character else words


class _Tokens:
    """The tokens of an Arrow array of token texts as numbers in the order of the words, and runs of them."""

    def __init__(self, texts: pa.Array, by_character: bool):
        texts = texts.cast(pa.string())
        if by_character:
            plain = "".join(t or "" for t in texts.to_pylist())
            cps = np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), np.uint32)
            self.size = pc.fill_null(pc.utf8_length(texts), 0).to_numpy().astype(np.int64)
            known, code = np.unique(cps, return_inverse=True)
            self.words, self.code = pa.array([chr(c) for c in known.tolist()], pa.string()), code.astype(np.int64)
        else:
            lists = pc.split_pattern(texts, " ")
            self.size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
            self.size[pc.fill_null(pc.equal(texts, ""), False).to_numpy(zero_copy_only=False)] = 0  # no tokens, not an empty one
            flat = lists.flatten()
            coded = flat.filter(pc.not_equal(flat, "")).dictionary_encode()
            order = pc.sort_indices(coded.dictionary)
            rank = np.empty(len(order), np.int64)
            rank[order.to_numpy()] = np.arange(len(order))
            self.words, self.code = coded.dictionary.take(order), rank[coded.indices.to_numpy()]
        self.owner = np.repeat(np.arange(len(self.size)), self.size)

    def runs(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(where each run of ``n`` tokens starts, the number of its run, where each distinct run starts first); runs are numbered in order of their words."""
        at = np.flatnonzero(self.owner[:max(0, len(self.owner) - n + 1)] == self.owner[n - 1:])
        if not at.size:
            return at, at, at
        rank, below = self.code[at], len(self.words)
        for k in range(1, n):
            if below * len(self.words) >= 1 << 62:
                rank, below = _ranked(rank)
            rank, below = rank * len(self.words) + self.code[at + k], below * len(self.words)
        bits = len(rank).bit_length()
        if below << bits >= 1 << 63:
            rank, below = _ranked(rank)
        by_rank = np.sort(rank << bits | np.arange(len(rank)))  # quicker than an order of the ranks
        place, rank = by_rank & ((1 << bits) - 1), by_rank >> bits
        new = np.append(True, rank[1:] != rank[:-1])
        number = np.empty(len(rank), np.int64)
        number[place] = np.cumsum(new) - 1
        return at, number, at[place[new]]

    def texts(self, first: np.ndarray, n: int) -> pa.Array:
        """The words of the runs that start there, parted by spaces."""
        parts = [self.words.take(pa.array(self.code[first + k])) for k in range(n)]
        return parts[0] if n == 1 else pc.binary_join_element_wise(*parts, " ")

    def buckets(self, first: np.ndarray, n: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """The distinct runs' order by a hash of their words into buckets, and where each bucket ends in it."""
        if not hasattr(self, "hash"):
            self.hash = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in self.words.to_pylist()], np.uint64)
        mixed = np.zeros(len(first), np.uint64)
        for k in range(n):
            mixed = (mixed ^ self.hash[self.code[first + k]]) * np.uint64(0x9E3779B97F4A7C15)
        own = (mixed >> np.uint64(33)).astype(np.int64) % buckets
        order = np.argsort(own, kind="stable")
        return order, np.searchsorted(own[order], np.arange(buckets), "right")


def distinct_runs(batches: Iterator[pa.RecordBatch], lengths: Iterable[int]) -> Iterator[pa.RecordBatch]:
    """(lang, t) -> (lang, word, n): the runs of words of these lengths, each once per ``GATHERED_TOKENS``."""
    for part in _portions(batches, 1):
        for lang in pc.unique(part.column(0)).to_pylist():
            own = pc.is_null(part.column(0)) if lang is None else pc.fill_null(pc.equal(part.column(0), lang), False)
            tokens = _Tokens(part.column(1).filter(own), False)
            for n in lengths:
                _, _, first = tokens.runs(n)
                if first.size:
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(first), pa.string()), tokens.texts(first, n),
                                                      pa.repeat(pa.scalar(n, pa.int32()), len(first))], names=["lang", "word", "n"])


def _portions(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The rows in order, in portions of about eight times ``GATHERED_TOKENS`` bytes of text or one row."""
    held: list[pa.RecordBatch] = []
    size, bound = 0, 8 * GATHERED_TOKENS
    for batch in batches:
        lo = 0
        for part in slices(batch.column(column), bound):
            more = pc.sum(pc.binary_length(part)).as_py() or 0
            if held and size + more > bound:
                yield pa.concat_batches(held)
                held, size = [], 0
            held.append(batch.slice(lo, len(part)))
            size, lo = size + more, lo + len(part)
    if held:
        yield pa.concat_batches(held)


def _packed_runs(tokens: _Tokens, n: int, buckets: int) -> Iterator[tuple[int, int, bytes]]:
    """(bucket, bytes, Zstandard frame of its distinct runs of ``n`` tokens in order of their words, a line each)."""
    _, _, first = tokens.runs(n)
    if not first.size:
        return
    order, ends = tokens.buckets(first, n, buckets)
    cuts = pa.array(np.append(0, ends).astype(np.int32))
    joined = pc.binary_join(pa.ListArray.from_arrays(cuts, tokens.texts(first[order], n)), "\n").cast(pa.binary())
    codec = pa.Codec("zstd", compression_level=3)
    for bucket, text in enumerate(joined.to_pylist()):
        if text:
            yield bucket, len(text), codec.compress(text, asbytes=True)


#: A text's or a list's runs of ``n`` tokens in one bucket; ``first`` and ``last`` are the first and last row of the texts.
_PACKED = "lang string, n int, bucket int, texts boolean, chunk long, first long, last long, size long, runs binary"


def _packed_rows(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.string(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    names = [c.split()[0] for c in _PACKED.split(", ")]
    for lo in range(0, len(rows), 64):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[lo:lo + 64]), kinds)], names=names)


def _listed_runs(batches: Iterator[pa.RecordBatch], by_character: list[str], buckets: int) -> Iterator[pa.RecordBatch]:
    """(lang, n, t) -> packed runs of the list: every entry is one."""
    for part in _portions(batches, 2):
        for lang in pc.unique(part.column(0)).to_pylist():
            of = part.filter(pc.equal(part.column(0), lang))
            for n in pc.unique(of.column(1)).to_pylist():
                tokens = _Tokens(of.column(2).filter(pc.equal(of.column(1), n)), lang in by_character)
                yield from _packed_rows([(lang, n, b, False, 0, 0, 0, size, runs) for b, size, runs in _packed_runs(tokens, n, buckets)])


def _by_chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """(row, chunk, lang, t) -> a table for each chunk, whose rows follow each other."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        chunk = batch.column(1).to_numpy()
        cuts = np.append(np.flatnonzero(chunk[1:] != chunk[:-1]) + 1, len(chunk)).tolist()
        for lo, hi in zip([0, *cuts], cuts):
            if hi > lo:
                if held and held[-1].column(1)[0].as_py() != chunk[lo]:
                    yield pa.Table.from_batches(held).combine_chunks()
                    held = []
                held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _by_language(table: pa.Table) -> Iterator[tuple[str, pa.Table, pa.Array]]:
    """(language, its rows, their texts) of a table (row, chunk, lang, t), by row."""
    table = table.sort_by("__row")
    for lang in sorted(pc.unique(table.column("lang")).to_pylist()):
        own = table.filter(pc.equal(table.column("lang"), lang))
        yield lang, own, pa.concat_arrays(own.column("t").chunks)


def _text_runs(batches: Iterator[pa.RecordBatch], lengths: dict[str, list[int]], by_character: list[str], buckets: int) -> Iterator[pa.RecordBatch]:
    """(row, chunk, lang, t) -> packed runs of the listed lengths of every chunk's texts."""
    for table in _by_chunk(batches):
        rows = table.column("__row").to_numpy()
        where = (int(table.column("__chunk")[0].as_py()), int(rows.min()), int(rows.max()))
        for lang, _, texts in _by_language(table):
            tokens = _Tokens(texts, lang in by_character)
            for n in lengths[lang]:
                yield from _packed_rows([(lang, n, b, True, *where, size, runs) for b, size, runs in _packed_runs(tokens, n, buckets)])


def _unpacked_runs(size: int, runs: bytes) -> pa.Array:
    return pc.split_pattern(pa.array([pa.Codec("zstd").decompress(runs, size, asbytes=True).decode("utf-8", "surrogatepass")], pa.large_string()), "\n").flatten()


def _found(batches: Iterator[pa.RecordBatch], looked_up: int) -> Iterator[pa.RecordBatch]:
    """Packed runs sorted by (lang, n, bucket, texts) -> (chunk, first, last, lang, n, bucket, bits): a bit per run of the texts, set if it is listed."""
    names = ["chunk", "first", "last", "lang", "n", "bucket", "found"]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.binary())
    group, known, waiting, n = None, [], [], 0
    distinct = 0  # of the listed runs, those that are known to be

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal waiting, n
        if waiting:
            bits = pc.is_in(pa.concat_arrays([r for _, r in waiting]), value_set=pa.concat_arrays(known)).to_numpy(zero_copy_only=False)
            out, lo = [], 0
            for where, runs in waiting:
                if bits[lo:lo + len(runs)].any():
                    out.append((*where, *group, np.packbits(bits[lo:lo + len(runs)]).tobytes()))
                lo += len(runs)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)
        waiting, n = [], 0

    for batch in batches:
        for lang, length, bucket, texts, chunk, first, last, size, runs in zip(*(batch.column(i) for i in range(9))):
            key = (lang.as_py(), length.as_py(), bucket.as_py())
            if key != group:
                yield from flush()
                group, known, distinct = key, [], 0
            if not texts.as_py():
                known.append(_unpacked_runs(size.as_py(), runs.as_py()))
                if sum(map(len, known)) > 2 * max(distinct, looked_up):
                    known = [pc.unique(pa.concat_arrays(known))]
                    distinct = len(known[0])
            elif known:
                waiting.append(((chunk.as_py(), first.as_py(), last.as_py()), _unpacked_runs(size.as_py(), runs.as_py())))
                n += len(waiting[-1][1])
                if n >= looked_up:
                    yield from flush()
    yield from flush()


def _chunk_shares(texts: pa.Table, found: pa.Table, by_character: list[str], buckets: int) -> pa.Table:
    """(row, share) of a chunk's texts, from the runs of them that are listed."""
    out = [(np.empty(0, np.int64), np.empty(0))]
    texts = texts.sort_by("__row")
    rows = texts.column("__row").to_numpy()
    hits: dict[tuple, dict] = {}
    for first, last, lang, n, bucket, bits in zip(*(found.column(c).to_pylist() for c in ("first", "last", "lang", "n", "bucket", "found"))):
        hits.setdefault((first, last), {}).setdefault(lang, {}).setdefault(n, {})[bucket] = bits
    for (first, last), by_lang in hits.items():  # as the texts' runs were gathered
        part = texts.slice(int(rows.searchsorted(first)), int(rows.searchsorted(last, "right") - rows.searchsorted(first)))
        for lang, own, plain in _by_language(part):
            if lang not in by_lang:
                continue
            tokens = _Tokens(plain, lang in by_character)
            covered = np.zeros(len(tokens.owner) + 1, np.int32)
            for n, by_bucket in by_lang[lang].items():
                at, number, starts = tokens.runs(n)
                order, ends = tokens.buckets(starts, n, buckets)
                listed = np.zeros(len(starts), bool)
                for bucket, bits in by_bucket.items():
                    lo, hi = (int(ends[bucket - 1]) if bucket else 0), int(ends[bucket])
                    listed[order[lo:hi]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=hi - lo).astype(bool)
                at = at[listed[number]]
                covered[at] += 1  # runs of one length start at different tokens
                covered[at + n] -= 1
            inside = np.cumsum(covered[:-1]) > 0  # overlapping runs count each token once
            n_hit = np.bincount(tokens.owner[inside], minlength=len(tokens.size))
            hit = n_hit > 0
            out.append((own.column("__row").to_numpy()[hit], n_hit[hit] / tokens.size[hit]))
    row, share = (np.concatenate(x) for x in zip(*out))
    return pa.table({"hit_row": pa.array(row, pa.int64()), "__share": pa.array(share, pa.float64())})


def _flagged_ratio_by_join(df: DataFrame, listed: DataFrame, text_col: str, lang_col: str, out_col: str, by_character: list[str]) -> DataFrame:
    """The ratio by a table of any size: the runs of a chunk of texts meet the listed ones, and a bit for each comes back.

    Runs travel as compressed lists, each distinct one once per chunk; where they stand in the texts is found anew from
    the texts, which number their runs as before. What is written on the way goes when the next table is there.
    """
    spark, bound = df.sparkSession, 8 * GATHERED_TOKENS

    @F.arrow_udf(T.LongType())
    def chunk(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        now, held = -1, 0
        for rows, sizes in parts:
            out = np.empty(len(rows), np.int64)
            for i, (row, size) in enumerate(zip(rows.to_numpy().tolist(), sizes.to_numpy().tolist())):
                if now < 0 or held + size > bound:
                    now, held = row, 0
                held += size
                out[i] = now
            yield pa.array(out)

    rows = df.withColumn("__row", F.monotonically_increasing_id())
    rows = rows.withColumn("__chunk", chunk(F.col("__row"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")))
    rows = materialize_sparing(rows, "flagged-rows")  # the row numbers must stay what they are
    n = F.when(F.col("lang").isin(by_character), F.char_length("t")).otherwise(F.char_length("t") - F.char_length(F.replace("t", F.lit(" "), F.lit(""))) + 1)
    entries = listed.where("t != ''").select("lang", n.cast("int").alias("n"), "t")
    lengths: dict[str, list[int]] = {}
    largest = 0
    for r in entries.groupBy("lang", "n").agg(F.count(F.lit(1)).alias("k")).collect():  # languages by the lengths of their entries
        lengths.setdefault(r["lang"], []).append(r["n"])
        largest = max(largest, r["k"])
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets, looked_up = max(-(-largest // LOOKED_UP), min(partitions, 64)), LOOKED_UP
    texts = rows.where(F.col(lang_col).isin(list(lengths)) & F.col(text_col).isNotNull()).select(
        "__row", "__chunk", F.col(lang_col).alias("lang"), token_text(F.col(text_col), F.col(lang_col), by_character).alias("t"))
    packed = entries.mapInArrow(lambda it: _listed_runs(it, by_character, buckets), _PACKED).unionAll(
        texts.mapInArrow(lambda it: _text_runs(it, lengths, by_character, buckets), _PACKED))
    key = ["lang", "n", "bucket"]
    found = materialize_sparing(packed.repartition(partitions, *key).sortWithinPartitions(*key, "texts").mapInArrow(
        lambda it: _found(it, looked_up), "chunk long, first long, last long, lang string, n int, bucket int, found binary"), "flagged-found")
    drop_materialized(listed)
    shares = texts.groupBy("__chunk").cogroup(found.groupBy("chunk")).applyInArrow(
        lambda left, right: _chunk_shares(left, right, by_character, buckets), "hit_row long, __share double")
    shares = materialize_sparing(shares, "flagged-shares")
    drop_materialized(found)
    share = F.coalesce(shares["__share"], F.lit(0.0))
    out = rows.join(shares, rows["__row"] == shares["hit_row"], "left")
    return out.withColumn("__share", share).select(*[F.col("__share").alias(c) if c == out_col else rows[c] for c in df.columns],
                                                   *([] if out_col in df.columns else [F.col("__share").alias(out_col)]))


def flagged_words_filter_by_language(df: DataFrame, words: DataFrame, max_ratio: float = 0.045, **args) -> DataFrame:
    """Rows whose flagged ratio for their own language is at most ``max_ratio``."""
    return flagged_ratio_by_language(df, words, out_col="__flagged", **args).where(F.col("__flagged") <= max_ratio).drop("__flagged")


# ---------------------------------------------------------------- lines, length

def maximum_line_length(text: str | Column) -> Column:
    """Characters in the longest line (line ends: \\r\\n, \\n, \\r); 0 for empty text."""
    lines = F.split(F.replace(col_(text), F.lit("\r"), F.lit("\n")), "\n")  # \\r\\n: an empty line more, never the longest
    return F.coalesce(F.array_max(F.transform(lines, lambda l: F.length(l))), F.lit(0))


def maximum_line_length_filter(df: DataFrame, text_col: str = "text", min_len: int = 10,
                               max_len: int = 2**31 - 1) -> DataFrame:
    m = maximum_line_length(text_col)
    return df.where((m >= F.lit(min_len)) & (m <= F.lit(max_len)))


def text_length_filter(df: DataFrame, text_col: str = "text", min_len: int = 10,
                       max_len: int = 2**31 - 1) -> DataFrame:
    n = F.length(F.col(text_col))
    return df.where((n >= F.lit(min_len)) & (n <= F.lit(max_len)))
