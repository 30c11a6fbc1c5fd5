"""Findings of round 4, each on rows of its own."""

import hashlib
import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from corpusprep.operators import dedup as D
from corpusprep.operators import quality as Q
from corpusprep.operators.components import _forest
from corpusprep.plans import reader_queries as RQ
from corpusprep.session import ensure_checkpoint_dir


def _components(fp, cell, side, near):
    """The smallest fingerprint of every row's component, by all pairs."""
    i, j = np.triu_indices(len(fp), 1)
    ok = (cell[i] == cell[j]) & ((side[i] < 0) | (side[i] != side[j])) & (np.bitwise_count(fp[i] ^ fp[j]) <= near)
    root = np.arange(len(fp))
    nodes, roots = _forest(i[ok], j[ok])
    root[nodes] = roots
    least = fp.copy()
    np.minimum.at(least, root, fp)
    return dict(zip(zip(cell.tolist(), fp.tolist()), least[root].tolist()))


@pytest.mark.parametrize("seed", range(4))
def test_links_of_cells_are_those_of_all_pairs(monkeypatch, seed):
    """F2 recipe_zh: cells of one row, of few, of families and of strangers, whole or across two sides."""
    monkeypatch.setattr(D, "COMPARED", 1 << 12)
    rng = np.random.default_rng(seed)
    fps, cells, sides = [], [], []
    for c, (n, families) in enumerate([(1, 1), (40, 3), (64, 1), (65, 1), (500, 1), (700, 12), (300, 300), (900, 2)]):
        heads = rng.integers(0, 1 << 63, families, dtype=np.uint64)
        fp = heads[rng.integers(0, families, n)]
        for _ in range(5):
            fp = fp ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
        fp = np.unique(fp)
        fps.append(rng.permutation(fp))
        cells.append(np.full(len(fp), c))
        sides.append(np.full(len(fp), -1) if (c + seed) % 2 else rng.integers(0, 2, len(fp)))
    fp, cell, side = map(np.concatenate, (fps, cells, sides))
    a, b = D._cell_links(fp, cell, side, 8)
    # a fingerprint is in one cell only, so its link tells its component
    got = {(c, f): f for c, f in zip(cell.tolist(), fp.tolist())}
    at = dict(zip(fp.tolist(), cell.tolist()))
    got |= {(at[x], x): y for x, y in zip(a.tolist(), b.tolist())}
    assert got == _components(fp, cell, side, 8)


def test_a_family_of_near_fingerprints_is_not_compared_pair_by_pair(monkeypatch):
    """F2 recipe_zh: what a component has reached is compared no more, so a cell's work is not the square of a family."""
    rng = np.random.default_rng(5)
    fp = np.full(6000, rng.integers(0, 1 << 63, dtype=np.uint64))
    for _ in range(3):
        fp = fp ^ (np.uint64(1) << rng.integers(0, 64, len(fp)).astype(np.uint64))
    fp = np.unique(fp)
    count, compared = np.bitwise_count, []
    monkeypatch.setattr(np, "bitwise_count", lambda x: compared.append(x.size) or count(x))
    a, _ = D._cell_links(fp, np.zeros(len(fp), np.int64), np.full(len(fp), -1), 8)
    assert len(a) == len(fp) - 1 and sum(compared) < len(fp) ** 2 / 10


def _plain(text, by_word, window):
    t = text.split() if by_word else list(text)
    if not t:
        return None
    grams = [t[i:i + window] for i in range(max(1, len(t) - window + 1))]
    h = [int.from_bytes(hashlib.md5((" " if by_word else "").join(g).encode()).digest()[:8], "big") for g in grams]
    bits = sum((sum(x >> b & 1 for x in h) * 2 > len(h)) << b for b in range(64))
    return bits - (1 << 64) if bits >> 63 else bits


@pytest.mark.parametrize("alphabet", ["ab", "abc déf.😀", "".join(map(chr, range(0x4E00, 0x4E00 + 3000)))])
def test_fingerprints_of_characters_and_words(alphabet):
    rng = random.Random(len(alphabet))
    texts = ["".join(rng.choices(alphabet, k=k)) for k in (0, 1, 3, 4, 5, 254, 255, 256, 257, 258, 259, 600, 0, 2, 4)]
    for by_word, window in ((False, 1), (False, 4), (False, 9), (True, 3)):
        assert D._fingerprints(texts, by_word, window) == [_plain(t, by_word, window) for t in texts]
    assert D._fingerprints(["", ""], False, 4) == [None, None] and D._fingerprints(["ab"], False, 4) == [_plain("ab", False, 4)]


def test_equal_shingles_of_characters_are_hashed_once(monkeypatch):
    """F2 recipe_zh."""
    hashed = []
    whole = D.md5_prefixes
    monkeypatch.setattr(D, "md5_prefixes", lambda data, starts, ends: hashed.append(len(starts)) or whole(data, starts, ends))
    texts = ["the same few words come again and again, " * 200] * 10
    assert len(set(D._fingerprints(texts, False, 4))) == 1 and sum(hashed) < 200


def _flagged_texts(rng, n):
    by_lang = {"en": ["bad", "Very", "word", "x", "ärger", "idea!"], "zh": ["坏", "人", "a", "恶", "😀"], "fr": ["bad"]}
    return [(lang, None if k % 11 == 0 else (" " if lang != "zh" else "").join(rng.choices(by_lang[lang], k=rng.randint(0, 40))))
            for k, lang in enumerate(rng.choices([*by_lang], k=n))]


def _plain_share(lang, text, phrases):
    t = [c for c in re.findall(r"[^\W_]", (text or "").lower())] if lang == "zh" else re.findall(r"[^\W_]+", (text or "").lower())
    inside = {i + k for p in phrases.get(lang, ()) for i in range(len(t) - len(p) + 1) if t[i:i + len(p)] == p for k in range(len(p))}
    return len(inside) / len(t) if t else 0.0


def _texts_table(rows):
    token = lambda lang, t: ("" if lang == "zh" else " ").join(re.findall(r"[^\W_]" if lang == "zh" else r"[^\W_]+", t.lower()))
    cols = zip(*[(i, 3, lang, token(lang, t)) for i, (lang, t) in rows if t is not None])
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.string()))],
                                      names=["__row", "__chunk", "lang", "t"])


@pytest.mark.parametrize("buckets", [1, 5])
def test_packed_runs_find_what_a_plain_search_finds(buckets):
    """F1 flagged_by_language: also where two tasks gather parts of one chunk."""
    rng = random.Random(buckets)
    phrases = {"en": [["bad"], ["very", "bad", "word"], ["ärger", "x"], ["x", "x"]], "zh": [["坏", "人"], ["恶"], ["a", "a", "坏"]], "de": [["bad"]]}
    rows = list(enumerate(_flagged_texts(rng, 120)))
    lengths = {k: sorted({len(p) for p in v}) for k, v in phrases.items()}
    rows = [r for r in rows if r[1][0] in lengths]
    entries = [(k, len(p), ("" if k == "zh" else " ").join(p)) for k, v in phrases.items() for p in v + v[:1]]
    listed = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*entries), (pa.string(), pa.int32(), pa.string()))], names=["lang", "n", "t"])
    packed = [*Q._listed_runs(iter([listed, listed]), ["zh"], buckets)]
    for part in (rows[:50], rows[50:]):
        whole = _texts_table(part)
        packed += Q._text_runs(iter([whole.slice(0, 9), whole.slice(9)]), lengths, ["zh"], buckets)
    ordered = pa.Table.from_batches(packed).sort_by([(c, "ascending") for c in ("lang", "n", "bucket", "texts")]).combine_chunks()
    for looked_up in (1, 1000):
        found = pa.Table.from_batches([*Q._found(iter(ordered.to_batches(max_chunksize=7)), looked_up)])
        shares = Q._chunk_shares(pa.Table.from_batches([_texts_table(rows)]), found, ["zh"], buckets)
        got = dict(zip(*(shares.column(c).to_pylist() for c in ("hit_row", "__share"))))
        assert {i: got.get(i, 0.0) for i, _ in rows} == {i: _plain_share(*r, phrases) for i, r in rows}


def test_the_flagged_table_holds_the_same_words(spark, tmp_path):
    """every document's words and pairs by their MD5, each once, also of documents without language."""
    rng = random.Random(2)
    texts = [" ".join(rng.choices(["Straße", "a", "b,c", "İx", "w1", "ΑΣ", "...", "d" * 70], k=rng.randint(0, 30))) for _ in range(60)] + [None, ""]
    rows = [(i, rng.choice(["en", "de", None]), t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    tokens = {r["doc_id"]: r["t"] for r in spark.read.parquet(f"{tmp_path}/documents.parquet").select("doc_id", Q.word_tokens("text").alias("t")).collect()}
    want = set()
    for i, lang, _ in rows:
        t = tokens[i] or []
        digit = lambda w: int(hashlib.md5(w.encode()).hexdigest()[0], 16)
        want |= {(lang, w) for w in t if digit(w) == 0} | {(lang, f"{a} {b}") for a, b in zip(t, t[1:]) if digit(f"{a} {b}") < 8}
    got = [tuple(r) for r in RQ.flagged_table(spark, str(tmp_path)).collect()]
    assert set(got) == want and len(got) == len(want)


def test_a_joined_flagged_table_leaves_little_on_the_disk(spark, monkeypatch):
    """the list, its shuffle and the runs go when the shares are there; only the numbered rows and shares stay."""
    monkeypatch.setattr(Q, "SENT_LIST_BYTES", 0)
    folder = re.sub("^file:/+", "/", ensure_checkpoint_dir(spark))
    before = set(os.listdir(folder))
    settings = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch"), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    df = spark.createDataFrame([(i, "en", f"w{i} bad x") for i in range(50)], "id int, lang string, text string")
    listed = spark.createDataFrame([("en", "bad x"), ("en", "w7")], "lang string, word string").distinct()
    got = {r["id"]: r["flagged_ratio"] for r in Q.flagged_ratio_by_language(df, listed).collect()}
    assert got == {i: 1.0 if i == 7 else 2 / 3 for i in range(50)}
    kept = {n.rsplit("-", 1)[0] for n in set(os.listdir(folder)) - before if os.path.isdir(f"{folder}/{n}")}
    assert kept == {"flagged-rows", "flagged-shares"}
    assert settings == (spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch"), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled"))
