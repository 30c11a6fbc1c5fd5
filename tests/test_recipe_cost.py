"""the recipes' one pass over the text, against plain versions and by what it no longer does."""

import hashlib
import random
import re
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusprep.functions.digest import md5_prefixes
from corpusprep.functions.text import slices
from corpusprep.operators import dedup as D
from corpusprep.operators import quality as Q

LATIN = "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ.,\n0123456789éèàüöäßñç"
WIDE = "".join(map(chr, range(0x4E00, 0x4E00 + 400))) + "😀"


def _ratio(text: str, rep_len: int) -> float:
    grams = Counter(text[i:i + rep_len] for i in range(len(text) - rep_len + 1))
    counts = sorted(grams.values(), reverse=True)
    k = min(int(len(counts) ** 0.5), sum(c > 1 for c in counts))
    return sum(counts[:k]) / sum(counts) if counts else 0.0


def _texts(rng: random.Random) -> list[str]:
    out = ["", "a", "aaaaaaaaa", "aaaaaaaaaa", "ab" * 40, LATIN * 3, WIDE * 2, WIDE[:90] * 3]
    for alphabet in ("ab", LATIN, WIDE):
        for n in (9, 10, 11, 60, 700):
            s = "".join(rng.choices(alphabet, k=n))
            out += [s, s + s[:n // 2] + s]
    return rng.sample(out, len(out))


@pytest.mark.parametrize("rep_len", [1, 2, 5, 10, 13, 64, 70])
def test_repetition_ratio_like_plain_count(rep_len):
    texts = _texts(random.Random(rep_len))
    assert Q._repetition_ratios(texts, rep_len).tolist() == [_ratio(t, rep_len) for t in texts]


def test_ordinary_texts_are_not_ranked(monkeypatch):
    def ranked(*_):
        raise AssertionError("n-grams of a text of few characters need no ranking")

    monkeypatch.setattr(Q, "_ranked", ranked)
    rng = random.Random(3)
    texts = ["".join(rng.choices(LATIN, k=4000)) for _ in range(20)]
    assert Q._repetition_ratios(texts, 10).tolist() == [_ratio(t, 10) for t in texts]


def test_md5_of_strings_up_to_the_end_of_the_data():
    data = np.frombuffer(random.Random(5).randbytes(300), dtype=np.uint8)
    at = [(i, j) for i in range(0, 301, 7) for j in range(i, min(i + 70, 300) + 1)]
    got = md5_prefixes(data, np.array([a for a, _ in at]), np.array([b for _, b in at]))
    assert got.tolist() == [int.from_bytes(hashlib.md5(data[a:b].tobytes()).digest()[:8], "big") for a, b in at]


def test_votes_of_more_hashes_than_a_block():
    h = np.random.default_rng(7).integers(0, 2 ** 63, 70_001, dtype=np.uint64) | np.uint64(1 << 63)
    bits = [(int((h >> np.uint64(b) & np.uint64(1)).sum()) * 2 > len(h)) << b for b in range(64)]
    assert D._vote(h) & (2 ** 64 - 1) == sum(bits)


def test_flagged_shares_of_slices():
    rng = random.Random(11)
    words = ["trash", "idiot", "tr", "ash"]
    texts = rng.sample([None, ""] * 20 + [" ".join(rng.choices(["trash", "idiot", "tr", "ash", "thé", "und"], k=rng.randint(1, 40))) for _ in range(200)], 240)
    whole = pa.array(texts, pa.string())
    for aug in (False, True):
        expected = []
        for t in texts:
            tokens = (t or "").split()
            tokens += [a + b for a, b in zip(tokens, tokens[1:])] if aug else []
            expected.append(sum(w in words for w in tokens) / len(tokens) if tokens else 0.0)
        for size in (1, 300, 1 << 20):
            got = np.concatenate([Q._word_shares(p, pa.array(words), aug) for p in slices(whole, size)])
            assert got.tolist() == expected


def test_statistics_of_odd_texts(spark):
    texts = [None, "", " ", "...", "Trash, trash-talk!", "idiot", "\r", "\r\n\r\n", "ab\rcde\r\nf\n", "a\r\r\nbcdef", "İdiot trash ΑΣ", "x\n" * 50,
             " lead and trail ", "tr ash", "१२ ab ½"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    words = ["trash", "idiot"]
    share = [Q.flagged_words_ratio("text", words), Q.flagged_words_ratio("text", words, use_words_aug=True)]
    out = df.select("id", Q.maximum_line_length("text").alias("line"), Q.alphanumeric_ratio("text").alias("alnum"), share[0].alias("one"), share[1].alias("two"))
    assert "regexp_extract_all" not in out._jdf.queryExecution().executedPlan().toString()  # words go to Python as text, not as arrays
    for r, t in zip(out.orderBy("id").collect(), texts):
        t = t or ""
        letters = lambda c: unicodedata.category(c)[0] in "LN"
        tokens = "".join(c if letters(c) else " " for c in t.lower()).split()
        pairs = [a + b for a, b in zip(tokens, tokens[1:])]
        assert r["line"] == max(map(len, re.split(r"\r\n|\n|\r", t)))
        assert r["alnum"] == (sum(map(letters, t)) / len(t) if t else 0.0)
        assert r["one"] == (sum(w in words for w in tokens) / len(tokens) if tokens else 0.0)
        both = tokens + pairs
        assert r["two"] == (min(sum(w in words for w in both) / len(both), 1.0) if both else 0.0)
    assert out.where(F.col("id") == 0).first()["alnum"] == 0.0
