"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A text's words (lower-cased runs of letters, digits and non-ASCII characters) enter
by two inputs: an embedding of the word and the mean embedding of its character
sequences (byte n-grams with word borders). Windows of ``window`` words, each
overlapping the next by half, cover the whole text; a gated recurrent unit reads
every window in both directions, attention pools its states, and each window gets a
logit. A text's score is a logistic function of its windows' strongest, mean and
softened-strongest logits, calibrated on documents the network was not trained on.

Everything is trained here with Adam and back-propagation through time, on at most
``max_positive`` and ``max_negative`` labelled rows (the smallest hashes of their
ids), which bounds what reaches the driver. The ids, language, source and labels
never enter a score. On Spark: scoring runs where the rows are, without a shuffle;
a word's inputs are computed once per distinct word of a slice of rows.

Defined results: null and empty texts have one window without words; a row with a
null id is scored (held_out false) and never trained on; repeated rows get equal
scores. Extra columns are ignored. Without labelled rows of both classes there is nothing
to learn from: every text then scores 0. An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.splits import smallest_hashes
from .common import text_slices
from .pu_quality import held_out
from .string_tiling import lowered, token_hashes

#: Production parameters.
WINDOW, STRIDE = 64, 32
WORD_BUCKETS, NGRAM_BUCKETS, NGRAMS = 1 << 13, 1 << 14, (3, 4, 5, 6)
EMBED, HIDDEN = 8, 8
MAX_POSITIVE, MAX_NEGATIVE = 1500, 3000
THRESHOLD = 0.5
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BLOCK = 2048  # windows that are read at a time


@dataclass
class Words:
    """The words of several texts: distinct words with their inputs, and windows of word numbers (-1: no word)."""

    word_bucket: np.ndarray
    gram_word: np.ndarray
    gram_bucket: np.ndarray
    windows: np.ndarray
    window_text: np.ndarray


def read_words(texts: list[bytes], window: int = WINDOW, stride: int = STRIDE) -> Words:
    low = [lowered(t) for t in texts]
    data = np.frombuffer(b" ".join(low) + b" ", dtype=np.uint8)
    size = np.fromiter(map(len, low), np.int64, len(low)) + 1
    starts, ends, h = token_hashes(data)
    uniq, first, number = np.unique(h, return_index=True, return_inverse=True)
    bound = np.searchsorted(starts, np.concatenate(([0], np.cumsum(size))))
    count = np.diff(bound)
    n_win = np.maximum(1, -(-(count - window) // stride) + 1)
    text_of = np.repeat(np.arange(len(texts)), n_win)
    place = np.arange(n_win.sum()) - np.repeat(np.cumsum(n_win) - n_win, n_win)
    at = (bound[:-1][text_of] + place * stride)[:, None] + np.arange(window)
    inside = at < bound[1:][text_of][:, None]
    windows = np.where(inside, np.append(number, 0)[np.minimum(at, len(number))], -1).astype(np.int32)

    # byte n-grams of the distinct words, each with a border byte on both sides
    s, e = starts[first], ends[first]
    length = e - s + 2
    base = np.concatenate(([0], np.cumsum(length)))
    owner = np.repeat(np.arange(len(uniq)), length)
    offset = np.arange(base[-1]) - base[:-1][owner]
    border = (offset == 0) | (offset == length[owner] - 1)
    flat = np.where(border, 1, data[np.minimum(s[owner] + np.maximum(offset - 1, 0), len(data) - 1)]).astype(np.uint64)
    words, grams = [], []
    for n in NGRAMS:
        m = len(flat) - n + 1
        if m <= 0:
            continue
        g = np.full(m, np.uint64(n))
        for k in range(n):
            g = g * np.uint64(0x100000001B3) + flat[k:k + m]
        ok = offset[:m] + n <= length[owner[:m]]
        words.append(owner[:m][ok])
        grams.append(((g[ok] * _MIX) >> np.uint64(40)).astype(np.int64) % NGRAM_BUCKETS)
    gram_word = np.concatenate(words) if words else np.empty(0, np.int64)
    gram_bucket = np.concatenate(grams) if grams else np.empty(0, np.int64)
    order = np.argsort(gram_word, kind="stable")
    return Words((uniq * _MIX >> np.uint64(40)).astype(np.int64) % WORD_BUCKETS, gram_word[order], gram_bucket[order],
                 windows, text_of)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def init_params(seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    d, h = 2 * EMBED, HIDDEN
    p = {"Ew": rng.normal(0, 0.1, (WORD_BUCKETS, EMBED)), "Ec": rng.normal(0, 0.1, (NGRAM_BUCKETS, EMBED))}
    for way in ("f", "b"):
        p |= {f"W{way}": rng.normal(0, d ** -0.5, (d, 3 * h)), f"U{way}": rng.normal(0, h ** -0.5, (h, 3 * h)),
              f"c{way}": np.zeros(3 * h)}
    p |= {"A": rng.normal(0, (2 * h) ** -0.5, (2 * h, h)), "a": rng.normal(0, h ** -0.5, h),
          "o": rng.normal(0, (2 * h) ** -0.5, 2 * h), "ob": np.zeros(1)}
    return {k: v.astype(np.float32) for k, v in p.items()}


def word_inputs(p: dict, w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(inputs of the distinct words, number of n-grams of each)."""
    n = len(w.word_bucket)
    grams = np.bincount(w.gram_word, minlength=n)
    x = np.zeros((n + 1, 2 * EMBED), dtype=np.float32)  # the last row stands for "no word"
    x[:n, :EMBED] = p["Ew"][w.word_bucket]
    if w.gram_word.size:
        has = grams > 0
        first = (np.cumsum(grams) - grams)[has]
        x[:n, EMBED:][has] = np.add.reduceat(p["Ec"][w.gram_bucket], first, axis=0) / grams[has, None]
    return x, grams


def _gru(pre: np.ndarray, mask: np.ndarray, u: np.ndarray, back: bool, keep: bool):
    """States [T, B, H] of a gated recurrent unit over input projections [T, B, 3H]; masked steps carry the state on."""
    t_all, b, h3 = pre.shape
    h = h3 // 3
    state = np.zeros((b, h), dtype=np.float32)
    states = np.empty((t_all, b, h), dtype=np.float32)
    tape = []
    for t in range(t_all - 1, -1, -1) if back else range(t_all):
        rec = state @ u
        zr = _sigmoid(pre[t, :, :2 * h] + rec[:, :2 * h])
        z, r = zr[:, :h], zr[:, h:]
        cand = np.tanh(pre[t, :, 2 * h:] + r * rec[:, 2 * h:])
        new = cand + z * (state - cand)
        m = mask[t][:, None]
        if keep:
            tape.append((t, state, z, r, cand, rec[:, 2 * h:], m))
        state = np.where(m, new, state)
        states[t] = state
    return states, tape


def forward(p: dict, x: np.ndarray, windows: np.ndarray, keep: bool = False):
    """Window logits; with ``keep`` also what back-propagation needs."""
    w = windows.T  # [T, B]; -1 picks the last row of x
    mask = w >= 0
    outs = []
    for way in ("f", "b"):
        pre = (x @ p[f"W{way}"] + p[f"c{way}"])[w]
        outs.append(_gru(pre, mask, p[f"U{way}"], way == "b", keep))
    s = np.concatenate([outs[0][0], outs[1][0]], axis=2)
    key = np.tanh(s @ p["A"])
    e = np.where(mask, key @ p["a"], -1e9)
    e = np.exp(e - e.max(0)) * mask
    att = e / np.maximum(e.sum(0), 1e-9)
    pooled = np.einsum("tb,tbh->bh", att, s)
    logit = pooled @ p["o"] + p["ob"][0]
    return logit, (w, mask, outs, s, key, att, pooled) if keep else None


def _add_rows(index: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """``n`` rows, each the sum of the ``values`` rows whose ``index`` names it."""
    out = np.zeros((n, values.shape[1]), dtype=np.float32)
    if index.size:
        order = np.argsort(index, kind="stable")
        at = index[order]
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        out[at[first]] = np.add.reduceat(values[order], first, axis=0)
    return out


def backward(p: dict, w: Words, x: np.ndarray, grams: np.ndarray, tape, d_logit: np.ndarray) -> dict[str, np.ndarray]:
    idx, mask, outs, s, key, att, pooled = tape
    h = HIDDEN
    g = {"o": pooled.T @ d_logit, "ob": np.array([d_logit.sum()], dtype=np.float32)}
    d_pool = np.outer(d_logit, p["o"])
    ds = att[:, :, None] * d_pool
    d_att = np.einsum("bh,tbh->tb", d_pool, s)
    d_e = att * (d_att - (att * d_att).sum(0))
    d_key = d_e[:, :, None] * p["a"] * (1 - key * key)
    g["a"] = np.einsum("tb,tbh->h", d_e, key)
    g["A"] = np.einsum("tbi,tbj->ij", s, d_key)
    ds += d_key @ p["A"].T
    dx = np.zeros_like(x)
    for k, way in enumerate(("f", "b")):
        u, d_state = p[f"U{way}"], np.zeros((s.shape[1], h), dtype=np.float32)
        d_pre = np.zeros((*idx.shape, 3 * h), dtype=np.float32)
        gu = np.zeros_like(u)
        for t, prev, z, r, cand, rec_n, m in reversed(outs[k][1]):
            d_state = d_state + ds[t, :, k * h:(k + 1) * h]
            dn = np.where(m, d_state, 0)
            d_cand = dn * (1 - z) * (1 - cand * cand)
            dz = dn * (prev - cand) * z * (1 - z)
            dr = d_cand * rec_n * r * (1 - r)
            d_rec = np.concatenate([dz, dr, d_cand * r], axis=1)
            d_pre[t] = np.concatenate([dz, dr, d_cand], axis=1)
            gu += prev.T @ d_rec
            d_state = np.where(m, dn * z, d_state) + d_rec @ u.T
        g[f"U{way}"] = gu
        per_word = _add_rows(np.where(mask, idx, len(x) - 1).reshape(-1), d_pre.reshape(-1, 3 * h), len(x))
        per_word[-1] = 0
        g[f"c{way}"] = per_word.sum(0)
        g[f"W{way}"] = x.T @ per_word
        dx += per_word @ p[f"W{way}"].T
    n = len(w.word_bucket)
    g["Ew"] = _add_rows(w.word_bucket, dx[:n, :EMBED], len(p["Ew"]))
    g["Ec"] = _add_rows(w.gram_bucket, (dx[:n, EMBED:] / np.maximum(grams, 1)[:, None])[w.gram_word], len(p["Ec"]))
    return g


def _sub_words(w: Words, rows: np.ndarray) -> Words:
    """Only some windows, with their words renumbered."""
    used, back = np.unique(w.windows[rows], return_inverse=True)
    back = back.reshape(len(rows), -1)
    if used[0] == -1:
        used, back = used[1:], back - 1
    renumber = np.full(len(w.word_bucket), -1)
    renumber[used] = np.arange(len(used))
    own = renumber[w.gram_word] >= 0
    return Words(w.word_bucket[used], renumber[w.gram_word[own]], w.gram_bucket[own], back, w.window_text[rows])


@dataclass
class Model:
    params: dict = field(repr=False)
    weight: np.ndarray = None
    bias: float = 0.0

    def window_logits(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(text number, logit) of every window of the texts."""
        w = read_words(texts)
        x, _ = word_inputs(self.params, w)
        parts = [forward(self.params, x, w.windows[i:i + _BLOCK])[0] for i in range(0, len(w.windows), _BLOCK)]
        return w.window_text, np.concatenate(parts) if parts else np.empty(0)

    def evidence(self, texts: list[bytes]) -> np.ndarray:
        """Per text: strongest, mean and softened-strongest window logit, clipped."""
        text_of, logit = self.window_logits(texts)
        logit = np.clip(logit.astype(np.float64), -12, 12)
        n = np.bincount(text_of, minlength=len(texts))
        top = np.full(len(texts), -12.0)
        np.maximum.at(top, text_of, logit)
        mean = np.bincount(text_of, logit, len(texts)) / n
        chance = np.bincount(text_of, _sigmoid(logit), len(texts)) / n
        return np.stack([top, mean, chance * 8], axis=1)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.weight is None:
            return np.zeros(len(texts))
        return _sigmoid(self.evidence(texts) @ self.weight + self.bias)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 400, ridge: float = 1e-2) -> tuple[np.ndarray, float]:
    """Weighted ridge logistic regression by Newton's method."""
    z = np.column_stack([x, np.ones(len(x))])
    beta = np.zeros(z.shape[1])
    for _ in range(min(steps, 50)):
        s = _sigmoid(z @ beta)
        grad = z.T @ (weight * (s - y)) + ridge * len(x) * np.append(beta[:-1], 0) / 100
        hess = (z * (weight * np.maximum(s * (1 - s), 1e-6))[:, None]).T @ z + np.eye(len(beta)) * ridge * len(x) / 100
        step = np.linalg.solve(hess, grad)
        beta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return beta[:-1], float(beta[-1])


def fit_texts(texts: list[bytes], labels: np.ndarray, base_rate: float | None = None, seed: int = 3, epochs: int = 12,
              min_steps: int = 240, batch: int = 256, rate: float = 8e-3) -> Model:
    """Train on texts with 0/1 labels; every fifth text calibrates instead of training.

    An epoch reads one window of each text, drawn anew from all its windows, with the text's label; over the
    epochs the windows of a short text are all read, those of a very long one only in part. Calibration and
    scoring read every window of every text.
    """
    labels = np.asarray(labels)
    if len(set(labels.tolist())) < 2:
        return Model({})
    rng = np.random.default_rng(seed)
    tune = np.arange(len(texts)) % 5 == 4
    if len(set(labels[tune])) < 2 or len(set(labels[~tune])) < 2:
        tune = np.zeros(len(texts), dtype=bool)
    train = np.flatnonzero(~tune)
    w = read_words([texts[i] for i in train])
    y_text = labels[train].astype(np.float32)
    n_win = np.bincount(w.window_text, minlength=len(train))
    first = np.cumsum(n_win) - n_win
    # both classes weigh the same, however many texts they have
    weight = np.where(y_text == 1, 0.5 / max(1, (y_text == 1).sum()), 0.5 / max(1, (y_text == 0).sum())) * len(train)
    p = init_params(seed)
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v = {k: np.zeros_like(a) for k, a in p.items()}
    per_epoch = -(-len(train) // batch)
    epochs = max(epochs, -(-min_steps // per_epoch))
    step, total = 0, epochs * per_epoch
    for epoch in range(epochs):
        order = rng.permutation(len(train))
        for lo in range(0, len(order), batch):
            docs = order[lo:lo + batch]
            rows = first[docs] + (rng.random(len(docs)) * n_win[docs]).astype(np.int64)
            part = _sub_words(w, rows)
            x, grams = word_inputs(p, part)
            logit, tape = forward(p, x, part.windows, keep=True)
            d = ((_sigmoid(logit) - y_text[docs]) * weight[docs] / len(docs)).astype(np.float32)
            g = backward(p, part, x, grams, tape, d)
            norm = np.sqrt(sum(float((a * a).sum()) for a in g.values()))
            step += 1
            lr = rate * min(1.0, 2 * (1 - step / (total + 1)))
            for k in p:
                a = g[k] * min(1.0, 5.0 / (norm + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * a
                v[k] = 0.999 * v[k] + 0.001 * a * a
                p[k] = p[k] - lr * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    model = Model({k: a.astype(np.float32) for k, a in p.items()})
    rest = np.flatnonzero(tune) if tune.any() else train
    x = np.concatenate([model.evidence([texts[i] for i in rest[k:k + 200]]) for k in range(0, len(rest), 200)])
    y = labels[rest].astype(np.float64)
    share = labels.mean()
    base = share if base_rate is None else base_rate
    model.weight, model.bias = _logistic(x, y, np.where(y == 1, base / share, (1 - base) / (1 - share)))
    return model


# ------------------------------------------------------------------ Spark

def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        out: Column | None = None, max_positive: int = MAX_POSITIVE, max_negative: int = MAX_NEGATIVE,
        seed: int = 3) -> Model:
    """Fit on the labelled rows outside ``out`` with the smallest hashes, at most so many of each class."""
    out = held_out(id_col, 5, 0) if out is None else out
    known = labels.where(F.col(id_col).isNotNull() & ~out & F.col(label_col).isin(0, 1)) \
        .groupBy(id_col).agg(F.max(label_col).alias("y"))
    known = known.join(docs.select(id_col), id_col, "left_semi")
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    hashed = F.xxhash64(F.col(id_col), F.lit(seed))
    picked = (smallest_hashes(known.where("y = 1"), max_positive, hashed, id_col)
              .unionByName(smallest_hashes(known.where("y = 0"), max_negative, hashed, id_col))
              .withColumnRenamed(id_col, "__id"))  # at most max_positive + max_negative ids
    rows = docs.select(id_col, text_col).join(F.broadcast(picked), F.col(id_col) == F.col("__id"))
    # of rows that share a picked id the smallest text counts, so what reaches the driver is bounded by the ids
    rows = rows.groupBy(id_col, "y").agg(F.min(text_col).alias(text_col))
    got = rows.toPandas().sort_values(id_col)
    order = np.random.default_rng(seed).permutation(len(got))
    texts = [(t or "").encode() for t in got[text_col].to_numpy()[order]]
    base = counts.get(1, 0) / max(1, sum(counts.values()))
    return fit_texts(texts, got["y"].to_numpy()[order], base, seed)


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with ``score_col`` added: the estimated chance that a text is toxic."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for col in batches:
            batch = pa.RecordBatch.from_arrays([pa.array(np.arange(len(col))), col], names=["i", "t"])
            out = [model.scores(texts) for _, texts in text_slices(batch)]
            yield pa.array(np.concatenate(out) if out else np.empty(0))

    return docs.withColumn(score_col, F.arrow_udf(run, T.DoubleType())(F.col(text_col)))
