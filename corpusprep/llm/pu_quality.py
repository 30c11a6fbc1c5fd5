"""Quality classifier by positive-unlabelled learning with the non-negative risk estimator (nnPU).

Trained from trusted positives (labelled good) and unlabelled web text; labelled
bad rows are never shown to it. With class prior p, the risk
``p E_P[l(f)] + max(0, E_U[l(-f)] - p E_P[l(-f)])`` is minimised by Adam on a
small network; where the second term turns negative the step climbs it back
instead (Kiryo et al., 2017). The prior is estimated from the data: a plain
positive-against-unlabelled classifier orders texts, and the prior is the
smallest ratio of the unlabelled share to the positive share above any threshold
(best-bin estimation, Garg et al., 2021), measured on rows it did not see.

Features come from the whole text: shares of byte classes, word and line
statistics, repetition, and hashed byte pairs. The ids, language, source and
labels never enter a score.

On Spark: features are computed where the rows are and a score needs no shuffle.
The model is fitted on at most ``max_positives`` and ``max_unlabelled`` rows (the
smallest hashes of their ids), which bounds what reaches the driver; scoring
covers every row.

Defined results: null and empty texts are scored on zero features; rows with a
null id are scored (held_out false) and never trained on; repeated rows get equal
scores. Extra columns pass through ``filter_quality`` untouched. Without a positive or
an unlabelled row there is nothing to learn from: every text then scores 1 and nothing
is rejected. An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.splits import smallest_hashes
from .common import text_slices
from .string_tiling import lowered, token_hashes

#: Production parameters.
MAX_POSITIVES, MAX_UNLABELLED = 4000, 8000
PAIR_BUCKETS, HIDDEN = 128, 24
THRESHOLD = 0.7

_CLASSES = [b" \t", b"\n\r", bytes(range(48, 58)), bytes(range(97, 123)), bytes(range(65, 91)), b".", b",", b"'\"",
            b"!?", b";:", b"-_", b"()[]{}", b"|", b"%$#", b"*&@", b"<>/\\=+~^`", bytes(range(128, 256))]
_CLASS_OF = np.full(256, len(_CLASSES), dtype=np.int64)
for _k, _c in enumerate(_CLASSES):
    _CLASS_OF[list(_c)] = _k
_N_CLASSES = len(_CLASSES) + 1
_SOFT = np.array([1.0, 4.0, 16.0])  # pseudo-counts that keep ratios of short texts moderate
N_STATS = 14
N_FEATURES = _N_CLASSES + N_STATS + PAIR_BUCKETS


def held_out(id_col: str = "doc_id", modulus: int = 4, remainder: int = 2) -> Column:
    """Whether a row is kept out of training: crc32 of the id as text, by remainder."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def features(texts: list[bytes]) -> np.ndarray:
    """One row of ``N_FEATURES`` numbers per text, from the whole text."""
    n = len(texts)
    sep = b"\n\n"
    joined = sep.join(texts) + sep
    data = np.frombuffer(joined, dtype=np.uint8)
    size = np.fromiter(map(len, texts), np.int64, n)
    start = np.concatenate(([0], np.cumsum(size + 2)[:-1]))
    doc = np.repeat(np.arange(n), size + 2)
    own = np.ones(len(data), dtype=bool)
    own[start + size] = own[start + size + 1] = False
    cls = np.bincount((doc * _N_CLASSES + _CLASS_OF[data])[own], minlength=n * _N_CLASSES).reshape(n, -1)
    pair = (data[:-1].astype(np.int64) * 31 + data[1:].astype(np.int64) * 17) % PAIR_BUCKETS
    both = own[:-1] & own[1:]
    pairs = np.bincount((doc[:-1] * PAIR_BUCKETS + pair)[both], minlength=n * PAIR_BUCKETS).reshape(n, -1)

    low = data.copy()
    upper = (data >= 65) & (data <= 90)
    low[upper] += 32
    at, end, h = token_hashes(low)
    wdoc = doc[at] if at.size else np.empty(0, np.int64)
    words = np.bincount(wdoc, minlength=n)
    same = lambda k: np.bincount(wdoc[k:][(h[k:] == h[:-k]) & (wdoc[k:] == wdoc[:-k])], minlength=n)
    order = np.lexsort((h, wdoc))
    fresh = np.ones(len(h), dtype=bool)
    fresh[1:] = (h[order][1:] != h[order][:-1]) | (wdoc[order][1:] != wdoc[order][:-1])
    unique = np.bincount(wdoc[order][fresh], minlength=n)
    # the commonest word's share, from the runs of equal words in the sorted order
    first = np.flatnonzero(fresh)
    runs = np.diff(np.append(first, len(h)))
    top = np.zeros(n)
    np.maximum.at(top, wdoc[order][first], runs)
    length = (end - at).astype(float)
    wsum, wsq = np.bincount(wdoc, length, n), np.bincount(wdoc, length ** 2, n)
    long_words = np.bincount(wdoc[length > 20], minlength=n)
    short_words = np.bincount(wdoc[length <= 2], minlength=n)
    lines = cls[:, 1] + 1.0
    w1 = words + 1.0
    mean = wsum / w1
    stats = np.stack([np.log1p(size), np.log1p(words), mean, np.sqrt(np.maximum(wsq / w1 - mean ** 2, 0)),
                      *[(words - same(k)) / w1 for k in (1, 2)], np.log1p(same(1)), unique / w1,
                      np.log1p(words) - np.log1p(unique), top / w1, long_words / w1, short_words / w1,
                      np.log1p(words / lines), cls[:, 0] / w1], axis=1)
    share = np.sqrt(cls / (size[:, None] + _SOFT[1]))
    return np.concatenate([share, stats, np.sqrt(pairs / (size[:, None] + _SOFT[2]))], axis=1).astype(np.float32)


# ------------------------------------------------------------------ model

def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Network:
    """Standardised features, one tanh layer with a linear bypass, one output."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    direct: np.ndarray
    b2: float
    prior: float = float("nan")

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.tanh(z @ self.w1 + self.b1) @ self.w2 + z @ self.direct + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x))


def _train(pos: np.ndarray, unl: np.ndarray, prior: float | None, steps: int, seed: int, beta: float = 0.0,
           rate: float = 1e-2, decay: float = 1e-4, batch: int = 512) -> Network:
    """Adam on the non-negative risk with ``prior``, or on plain positive-against-unlabelled log loss without one."""
    rng = np.random.default_rng(seed)
    both = np.concatenate([pos, unl])
    mean, scale = both.mean(0), both.std(0) + 1e-3
    d = both.shape[1]
    net = [rng.normal(0, d ** -0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN ** -0.5, HIDDEN),
           np.zeros(d), np.zeros(1)]
    m, v = [np.zeros_like(p) for p in net], [np.zeros_like(p) for p in net]
    zp, zu = (np.clip((a - mean) / scale, -6, 6).astype(np.float64) for a in (pos, unl))
    for step in range(1, steps + 1):
        a, b = zp[rng.integers(0, len(zp), batch)], zu[rng.integers(0, len(zu), batch)]
        z = np.concatenate([a, b])
        hid = np.tanh(z @ net[0] + net[1])
        s = _sigmoid(hid @ net[2] + z @ net[3] + net[4])
        sp, su = s[:batch], s[batch:]
        if prior is None:
            g = np.concatenate([(sp - 1) / batch, su / batch]) / 2
        else:
            # logistic loss: l(f) = -log s, l(-f) = -log(1 - s); dl(f)/df = s - 1, dl(-f)/df = s
            negative = -np.log1p(-su + 1e-12).mean() + prior * np.log1p(-sp + 1e-12).mean()
            g_neg = np.concatenate([-prior * sp / batch, su / batch])
            g = -g_neg if negative < -beta else g_neg + np.concatenate([prior * (sp - 1) / batch, np.zeros(batch)])
        gh = np.outer(g, net[2]) * (1 - hid ** 2)
        grads = [z.T @ gh + decay * net[0], gh.sum(0), hid.T @ g + decay * net[2], z.T @ g + decay * net[3], g.sum(keepdims=True)]
        lr = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for i, gr in enumerate(grads):
            m[i] = 0.9 * m[i] + 0.1 * gr
            v[i] = 0.999 * v[i] + 0.001 * gr * gr
            net[i] = net[i] - lr * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
    return Network(mean, scale, net[0], net[1], net[2], net[3], float(net[4][0]))


def estimate_prior(pos_scores: np.ndarray, unl_scores: np.ndarray, confidence: float = 0.1, slack: float = 0.01) -> float:
    """The smallest upper bound on the share of positives among the unlabelled over all thresholds (best bin)."""
    p, u = np.sort(pos_scores), np.sort(unl_scores)
    t = np.unique(np.concatenate([p, u]))
    qp = 1 - np.searchsorted(p, t) / len(p)
    qu = 1 - np.searchsorted(u, t) / len(u)
    room = np.sqrt(np.log(4 / confidence) / 2) * (len(p) ** -0.5 + len(u) ** -0.5)
    ok = qp > 0.2
    if not ok.any():
        return 0.5
    best = np.argmin(((qu + (1 + slack) * room) / np.maximum(qp, 1e-9))[ok])
    return float(np.clip(qu[ok][best] / qp[ok][best], 0.01, 0.99))


def fit_matrix(pos: np.ndarray, unl: np.ndarray, seed: int = 7, steps: int = 4000) -> Network:
    """nnPU network from positive and unlabelled feature rows, with the prior estimated by two-fold cross-scoring."""
    if len(pos) == 0 or len(unl) == 0:
        zero = np.zeros(N_FEATURES)
        return Network(zero, zero + 1, np.zeros((N_FEATURES, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), zero, 100.0, 1.0)
    ps, us = np.empty(len(pos)), np.empty(len(unl))
    for fold in (0, 1):
        tp, tu = np.arange(len(pos)) % 2 == fold, np.arange(len(unl)) % 2 == fold
        if tp.all() or tu.all() or not tp.any() or not tu.any():
            tp, tu = np.ones(len(pos), bool), np.ones(len(unl), bool)
            net = _train(pos, unl, None, steps // 8, seed)
            ps, us = net.scores(pos), net.scores(unl)
            break
        net = _train(pos[tp], unl[tu], None, steps // 8, seed + fold)
        ps[~tp], us[~tu] = net.scores(pos[~tp]), net.scores(unl[~tu])
    prior = estimate_prior(ps, us)
    net = _train(pos, unl, prior, steps, seed)
    net.prior = prior
    return net


# ------------------------------------------------------------------ Spark

def feature_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in text_slices(batch):
                x = features(texts)
                flat = pa.array(x.reshape(-1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, batch.schema.field(0).type),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1, dtype=np.int32) * N_FEATURES), flat)],
                    names=["id", "x"])

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("x", T.ArrayType(T.FloatType()))])
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        out: Column | None = None, max_positives: int = MAX_POSITIVES, max_unlabelled: int = MAX_UNLABELLED,
        seed: int = 7) -> Network:
    """Fit on the rows with the smallest hashes: labelled 1 (outside ``out``) as positives, never labelled as unlabelled."""
    out = held_out(id_col) if out is None else out
    hashed = F.xxhash64(F.col(id_col), F.lit(seed))
    known = labels.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).alias("y"))
    ids = docs.select(id_col).where(F.col(id_col).isNotNull() & ~out).distinct().join(known, id_col, "left")
    pos = smallest_hashes(ids.where(F.col("y") == 1).select(id_col), max_positives, hashed, id_col)
    unl = smallest_hashes(ids.where(F.col("y").isNull()).select(id_col), max_unlabelled, hashed, id_col)
    picked = (pos.withColumn("p", F.lit(1)).unionByName(unl.withColumn("p", F.lit(0)))
              .withColumnRenamed(id_col, "__id"))  # at most max_positives + max_unlabelled ids
    rows = docs.select(id_col, text_col).join(F.broadcast(picked), F.col(id_col) == F.col("__id"))
    # of rows that share a picked id the smallest text counts, so what reaches the driver is bounded by the ids
    rows = rows.groupBy(id_col).agg(F.min(text_col).alias(text_col))
    x = feature_rows(rows, id_col, text_col).join(F.broadcast(picked), F.col("id") == F.col("__id"))
    got = x.select("id", "p", "x").toPandas()
    if got.empty:
        return fit_matrix(np.empty((0, N_FEATURES)), np.empty((0, N_FEATURES)))
    got = got.sort_values("id")
    m = np.array(got["x"].tolist(), dtype=np.float64).reshape(len(got), N_FEATURES)
    is_pos = got["p"].to_numpy() == 1
    return fit_matrix(m[is_pos], m[~is_pos], seed)


def score(docs: DataFrame, net: Network, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with ``score_col`` added: the estimated chance that a text is good."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for col in batches:
            out = []
            batch = pa.RecordBatch.from_arrays([pa.array(np.arange(len(col))), col], names=["i", "t"])
            for _, texts in text_slices(batch):
                out.append(net.scores(features(texts).astype(np.float64)))
            yield pa.array(np.concatenate(out) if out else np.empty(0))

    return docs.withColumn(score_col, F.arrow_udf(run, T.DoubleType())(F.col(text_col)))


def filter_quality(docs: DataFrame, net: Network, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores ``threshold`` or more."""
    return score(docs, net, text_col, "__quality").where(F.col("__quality") >= threshold).drop("__quality")
