"""Secret scan, vector codes and presence-mask search against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusprep.llm import common
from corpusprep.llm import mask_search as M
from corpusprep.llm import secret_scan as S
from corpusprep.llm import vector_codes as C

DOC = "doc_id long, text string, lang string, source string, n_chars long"


# ------------------------------------------------------------------ secret scan

def plain_base(text):
    """The base matches as the definition words them: maximal matches, failing ones dropped."""
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in re.finditer(
        r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[1]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(found)]


def test_base_matches_against_the_plain_definition():
    r = random.Random(3)
    pieces = ["password", "PassWd", "ſecret", "secret", "toKen", "toKen", "api_key", "APIKEY", "=", ":", " ", "\"", "'", "é", "\U0001f600", "AKIA", "AKIAABCDEFGHIJKLMN",
              "deadbeefdeadbeef", "0123456789abcdef0", "abcdefghijkl", "x.y-z/+_=", "==", "\n", "A", "7", "zzzzzzzzzzzzzzzzzzzzzzz1234567890abc"]
    for _ in range(3000):
        text = "".join(r.choice(pieces) for _ in range(r.randrange(14)))
        base, bare = S.scan_text(text)
        assert [f"{S.KINDS[k]}:{s}:{e}" for s, k, e, _ in base] == plain_base(text), text
        for s, _, e, v in bare:
            assert text[s:e] == v and not any(b[0] < e and s < b[2] for b in base)
        runs = [m for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text) if not any(b[0] < m.end() and m.start() < b[2] for b in base)]
        assert [(b[0], b[2]) for b in bare] == [m.span() for m in runs]


def test_ownership_separates_copied_examples_from_live_ones(spark):
    live, example, bare = "9f8e7d6c5b4a39281706", "abcdef0123456789aaaa", "Zx9Qw8Er7Ty6Ui5Op4Lk3"
    rows = [(1, f"token = {live}", "en", "acme/one", 0), (2, f"é {bare} end", "en", "acme/two", 0), (3, None, "en", None, 0), (4, "", None, "x/y", 0),
            (5, f"{bare}", "en", "acme/two", 0), (5, f"{bare}", "en", "acme/two", 0), (6, "w" * 100_000 + f" {bare}", "en", "acme/one", 0)]
    rows += [(100 + i, f"see {example} and password: changeme-changeme", "en", f"owner{i % 5}/r", 0) for i in range(60)]  # a third and more is one value
    docs = spark.createDataFrame(rows, DOC).withColumn("spans", F.lit("clash")).withColumn("value", F.lit(1)).withColumn("__row", F.lit(0))
    out = S.find_secrets(docs).collect()
    assert len(out) == len(rows)
    got = defaultdict(list)
    for r in out:
        got[r.doc_id].append(r)
    for i, text, *_ in rows:
        for r in got[i]:
            base = plain_base(text)
            assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
            assert set(base) <= set(r.spans.split(",")) and r.n_assign + r.n_access + r.n_hex == len(base)
    assert got[1][0].spans == "assign:0:28,hex:8:28" and got[1][0].n_live == 2
    assert got[2][0].spans == "live:2:23" and [r.spans for r in got[5]] == ["live:0:21"] * 2
    assert got[6][0].spans == "live:100001:100022"
    assert got[3][0].spans == got[4][0].spans == "" and got[3][0].n_live == 0
    assert all(got[100 + i][0].n_copied >= 1 and "live" not in got[100 + i][0].spans for i in range(60))
    # the same bare value under a third owner is a copied example
    more = spark.createDataFrame(rows + [(7, bare, "en", "b/q", 0), (8, bare, "en", "c/q", 0)], DOC)
    assert all("live" not in r.spans for r in S.find_secrets(more).collect())


def test_secret_scan_of_empty_tables_and_null_repositories(spark):
    assert S.find_secrets(spark.createDataFrame([], DOC)).collect() == []
    bare = "Zx9Qw8Er7Ty6Ui5Op4Lk3"
    rows = [(None, bare, None, None, None), (2, bare, None, None, None), (3, bare, None, "a/b", None)]
    out = S.find_secrets(spark.createDataFrame(rows, DOC)).collect()  # null is one repository and one owner: two in all
    assert [r.spans for r in out] == ["live:0:21"] * 3 and {r.doc_id for r in out} == {None, 2, 3}


def test_join_counted_with_hot_and_rare_keys(spark, monkeypatch):
    rows = spark.createDataFrame([(k, i) for k, n in ((None, 50), ("hot", 900), ("b", 3), ("c", 1)) for i in range(n)], "key string, i long")
    counted = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    for share in (1 / 4096, 0.04, 0.9999):
        monkeypatch.setattr(common, "HOT_SHARE", share)
        out = common.join_counted(rows, counted, "key")
        assert Counter((r.key, r.n) for r in out.collect()) == {(None, 50): 50, ("hot", 900): 900, ("b", 3): 3, ("c", 1): 1}


# ------------------------------------------------------------------ vector codes

def brute_codes(rows, parts=4, entries=256, rounds=4):
    """Every part against every entry in Python integers; ``rows`` are (id, vector, label), kept ones only."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2] is None, r[2] or 0))
    whole = lambda v: [math.floor(1024 * x) for x in v]
    cut = lambda v, p: v[p * len(v) // parts:(p + 1) * len(v) // parts]
    books = [[cut(whole(v), p) for _, v, _ in order[:entries]] for p in range(parts)]
    vecs = [whole(v) for _, v, _ in rows]

    def assign():
        out = []
        for v in vecs:
            mine = []
            for p in range(parts):
                d = [sum((a - b) ** 2 for a, b in zip(cut(v, p), e)) for e in books[p]]
                mine.append((d.index(min(d)), min(d)))
            out.append(mine)
        return out

    for _ in range(rounds):
        at = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                members = [cut(v, p) for v, a in zip(vecs, at) if a[p][0] == e]
                if members:
                    books[p][e] = [sum(c) // len(members) for c in zip(*members)]
    at = assign()
    by_label = Counter()
    for (_, _, label), a in zip(rows, at):
        by_label[label] += sum(d for _, d in a)
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, "".join(f"{c:02x}" for c, _ in a), min(sum(d for _, d in a), C.LONG_MAX), min(by_label[label], C.LONG_MAX), sha)
                   for (i, _, label), a in zip(rows, at)), key=repr)


VEC = "vec_id long, embedding array<double>, label int"


def test_vector_codes_equal_brute_force(spark, monkeypatch):
    r = random.Random(5)
    centres = [[r.uniform(-1, 1) for _ in range(8)] for _ in range(12)]
    kept = [(i, [c + r.gauss(0, 0.01) for c in r.choice(centres)], r.choice([None, 1, 2, 3])) for i in range(120)]
    kept += [(200 + i, [0.25] * 8, 7) for i in range(60)]  # a third of the rows is one vector
    kept += [(None, [0.5] * 8, None), (3, [-0.0] * 8, 1), (5, [0.1] * 8, 2), (5, [0.1] * 8, 2)]
    dropped = [(900, None, 1), (901, [0.1] * 7 + [None], 1), (902, [float("nan")] * 8, 1), (903, [float("inf")] * 8, 1), (904, [], 1), (905, [0.1] * 6, 1),
               (906, [0.1] * 12, 1)]
    rows = kept + dropped
    r.shuffle(rows)
    table = spark.createDataFrame(rows, VEC).withColumn("code", F.lit("x")).withColumn("row", F.lit(1)).repartition(5)
    for block, size, entries in ((256, 1 << 16, 256), (7, 50, 16)):
        monkeypatch.setattr(C, "BLOCK", block)
        monkeypatch.setattr(C, "RANGE", size)
        got = sorted((tuple(x) for x in C.compress(table, entries=entries).collect()), key=repr)
        assert got == brute_codes([x for x in rows if x in kept], entries=entries)


@pytest.mark.parametrize("size", [3.0, 20_000.0, 5e5, 1e9, 1e23])
def test_vector_codes_are_exact_at_every_magnitude(spark, size):
    r = random.Random(int(size) % 97)
    rows = [(i, [r.uniform(-size, size) for _ in range(4)], i % 2) for i in range(30)]
    got = sorted((tuple(x) for x in C.compress(spark.createDataFrame(rows, VEC), entries=5).collect()), key=repr)
    assert got == brute_codes(rows, entries=5)


def test_vector_codes_of_empty_tables(spark):
    assert C.compress(spark.createDataFrame([], VEC)).collect() == []
    assert C.compress(spark.createDataFrame([(1, None, 2), (2, [], None)], VEC)).collect() == []


def test_shortlists_hold_every_nearest_entry_and_hilbert_steps_are_neighbours():
    g = np.random.default_rng(2)
    for kind in (np.float64, np.int64, object):
        for _ in range(40):
            x = g.integers(-50, 50, (20, 5))
            x = x // g.integers(1, 30)
            e = g.integers(-60, 60, (30, 5))
            near = C.shortlist(x.min(axis=0).astype(kind), x.max(axis=0).astype(kind), e.astype(kind))
            d = ((x[:, None] - e[None]) ** 2).sum(axis=2)
            assert set(d.argmin(axis=1)) <= set(near.tolist()) and (np.diff(near) > 0).all()
            at, best = C.nearest(x.astype(kind), e.astype(kind)[near])
            assert (near[at] == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
    tight = C.shortlist(np.array([5., 5.]), np.array([6., 6.]), np.array([[5., 5.], [90., 90.], [-70., 0.]]))
    assert tight.tolist() == [0]
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    index = C.hilbert_index(cells, 3)
    assert sorted(index.tolist()) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(index)], axis=0)).sum(axis=1) == 1).all()


# ------------------------------------------------------------------ presence-mask search

def plain_terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute_search(docs, items, k):
    counts = [(i, Counter(plain_terms(t))) for i, t in docs]
    n_docs, total = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for row, (i, c) in enumerate(counts):
            m = 75 + 25 * sum(c.values()) * n_docs // total if total else 0
            s = 0
            for t in plain_terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    s += w * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
            if s > 0:
                scored.append((-s, i is None, i or 0, row, i))
        out += [(item, rank + 1, s[4], -s[0]) for rank, s in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def test_terms_fold_only_ascii_letters():
    text = "Ünder_score ÀB İiK x2  y\u0085z \x1cq"
    assert [t.decode() for t in M.terms_of(text.encode())] == plain_terms(text)


def test_mask_search_equals_brute_force(spark, monkeypatch):
    r = random.Random(11)
    words = [f"w{i}" for i in range(150)] + ["é", "Ünï", "日本"]
    weights = [1 / (i + 1) for i in range(len(words))]
    text = lambda n: r.choice([" ", ", ", "\n"]).join(r.choices(words, weights, k=n))
    docs = [(i, text(r.randrange(1, 60))) for i in range(300)]
    docs += [(1000 + i, "w0 w1 common words") for i in range(150)]  # a third are copies
    docs += [(None, "w7 w8 w7"), (None, None), (5, ""), (5, "w9 w9"), (6, "--- ..."), (7, " ".join(f"w{i % 150}" for i in range(30_000)))]
    items = [(i, text(r.randrange(1, 12))) for i in range(20)]
    items += [(20, " ".join(words[:140])), (21, None), (22, ""), (23, "absent"), (24, "w0 W0 w0 w1"), (24, "w0 W0 w0 w1"), (None, "w7")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("rank", F.lit(1)).withColumn("__text", F.lit("z"))
    q = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(4))
    for rows, item_bytes, k in ((1 << 14, 1 << 24, 20), (40, 1 << 24, 3), (100, 400, 20)):
        monkeypatch.setattr(M, "CHUNK_ROWS", rows)
        monkeypatch.setattr(M, "ITEM_BYTES", item_bytes)
        got = sorted((tuple(x) for x in M.search(d.coalesce(1), q, k).collect()), key=repr)
        assert got == brute_search(docs, items, k)


def test_masks_are_left_out_only_when_they_cannot_matter():
    g = np.random.default_rng(4)
    for _ in range(60):
        n, terms, k = int(g.integers(1, 200)), int(g.integers(1, 80)), int(g.integers(1, 12))
        gain = g.integers(0, 50, (terms, n)) * (g.random((terms, n)) < 0.2)
        present, total = (gain > 0).astype(np.uint8), gain.sum(axis=0)
        seen = []

        def score_of(docs):
            seen.extend(docs.tolist())
            return total[docs]

        order = g.permutation(n)
        docs, scores = M.best_by_masks(iter(present), gain.max(axis=1), score_of, k, order)
        want = [d for d in np.lexsort((order, -total)) if total[d] > 0][:k]
        assert docs.tolist() == want and scores.tolist() == total[want].tolist()
        assert len(seen) == len(set(seen))


def test_mask_search_of_empty_tables(spark):
    d, q = "doc_id long, text string", "item_id long, text string"
    one = spark.createDataFrame([(1, "a b")], d)
    assert M.search(spark.createDataFrame([], d), spark.createDataFrame([(1, "a")], q)).collect() == []
    assert M.search(one, spark.createDataFrame([], q)).collect() == []
    assert [tuple(r) for r in M.search(one, spark.createDataFrame([(1, "a")], q)).collect()] == brute_search([(1, "a b")], [(1, "a")], 20)
