import random
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from corpusprep.operators import components as C
from corpusprep.operators import dedup as D
from corpusprep.operators.components import connected_components


def test_exact_dedup_normalization_and_smallest_id(spark):
    rows = [(5, "Hello, World 1"), (2, "hello world"), (9, "HELLO   WORLD!!"), (3, "other"), (7, "!!!"), (8, "  ")]
    df = spark.createDataFrame(rows, "id int, text string")
    kept = sorted(r.id for r in D.document_deduplicator(df, "id", lowercase=True, ignore_non_character=True).collect())
    assert kept == [2, 3, 7]  # 7 and 8 are both empty after normalization


def test_exact_dedup_idempotent_and_skew(spark):
    rows = [(i, "same text") for i in range(300)] + [(1000 + i, f"doc {chr(65 + i % 26)}{i}") for i in range(100)]
    df = spark.createDataFrame(rows, "id int, text string")
    once = D.document_deduplicator(df, "id", lowercase=True, ignore_non_character=False)
    twice = D.document_deduplicator(once, "id", lowercase=True, ignore_non_character=False)
    assert sorted(r.id for r in once.collect()) == sorted(r.id for r in twice.collect())
    assert once.count() == 101


def test_near_pairs_equal_brute_force(spark):
    rnd = random.Random(7)
    base = [rnd.getrandbits(64) for _ in range(40)]
    fps = set(base)
    for b in base[:25]:  # near copies at distance 1..9
        x = b
        for bit in rnd.sample(range(64), rnd.randint(1, 9)):
            x ^= 1 << bit
        fps.add(x)
    signed = [f - (1 << 64) if f >= 1 << 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    for blocks, h in [(9, 7), (10, 8), (6, 3), (12, 7)]:
        got = {(r.fp_a, r.fp_b) for r in D.near_pairs(df, "fp", blocks, h).collect()}
        want = {(min(a, b), max(a, b)) for a, b in combinations(signed, 2) if bin((a ^ b) & (2**64 - 1)).count("1") <= h}
        assert got == want


def _brute_pairs(fps, h):
    arr, want = np.array(fps, dtype=np.uint64), set()
    for i, x in enumerate(arr):
        for j in np.flatnonzero(np.bitwise_count(arr[i + 1:] ^ x) <= h):
            want.add((int(x), int(arr[i + 1 + j])))
    return want


def _comparisons(cells):
    n = F.col("count").cast("double")
    return cells.groupBy("path", "key", "i", "j").count().agg(F.sum(n * n / 2)).first()[0]


def test_a_bucket_of_200000_is_split_on_its_remaining_bits(spark):
    """Distinct fingerprints that share two blocks: exact pairs with far fewer comparisons than all with all."""
    rng = np.random.default_rng(3)
    low = np.unique(rng.integers(0, 1 << 50, 200_000, dtype=np.uint64))
    near = low[:400].copy()
    for k in range(400):  # copies at distances 1 to 9
        for bit in rng.choice(50, 1 + k % 9, replace=False):
            near[k] ^= np.uint64(1 << int(bit))
    fps = np.unique(np.concatenate([low, near])).astype(np.int64)
    df = spark.createDataFrame(pd.DataFrame({"fp": fps}))
    cells, _ = D._dealt(df, 9, 7, D.CELL)
    assert _comparisons(cells) < 36 / 4 * len(fps) ** 2 / 2 / 8  # the bucket alone would be len(fps) ** 2 / 2
    got = {(r.fp_a, r.fp_b): r.distance for r in D.near_pairs(df, "fp", 9, 7).collect()}
    # every pair within 7 bits is one of a fingerprint and its copy, or found among pairs that share a 25-bit half's block
    want = {}
    u = fps.view(np.uint64)
    cuts = [50 * i // 8 for i in range(9)]
    for a, b in zip(cuts, cuts[1:]):
        part = (u >> np.uint64(a)) & np.uint64((1 << (b - a)) - 1)
        order = np.argsort(part, kind="stable")
        for group in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
            g = u[group]
            for i in range(len(g) - 1):
                d = np.bitwise_count(g[i + 1:] ^ g[i])
                for j in np.flatnonzero(d <= 7):
                    x, y = int(g[i]), int(g[i + 1 + j])
                    want[min(x, y), max(x, y)] = int(d[j])
    assert got == want and len(want) > 200


def test_a_ball_of_near_fingerprints_stays_a_grid(spark):
    """All within 6 bits of each other: splitting would multiply rows, so the bucket is dealt in blocks."""
    ball = sorted({0} | {1 << a | 1 << b | 1 << c for a in range(46) for b in range(a) for c in range(b)} | {1 << a for a in range(46)})
    ball = ball[:6000]
    df = spark.createDataFrame([(f,) for f in ball], "fp long")
    cells, paths = D._dealt(df, 9, 7, 1024)
    assert cells.groupBy("path", "key", "i", "j").count().agg(F.max("count")).first()[0] < 3 * 1024
    assert cells.count() < 36 * 8 * 12 * len(ball)
    roots = D.near_links(df, 9, 7, 1024)
    assert connected_components(df.withColumnRenamed("fp", "node"), roots, "node", "fp_a", "fp_b").select("label").distinct().count() == 1


def test_large_bucket_is_dealt_in_cells(spark):
    """20,000 distinct fingerprints that share their first two blocks: right links, bounded cells."""
    rnd = random.Random(11)
    low = sorted({rnd.getrandbits(50) for _ in range(20_000)})
    low += [x ^ 1 << rnd.randrange(50) for x in low[:300]]  # near copies
    fps = sorted(set(low))
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    cell = 1024
    dealt = D._dealt(df, 9, 7, cell)[0].groupBy("path", "key", "i", "j").count()
    assert dealt.agg(F.max("count")).first()[0] < 3 * cell
    got = {(r.fp_a, r.fp_b) for r in D.near_pairs(df, "fp", 9, 7, cell).collect()}
    want = _brute_pairs(fps, 7)
    assert got == want
    links = [(r.fp_a, r.fp_b) for r in D.near_links(df, 9, 7, cell).collect()]
    assert len(links) < 40 * len(fps)

    def parts(pairs):
        root = {f: f for f in fps}

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x
        for a, b in pairs:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
        return [find(f) for f in fps]

    assert parts(links) == parts(want)


def test_connected_components_chain(spark):
    nodes = spark.createDataFrame([(i,) for i in range(1, 8)], "node long")
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (6, 7)], "src long, dst long")
    got = {r.node: r.label for r in connected_components(nodes, edges).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5, 6: 6, 7: 6}


def test_connected_components_long_path_and_no_edges(spark):
    n = 400  # more rounds than a label could walk one step at a time in a fixed number of them
    order = list(range(n))
    random.Random(2).shuffle(order)
    edges = spark.createDataFrame(list(zip(order, order[1:])), "src long, dst long")
    nodes = spark.range(0, n + 1).withColumnRenamed("id", "node")
    got = {r.node: r.label for r in connected_components(nodes, edges).collect()}
    assert got == {**{i: 0 for i in range(n)}, n: n}
    assert connected_components(nodes, edges.limit(0)).where("node <> label").count() == 0


def _plain_roots(rows):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in rows:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_contraction_settles_nodes_early(spark, monkeypatch):
    """A shuffled path, a hub, a cycle and a clique over many partitions; integers contract, text nodes take star rounds."""
    rng = np.random.default_rng(5)
    path = rng.permutation(60_000)
    hub = np.stack([np.full(30_000, 300_000), np.arange(300_001, 330_001)], axis=1)
    cycle = np.stack([np.arange(400_000, 400_500), np.roll(np.arange(400_000, 400_500), 1)], axis=1)
    clique = np.array([(a, b) for a, b in combinations(range(500_000, 500_060), 2)])
    rows = np.concatenate([np.stack([path[:-1], path[1:]], axis=1), hub, cycle, clique])
    edges = spark.createDataFrame(pd.DataFrame({"src": rows[:, 0], "dst": rows[:, 1]})).repartition(5)
    want = _plain_roots(rows.tolist())
    written = []
    plain = C.materialize

    def counted(df, name):
        out = plain(df, name)
        written.append((name, out.count()))
        return out

    monkeypatch.setattr(C, "materialize", counted)
    monkeypatch.setattr(C, "LOCAL_EDGES", 1 << 13)
    assert {r.node: r.root for r in C.component_roots(edges).collect()} == want
    rounds = [n for name, n in written if name == "edges"]
    # star rounds alone take 15 of 90,000 edges each; here every round leaves fewer
    assert len(rounds) <= 15 and sum(n for _, n in written) < 15 * 90_000 / 2, written
    text = spark.createDataFrame([(f"n{a:06d}", f"n{b:06d}") for a, b in rows[59_000:61_000].tolist()], "src string, dst string")
    got = {r.node: r.root for r in C.component_roots(text).collect()}
    assert got == {f"n{a:06d}": f"n{b:06d}" for a, b in _plain_roots(rows[59_000:61_000].tolist()).items()}


def test_simhash_dedup_keeps_empty_and_smallest(spark):
    t = "the quick brown fox jumps over the lazy dog again and again"
    # 2 differs from 4 only in case and punctuation: same fingerprint after normalization
    rows = [(4, t), (2, t.upper() + "!"), (9, "completely different words in this one here"), (5, "..."), (6, "")]
    df = spark.createDataFrame(rows, "id long, text string")
    kept = D.document_simhash_deduplicator(df, "id", window_size=3, ignore_pattern=r"\p{P}", num_blocks=9,
                                           hamming_distance=7)
    ids = sorted(r.id for r in kept.collect())
    assert 2 in ids and 4 not in ids and 9 in ids and 5 in ids and 6 in ids


def test_fingerprint_fewer_tokens_than_window(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "")], "id long, text string")
    fp = {r.id: r.fp for r in D.fingerprints(df, "id", window_size=3).collect()}
    assert fp[2] is None and fp[1] is not None


def test_many_digests_at_once_are_md5():
    import hashlib

    from corpusprep.functions.digest import md5_prefixes
    rnd = random.Random(2)
    strings = [bytes(rnd.randrange(256) for _ in range(n)) for n in [*range(0, 70), 119, 120, 500]] * 3 + [b""] * 5000
    data, ends = b"".join(strings), np.cumsum([len(s) for s in strings])
    got = md5_prefixes(np.frombuffer(data, np.uint8), ends - [len(s) for s in strings], ends)
    assert [int(h) for h in got] == [int.from_bytes(hashlib.md5(s).digest()[:8], "big") for s in strings]
    assert md5_prefixes(np.empty(0, np.uint8), np.empty(0, np.int64), np.empty(0, np.int64)).size == 0


def test_fingerprints_by_the_definition():
    import hashlib
    rnd = random.Random(3)
    pieces = ["a", "bb", "ccc", "é", "日本", "\U0001f600", " ", "\u3000", "\n", "x" * 80, "  "]
    texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randrange(40))) for _ in range(300)] + ["", " ", "one", "w " * 30_000]
    for by_word, window in ((True, 3), (False, 4), (True, 1)):
        want = []
        for t in texts:
            tokens = t.split() if by_word else t
            shingles = [(" " if by_word else "").join(tokens[i:i + window]) for i in range(max(1, len(tokens) - window + 1))] if tokens else []
            h = [int.from_bytes(hashlib.md5(s.encode()).digest()[:8], "big") for s in shingles]
            fp = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
            want.append((fp - (1 << 64) if fp >> 63 else fp) if h else None)
        assert D._fingerprints(texts, by_word, window) == want
