"""SimHash with BK-trees, content-defined chunks and sorted suffix runs against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from corpusprep.llm import cdc_dedup as C
from corpusprep.llm import simhash_bktree as H
from corpusprep.llm import suffix_dedup as S
from corpusprep.llm import suffix_runs as R

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


def words(rnd, n, vocabulary=400):
    return " ".join(f"w{rnd.randrange(vocabulary):x}q" for _ in range(n))


# ------------------------------------------------------------------ SimHash

def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps, radius=2):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(fps)):
        groups.setdefault(find(i), []).append(ids[i])
    return {r: min((x for x in g if x is not None), default=None) for r, g in groups.items()}, find


def test_simhash_edge_cases_against_brute_force(spark):
    rnd = random.Random(1)
    base = words(rnd, 300)
    texts = [None, "", " \t\n", "one", "One TWO", "ÄÖ äö Ä", "a\x0bb\x0cc d", "a b c", base, base.upper(), base + " tail",
             base.replace("w1q", "w2q", 1), words(rnd, 40), "x" * 50, words(rnd, 60_000)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(8, base), (None, base), (None, "nothing like it")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("fp", F.lit("clash")).withColumn("component_id", F.lit(0))
    got = H.simhash_components(df).collect()
    fps = [brute_fingerprint(t) for _, t in rows]
    names, find = brute_components([i for i, _ in rows], fps)
    want = Counter((rows[k][0], fps[k], names[find(k)]) for k in range(len(rows)))
    assert Counter((r.doc_id, r.fp % 2**64, r.component_id) for r in got) == want
    kept = [r.doc_id for r in H.deduplicate(df).collect()]
    assert kept.count(8) == 2 and 0 in kept and 1 not in kept and kept.count(None) == 2
    assert H.simhash_components(df.limit(0)).count() == 0


def test_simhash_query_equals_brute_force_on_whole_table(spark):
    import __spark_entry__ as E
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    fps = [brute_fingerprint(d.text) for d in docs]
    names, find = brute_components([d.doc_id for d in docs], fps)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in E.queries()["op8_simhash_bktree"](spark, SF).collect()}
    assert got == {d.doc_id: (f"{fps[k]:016x}", names[find(k)]) for k, d in enumerate(docs)}


def test_bk_forest_finds_every_neighbour():
    rng = np.random.default_rng(4)
    centre = rng.integers(0, 2**63, 3, dtype=np.uint64)
    fp = set()
    for _ in range(600):
        x = int(centre[rng.integers(3)])
        for b in rng.integers(0, 16, rng.integers(0, 7)):
            x ^= 1 << int(b)
        fp.add(x)
    fp = np.array(sorted(fp), dtype=np.uint64)
    shard = fp >> np.uint64(16)
    forest = H.BKForest(fp, shard)
    q, n = forest.search(np.arange(len(fp)), 2)
    want = {(i, j) for i in range(len(fp)) for j in range(len(fp))
            if shard[i] == shard[j] and bin(int(fp[i] ^ fp[j])).count("1") <= 2}
    assert set(zip(q.tolist(), n.tolist())) == want and len(q) == len(want)
    a, _ = forest.spanning_links(2, block=100)
    assert len(a) < len(fp)


# ------------------------------------------------------------------ chunks

def brute_chunks(t):
    ends, pos = [], 0
    while len(t) - pos > C.MIN_BYTES:
        h, at = 0, None
        for j in range(max(0, pos - 40), min(len(t), pos + C.MAX_BYTES)):
            h = ((h << 1) + int(C.GEAR[t[j]])) & 0xFFFFFFFF
            if j + 1 - pos >= C.MIN_BYTES and j + 1 < len(t) and t[j + 1] & 0xC0 != 0x80 \
                    and h >> (C.WINDOW - C.MASK_BITS) & (1 << C.MASK_BITS) - 1 == 0:
                at = j + 1
                break
        if at is None:
            at = min(len(t), pos + C.MAX_BYTES)
            while at < len(t) and t[at] & 0xC0 == 0x80:
                at -= 1
        ends.append(at)
        pos = at
    if pos < len(t):
        ends.append(len(t))
    return [t[a:b] for a, b in zip([0, *ends], ends)]


def brute_cdc(rows):
    first = {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        for c in brute_chunks((t or "").encode()):
            first.setdefault(c, i)
    out = []
    for i, t in rows:
        if i is None or t is None:
            out.append((i, t))
            continue
        kept, run, seen = [], [], set()

        def close():
            if sum(map(len, run)) < C.MIN_RUN_BYTES:
                kept.extend(run)
            run.clear()
        for c in brute_chunks(t.encode()):
            if first[c] < i or c in seen:
                run.append(c)
            else:
                close()
                kept.append(c)
            seen.add(c)
        close()
        out.append((i, b"".join(kept).decode()))
    return Counter(out)


def test_chunks_edge_cases_against_brute_force(spark):
    rnd = random.Random(2)
    passage, long = words(rnd, 60), words(rnd, 20_000)
    rows = [(0, None), (1, ""), (2, "short"), (3, words(rnd, 80) + " " + passage), (4, passage + " " + words(rnd, 80)),
            (5, "é" * 500), (6, "é" * 500), (7, "ab" * 1000), (8, long), (9, words(rnd, 5) + long), (9, words(rnd, 50)), (10, passage),
            (10, passage), (None, passage), (None, None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("locs", F.lit("clash")).withColumn("cdc_spans", F.lit("clash"))
    out = C.deduplicate(df)
    assert out.columns == ["doc_id", "text", "locs", "cdc_bytes", "cdc_chunks", "cdc_duplicates", "cdc_removed", "cdc_spans"]
    got = Counter((r.doc_id, r.text) for r in out.collect())
    assert got == brute_cdc(rows)
    assert len(dict(got)) and (4, passage + " ") not in got
    assert C.deduplicate(df.limit(0)).count() == 0


def test_chunks_resist_an_insertion(spark):
    rnd = random.Random(3)
    t = words(rnd, 3000).encode()
    a, b = brute_chunks(t), brute_chunks(t[:500] + b"something new " + t[500:])
    assert len(set(a) - set(b)) <= 4
    (starts, names), = C.Chunker()([t])
    assert [t[s:e] for s, e in zip(starts, [*starts[1:], len(t)])] == a and len(names) == len(a)


def test_second_copies_of_51_words_are_found(spark):
    """400 passages, each planted in two texts: at most 2 % of the second copies stay whole, 5 % lose less than half."""
    rnd = random.Random(9)
    rows, at = [], {}
    for k in range(400):
        passage = words(rnd, 51, 10**6)
        left = words(rnd, rnd.randint(20, 120), 10**6) + " "
        rows.append((k, words(rnd, rnd.randint(20, 120), 10**6) + " " + passage + " " + words(rnd, 60, 10**6)))
        rows.append((1000 + k, left + passage + " " + words(rnd, 60, 10**6)))
        at[1000 + k] = len(passage)
    got = {r.doc_id: r.cdc_removed for r in C.deduplicate(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[k] == 0 for k in range(400))
    share = [got[i] / n for i, n in at.items()]
    assert all(s <= 1 for s in share)
    assert sum(s == 0 for s in share) <= 8 and sum(s < 0.5 for s in share) <= 20 and sum(share) / len(share) >= 0.78


def test_chunk_query_equals_brute_force_on_whole_table(spark):
    import __spark_entry__ as E
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = E.queries()["op2_cdc_dedup"](spark, SF).collect()
    assert Counter((r.doc_id, r.text) for r in got) == brute_cdc(rows)
    size = {i: len(t.encode()) for i, t in rows}
    assert all(r.n_bytes == size[r.doc_id] and r.n_removed == r.n_bytes - len(r.text.encode()) for r in got)


# ------------------------------------------------------------------ suffixes

def brute_repeats(texts, length):
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        mark = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                mark[i:i + length] = b"\1" * length
        kept = bytes(x for x, m in zip(t, mark) if not m)
        out.append((len(t), sum(mark), len(re.findall(b"\1+", bytes(mark))), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [10**9, 3, 0])
def test_repeats_against_brute_force(spark, hot):
    rnd = random.Random(5)
    base = ["".join(rnd.choice("ab ") for _ in range(60)) for _ in range(6)]
    texts = ["".join(rnd.choice(base)[rnd.randint(0, 20):rnd.randint(25, 60)] for _ in range(rnd.randint(0, 5)))
             + "ab" * rnd.choice((0, 0, rnd.randint(0, 30))) for _ in range(60)]
    texts[3], texts[4] = None, ""
    texts[5] = texts[6] = "é" * 40
    rows = [(i, t) for i, t in enumerate(texts)] + [(7, texts[7]), (None, "x" * 19), (None, "unique " + base[0])]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("row_key", F.lit("clash")).repartition(4)
    got = S.remove_repeats(df, length=20, anchor=7, hot=hot, filter_bits=(12, 12)).collect()
    want = brute_repeats([(t or "").encode() for _, t in rows], 20)
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == \
        Counter((i, *w) for (i, _), w in zip(rows, want))
    assert S.remove_repeats(df.limit(0), length=20, anchor=7).count() == 0


def test_repeats_in_a_text_longer_than_a_segment(spark):
    rnd = random.Random(6)
    t = "".join(rnd.choice("abcdefgh") for _ in range(1_200_000))
    edge = (1 << 20) - 300
    df = spark.createDataFrame([(1, t), (2, "zz" + t[edge:edge + 600] + "yy"), (3, t[:199])], SCHEMA)
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in S.remove_repeats(df).collect()}
    assert got == {1: (600, 1), 2: (600, 1), 3: (0, 0)}


def test_repeat_query_equals_brute_force_on_whole_table(spark):
    import __spark_entry__ as E
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = brute_repeats([r.text.encode() for r in rows], 200)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in E.queries()["op4_suffix_dedup"](spark, SF).collect()}
    assert got == {r.doc_id: w for r, w in zip(rows, want)}


def test_merge_of_front_coded_runs():
    rnd = random.Random(7)
    for _ in range(300):
        runs = [sorted(bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 6))) for _ in range(rnd.randint(0, 9)))
                for _ in range(rnd.randint(0, 7))]
        got = list(R.merge_runs([R.front_code(r) for r in runs]))
        want = sorted(x for r in runs for x in r)
        assert [g[1] for g in got] == want
        for i, (lcp, s, run, place) in enumerate(got):
            assert runs[run][place] == s and lcp == (R.common_prefix(want[i - 1], s) if i else 0)


def test_repeated_offsets_small_and_large_groups():
    rnd = random.Random(8)
    length = 6
    for _ in range(300):
        recs = []
        for _ in range(rnd.randint(1, 30)):
            lo = rnd.randint(0, 2)
            hi = lo + rnd.randint(0, 3)
            recs.append((b"a" + bytes(rnd.choice(b"ab") for _ in range(length - lo - 1)),
                         bytes(rnd.choice(b"ab") for _ in range(hi)), lo, hi))
        recs.sort()
        right = [r[0] for r in recs]
        lcps = [0] + [R.common_prefix(a, b) for a, b in zip(right, right[1:])]
        got = R.repeated_offsets(right, lcps, *(list(c) for c in list(zip(*recs))[1:]), length)
        windows = {}
        for i, (r, left, lo, hi) in enumerate(recs):
            for j in range(lo, hi + 1):
                windows.setdefault((j, r[:length - j], left[:j]), []).append(i)
        want = [set() for _ in recs]
        for (j, _, _), who in windows.items():
            for i in who if len(who) > 1 else ():
                want[i].add(j)
        assert [{j for a, b in g for j in range(a, b + 1)} for g in got] == want
