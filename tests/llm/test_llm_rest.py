"""String tiling, multi-index search, mixing, revisits, page differencing and the pipeline."""

import random
import re
from collections import Counter
from datetime import datetime

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusprep.llm import inverted_multi_index as I
from corpusprep.llm import page_differencing as G
from corpusprep.llm import queries as Q
from corpusprep.llm import revisits as V
from corpusprep.llm import string_tiling as S
from corpusprep.llm import temperature_mixing as M

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------------ string tiling

def tokens(text):
    return [t.encode() for t in re.findall("[0-9a-z\u0080-\U0010ffff]+", (text or "").lower())]


def brute_tiles(doc, item, least):
    """Greedy string tiling by comparing every place with every place."""
    n = min(least, len(item))
    free_d, free_i, covered = [True] * len(doc), [True] * len(item), 0
    while n:
        best = []
        for i in range(len(item)):
            for d in range(len(doc)):
                k = 0
                while (i + k < len(item) and d + k < len(doc) and free_i[i + k] and free_d[d + k] and item[i + k] == doc[d + k]):
                    k += 1
                if k >= n:
                    best.append((-k, i, d))
        if not best:
            return covered
        longest = min(best)[0]
        for k, i, d in sorted(b for b in best if b[0] == longest):
            if all(free_i[i:i - k]) and all(free_d[d:d - k]):
                covered -= k
                free_i[i:i - k] = free_d[d:d - k] = [False] * -k
    return covered


def test_tiles_by_hand_and_by_brute_force():
    w = lambda s: s.encode().split()
    assert S.greedy_tiles(w("a b c d e f g"), w("a b c d e f g"), 3) == [(7, 0, 0)]
    # reordered halves: both count
    assert sorted(S.greedy_tiles(w("e f g h x a b c d"), w("a b c d e f g h"), 3)) == [(4, 0, 5), (4, 4, 0)]
    # a second copy in the text finds nothing left to cover
    assert S.greedy_tiles(w("a b c a b c"), w("a b c"), 3) == [(3, 0, 0)]
    assert S.greedy_tiles(w("a b"), w("a b"), 5) == [(2, 0, 0)] and S.greedy_tiles([], w("a"), 5) == []
    rnd = random.Random(1)
    for _ in range(150):
        doc, item = ([rnd.choice([b"a", b"b", b"c"]) for _ in range(rnd.randint(0, n))] for n in (30, 14))
        assert sum(t[0] for t in S.greedy_tiles(doc, item, 3)) == brute_tiles(doc, item, 3)


@pytest.mark.parametrize("block_seeds", [S.BLOCK_SEEDS, 60])
def test_contamination_edge_cases(spark, block_seeds):
    rnd = random.Random(2)
    text = lambda n: " ".join(f"t{rnd.randrange(500)}" for _ in range(n))
    items = [(0, text(30)), (1, text(40)), (2, "Only Three Words"), (3, None), (4, ""), (None, text(20)), (5, text(12)), (5, text(12))]
    a, b = items[0][1].split(), items[1][1].split()
    docs = [(0, None), (1, ""), (2, text(200)), (3, text(50) + " " + items[0][1].upper() + " " + text(50)),
            (4, " ".join(b[20:] + ["gap"] + b[:20])), (5, "see only three words here"), (6, " ".join(a[:10])),
            (7, text(60_000) + " " + items[1][1] + " " + text(1000)), (8, items[0][1]), (8, items[0][1]), (8, text(9)),
            (None, items[0][1]), (9, ", ".join(a)), (10, "é " + items[6][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash")).withColumn("seeds", F.lit(1))
    it = spark.createDataFrame(items, "item_id long, text string").withColumn("n", F.lit("clash"))
    got = Counter((r.doc_id, r.item_id) for r in S.contaminated_pairs(df, it, block_seeds=block_seeds).collect())
    want = set()
    for i, t in docs:
        for k, x in items:
            item = tokens(x)
            if item and 2 * brute_tiles(tokens(t)[-2000:], item, 5) >= len(item):
                want.add((i, k))
    assert set(got) == want and {(4, 1), (7, 1), (None, 0), (5, 2)} <= want and (6, 0) not in want
    assert max(got.values()) == 1
    kept = [r.doc_id for r in S.decontaminate(df, it).collect()]
    assert sorted(x for x in kept if x is not None) == [0, 1, 2, 6] and None not in kept
    assert S.contaminated_pairs(df.limit(0), it).count() == 0 and S.contaminated_pairs(df, it.limit(0)).count() == 0


def test_equal_rows_do_not_add_up_and_null_items_are_found(spark):
    rnd = random.Random(6)
    item = " ".join(f"w{rnd.randrange(900)}" for _ in range(15))
    part = " ".join(item.split()[:5])
    docs = [(1, f"x {part} y"), (1, f"x {part} y"), (2, f"x {part} y {part} z"), (3, f"{part} {part}"), (None, item), (4, f"a {item} b"), (4, f"a {item} b")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    it = spark.createDataFrame([(None, item), (7, item)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_covered, r.n_tiles) for r in S.contaminated_pairs(df, it).collect()}
    assert got == {(d, i): (15, 1) for d in (None, 4) for i in (None, 7)}
    low = {(r.doc_id, r.item_id): r.coverage for r in S.contaminated_pairs(df, it, threshold=0.3).collect()}
    assert {low[d, i] for d in (1, 2, 3) for i in (None, 7)} == {1 / 3}  # 5 of 15 tokens, however often the rows repeat


def test_one_phrase_in_many_items_builds_no_pair(spark):
    rnd = random.Random(7)
    text = lambda n: " ".join(f"t{rnd.randrange(10_000)}" for _ in range(n))
    phrase = "the same five word phrase"
    docs = spark.createDataFrame([(i, f"{text(20)} {phrase} {text(20)}") for i in range(300)], "doc_id long, text string")
    items = spark.createDataFrame([(i, f"{text(10)} {phrase} {text(10)}") for i in range(300)], "item_id long, text string")
    keyed = items.select(F.col("item_id").alias("item"), F.col("text").alias("item_text"))
    index = S.seed_index(S._item_seeds(keyed, 5).toArrow())
    assert S._candidates(docs, "doc_id", "text", index, 0.5).count() == 0
    assert S._candidates(docs, "doc_id", "text", index, 0.2).count() == 90_000  # 5 of 25 tokens: all can reach this one
    assert S.contaminated_pairs(docs, items).count() == 0


def test_the_bound_never_drops_a_pair():
    rnd = random.Random(9)
    for _ in range(200):
        item = [rnd.choice([b"a", b"b", b"c", b"d"]) for _ in range(rnd.randint(1, 25))]
        doc = [rnd.choice([b"a", b"b", b"c", b"d"]) for _ in range(rnd.randint(1, 60))]
        n = min(3, len(item))
        h = lambda seq: S.token_hashes(np.frombuffer(b" ".join(seq), np.uint8))[2]
        seeds = S.seed_hashes(h(item), n).view(np.int64)
        index = S.seed_index(pa.table({"item": np.zeros(len(seeds), np.int64), "n": np.full(len(seeds), n), "size": np.full(len(seeds), len(item)),
                                       "seed": seeds, "place": np.arange(len(seeds))}))
        covered = brute_tiles(doc, item, 3)
        found = S.seed_hashes(h(doc), n).view(np.int64)
        if covered:
            fine, _, spots = S.reachable(found, index, covered / len(item))
            assert fine.tolist() == [0] and set(found[spots].tolist()) == set(found.tolist()) & set(seeds.tolist())


def test_contamination_query_equals_brute_force(spark):
    import __spark_entry__ as E
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = {r.item_id: tokens(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    want = {}
    for d in docs:
        doc = tokens(d.text)
        seeds = set(zip(*(doc[k:] for k in range(5))))
        for i, item in items.items():
            if seeds & set(zip(*(item[k:] for k in range(5)))) and 2 * (n := brute_tiles(doc, item, 5)) >= len(item):
                want[d.doc_id, i] = n
    got = {(r.doc_id, r.item_id): r.n_covered for r in E.queries()["op3_string_tiling"](spark, SF).collect()}
    assert got == want and want


# ------------------------------------------------------------------ multi-index

def test_multi_sequence_visits_cells_in_order():
    rng = np.random.default_rng(1)
    da, db, sizes = rng.random(9), rng.random(7), rng.integers(0, 5, 63)
    got = I.multi_sequence(da, db, sizes, int(sizes.sum()))
    order = sorted(range(63), key=lambda c: da[c // 7] + db[c % 7])
    assert got == [c for c in order if sizes[c]]
    few = I.multi_sequence(da, db, sizes, 40)
    assert few == got[:len(few)] and sizes[few].sum() >= 40 > sizes[few[:-1]].sum()


def test_search_edge_cases_are_exact_when_all_cells_are_visited(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), rng.normal(size=8).round(2).tolist()) for i in range(1, 400)]
    rows += [(i, [float(k) for k in range(1, 9)]) for i in range(1000, 1100)]  # a hot vector: ties by id
    bad = [(2000, None), (2050, [0.0] * 8), (2100, [float("nan")] * 8), (2150, [None] + [1.0] * 7), (2200, [1.0] * 3),
           (2250, [float("inf")] * 8), (None, [1.0] * 8), (2300, [])]
    df = spark.createDataFrame(rows + bad + [rows[49]], "vec_id long, embedding array<double>").withColumn("cell", F.lit("x"))
    got = {}
    for r in I.search(df, F.col("vec_id") % 50 == 0, block_rows=30, centroids=4).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    ids = np.array([i for i, _ in rows] + [rows[49][0]])
    x = np.array([v for _, v in rows] + [rows[49][1]])
    want = I.brute_force(ids, x, np.array([i for i in ids if i % 50 == 0]))
    assert {q: [i for i, _ in v] for q, v in got.items()} == want
    assert [i for i, _ in got[1000]] == [1001, 1002, 1003, 1004, 1005]
    for q, v in got.items():
        a = x[ids == q][0]
        for i, s in v:
            b = x[ids == i][0]
            assert abs(s - a @ b / np.linalg.norm(a) / np.linalg.norm(b)) < 1e-12
    assert I.search(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert I.search(df, F.col("vec_id") < 0).count() == 0
    two = spark.createDataFrame(rows[:2] + [(0, rows[5][1])], "vec_id long, embedding array<double>")
    assert I.search(two, F.col("vec_id") == 0).count() == 2


def test_search_query_recall(spark):
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.1"
    got = {}
    for r in E.queries()["op10_inverted_multi_index"](spark, sf).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=float)
    want = I.brute_force(ids, x, ids[ids % 50 == 0])
    assert set(got) == set(want)
    assert np.mean([len(set(got[q]) & set(v)) / len(v) for q, v in want.items()]) >= 0.9


# ------------------------------------------------------------------ mixing

def skewed(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    source = F.when(F.col("doc_id") % 3 > 0, "big").when(F.col("doc_id") % 2 == 0, "mid").otherwise(F.concat(F.lit("s"), F.col("doc_id") % 5))
    return docs.withColumn("source", source)


def test_mixing_equals_sql_on_skewed_sources(spark, tmp_path):
    docs = skewed(spark).toPandas()
    docs.to_parquet(tmp_path / "documents.parquet")
    con = duckdb.connect()
    con.register("documents", docs)
    want = con.sql(Q.OP5_SQL).df()
    out = Q.QUERIES["op5_temperature_mixing"](spark, str(tmp_path)).toPandas()
    key = lambda f: sorted(zip(f.doc_id, f.block, f.mix_key.round(9), f.source, f.text))
    assert key(out) == key(want) and out.block.max() >= 1 and len(out) != len(docs)
    tokens_of = out.text.str.split().str.len().groupby(out.source).sum()
    share = tokens_of / tokens_of.sum()
    entropy = -(share * np.log(share)).sum() / np.log(len(share))
    assert abs(entropy - 0.95) < 0.02


def test_mixing_by_repeats_and_edge_rows(spark):
    docs = skewed(spark).select("doc_id", "text", "source")
    n = M.token_count(F.col("text"))
    per = docs.groupBy("source").agg(F.sum(n).alias("tokens"))
    total = per.agg(F.sum("tokens")).first()[0]
    a = M.find_exponent(per, total, None, 1.5)
    rep = {r.source: r.tokens ** a for r in per.collect()}
    z = sum(rep.values())
    most = max(total * rep[r.source] / z / r.tokens for r in per.collect())
    assert 0 < a < 1 and 1.49 < most <= 1.5 + 1e-6
    out = M.mix(docs, max_repeats=1.5, target_entropy=None)
    assert out.agg(F.max("block")).first()[0] <= 1
    # whole blocks hold every document of their source once
    counts = out.where("block = 0").groupBy("doc_id").count()
    assert counts.where("count > 1").count() == 0

    rows = [(1, None, "a"), (2, "", None), (3, "x y", ""), (3, "x y", ""), (4, "z " * 5000, "b"), (None, "n u l l", "b"), (5, "one", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("block", F.lit("clash"))
    got = M.mix(df)
    assert got.columns == ["doc_id", "text", "source", "block", "mix_key"]
    assert all(0 <= r.mix_key < 1 for r in got.collect()) and {r.doc_id for r in got.collect()} >= {1, 2}
    assert M.mix(df.limit(0)).count() == 0
    empty = M.mix(spark.createDataFrame([(1, None, "a"), (2, "", "b")], "doc_id long, text string, source string"))
    assert sorted((r.doc_id, r.block) for r in empty.collect()) == [(1, 0), (2, 0)]


# ------------------------------------------------------------------ revisits

def test_revisits_by_hand(spark):
    t = lambda s: datetime(2024, 1, 1, 0, 0, s)
    rows = [
        (1, "http://WWW.Example.com:80/a/?b=2&a=1&utm_source=x#f", t(1), "response", 200, {"ETag": '"v1"', "Content-Type": "text/html", "X": "old"}),
        (2, "https://example.com/a?a=1&b=2", t(5), "response", 200, {"ETag": '"v2"', "Last-Modified": "D2"}),
        (3, "example.com/no-scheme", t(6), "revisit", 304, None),
        (4, "https://example.com/a?b=2&a=1", t(3), "revisit", 304,
         {"etag": 'W/"v1"', "X": "new", "Content-Type": "no", "Connection": "close, Hop", "Hop": "1", "Y": ""}),
        (5, "https://example.com/a?a=1&b=2", t(5), "revisit", 304, {"etag": '"v1"'}),  # strictly earlier: record 1
        (6, "https://example.com/a?a=1&b=2", t(7), "revisit", 304, {"etag": '"v1"'}),
        (7, "https://example.com/a?a=1&b=2", t(8), "revisit", 304, {"last-modified": "D2"}),
        (8, "https://example.com/a?a=1&b=2", t(8), "revisit", 304, {"last-modified": "D3"}),
        (9, "https://example.com/a?a=1&b=2", t(8), "revisit", 304, None),
        (10, "https://example.com/other", t(9), "revisit", 304, None),
        (11, None, t(9), "revisit", 304, {"etag": '"v1"'}),
        (12, "https://example.com/a?a=1&b=2", None, "revisit", 304, {"etag": '"v2"'}),
        (13, "https://example.com/a?a=1&b=2", t(6), "response", 404, {"ETag": '"v3"'}),  # not a full response
        (14, "https://e.org/", t(1), "response", 200, {"ETag": '"a"'}), (15, "https://e.org", t(1), "response", 200, {"ETag": '"b"'}),
        (16, "https://www.e.org", t(2), "revisit", 304, {"ETag": '"b"'}), (16, "https://www.e.org", t(2), "revisit", 304, {"ETag": '"b"'})]
    df = spark.createDataFrame(rows, "record_id long, target_uri string, captured_at timestamp, record_type string, status int, "
                                     "headers map<string,string>").withColumn("near", F.lit("clash")).withColumn("payload", F.lit("p"))
    for ranges in (256, 2):
        out = V.resolve_revisits(df, ranges=ranges).collect()
        got = {r.record_id: (r.response_id, r.resolution) for r in out}
        assert got == {3: (None, "no_url"), 4: (1, "resolved"), 5: (1, "resolved"), 6: (2, "etag_mismatch"), 7: (2, "resolved"),
                       8: (2, "date_mismatch"), 9: (2, "no_validator"), 10: (None, "no_response"), 11: (None, "no_url"),
                       12: (None, "no_time"), 16: (15, "resolved")}
        assert len(out) == 12
    headers = {r.record_id: r.headers for r in out}
    assert [tuple(h) for h in headers[4]] == [("content-type", "text/html"), ("etag", 'W/"v1"'), ("x", "new")]
    assert headers[6] is None
    bodies = {r.record_id: r.payload for r in V.attach_payload(V.resolve_revisits(df), df).collect()}
    assert bodies[4] == "p" and bodies[6] is None
    assert V.resolve_revisits(df.limit(0)).count() == 0


# ------------------------------------------------------------------ pages

def test_shared_lines_are_a_longest_common_subsequence():
    def length(a, b):
        d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                d[i + 1][j + 1] = d[i][j] + 1 if x == y else max(d[i][j + 1], d[i + 1][j])
        return d[-1][-1]

    rnd = random.Random(1)
    for _ in range(1500):
        a, b = ([rnd.choice("abcd") for _ in range(rnd.randint(0, 12))] for _ in range(2))
        s = [x for x, k in zip(a, G.shared_lines(a, b)) if k]
        it = iter(b)
        assert len(s) == length(a, b) and all(any(x == y for y in it) for x in s)


def test_page_reading_by_hand():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><article>x</article>";</script></head>
    <body class="no-sidebar"><header><h1>Site</h1></header><nav><ul><li>Menu</li></ul></nav><div class="cookie-notice"><div>We use</div> cookies</div>
    <!-- <article>gone</article> --><article><header><h1>A &amp; B</h1></header><p>one <b>two</b>
      three&nbsp;&#233;</p><div class="ad"><p>Buy</p></div><p>1 < 2 &copy</p><aside>more</aside><form>mail <input></form>
      <section id="comments"><p>first!</p></section></article><footer>&copy; x</footer></body></html>"""
    lines, inside = G.page_lines(page)
    assert [x for x, i in zip(lines, inside) if i] == ["A & B", "one two three é", "1 < 2 ©"]
    assert [x for x, i in zip(lines, inside) if not i] == []
    assert G.page_lines("") == ([], []) and G.page_lines("<p>open <b>tags")[0] == ["open tags"]
    assert G.page_lines("<nav>never closed<article><p>text</p></article>")[0] == ["text"]


def test_names_that_only_hint_at_chrome_drop_nothing_of_an_article():
    page = """<body><div class="cookie-notice">We use</div><form id="aspnetForm"><div class="has-sidebar layout"><!-- </div> -->
    <article><div class="article-header"><h1 class="header-title">Title</h1></div>
    <section id="legal-history"><h2 id="social-media-policy">Policy</h2><p>text <span class="footer-note">note</span></p></section>
    <h2 id="comments">On comments</h2><div class="box share">Tweet</div><div class="Ad"><p>Buy</p></div>
    <div class="comments-area"><article>first!</article></div><nav>Up</nav></article>
    <div class="sidebar">Side</div></div></form><div class="related">More</div></body>"""
    lines, inside = G.page_lines(page)
    assert lines == ["Title", "Policy", "text note", "On comments"] and all(inside)
    assert G.page_lines("<div class=sidebar><div>a</div><!-- <article> --></div><main>b</main>")[0] == ["b"]


def test_chrome_is_left_out_wherever_it_stands():
    chrome = ("<div class='sidebar'>side</div><div class='cookie-notice'>we use</div><div class='promo'>buy</div>"
              "<section class='comment-section'><p>first!</p></section><div class='newsletter'>mail</div><div hidden>h</div>")
    assert G.main_lines(f"<body><main><h1>T</h1>{chrome}<p>body</p></main></body>") == (["T", "body"], True)
    page = ("<main><nav class='breadcrumb'>a</nav><div class='breadcrumbs'>a > b</div><article><h1>T</h1><p>body</p></article>"
            "<div class='related-links'>more</div><div class='sidebar'>side</div><div id='respond'>say</div><p>loose</p></main>")
    assert G.main_lines(page) == (["T", "body"], True)
    page = ("<article><h1>T</h1><div class='comment'>c</div><div class='user-comments'>c</div><div class='ad-wrapper'>a</div>"
            "<div class='advertisement-box'>a</div><div class='AdSlot'>a</div><div class='newsletter-signup'>n</div><div class='legal'>law</div><p>body</p></article>")
    assert G.main_lines(page) == (["T", "law", "body"], True)
    page = "<article><p>body</p><article class='comment'>nice</article></article><article class='teaser'>next</article><article class='post-card'>x</article>"
    assert G.main_lines(page) == (["body"], True)
    assert G.main_lines("<article class='card'><p>only</p></article>") == (["only"], True)
    assert G.main_lines("<article class='post'>one</article><article class='post'>two</article>") == (["one", "two"], True)
    page = "<div class='content-header'><h1>T</h1></div><div id='legal-history'><p>law</p></div><p class='share-price'>9</p><div class='site-header'>s</div>"
    assert G.main_lines(page) == (["T", "law", "9"], False)
    assert G.main_lines("<article></article><main><p>x</p></main>") == (["x"], True)


def test_neighbours_without_text_and_across_ranges(spark, monkeypatch):
    page = lambda *body: "<body>" + "".join(f"<p>{b}</p>" for b in body) + "</body>"
    schema = "page_id long, url string, html string"
    three = [(1, "https://h.org/1", page("Menu", "one")), (2, "https://h.org/2", page()), (3, "https://h.org/3", page("Menu", "three"))]
    assert {r.page_id: r.text for r in G.extract_main_text(spark.createDataFrame(three, schema)).collect()} == {1: "one", 2: "", 3: "three"}
    # copies tell nothing about the template: the other neighbour does, and copies alone keep their lines
    copies = [(k, f"https://h.org/a/{k}", page("Menu", "same")) for k in (1, 2, 3)] + [(4, "https://h.org/a/4", page("Menu", "other"))]
    assert {r.page_id: r.text for r in G.extract_main_text(spark.createDataFrame(copies, schema)).collect()} == {
        1: "Menu\nsame", 2: "Menu\nsame", 3: "same", 4: "other"}
    rows = [(i, f"https://h{i % 3}.org/a/{i:04d}", page("Menu", f"story {i}", "Foot") if i % 5 else None) for i in range(400)]
    rows += [(1000 + i, "https://hot.org/", page("Top", f"copy {i}")) for i in range(150)] + [(5000, "https://lone.org/x", page("Menu", "lone"))]
    df = spark.createDataFrame(rows, schema).repartition(7)
    want = {i: f"story {i}" if i % 5 else "" for i in range(400)} | {1000 + i: f"copy {i}" for i in range(150)} | {5000: "Menu\nlone"}
    for size in (1, 16, 10_000):
        monkeypatch.setattr(G, "RANGE_SAMPLES", size)
        out = G.extract_main_text(df).collect()
        assert {r.page_id: r.text for r in out} == want and len(out) == len(rows), size


def test_unmarked_pages_lose_what_their_neighbour_shares(spark):
    page = lambda *body: "<body>" + "".join(f"<p>{b}</p>" for b in body) + "</body>"
    rows = [(1, "https://h.org/a/1", page("Top", "first story", "Bottom")), (2, "https://h.org/a/2", page("Top", "second story", "Bottom")),
            (3, "https://h.org/b", page("Other", "third")), (4, "https://i.org/a/1", page("Top", "alone")), (5, None, page("Top", "no url")),
            (6, None, page("Top", "no url")), (7, "https://h.org/a/3", None), (8, "https://h.org/a/2/x", ""),
            (9, "https://j.org/1", "<article><p>copy</p></article>"), (10, "https://j.org/2", "<article><p>copy</p></article>"),
            (None, "https://k.org/", "<p>x</p>"), (11, "https://l.org/", page("w " * 100_000)), (12, "not a url", "<p>y</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("lines", F.lit("clash"))
    out = G.extract_main_text(df).collect()
    got = {r.page_id: r.text for r in out}
    assert got == {1: "first story", 2: "second story", 3: "Other\nthird", 4: "Top\nalone", 5: "Top\nno url", 6: "Top\nno url", 7: "", 8: "",
                   9: "copy", 10: "copy", None: "x", 11: " ".join(["w"] * 100_000), 12: "y"}
    assert all(r.n_chars == len(r.text) for r in out) and G.extract_main_text(df.limit(0)).count() == 0


def test_page_query_equals_a_plain_reading_of_the_table(spark):
    import html

    import __spark_entry__ as E
    want = {}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        body = re.sub("</?b>", "", r.html[r.html.index("<article>"):r.html.index("</article>")])
        blocks = [" ".join(html.unescape(x).split()) for x in re.split("<(?:/?(?:article|h1|p)|br)>", body)]
        want[r.page_id] = "\n".join(b for b in blocks if b)
    assert {r.page_id: r.text for r in E.queries()["op7_page_differencing"](spark, SF).collect()} == want


# ------------------------------------------------------------------ pipeline

def test_pipeline_stages_on_the_small_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(10**6, None, "en", "src0", 0), (10**6 + 1, "", None, None, None)], docs.schema)
    docs = docs.unionByName(extra)
    before = {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        path = f"{spark.conf.get('spark.checkpoint.dir')}/stage-{abs(hash(name))}-{random.random()}"
        out.write.parquet(path)
        last, docs = docs, spark.read.parquet(path)
        after = {r.doc_id for r in docs.collect()}
        assert after <= before, name
        if stage is not corpus_pipeline.mixing:
            assert docs.columns == last.columns, name
        before = after
    assert {"block", "mix_key"} <= set(docs.columns) and docs.count() > 100


def test_pipeline_stages_decide_by_row_and_not_by_id(spark, tmp_path):
    rnd = random.Random(5)
    text = lambda n: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(n))
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    row = lambda i, t: (i, t, "en", "s", len(t or ""))

    def rows_after(stage, rows, name):
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / name))
        out = stage(spark, spark.read.parquet(str(tmp_path / name)), str(tmp_path))
        assert out.columns == schema.names
        return Counter((r.doc_id, r.text) for r in out.collect())

    a, b, c, d, e = (text(100) for _ in range(5))
    # one near copy in id 5 does not take the clean row of that id; equal rows and null-id copies leave one
    got = rows_after(corpus_pipeline.near_dedup, [
        row(1, a), row(5, a), row(5, b), row(6, c), row(6, c), row(None, c), row(None, d), row(None, d), row(None, e)], "near")
    assert got == Counter([(1, a), (5, b), (6, c), (None, d), (None, e)])

    # a passage shared by rows of one id, or held by rows without one, stays once
    p, q = text(80), text(80)
    rows = [row(3, text(50) + " " + p), row(3, text(51) + " " + p), row(None, text(50) + " " + q), row(None, text(52) + " " + q),
            row(4, "short"), row(4, "short"), row(None, None), row(None, None), row(8, a), row(8, a), row(None, b), row(None, b)]
    got = rows_after(corpus_pipeline.substring_dedup, rows, "substring")
    holding = lambda x: sum(n for (_, t), n in got.items() if x[200:400] in (t or ""))
    assert holding(p) == 1 and holding(q) == 1 and sum(got.values()) == 10
    assert got[8, a] == 1 and got[None, b] == 1 and got[4, "short"] == 2 and got[None, None] == 2

    # a contaminated row goes, the other rows of its id, or without an id, stay
    spark.createDataFrame([(0, a)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = rows_after(corpus_pipeline.decontamination, [
        row(1, a), row(1, b), row(None, "x " + a), row(None, c), row(None, c), row(2, d)], "items")
    assert got == Counter([(1, b), (None, c), (None, c), (2, d)])


def test_pipeline_runs_on_an_empty_table(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
