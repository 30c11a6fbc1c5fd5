"""Every stage of the pipeline against a plain version, each on its own input; recall of the multi-index where it does not search all."""

import duckdb
import numpy as np
from pyspark.sql import functions as F
from test_llm_dedup import brute_cdc, brute_components, brute_fingerprint
from test_llm_rest import brute_tiles, tokens

import corpus_pipeline as P
from corpusprep.llm import inverted_multi_index as I
from corpusprep.llm import pu_quality as U
from corpusprep.llm import queries as Q
from corpusprep.llm import revisits as V

SF = "/root/testdata/sf0.001"


def plain_near(rows):
    fps = [brute_fingerprint(r["text"]) for r in rows]
    names, find = brute_components([r["doc_id"] for r in rows], fps)
    return [r for k, r in enumerate(rows) if names[find(k)] == r["doc_id"]]


def plain_substrings(rows):
    left = {i: t for (i, t), n in brute_cdc([(r["doc_id"], r["text"]) for r in rows]).items()}
    out = []
    for r in rows:
        t = left[r["doc_id"]]
        if t == r["text"]:
            out.append(r)
        elif t.strip(" "):
            out.append(r | {"text": t, "n_chars": len(t)})
    return out


def plain_decontamination(rows, items):
    def dirty(text):
        doc = tokens(text)
        seeds = set(zip(*(doc[k:] for k in range(5))))
        return any(2 * brute_tiles(doc, item, 5) >= len(item) for item in items if item and (len(item) < 5 or seeds & set(zip(*(item[k:] for k in range(5))))))
    return [r for r in rows if not dirty(r["text"])]


def test_stages_equal_plain_versions(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tokens(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    by_id = lambda rows: sorted((r if isinstance(r, dict) else r.asDict() for r in rows), key=lambda r: r["doc_id"])
    stages = dict(P.STAGES)
    rows = by_id(docs.collect())

    def run(name, rows):
        given = spark.createDataFrame([tuple(r[c] for c in docs.columns) for r in rows], docs.schema)
        return given, stages[name](spark, given, SF)

    # the classifier's own decision, row by row, by the network that the stage fitted
    nets, fit = [], U.fit
    monkeypatch.setattr(U, "fit", lambda *a: nets.append(fit(*a)) or nets[-1])
    given, out = run("quality classifier", rows)
    net, = nets
    good = {r.doc_id for r in U.score(given, net).where(F.col("score") >= U.THRESHOLD).select("doc_id").collect()}
    kept = by_id(out.collect())
    assert kept == [r for r in rows if r["doc_id"] in good] and 0 < len(kept) <= len(rows)

    # planted on top of the table: an exact copy, a near copy, a shared passage, a benchmark item
    passage = " ".join(f"planted{i}" for i in range(70))
    rows += [rows[3] | {"doc_id": 90_001}, rows[3] | {"doc_id": 90_002, "text": rows[3]["text"].upper()},
             rows[4] | {"doc_id": 90_003, "text": rows[4]["text"][:900] + " " + passage}, rows[5] | {"doc_id": 90_004, "text": passage + " " + rows[5]["text"][:900]},
             rows[6] | {"doc_id": 90_005, "text": "see " + spark.read.parquet(f"{SF}/benchmark.parquet").first().text}]
    for name, plain in (("SimHash near-dedup", plain_near), ("substring dedup", plain_substrings),
                        ("benchmark decontamination", lambda r: plain_decontamination(r, items))):
        given, out = run(name, rows)
        assert out.columns == docs.columns
        got, want = by_id(out.collect()), by_id(plain(rows))
        assert got == want, (name, len(got), len(want))
        assert got != rows, name  # every stage decides something here
        rows = got
    given, out = run("mixing sources to target weights", rows)
    con = duckdb.connect()
    con.register("documents", given.toPandas())
    want = con.execute(Q.OP5_SQL.replace("SELECT doc_id, text, lang, source, n_chars, block,", "SELECT doc_id, block,")).fetchall()
    got = [(r.doc_id, r.block, round(r.mix_key, 12)) for r in out.collect()]
    assert sorted(got) == sorted((a, b, round(c, 12)) for a, b, c in want)


def test_recall_where_the_index_does_not_visit_every_cell(spark):
    """24,000 vectors in 300 clusters: at least 0.9 of the true neighbours, from a share of the entries."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(300, 32))
    x = centres[rng.integers(0, 300, 24_000)] + rng.normal(scale=0.35, size=(24_000, 32))
    ids = np.arange(24_000)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>").repartition(8)
    out = I.search(df, F.col("vec_id") % 400 == 0, k=5).collect()
    want = I.brute_force(ids, x, ids[::400])
    got = {}
    for r in out:
        got.setdefault(r.query_id, set()).add(r.vec_id)
    recall = np.mean([len(got[q] & set(v)) / 5 for q, v in want.items()])
    assert recall >= 0.9 and 24_000 > 10 * I.MIN_CANDIDATES, recall


def test_ports_brackets_and_other_revisits(spark):
    urls = [("http://a.org:80/x", "a.org/x"), ("http://a.org:443/x", "a.org:443/x"), ("https://a.org:443/x/", "a.org/x"), ("https://a.org:80/x", "a.org:80/x"),
            ("http://[::1]/a", "[::1]/a"), ("HTTPS://u:p@[2001:DB8::7]:8443/", "[2001:db8::7]:8443/"), ("http://[::1]:80", "[::1]/"), ("nothing", None)]
    df = spark.createDataFrame([(u,) for u, _ in urls], "u string")
    assert [r.c for r in df.select(V.canonical_url(F.col("u")).alias("c")).collect()] == [c for _, c in urls]
    rows = [(1, "http://a.org/", 1, "response", 200, {"etag": '"x"'}, None), (2, "http://a.org/", 2, "revisit", 304, {"etag": '"x"'}, None),
            (3, "http://a.org/", 2, "revisit", 200, {"etag": '"x"'}, None),
            (4, "http://a.org/", 2, "revisit", None, {"etag": '"x"'}, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            (5, "http://a.org/", 2, "revisit", None, {"etag": '"x"'}, "http://netpreserve.org/warc/1.1/revisit/server-not-modified")]
    r = spark.createDataFrame(rows, "record_id int, target_uri string, t long, record_type string, status int, headers map<string,string>, profile string")
    r = r.withColumn("captured_at", F.timestamp_seconds("t"))
    got = {x.record_id: x.resolution for x in V.resolve_revisits(r, profile_col="profile").collect()}
    assert got == {2: "resolved", 3: "other_profile", 4: "other_profile", 5: "resolved"}
