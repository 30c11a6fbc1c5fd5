import os
import re
import tempfile

import pytest

from pyspark.sql import functions as F

from corpusprep.operators import packing as P
from corpusprep.operators import tokens as TK
from corpusprep.streaming import stream as ST

SF = "/root/testdata/sf0.001"


def test_stream_prepare_equals_static(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    vocab = TK.build_vocabulary(docs, "text", 500)
    d = tempfile.mkdtemp(prefix="corpusprep-stream-")
    stream = ST.stream_corpus(spark, SF, docs.schema, path_glob_filter="documents.parquet")
    sink = ST.stream_prepare(stream, vocab, 256, "doc_id", 1000, sink=os.path.join(d, "out"),
                             checkpoint=os.path.join(d, "ck"))
    got = {(r.group_id, r.block_id): list(r.input_ids) for r in spark.read.parquet(sink).collect()}
    static = P.group_texts(P.assign_groups(TK.tokenize_text(docs.select("doc_id", "text"), vocab), "doc_id", 1000), 256)
    want = {(r.group_id, r.block_id): list(r.input_ids) for r in static.collect()}
    assert got == want and len(got) > 10


def test_replayed_batch_adds_no_rows(spark):
    toks = spark.createDataFrame([(i, [i] * 5) for i in range(40)], "doc_id long, input_ids array<int>")
    sink = os.path.join(tempfile.mkdtemp(prefix="corpusprep-stream-"), "out")
    for seed in (None, 7):
        for batch_id in (0, 1, 1, 0):
            ST.pack_batch(toks, batch_id, sink, 8, "doc_id", 10, seed)
        out = spark.read.parquet(sink)
        assert out.groupBy("batch_id").count().count() == 2 and out.count() == 2 * 4 * 6
        assert out.dropDuplicates(["batch_id", "group_id", "block_id"]).count() == out.count()


def test_entry_flagship(spark):
    import __spark_entry__ as E
    from corpusprep.plans import recipe as R

    df = E.entry(spark)
    assert df.columns == ["doc_id", "lang"]
    assert df.count() > 0
    # without a flagged-word list the en recipe keeps 180 of 200 documents (survey anchor)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = R.run_recipe(docs, R.EN_RECIPE, R.RecipeContext(id_col="doc_id", flagged_words={"en": []}))
    assert out.count() == 180


def test_every_query_has_an_oracle_or_is_marked():
    import __spark_entry__ as E
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 30


# what a query's first scan of a table must not read beyond
NEEDED = {"head_split": {"doc_id"}, "shuffle_order": {"doc_id"}, "take_docs": {"doc_id", "lang"},
          "argmax_embeddings": {"vec_id", "embedding"}, "exact_dedup": {"doc_id", "text", "lang"},
          "remove_null_text": {"doc_id", "text"}, "filter_rows_pandas": {"doc_id", "lang", "n_chars"},
          "quality_stats": {"doc_id", "text"}, "simhash_en": {"doc_id", "text"}}


def test_plans_scan_files_without_row_udfs_or_cartesian(spark):
    from corpusprep.plans import catalog
    for name, fn in catalog.queries().items():
        if name.startswith("stream"):
            continue
        plan = fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "FileScan parquet" in plan or "Scan parquet" in plan, name
        assert "BatchEvalPython" not in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        for m in re.finditer(r"ReadSchema: struct<([^>]*)>?", plan):
            if name in NEEDED:
                read = {c.split(":")[0] for c in m[1].split(",") if ":" in c}
                assert read <= NEEDED[name] | {"__key", "__at", "__n", "element"}, (name, read)


def test_the_tokenizer_runs_once_per_plan(spark):
    from corpusprep.plans import catalog
    for name in ("packed_blocks", "pretrain_blocks", "token_accuracy", "tokens_by_split"):
        plan = catalog.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"\bArrowEvalPython\b", plan.split("== Initial Plan ==")[0])) == 1, name


def test_shared_folder_is_required_off_local_masters(monkeypatch):
    from corpusprep import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, *a):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
