import json
import os
import tempfile

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusprep.plans import recipe as R
from corpusprep.sources import readers as S


def _tmpdir():
    return tempfile.mkdtemp(prefix="corpusprep-test-")


def test_json_split_reader(spark):
    d = _tmpdir()
    os.makedirs(os.path.join(d, "sub"))
    with open(os.path.join(d, "train_a.jsonl"), "w") as fh:
        fh.write(json.dumps({"instruction": "i", "input": "", "output": "o"}) + "\n")
    with open(os.path.join(d, "sub", "train_b.json"), "w") as fh:
        fh.write(json.dumps({"instruction": "j", "input": "x", "output": "p"}) + "\n")
    with open(os.path.join(d, "validation_a.jsonl"), "w") as fh:
        fh.write(json.dumps({"instruction": "v", "input": "", "output": "w"}) + "\n")
    df = S.read_json_split(spark, d, "train", "instruction string, input string, output string")
    assert sorted(r.instruction for r in df.collect()) == ["i", "j"]


def test_json_arrays_next_to_lines(spark):
    d = _tmpdir()
    with open(os.path.join(d, "train_a.jsonl"), "w") as fh:
        fh.write("".join(json.dumps({"id": i, "text": f"line {i}"}) + "\n" for i in range(3)))
    with open(os.path.join(d, "train_b.json"), "w") as fh:
        json.dump([{"id": 10, "text": "x"}, {"id": 11, "text": "y", "more": 1}], fh, indent=2)
    with open(os.path.join(d, "train_c.json"), "w") as fh:
        fh.write(json.dumps({"id": 20, "text": "l1"}) + "\n" + json.dumps({"id": 21, "text": "l2"}) + "\n")
    with open(os.path.join(d, "train_d.json"), "w") as fh:
        json.dump({"id": 30, "text": "one object"}, fh, indent=1)
    df = S.read_json_split(spark, d, "train")
    assert sorted(r.id for r in df.collect()) == [0, 1, 2, 10, 11, 20, 21, 30]
    assert df.where("text IS NULL OR id IS NULL").count() == 0


def test_validation_is_carved_when_absent(spark):
    d = _tmpdir()
    with open(os.path.join(d, "train_a.jsonl"), "w") as fh:
        fh.write("".join(json.dumps({"id": i, "text": f"t{i}"}) + "\n" for i in range(2000)))
    read = lambda split: S.read_json_split(spark, d, split)
    train, val = S.with_validation(read, "id", 10)
    a, b = {r.id for r in train.collect()}, {r.id for r in val.collect()}
    assert not a & b and a | b == set(range(2000)) and 100 < len(b) < 300
    assert train.columns == ["id", "text"]
    with open(os.path.join(d, "validation.jsonl"), "w") as fh:
        fh.write(json.dumps({"id": 9999, "text": "v"}) + "\n")
    train, val = S.with_validation(read, "id", 10)
    assert train.count() == 2000 and [r.id for r in val.collect()] == [9999]


def test_named_table_and_lines_without_end(spark):
    spark.range(3).createOrReplaceTempView("three_rows")
    assert S.read_named(spark, "three_rows").count() == 3


def test_corpus_reader_mixed_formats_and_text(spark):
    d = _tmpdir()
    spark.createDataFrame([("p1",), ("p2",)], "text string").toPandas().to_parquet(os.path.join(d, "train_x.parquet"))
    with open(os.path.join(d, "train_y.jsonl"), "w") as fh:
        fh.write(json.dumps({"text": "j1", "extra": 1}) + "\n")
    df = S.read_corpus_split(spark, d, "train")
    assert sorted(r.text for r in df.collect()) == ["j1", "p1", "p2"]
    with open(os.path.join(d, "train_z.txt"), "w") as fh:
        fh.write("line one\nline two\n")
    t = S.read_text_lines(spark, d, "train", keep_linebreaks=True)
    assert sorted(r.text for r in t.collect()) == ["line one\n", "line two\n"]


def test_write_and_read_back(spark):
    d = _tmpdir()
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, text string")
    S.write_jsonl(df, os.path.join(d, "out.jsonl"))
    S.write_parquet(df, os.path.join(d, "out.parquet"))
    assert S.read_recipe_input(spark, os.path.join(d, "out.jsonl")).count() == 2
    assert S.read_recipe_input(spark, os.path.join(d, "out.parquet")).count() == 2


def test_recipe_yaml_and_funnel_consistent(spark):
    d = _tmpdir()
    p = os.path.join(d, "r.yaml")
    with open(p, "w") as fh:
        fh.write("np: 4\nprocess:\n  - document_deduplicator:\n      lowercase: true\n"
                 "  - text_length_filter:\n      min_len: 5\n")
    cfg, steps = R.load_recipe(p)
    assert cfg["np"] == 4 and [s[0] for s in steps] == ["document_deduplicator", "text_length_filter"]
    df = spark.createDataFrame([(1, "Hello there"), (2, "hello there"), (3, "tiny"), (4, "another one")],
                               "id long, text string")
    ctx = R.RecipeContext(id_col="id")
    out = sorted(r.id for r in R.run_recipe(df, steps, ctx).collect())
    assert out == [1, 4]
    tr = {r.id: (r.removed_step, r.removed_by, r.kept_id) for r in R.trace(df, steps, ctx).collect()}
    assert tr[2] == (1, "document_deduplicator", 1) and tr[3] == (2, "text_length_filter", None)
    fun = [(r.step, r.remaining) for r in R.funnel(R.trace(df, steps, ctx), steps).orderBy("step").collect()]
    assert fun == [(1, 3), (2, 2)]


def test_null_texts_run_trace_and_funnel_agree(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a text that is long enough"), (4, "A text that is long enough!")],
                               "id long, text string")
    steps = [("document_deduplicator", {"lowercase": True, "ignore_non_character": True}), ("text_length_filter", {"min_len": 5})]
    ctx = R.RecipeContext(id_col="id")
    assert sorted(r.id for r in R.run_recipe(df, steps, ctx).collect()) == [3]
    traced = R.trace(df, steps, ctx)
    got = {r.id: (r.removed_step, r.kept_id) for r in traced.collect()}
    assert got == {1: (2, None), 2: (1, 1), 3: (None, None), 4: (1, 3)}
    assert [(r.step, r.remaining) for r in R.funnel(traced, steps).orderBy("step").collect()] == [(1, 2), (2, 1)]


def test_user_operators_and_missing_inputs(spark):
    df = spark.createDataFrame([(1, "aa x"), (2, "aa y"), (3, "b")], "id long, text string")
    ctx = R.RecipeContext(id_col="id")
    R.register_operator("starts_with_a", lambda ctx, a: F.col(ctx.text_col).startswith("a"))
    R.register_operator("same_first_word", lambda ctx, a: F.substring_index(ctx.text_col, " ", 1),
                        lambda keyed, a: keyed.withColumn("kept_id", F.min("id").over(Window.partitionBy("key"))).drop("key"))
    steps = [("same_first_word", {}), ("starts_with_a", {})]
    assert {r.id: r.removed_by for r in R.trace(df, steps, ctx).collect()} == {1: None, 2: "same_first_word", 3: "starts_with_a"}
    with pytest.raises(ValueError, match="flagged-word"):
        R.run_recipe(df, [("flagged_words_filter", {"lang": "fr"})], ctx)
    with pytest.raises(NotImplementedError):
        R.run_recipe(df, [("alphanumeric_filter", {"tokenization": True})], ctx)


def test_repetition_runs_once_per_document(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(ctx, a):
        @F.pandas_udf("double")
        def ratio(s: pd.Series) -> pd.Series:
            seen.add(len(s))
            return pd.Series([0.0] * len(s))
        return ratio(F.col(ctx.text_col)) <= 0.5

    R.register_operator("counted", count)
    df = spark.createDataFrame([(i, f"text number {i % 40}") for i in range(100)], "id long, text string")
    steps = [("document_deduplicator", {}), ("counted", {}), ("document_simhash_deduplicator", {"window_size": 2})]
    R.run_recipe(df, steps, R.RecipeContext(id_col="id")).collect()
    assert seen.value == 100


def _nasty(r, i):
    tail = r.choice(['plain', 'brace } and { "quoted" \\ back', 'ends in \\', '\\"', '}}}}', '{"a": [1]}', 'é ünï \U0001f600', '', '\n tab\t', ',[]'])
    return {"id": i, "text": tail * r.randrange(1, 30), "more": {"a": [{"b": tail}, {}], "c": r.random()}, "none": None}


def test_large_json_arrays_are_read_by_byte_range(spark):
    import random

    from corpusprep.sources import json_records as J
    r, d, want = random.Random(8), _tmpdir(), {}
    rows = [_nasty(r, i) for i in range(120)]
    rows[7]["text"] = "x{y}" * 4_000  # a record over many ranges
    layouts = {"a": json.dumps(rows), "b": json.dumps(rows, indent=2), "c": "\n".join(map(json.dumps, rows)), "d": json.dumps(rows, ensure_ascii=False) + "\n",
               "e": "[]", "f": "", "g": json.dumps(rows[0], indent=1), "h": "\ufeff[" + ",\r\n".join(map(json.dumps, rows[:9])) + "]\r\n", "i": json.dumps(rows[:1])[1:-1]}
    for name, text in layouts.items():
        with open(os.path.join(d, f"train_{name}.json"), "w", newline="") as fh:
            fh.write(text)
        want[name] = rows if name in "abcd" else rows[:1] if name in "gi" else rows[:9] if name == "h" else []
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("128m", "1500"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            if size == "1500":
                assert J.json_pieces(spark, d, "train_a.json").rdd.getNumPartitions() > 20  # one array, many tasks
            got = {}
            for x in J.json_records(spark, d).collect():
                got.setdefault(os.path.basename(x.path)[6:-5], []).append(json.loads(x.record))
            for name in layouts:
                mine = sorted(got.get(name, []), key=lambda v: v["id"])
                assert mine == sorted(want[name], key=lambda v: v["id"]), (size, name)
        schema = "id long, text string, more struct<c:double>"
        df = S.read_json_split(spark, d, "train", schema)
        n = sum(map(len, want.values()))
        assert df.count() == n and S.read_json_split(spark, d, "train").count() == n
        assert {(x.id, x.text, x.c) for x in df.select("id", "text", "more.c").collect()} == {(v["id"], v["text"], v["more"]["c"]) for v in rows}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_a_truncated_array_keeps_its_whole_records(spark):
    d = _tmpdir()
    with open(os.path.join(d, "train_a.json"), "w") as fh:
        fh.write('[{"id": 1}, {"id": 2}, {"id": 3, "text": "cut')
    got = S.read_json_split(spark, d, "train", "id long, text string").collect()
    assert sorted((r.id for r in got if r.id is not None)) == [1, 2] and len(got) <= 3


def test_line_ends_are_kept_as_they_are(spark):
    d = _tmpdir()
    for name, text in {"a": "one\r\ntwo\n\nfour", "b": "x\n", "c": "", "d": "é"}.items():
        with open(os.path.join(d, f"train_{name}.txt"), "w", newline="") as fh:
            fh.write(text)
    got = sorted(r.text for r in S.read_text_lines(spark, d).collect())
    assert got == sorted(["one\r\n", "two\n", "\n", "four", "x\n", "é"])
    assert sorted(r.text for r in S.read_text_lines(spark, d, keep_linebreaks=False).collect()) == sorted(["one", "two", "", "four", "x", "é"])
