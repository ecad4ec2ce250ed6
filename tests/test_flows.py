"""Queries that pass through files: tokens with contractions, stop-word folders, nested JSON, run log, run status."""

import json

from pyspark.sql import functions as F

from textlane.functions.expr import tokens
from textlane.operators import runs, text
from textlane.sources import files


def _tokens(spark, s):
    return spark.createDataFrame([(s,)], "t string").select(tokens(F.col("t"), "treebank")).first()[0]


def test_contractions_and_punctuation_stand_apart(spark):
    assert _tokens(spark, "I don't know, it's John's 1,000.50 dollars!") == [
        "i", "do", "n't", "know", ",", "it", "'s", "john", "'s", "1,000.50", "dollars", "!"]
    assert _tokens(spark, "They'll re-open (today).") == ["they", "'ll", "re-open", "(", "today", ")", "."]
    assert _tokens(spark, "") == [] and _tokens(spark, None) is None


def test_stopword_folder_named_by_language(spark, tmp_path):
    (tmp_path / "english").write_text("the\nand\n\n")
    (tmp_path / "german").write_text("und\ndie\n")
    stop = files.read_stopword_dir(spark, str(tmp_path))
    assert {tuple(r) for r in stop.collect()} == {("english", "the"), ("english", "and"), ("german", "und"), ("german", "die")}
    rows = spark.createDataFrame([("english", "die"), ("german", "die"), ("english", "the")], "lang string, term string")
    left = text.remove_stopwords_table(rows, stop, "lang")
    assert [(r.lang, r.term) for r in left.collect()] == [("english", "die")]


def test_nested_json_files(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"{k}.json").write_text(json.dumps([{"_id": k, "_source": {"a": f"x{k}", "b": {"c": None if k else 1}}}]))
    df = files.read_json(spark, str(tmp_path), "_id int, _source struct<a string, b struct<c int>>", multiline=True)
    assert df.columns == ["_id", "_source.a", "_source.b.c"]
    assert sorted(tuple(r) for r in df.collect()) == [(0, "x0", 1), (1, "x1", None), (2, "x2", None)]


def test_run_log_appends(spark, tmp_path):
    path = str(tmp_path / "log")
    for k in range(2):
        files.append_run_values(spark.createDataFrame([("r", "metric" if k else "param", "a", str(k))],
                                                      "run_id string, kind string, key string, value string"), path)
    assert {(r.kind, r.value) for r in spark.read.parquet(path).collect()} == {("param", "0"), ("metric", "1")}


def test_run_status(spark):
    ev = spark.createDataFrame([(1, "view", 1), (1, "error", 2), (2, "error", 1), (2, "purchase", 2), (3, "view", 1), (4, None, 1)],
                               "run int, key string, ts int")
    got = runs.run_status(ev, "run", "key", ["ts"], ("purchase",), ("error",))
    assert {r.run: r.status for r in got.collect()} == {1: "FAILED", 2: "FINISHED", 3: "RUNNING", 4: "RUNNING"}


def test_run_store_scan_opens_its_many_files_in_few_tasks(spark, tmp_path):
    for r in range(20):
        (tmp_path / "0" / f"r{r}" / "metrics").mkdir(parents=True)
        for k in range(10):
            (tmp_path / "0" / f"r{r}" / "metrics" / f"m{k}").write_text(f"{r} {k}.5 1\n")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    m = files.scan_run_metrics(spark, str(tmp_path))
    assert spark.conf.get("spark.sql.files.openCostInBytes") == cost
    assert m.select(F.spark_partition_id()).distinct().count() <= 4     # 200 files, 7 tasks by the default cost
    assert m.rdd.getNumPartitions() <= 4
    assert {(r.experiment_id, r.run_id, r.key, r.ts_ms, r.value, r.step) for r in m.collect()} == {
        ("0", f"r{r}", f"m{k}", r, k + 0.5, 1) for r in range(20) for k in range(10)}


def test_model_roundtrip_beyond_the_largest_vector(spark, tmp_path, monkeypatch):
    from textlane.operators import mllib
    from textlane.plans import catalog_flows
    texts = ["red apples fall", "green apples and green pears", "", "  ", "the", "pears fall"]
    rows = [(i, t, "en", "web", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet"))
    vector = {tuple(r) for r in catalog_flows.s6_model_roundtrip(spark, str(tmp_path)).filter("n_terms > 0").collect()}
    monkeypatch.setattr(mllib, "MAX_VECTOR_TERMS", 3)
    table = catalog_flows.s6_model_roundtrip(spark, str(tmp_path))
    assert {tuple(r) for r in table.filter("n_terms > 0").collect()} == vector and len(vector) == 3
    assert {(r.n_terms, r.w_sum) for r in table.filter("n_terms = 0").collect()} == {(0, 0.0)} and table.count() == 6


def test_file_per_group_has_the_folders_of_a_partitioned_write(spark, tmp_path):
    rows = [("0", "1", "view", "a 1"), ("0", "1", "view", "b 2"), ("0", "2", "x/y=z%", "ü"), ("0", None, "view", "n"), ("0", "3", "", "e")]
    df = spark.createDataFrame(rows, "exp string, run string, key string, line string")
    files.write_file_per_group(df, f"file:{tmp_path}/own", ("exp", "run", "key"))
    df.coalesce(1).write.partitionBy("exp", "run", "key").text(f"{tmp_path}/spark")

    def found(name):
        return {str(f.parent.relative_to(tmp_path / name)): sorted(f.read_text().splitlines()) for f in (tmp_path / name).rglob("*.txt")}

    assert found("own") == found("spark") and len(list((tmp_path / "own").rglob("*.txt"))) == 4


def test_run_store_lines_are_the_same_whole_and_by_line(spark, tmp_path, monkeypatch):
    import gzip
    for k, text_ in enumerate(["1 2.5 3\n4 5 6", "7 8 9\r\n\r\n", "﻿1 1 1\n"]):
        (tmp_path / f"e/r{k}/metrics").mkdir(parents=True)
        (tmp_path / f"e/r{k}/metrics/m").write_bytes(text_.encode())
    (tmp_path / "e/r0/metrics/z.gz").write_bytes(gzip.compress(b"2 2 2\n"))
    want = {("r0", "m", 1, 2.5, 3), ("r0", "m", 4, 5.0, 6), ("r1", "m", 7, 8.0, 9), ("r2", "m", 1, 1.0, 1), ("r0", "z.gz", 2, 2.0, 2)}
    for whole in (files.WHOLE_BYTES, 8, 0):
        monkeypatch.setattr(files, "WHOLE_BYTES", whole)
        rows = files.scan_run_metrics(spark, str(tmp_path)).collect()
        assert {(r.run_id, r.key, r.ts_ms, r.value, r.step) for r in rows} == want and len(rows) == len(want)
