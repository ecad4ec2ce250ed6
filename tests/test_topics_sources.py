"""NMF objective, top terms, run-store scan, label-map and CSV round trips."""

import os
import tempfile

from pyspark.sql import functions as F

from textlane.operators import topics
from textlane.sources import files


def test_nmf_objective_falls(spark):
    rows = [(d, t, float((d * 7 + t * 3) % 5 + 1)) for d in range(12) for t in range(9) if (d + t) % 3]
    X = spark.createDataFrame(rows, "doc_id long, t long, x double").select(
        "doc_id", F.concat(F.lit("w"), F.col("t")).alias("term"), "x")
    _, hist = topics.fit_nmf(X, k=3, max_iter=4, tol=0.0)
    assert all(b <= a + 1e-9 for a, b in zip(hist, hist[1:])) and hist[-1] < hist[0]


def test_top_terms_exact_with_salts(spark):
    rows = [("g", f"t{i:03d}", float(i % 17)) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, term string, w double")
    got = [r.term for r in topics.top_terms(df, "g", "term", "w", 5, salts=7).orderBy("rank").collect()]
    want = [t for _, t, _ in sorted(rows, key=lambda r: (-r[2], r[1]))[:5]]
    assert got == want


def test_run_store_scan(spark):
    root = tempfile.mkdtemp(prefix="runstore-")
    for run, vals in {"r1": [(1000, 0.5, 0), (2000, 0.7, 1)], "r2": [(1500, 0.2, 0)]}.items():
        os.makedirs(f"{root}/0/{run}/metrics")
        with open(f"{root}/0/{run}/metrics/precision_test", "w") as f:
            f.write("\n".join(f"{a} {b} {c}" for a, b, c in vals) + "\n")
        os.makedirs(f"{root}/0/{run}/params")
        with open(f"{root}/0/{run}/params/model", "w") as f:
            f.write("NB")
    m = files.scan_run_metrics(spark, root)
    assert sorted((r.run_id, r.key, r.ts_ms, r.value, r.step) for r in m.collect()) == [
        ("r1", "precision_test", 1000, 0.5, 0), ("r1", "precision_test", 2000, 0.7, 1), ("r2", "precision_test", 1500, 0.2, 0)]
    p = files.scan_run_texts(spark, root, "params")
    assert sorted((r.run_id, r.value) for r in p.collect()) == [("r1", "NB"), ("r2", "NB")]


def test_label_map_roundtrip(spark):
    path = tempfile.mkdtemp(prefix="lmap-") + "/m"
    m = spark.createDataFrame([("0", "Bank Account Services"), ("1", "Credit Report or Prepaid Card"), ("2", "Mortgage/Loan")],
                              "idx string, label string")
    files.write_label_map(m, path)
    assert sorted(tuple(r) for r in files.read_label_map(spark, path).collect()) == sorted(tuple(r) for r in m.collect())


def test_csv_roundtrip_keeps_newlines_and_quotes(spark):
    path = tempfile.mkdtemp(prefix="csv-") + "/c"
    df = spark.createDataFrame([(1, 'line one\nline "two", end'), (2, "")], "id int, t string")
    files.write_csv(df, path)
    back = files.read_csv(spark, path, "id int, t string").orderBy("id").collect()
    assert back[0].t == 'line one\nline "two", end'


def test_flatten_nested(spark):
    df = spark.createDataFrame([((("a", "b"), "c"),)], "s struct<x: struct<p: string, q: string>, y: string>")
    assert files.flatten(df).columns == ["s.x.p", "s.x.q", "s.y"]


def test_features_of_a_topic_step_read_the_texts_once(spark, tmp_path):
    from textlane.plans import catalog
    rows = [(1, "Alpha beta beta gamma"), (2, "beta gamma delta"), (3, None), (4, "delta alpha beta"), (5, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    x, _ = catalog.bounded_tfidf(spark, str(tmp_path), materialize=True)
    assert "regexp_extract_all" not in x._jdf.queryExecution().executedPlan().toString()
    plain, _ = catalog.bounded_tfidf(spark, str(tmp_path))
    read = lambda df: sorted((r.doc_id, r.term, r.tf, round(r.w, 9)) for r in df.collect())
    assert read(x) == read(plain) and len(read(x)) > 5
