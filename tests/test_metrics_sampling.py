"""Metrics (FIXTURES C9, C10, C13), splits, folds, registry stages (C11)."""

from pyspark.sql import functions as F

from textlane.operators import metrics as met, runs, sampling


def _pred(spark):
    rows = list(zip(range(5), ["0", "0", "0", "1", "2"], ["0", "0", "1", "1", "0"]))
    return spark.createDataFrame(rows, "id int, y string, p string")


def test_weighted_and_macro(spark):
    pred = _pred(spark)
    w = met.weighted_prf(pred).first()
    assert round(w.precision, 6) == 0.5 and round(w.recall, 6) == 0.6 and round(w.f1, 6) == 0.533333
    f = met.f1_micro_macro(pred).first()
    assert round(f.f1_micro, 6) == 0.6 and round(f.f1_macro, 6) == 0.444444
    assert met.accuracy(pred).first().accuracy == 0.6


def test_report_has_summary_rows(spark):
    rows = {r.row for r in met.classification_report(_pred(spark)).collect()}
    assert rows == {"0", "1", "2", "accuracy", "macro avg", "weighted avg"}


def _auc(spark, y, s):
    rows = []
    for i, (yy, ss) in enumerate(zip(y, s)):
        rows += [(i, yy, "1", ss), (i, yy, "0", 1 - ss)]
    return met.auc_ovr(spark.createDataFrame(rows, "id int, y string, label string, prob double"), buckets=2).first().auc


def test_auc_ties(spark):
    assert abs(_auc(spark, ["1", "0", "1", "0"], [0.9, 0.5, 0.5, 0.1]) - 0.875) < 1e-12
    assert abs(_auc(spark, ["1", "0", "1", "0"], [0.3, 0.3, 0.3, 0.3]) - 0.5) < 1e-12


def test_auc_invariant_under_monotone_map(spark):
    import random
    rnd = random.Random(3)
    y = [rnd.choice("01") for _ in range(60)]
    s = [round(rnd.random(), 2) for _ in y]
    a = _auc(spark, y, s)
    b = _auc(spark, y, [x ** 3 for x in s])
    assert 0 <= a <= 1 and abs(a - b) < 1e-12


def test_class_weights(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",)], "label string")
    got = {r.label: round(r.weight, 6) for r in sampling.class_weights(df, "label").collect()}
    assert got == {"a": 0.666667, "b": 2.0}


def test_folds_disjoint_balanced(spark):
    df = spark.range(0, 203).select(F.col("id").alias("k"), (F.col("id") % 3 == 0).cast("string").alias("y"))
    f = sampling.stratified_folds(df, "k", "y", 5, 37, salt_buckets=7).collect()
    assert len(f) == 203 and len({r.k for r in f}) == 203
    for cls in ("true", "false"):
        sizes = [sum(1 for r in f if r.y == cls and r.fold == i) for i in range(5)]
        assert max(sizes) - min(sizes) <= 1


def test_exact_split_size_and_stability(spark):
    df = spark.range(0, 997).withColumnRenamed("id", "k")
    a = sampling.split_exact(df, "k", 0.3, 42, bits=4)
    test_ids = {r.k for r in a.filter("split = 'test'").collect()}
    assert len(test_ids) == 300
    b = sampling.split_exact(df.repartition(7), "k", 0.3, 42, bits=8)
    assert test_ids == {r.k for r in b.filter("split = 'test'").collect()}


def test_hash_split_stable_under_repartition(spark):
    df = spark.range(0, 500).withColumnRenamed("id", "k")
    a = {r.k for r in sampling.split_by_hash(df, "k").filter("split = 'test'").collect()}
    b = {r.k for r in sampling.split_by_hash(df.repartition(13), "k").filter("split = 'test'").collect()}
    assert a == b and 100 < len(a) < 200


def test_stage_archiving(spark):
    v = spark.createDataFrame([("m", 1, "Production"), ("m", 2, "Production"), ("m", 3, "Production")],
                              "name string, version int, stage string")
    got = {r.version: r.current_stage for r in runs.stage_with_archiving(v, "name", "stage").collect()}
    assert got == {1: "Archived", 2: "Archived", 3: "Production"}


def test_grouped_rank_matches_plain_rank(spark):
    df = spark.range(0, 300).select((F.col("id") % 2).alias("g"), F.col("id").alias("o"), (F.col("id") / 37).cast("int").alias("salt"))
    got = {(r.g, r.o): r.rank for r in sampling.grouped_rank(df, ["g"], ["o"], "salt").collect()}
    for g in (0, 1):
        ordered = sorted(o for (gg, o) in got if gg == g)
        assert [got[(g, o)] for o in ordered] == list(range(len(ordered)))


def test_smote_neighbours_in_blocks_with_many_copies(spark, monkeypatch):
    from textlane.operators import smote
    monkeypatch.setattr(smote, "BLOCK", 4)
    points = [(f"c{i:02d}", "a", [1.0, 2.0]) for i in range(12)] + [(f"p{i}", "a", [float(i), -float(i * i)]) for i in range(7)]
    points += [("q0", "b", [1.0, 2.0]), ("q1", "b", [1.5, 2.0]), ("bad", "b", [1.0, None]), ("none", "b", None)]
    got = smote.nearest_neighbours(spark.createDataFrame(points, "id string, label string, vec array<double>"), k=3).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r["id"], r["nn_rank"])):
        found.setdefault(r["id"], []).append((r["nn_id"], r["nn_vec"]))
    vectors = {i: (c, v) for i, c, v in points if v is not None and None not in v}
    for i, (c, v) in vectors.items():
        others = sorted((sum((x - y) ** 2 for x, y in zip(v, w)), j, w) for j, (d, w) in vectors.items() if d == c and j != i)
        assert found.pop(i) == [(j, w) for _, j, w in others[:3]]
    assert not found
