"""Random forest with trees as tables (M6)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from textlane.operators import forest
from textlane.plans import catalog_ml


def _rows(spark, n=400, dim=6):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, dim))
    y = (x[:, 0] > 0).astype(int) + (x[:, 1] > 0.5)
    data = [(k, [float(v) for v in x[k]], int(y[k]), k % 4 != 0) for k in range(n)]
    return spark.createDataFrame(data, "id long, x array<double>, y int, train boolean")


def _predicted(rows, **kw):
    b = forest.forest_blocks(rows, "id", "x", "y", "train", 3)
    model = forest.fit_forest(b, n_trees=12, **kw)
    return model, {r["id"]: (r["p_idx"], tuple(r["proba"])) for r in forest.predict_forest(model, b).collect()}


def test_levels_and_local_subtrees_give_the_same_forest(spark):
    rows = _rows(spark)
    local, a = _predicted(rows)
    levels, b = _predicted(rows.repartition(3), local=40)
    assert not local.top and len(levels.top) > 12
    assert a == b and len(a) == 400
    right = {r["id"]: r["y"] for r in rows.collect()}
    for train, least in ((True, 0.97), (False, 0.8)):
        ids = [k for k in right if (k % 4 != 0) == train]
        assert np.mean([a[k][0] == right[k] for k in ids]) >= least
    assert all(abs(sum(p) - 1) < 1e-9 for _, p in a.values())


def test_depth_and_nodes_without_a_split(spark):
    rows = spark.createDataFrame([(k, [1.0, 2.0], k % 3 // 2, True) for k in range(90)], "id long, x array<double>, y int, train boolean")
    _, got = _predicted(rows, local=10)          # all vectors are equal: large leaves above the local subtrees
    assert {p for p, _ in got.values()} == {0} and len(got) == 90
    model, _ = _predicted(_rows(spark), max_depth=1)
    assert model.subtrees.agg(F.max(F.length("feature"))).first()[0] == 3 * 4
    with pytest.raises(ValueError):
        _predicted(rows.withColumn("y", F.when(F.col("id") > 3, F.col("y"))))


def test_query_goes_over_to_tables(spark, monkeypatch, tmp_path):
    """Beyond the limit MLlib's forest isn't called; every row, also one whose id repeats, gets its prediction."""
    data = [(k // 2, [float(k % 10), float(k * 37 % 101)], k % 10) for k in range(200)]
    spark.createDataFrame(data, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    monkeypatch.setattr(catalog_ml, "FOREST_VECTOR_ROWS", 10)
    monkeypatch.setattr(catalog_ml.mllib, "random_forest", None)
    rows = catalog_ml.m6_forest(spark, str(tmp_path)).collect()
    assert len(rows) == 200
    assert np.mean([r["y"] == r["p"] for r in rows if r["split"] == "train"]) > 0.9
