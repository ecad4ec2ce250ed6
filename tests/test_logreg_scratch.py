"""Logistic regression main flow, data-driven columns, label-map maximum, scratch folder rule."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from textlane import session
from textlane.operators import features as feat, metrics as met, runs


def test_logreg_probabilities(spark):
    from textlane.plans import catalog_ml
    rows = catalog_ml.logreg_scores(spark, SF).collect()
    assert rows and all(abs(sum(r.proba) - 1) < 1e-9 and min(r.proba) >= 0 for r in rows)
    train = [r for r in rows if r.split == "train"]
    assert sum(r.p == r.y for r in train) >= 0.95 * len(train)


def test_invert_label_map_takes_the_largest_number(spark):
    m = spark.createDataFrame([("9", "a"), ("10", "a"), ("2", "b"), ("x", "c")], "idx string, label string")
    assert {r.label: r.idx for r in feat.invert_label_map(m).collect()} == {"a": "10", "b": "2", "c": "x"}


def test_columns_come_from_the_data(spark):
    pred = spark.createDataFrame([("a", "a"), ("b", "new"), ("c", "a")], "y string, p string")
    out = {r.y: r.asDict() for r in met.confusion_matrix(pred).collect()}
    assert out["b"] == {"y": "b", "a": 0, "b": 0, "c": 0, "new": 1}
    log = spark.createDataFrame([(1, "x", 1.0, 1), (1, "unseen", 2.0, 1)], "run int, key string, value double, ts int")
    assert runs.runs_wide(log, "run", "key", "value", ["ts"]).columns == ["run", "unseen", "x"]


def test_no_private_scratch_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_dir(Session())
