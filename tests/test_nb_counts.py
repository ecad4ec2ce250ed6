"""Naive Bayes on TF-IDF rows from their counts (M1, M2): the same model and scores, no table of weights."""

import pytest

from textlane.operators import features as feat, models
from textlane.plans import catalog, catalog_flows

COUNTS = [(1, "a", 2), (1, "b", 1), (2, "a", 1), (2, "c", 3), (3, "c", 1), (3, "d", 1), (4, "b", 2), (4, "d", 2), (5, "a", 1), (5, "e", 4),
          (6, "e", 1), (None, "a", 1), (None, "f", 2)]
LABELS = [(1, "x"), (2, "x"), (2, "y"), (3, "y"), (4, None), (6, "y"), (7, "x"), (1, "x")]


def _both(spark):
    tf = spark.createDataFrame(COUNTS, "doc_id long, term string, tf long")
    idf = feat.with_idf(feat.vocabulary(tf), tf.selectExpr("count(distinct doc_id)").scalar())
    return tf, idf, feat.tfidf(tf, idf)


@pytest.mark.parametrize("labels", [LABELS, [r for r in LABELS if r[1]]])
@pytest.mark.parametrize("wide", [0, 64])
def test_counts_give_the_model_and_scores_of_the_weights(spark, monkeypatch, labels, wide):
    monkeypatch.setattr(models, "WIDE_CLASSES", wide)
    tf, idf, x = _both(spark)
    lab = spark.createDataFrame(labels, "doc_id long, label string")
    asked = spark.createDataFrame([(k,) for k in (1, 2, 2, 3, 5, 6, 7, 8, None)], "doc_id long")
    one = models.fit_naive_bayes(x, lab, 6, 0.5)
    two = models.naive_bayes_from_sums(models.class_sums(tf, idf, lab), lab, 6, 0.5)

    def rows(df):
        return sorted(([round(v, 9) if isinstance(v, float) else v for v in r] for r in df.collect()), key=str)

    assert rows(one.terms) == rows(two.terms) and rows(one.classes) == rows(two.classes)
    if all(c for _, c in labels):
        old, new = models.predict_naive_bayes(x, asked, one, digits=9), models.predict_from_counts(tf, idf, asked, two, digits=9)
        assert rows(old.selectExpr("doc_id", "p", "proba")) == rows(new.selectExpr("doc_id", "p", "proba"))


def test_queries_make_no_table_of_weights(spark, monkeypatch):
    from tests.conftest import SF

    def never(*a, **k):
        raise AssertionError("a table of weights")

    for module in (feat, models):
        monkeypatch.setattr(module, "tfidf", never)
    assert catalog.m2_nb_predict(spark, SF).count() == catalog.docs(spark, SF).count()
    assert catalog.e1_accuracy(spark, SF).count() == 2
    assert catalog_flows.e8_registry_eval(spark, SF).count() == 1


FOLDS = [(1, 0), (2, 1), (2, 1), (3, 2), (4, 0), (6, 1), (7, 2), (5, 0), (None, 1)]


@pytest.mark.parametrize("wide", [0, 64])
def test_counts_give_the_grid_of_the_weights(spark, monkeypatch, wide):
    monkeypatch.setattr(models, "WIDE_CLASSES", wide)
    tf, idf, x = _both(spark)
    lab = spark.createDataFrame([r for r in LABELS if r[1]] + [(4, "x"), (None, "y")], "doc_id long, label string")
    folds = spark.createDataFrame(FOLDS, "doc_id long, fold int")
    for v in (6, idf.selectExpr("count(1)").scalar()):
        old = models.naive_bayes_grid(x, lab, folds, v, [1.0, 0.01], 3)
        new = models.naive_bayes_grid_from_counts(tf, idf, lab, folds, v, [1.0, 0.01], 3)
        assert sorted(map(tuple, old.collect())) == sorted(map(tuple, new.collect()))


def test_grid_queries_make_no_table_of_weights(spark, monkeypatch):
    from tests.conftest import SF
    from textlane.plans import catalog_ml

    def never(*a, **k):
        raise AssertionError("a table of weights")

    for module in (feat, models):
        monkeypatch.setattr(module, "tfidf", never)
    assert catalog_ml.m8_nb_best(spark, SF).count() == 1
    assert catalog_ml.l1_pipeline_nb(spark, SF).count() == 2
