"""TF-IDF, bounds, NB, label maps (FIXTURES C4-C8)."""

import math

from pyspark.sql import functions as F

from textlane.operators import features as feat, models


def _tf(spark, docs):
    rows = [(i, t) for i, d in enumerate(docs) for t in d.split()]
    long = spark.createDataFrame(rows, "doc_id int, term string")
    return feat.term_counts(long)


def test_tfidf_golden(spark):
    tf = _tf(spark, ["aa bb", "aa aa"])
    x = feat.tfidf(tf, feat.with_idf(feat.vocabulary(tf), F.lit(2)))
    got = {(r.doc_id, r.term): round(r.w, 6) for r in x.collect()}
    assert got == {(0, "aa"): 0.579739, (0, "bb"): 0.814802, (1, "aa"): 1.0}


def test_l2_norms_are_one(spark):
    tf = _tf(spark, ["a b c a", "b b d", "e"])
    x = feat.tfidf(tf, feat.with_idf(feat.vocabulary(tf), F.lit(3)))
    for r in x.groupBy("doc_id").agg(F.sum(F.col("w") ** 2).alias("s")).collect():
        assert abs(r.s - 1.0) < 1e-12


def test_document_frequency_bounds(spark):
    vocab = spark.createDataFrame([("t1", 1), ("t2", 2), ("t95", 95), ("t96", 96)], "term string, doc_freq long")
    kept = {r.term for r in feat.bounded_vocabulary(vocab, F.lit(100), 2, 0.95).collect()}
    assert kept == {"t2", "t95"}


def test_naive_bayes_golden(spark):
    # class 0: (1,0) (2,1) (2,1); class 1: (0,3) over terms a, b
    rows = [(0, "a", 1.0), (0, "b", 0.0), (1, "a", 2.0), (1, "b", 1.0), (2, "a", 2.0), (2, "b", 1.0),
            (3, "a", 0.0), (3, "b", 3.0)]
    x = spark.createDataFrame(rows, "doc_id int, term string, w double").filter(F.col("w") > 0)
    labels = spark.createDataFrame([(0, "0"), (1, "0"), (2, "0"), (3, "1")], "doc_id int, label string")
    m = models.fit_naive_bayes(x, labels, 2, alpha=1.0)
    cls = {r.label: r for r in m.classes.collect()}
    assert math.isclose(math.exp(cls["0"].log_prior), 0.75) and math.isclose(math.exp(cls["1"].log_prior), 0.25)
    theta = {(r.label, r.term): math.exp(r.log_theta) for r in m.terms.collect()}
    assert math.isclose(theta[("0", "a")], 6 / 9) and math.isclose(theta[("0", "b")], 3 / 9)
    assert math.isclose(theta[("1", "b")], 4 / 5)
    # unseen pair (1, a) uses the class default 1/5
    assert math.isclose(math.exp(cls["1"].default_log_theta), 1 / 5)
    pred = models.predict_naive_bayes(x, labels.select("doc_id"), m)
    probs = [sum(e.prob for e in r.proba) for r in pred.collect()]
    assert all(abs(p - 1) < 1e-12 for p in probs)


def test_string_argmax_and_label_maps(spark):
    df = spark.createDataFrame([("Abc", "Bank + x", "noun"), ("zz", "Bank", "noun"), ("a", "a", "a")], "a string, b string, c string")
    assert [r.t for r in df.select(feat.string_argmax("a", "b", "c").alias("t")).collect()] == [2, 0, 0]
    m = spark.createDataFrame([("0", "A"), ("1", "B"), ("2", "C")], "idx string, label string")
    idx = spark.createDataFrame([(0,), (3,)], "i int")
    got = {r.i: r.label for r in feat.decode_labels(idx, "i", m).collect()}
    assert got == {0: "A", 3: None}


def test_macro_f1_evaluator_and_grid(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors

    from textlane.operators import metrics as met, mllib

    # macro F1 counts a never-predicted class as 0: classes 0 (f1 2/3), 1 (f1 2/3), 2 (0)
    pred = spark.createDataFrame([(0.0, 0.0), (0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (2.0, 0.0)],
                                 "label_idx double, prediction double")
    got = mllib.MacroF1Evaluator().evaluate(pred)
    ref = met.f1_micro_macro(pred.select(F.col("label_idx").alias("y"), F.col("prediction").alias("p"))).first()
    assert math.isclose(got, ref.f1_macro) and math.isclose(got, 4 / 9)
    # two separable clusters, 2 folds: every candidate scores 1.0 and the first one wins the tie
    rows = [(float(i % 2), Vectors.dense([float(i % 2) * 4 + (i % 5) * 0.1, 1.0]), i % 2 if i < 10 else (i + 1) % 2)
            for i in range(20)]
    train = spark.createDataFrame(rows, ["label_idx", "features", "fold"])
    lr = LogisticRegression(labelCol="label_idx", maxIter=50)
    grid = [{lr.regParam: 0.0}, {lr.regParam: 0.01}]
    _, res = mllib.grid_search(lr, grid, train, "f1_macro", k=2, parallelism=2)
    assert [r[2] for r in res] == [1.0, 1.0]
    assert mllib.best_candidate(res)[0] == 0


def test_sparse_vectors_from_rows_equal_the_vectorizer(spark):
    from textlane.operators import mllib
    docs = spark.createDataFrame([(1, ["b", "a", "b"]), (2, ["c"]), (3, ["ä", "a"])], "doc_id long, tokens array<string>")
    tf = feat.term_counts(docs.select("doc_id", F.explode("tokens").alias("term")))
    vocab = feat.with_idf(feat.vocabulary(tf), F.lit(3))
    want = {r.doc_id: r.features for r in mllib.tfidf_vectorizer(vocab).transform(docs).collect()}
    got = {r.doc_id: r.features for r in mllib.to_sparse_vectors(feat.tfidf(tf, vocab).select("doc_id", "term", "w"), "doc_id", vocab).collect()}
    assert got.keys() == want.keys()
    for k, v in got.items():
        assert v.size == want[k].size and list(v.indices) == list(want[k].indices)
        assert all(abs(a - b) < 1e-12 for a, b in zip(v.values, want[k].values))


def test_counts_weigh_confusion_rows(spark):
    from textlane.operators import metrics as met
    rows = [("a", "a", 3), ("a", "b", 1), ("b", "b", 2), ("b", "c", 2)]
    counted = spark.createDataFrame(rows, "y string, p string, n long")
    plain = spark.createDataFrame([(y, p) for y, p, n in rows for _ in range(n)], "y string, p string")
    assert met.f1_micro_macro(counted, n="n").first() == met.f1_micro_macro(plain).first()


def _small_corpus(spark):
    docs = ["a b b", "a c", "d d e", "e f", "a b c", "d f f", "b c c", "e d"]
    x = feat.tfidf(_tf(spark, docs), feat.with_idf(feat.vocabulary(_tf(spark, docs)), F.lit(float(len(docs)))))
    labels = spark.createDataFrame([(i, "x" if i in (0, 1, 4, 6) else "y") for i in range(8)], "doc_id int, label string")
    return x, labels


def test_nb_scores_of_few_and_many_classes_agree(spark, monkeypatch):
    x, labels = _small_corpus(spark)
    asked = labels.select("doc_id").unionByName(spark.createDataFrame([(0,), (99,)], "doc_id int"))   # one twice, one without terms
    model = models.fit_naive_bayes(x, labels.filter("doc_id < 6"), 6)
    got = {}
    for limit in (models.WIDE_CLASSES, 0):
        monkeypatch.setattr(models, "WIDE_CLASSES", limit)
        rows = models.naive_bayes_scores(x, asked, model).collect()
        got[limit] = {(r.doc_id, r.label): round(r.score, 9) for r in rows}
        assert len(rows) == len(got[limit]) == 18
    wide, long = got.values()
    assert wide == long


def test_nb_grid_of_few_and_many_classes_agree(spark, monkeypatch):
    x, labels = _small_corpus(spark)
    folds = labels.select("doc_id", (F.col("doc_id") % 3).alias("fold"))
    got = []
    for limit in (models.WIDE_CLASSES, 0):
        monkeypatch.setattr(models, "WIDE_CLASSES", limit)
        rows = models.naive_bayes_grid(x, labels, folds, x.select(F.countDistinct("term")).scalar(), [1.0, 0.01], 3).collect()
        got.append({(r.alpha, r.fold): round(r.accuracy, 9) for r in rows})
    assert got[0] == got[1] and len(got[0]) == 6
