"""Registered queries that fit models (MLlib, NMF, grids) and whole pipelines."""

from __future__ import annotations

import math
from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlane.functions.expr import tokens as token_expr
from textlane.operators import (features as feat, forest, metrics as met, mllib, models, sampling, sparse_tree, table_logreg, text,
                                topics)
from textlane.operators.sparse_smote import smote_sparse
from textlane.operators.text_chain import processed_text
from textlane.plans.catalog import (PROBA_DIGITS, _r, count_features, docs, docs_by_id, quality_split, lang_split,
                                    tfidf_features)
from textlane.plans.stages import Stage, run_stages
from textlane.session import IN_BLOCKS, fresh_path, materialize, settings, table
from textlane.sources import files

K_FOLDS = 5
# The hyper-parameter grids searched with 5 stratified folds.
NB_ALPHAS = [1.0, 0.1, 0.01, 0.001, 0.0001]
LOGREG_GRID = {"C": [0.01, 1, 10], "penalty": ["l1", "l2"]}
TREE_GRID = {"criterion": ["gini", "entropy"], "splitter": ["best", "random"], "max_depth": [2, 3, 4, 5, 6, 7, 8, None],
             "min_samples_leaf": [2, 3, 4, 7], "max_features": ["sqrt", "log2", None]}
#: One-vs-rest coefficients are vectors up to so many terms: every task sends one whole vector per iteration and class.
OVR_VECTOR_TERMS = 1 << 17
MAX_FOREST_DEPTH = 30     # MLlib's deepest tree stands in for "no limit"
#: Up to so many training rows MLlib grows the forest; its trees stand whole on the driver and go to every task at each level.
FOREST_VECTOR_ROWS = 1 << 14


def _vector_frame(spark: SparkSession, d: str, split: DataFrame):
    """``(doc_id, y, split, label_idx, features)`` and the label map for the rows of ``split``."""
    toks = text.remove_stopwords(text.tokenize(docs_by_id(spark, d, "text")))
    tf = feat.term_counts(text.explode_tokens(toks))
    n = feat.doc_count(docs(spark, d))
    vocab = feat.with_idf(feat.vocabulary(tf), n)
    vec = mllib.tfidf_vectorizer(vocab)
    lmap = feat.ordinal_label_map(split, "y")
    labelled = feat.encode_labels(split, "y", lmap, "label_idx").withColumn("label_idx", F.col("label_idx").cast("double"))
    frame = vec.transform(toks.join(labelled, "doc_id")).select("doc_id", "y", "split", "label_idx", "features")
    return frame, lmap


def _decoded(pred: DataFrame, lmap: DataFrame) -> DataFrame:
    return feat.decode_labels(pred, "p_idx", lmap, "p")


def _fit_predict(frame: DataFrame, lmap: DataFrame, estimator) -> DataFrame:
    train = frame.filter(F.col("split") == "train")
    model = mllib.fit(estimator, train)
    pred = mllib.predictions(model, frame, ("doc_id", "split", "y"))
    return _decoded(pred, lmap)


def _ovr_scores(spark, d, split: DataFrame, features: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """One-vs-rest logistic regression on the whole vocabulary: ``(doc_id, split, y, p, proba array in label order)``.

    Up to ``OVR_VECTOR_TERMS`` terms the coefficients are vectors; beyond, a table, fitted in blocks and applied by joins.
    """
    x, vocab = features if features is not None else tfidf_features(spark, d, materialize=True)[:2]
    if vocab.count() <= min(OVR_VECTOR_TERMS, mllib.MAX_VECTOR_TERMS):
        frame, lmap = _vector_frame(spark, d, split)
        frame = materialize(frame, "logreg-rows")
        train = frame.filter(F.col("split") == "train")
        model = mllib.logistic_regression(train.count(), C=1.0, multiclass="ovr").fit(train)
        scored = mllib.ovr_probabilities(model, frame)
    else:
        scored, lmap = _table_scores(x, split)
    return _decoded(scored, lmap).select("doc_id", "split", "y", "p", "proba")


def _table_scores(x: DataFrame, split: DataFrame):
    """The same model with its coefficients as a table."""
    lmap = feat.ordinal_label_map(split, "y")
    rows = feat.encode_labels(split, "y", lmap, "label_idx")
    train = rows.filter(F.col("split") == "train").select("doc_id", F.col("label_idx").cast("int").alias("y"))
    model = table_logreg.fit_table_logreg(x, train, lmap.count(), C=1.0, tol=1e-4)
    return table_logreg.table_logreg_probabilities(model, x, rows.select("doc_id", "split", "y")), lmap


def m3_logreg(spark, d):
    return _ovr_scores(spark, d, quality_split(spark, d)).select("doc_id", "split", "y", "p")


def m3_logreg_table(spark, d):
    """The model of m3_logreg fitted with its coefficients as a table, at any size of the vocabulary."""
    split = quality_split(spark, d)
    scored, lmap = _table_scores(tfidf_features(spark, d, materialize=True)[0], split)
    return _decoded(scored, lmap).select("doc_id", "split", "y", "p", _r(F.element_at("proba", 2), 3).alias("p_good"))


def m4_logreg_variants(spark, d):
    frame, lmap = _vector_frame(spark, d, quality_split(spark, d))
    # Weights of the training rows only; test labels must not set them.
    weights = sampling.class_weights(frame.filter(F.col("split") == "train"), "label_idx").select("label_idx", "weight")
    frame = materialize(frame.join(weights, "label_idx", "left"), "weighted-rows")
    n_train = frame.filter(F.col("split") == "train").count()
    out = None
    for name, est in [("l2", mllib.logistic_regression(n_train, C=1.0, penalty="l2", multiclass="multinomial")),
                      ("l1", mllib.logistic_regression(n_train, C=10.0, penalty="l1", multiclass="multinomial")),
                      ("l2_balanced", mllib.logistic_regression(n_train, C=1.0, weight_col="weight",
                                                                multiclass="multinomial"))]:
        acc = met.accuracy(_fit_predict(frame, lmap, est), by=("split",)).withColumn("variant", F.lit(name))
        out = acc if out is None else out.unionByName(acc)
    return out.select("variant", "split", _r("accuracy").alias("accuracy"))


def _tree_input(x: DataFrame, split: DataFrame, folds: DataFrame | None = None):
    """Rows for the sparse trees and the label map: train rows train set 0, or with folds every set but their own fold's."""
    lmap = feat.ordinal_label_map(split, "y")
    rows = feat.encode_labels(split, "y", lmap, "y_idx").select("doc_id", F.col("y_idx").cast("int").alias("y"), "split")
    if folds is None:
        rows = rows.withColumn("train_of", F.when(F.col("split") == "train", F.array(F.lit(0)))).withColumn("score_of", F.array(F.lit(0)))
    else:
        every = F.sequence(F.lit(0), F.lit(K_FOLDS - 1))
        rows = (rows.join(folds.select("doc_id", "fold"), "doc_id").withColumn("score_of", F.array("fold"))
                .withColumn("train_of", F.array_except(every, F.col("score_of"))))
    n_classes = lmap.count()
    return materialize(sparse_tree.tree_rows(x, rows), "tree-rows"), lmap, n_classes


def _tree_scores(x: DataFrame, split: DataFrame, variant: sparse_tree.Variant, n_terms: int, max_depth: int | None = None) -> DataFrame:
    """``(doc_id, split, y, p, proba array in label order)`` of one tree fitted on the train rows."""
    rows, lmap, n_classes = _tree_input(x, split)
    model = sparse_tree.fit_trees(rows, [variant], n_classes, n_terms, max_depth=max_depth)
    pred = sparse_tree.predict_trees(model, rows).select(F.col("id").alias("doc_id"), F.col("p").alias("p_idx"), "proba")
    return _decoded(pred, lmap).join(split, "doc_id").select("doc_id", "split", "y", "p", "proba")


def m5_tree(spark, d):
    """Decision tree on the whole vocabulary, grown until its leaves are pure."""
    x, vocab, _, _ = tfidf_features(spark, d, materialize=True)
    return _tree_scores(x, lang_split(spark, d), sparse_tree.Variant(), vocab.count()).select("doc_id", "split", "y", "p")


def _embedding_split(spark, d):
    emb = table(spark, d, "embeddings").select("vec_id", F.col("label").cast("string").alias("y"), "embedding")
    return sampling.split_by_hash(emb, "vec_id", 0.2, 37)


def _forest_rows(frame: DataFrame, lmap: DataFrame) -> DataFrame:
    """``(vec_id, split, y, p_idx)`` of the forest whose trees are tables."""
    rows = materialize(frame.withColumn("_row", F.monotonically_increasing_id()), "forest-rows")   # ids may repeat
    blocks = forest.forest_blocks(rows.withColumn("_train", F.col("split") == "train"), "_row", "embedding", "label_idx", "_train", lmap.count())
    model = forest.fit_forest(blocks, n_trees=100, seed=37, max_depth=MAX_FOREST_DEPTH)
    pred = forest.predict_forest(model, blocks).select(F.col("id").alias("_row"), "p_idx")
    return rows.select("_row", "vec_id", "split", "y").join(pred, "_row").drop("_row")


def m6_forest(spark, d):
    """Random forest of 100 trees on the embeddings; beyond ``FOREST_VECTOR_ROWS`` training rows its trees are tables."""
    sp = _embedding_split(spark, d)
    lmap = feat.ordinal_label_map(sp, "y")
    frame = feat.encode_labels(sp, "y", lmap, "label_idx").withColumn("label_idx", F.col("label_idx").cast("double"))
    if sp.filter(F.col("split") == "train").count() > FOREST_VECTOR_ROWS:
        pred = _forest_rows(frame, lmap)
    else:
        frame = materialize(files.to_vectors(frame, "embedding"), "forest-rows")
        model = mllib.fit(mllib.random_forest(num_trees=100, seed=37, max_depth=MAX_FOREST_DEPTH), frame.filter(F.col("split") == "train"))
        pred = mllib.predictions(model, frame, ("vec_id", "split", "y"))
    return _decoded(pred, lmap).select("vec_id", "split", "y", "p")


def l3_forest_accuracy(spark, d):
    return met.accuracy(m6_forest(spark, d), by=("split",)).select("split", _r("accuracy").alias("accuracy"))


def l4_logreg_embeddings(spark, d):
    """Small multinomial logistic regression on the numeric matrix, accuracy on its own training rows."""
    emb = files.to_vectors(table(spark, d, "embeddings").select("vec_id", F.col("label").cast("double").alias("label_idx"),
                                                                "embedding"), "embedding")
    n = emb.count()
    model = mllib.fit(mllib.logistic_regression(n, C=0.1, multiclass="multinomial"), emb)
    pred = model.transform(emb)
    return pred.agg(_r(F.avg((F.col("prediction") == F.col("label_idx")).cast("double"))).alias("accuracy"))


def _long_proba(pred: DataFrame, lmap: DataFrame) -> DataFrame:
    """``(split, y, label, prob)`` from arrays of probabilities in label order."""
    proba = pred.select("split", "y", F.posexplode("proba").alias("p_idx", "prob"))
    return feat.decode_labels(proba, "p_idx", lmap, "label").select("split", "y", "label", "prob")


def _nb_scores(x, split, v, alpha: float = 1.0):
    """Naive Bayes fitted on the train rows: predictions and long probabilities of all rows."""
    nb = models.fit_naive_bayes(x, split.filter(F.col("split") == "train").select("doc_id", F.col("y").alias("label")), v, alpha)
    pred = materialize(models.predict_naive_bayes(x, split.select("doc_id"), nb).join(split, "doc_id"), "nb-pred")
    proba = pred.select("split", "y", F.explode("proba").alias("_e")).select("split", "y", "_e.label", "_e.prob")
    return pred.select("split", "y", "p"), proba


def _smote_frame(x, vocab, split, frame, lmap):
    """Resampled training vectors and the test rows: ``(doc_id, split, y, label_idx, features)``."""
    train = split.filter(F.col("split") == "train")
    points, entries = smote_sparse(x, train, k=5, seed=7, label="y")
    made = mllib.to_sparse_vectors(entries, "id", vocab).join(points.select("id", "label"), "id")
    made = feat.encode_labels(made.select(F.col("id").alias("doc_id"), F.lit("train_resampled").alias("split"),
                                          F.col("label").alias("y"), "features"), "y", lmap, "label_idx")
    own = frame.select(F.col("doc_id").cast("string").alias("doc_id"), F.when(F.col("split") == "train", "train_resampled").otherwise(
        F.col("split")).alias("split"), "y", "label_idx", "features")
    return materialize(own.unionByName(made.select("doc_id", "split", "y", F.col("label_idx").cast("double").alias("label_idx"), "features")),
                       "resampled-rows")


def _smote_grid_scores(x, vocab, split, frame, lmap):
    """Balanced logistic regression, best of the grid on the resampled rows, scored on them and on the test rows."""
    rows = _smote_frame(x, vocab, split, frame, lmap)
    train = rows.filter(F.col("split") == "train_resampled")
    folds = sampling.stratified_folds(train.select("doc_id", "y"), "doc_id", "y", K_FOLDS, 37)
    train = materialize(sampling.with_class_weight(train.join(folds.select("doc_id", "fold"), "doc_id"), "label_idx", "weight"), "cv-train")
    n = train.count()
    lr = mllib.logistic_regression(n, weight_col="weight", multiclass="multinomial")
    model, _ = mllib.grid_search(lr, _logreg_grid(lr, n), train, "f1_micro", parallelism=4)
    return _decoded(mllib.predictions(model, rows, ("doc_id", "split", "y")), lmap)


def l2_model_table(spark, d):
    """Six models on one split: AUC, accuracy, precision, recall and F1 of each, on training and test rows.

    Naive Bayes and its alpha grid, logistic regression, balanced logistic-regression grid on SMOTE-resampled training
    rows (its split is called train_resampled), decision tree and its grid; all on one TF-IDF table of all terms.
    """
    sp = materialize(quality_split(spark, d), "quality-split")
    x, vocab, _, v = tfidf_features(spark, d, materialize=True)
    n_terms = vocab.count()
    frame, lmap = _vector_frame(spark, d, sp)
    frame = materialize(frame, "logreg-rows")

    def vector_scores(pred):
        pred = materialize(pred.select("split", "y", "p", "proba"), "model-pred")
        return pred.drop("proba"), _long_proba(pred, lmap)

    alpha = _nb_best(_nb_grid_means(x, sp, v)).first()["best_alpha"]
    setting, depth = _tree_setting(*_tree_grid_best(_tree_grid_scores(x, sp, n_terms)), n_terms)
    scored = {
        "MultinomialNB": _nb_scores(x, sp, v),
        "MultinomialNBCV": _nb_scores(x, sp, v, alpha),
        "LogisticRegression": vector_scores(_ovr_scores(spark, d, sp, (x, vocab))),
        "LogisticRegressionCVSmote": vector_scores(_smote_grid_scores(x, vocab, sp, frame, lmap)),
        "DecisionTreeClassifier": vector_scores(_tree_scores(x, sp, sparse_tree.Variant(), n_terms)),
        "DecisionTreeClassifierCV": vector_scores(_tree_scores(x, sp, setting, n_terms, depth)),
    }
    out = None
    for name, (pred, proba) in scored.items():
        rows = met.train_test_table(pred, proba).withColumn("model", F.lit(name))
        out = rows if out is None else out.unionByName(rows)
    return out.select("model", "metric", "split", _r("value").alias("value"))


def _nb_grid_means(x, split, v):
    return _grid_means(split, lambda train, folds: models.naive_bayes_grid(x, train, folds, v, NB_ALPHAS, K_FOLDS))


def _nb_grid_means_from_counts(spark, d, split):
    tf, idf, v = count_features(spark, d)
    return _grid_means(split, lambda train, folds: models.naive_bayes_grid_from_counts(tf, idf, train, folds, v, NB_ALPHAS, K_FOLDS))


def _grid_means(split, grid):
    train = split.filter(F.col("split") == "train").select("doc_id", F.col("y").alias("label"))
    per_fold = grid(train, sampling.stratified_folds(train, "doc_id", "label", K_FOLDS, 37))
    return per_fold.groupBy("alpha").agg(_r(F.avg("accuracy")).alias("mean_accuracy"))


def _nb_best(means: DataFrame) -> DataFrame:
    candidate = F.array_position(F.array(*[F.lit(a) for a in NB_ALPHAS]), F.col("alpha"))
    best = means.orderBy(F.desc("mean_accuracy"), candidate).limit(1)
    return best.select(F.col("alpha").alias("best_alpha"), F.col("mean_accuracy").alias("best_score"))


def m7_nb_grid(spark, d):
    """NB alpha grid with 5 stratified folds on the training rows; mean accuracy per alpha."""
    return _nb_grid_means_from_counts(spark, d, lang_split(spark, d)).select("alpha", "mean_accuracy")


def m8_nb_best(spark, d):
    """Best score and best alpha of the NB grid; the earlier candidate wins a tie."""
    return _nb_best(_nb_grid_means_from_counts(spark, d, lang_split(spark, d)))


def _cv_train(spark, d):
    """Training rows as vectors with 5 stratified folds and balanced class weights."""
    frame, _ = _vector_frame(spark, d, lang_split(spark, d))
    train = frame.filter(F.col("split") == "train")
    folds = sampling.stratified_folds(train.select("doc_id", "y"), "doc_id", "y", K_FOLDS, 37)
    train = sampling.with_class_weight(train.join(folds.select("doc_id", "fold"), "doc_id"), "label_idx", "weight")
    return materialize(train, "cv-train")


def _grid_frame(spark, names: list[str], types: str, rows: list, score: str):
    best = mllib.best_candidate([(i, p, m) for i, p, m in rows])[0]
    data = [(i, *p, round(m, 6), i == best) for i, p, m in rows]
    return spark.createDataFrame(data, f"candidate int, {types}, {score} double, is_best boolean")


def _logreg_grid(lr, n: int) -> list:
    return [{lr.regParam: 1.0 / (c * n), lr.elasticNetParam: 1.0 if pen == "l1" else 0.0}
            for c, pen in product(LOGREG_GRID["C"], LOGREG_GRID["penalty"])]


def m7_logreg_grid(spark, d):
    """Balanced logistic regression, grid C x penalty, 5 folds, scored by f1_micro (accuracy)."""
    train = _cv_train(spark, d)
    n = train.count()
    lr = mllib.logistic_regression(n, weight_col="weight", multiclass="multinomial")
    _, rows = mllib.grid_search(lr, _logreg_grid(lr, n), train, "f1_micro", parallelism=4)
    return _grid_frame(spark, ["C", "penalty"], "C double, penalty string",
                       [(i, (float(c), pen), m) for (i, _, m), (c, pen) in zip(rows, product(LOGREG_GRID["C"], LOGREG_GRID["penalty"]))],
                       "mean_f1_micro")


def _tree_candidates() -> list[tuple]:
    """(criterion, splitter, max_depth, min_samples_leaf, max_features) in the order of the grid."""
    return list(product(*TREE_GRID.values()))


def _tree_setting(criterion: str, splitter: str, max_depth: int | None, leaf: int, max_features: str | None, n_terms: int):
    """The variant of a candidate and its depth; sqrt and log2 are shares of all terms, 1 at least."""
    drawn = {"sqrt": math.sqrt, "log2": math.log2}.get(max_features)
    return sparse_tree.Variant(criterion, leaf, splitter, max(1, int(drawn(max(n_terms, 1)))) if drawn else None), max_depth


def _tree_grid_scores(x: DataFrame, split: DataFrame, n_terms: int) -> list[tuple]:
    """``(candidate, parameters, mean macro F1)`` of all candidates, from one growth per fold and setting without depth."""
    train = split.filter(F.col("split") == "train")
    folds = sampling.stratified_folds(train.select("doc_id", "y"), "doc_id", "y", K_FOLDS, 37)
    rows, _, n_classes = _tree_input(x, train, folds)
    settings = [_tree_setting(*c, n_terms) for c in _tree_candidates()]
    variants = list(dict.fromkeys(v for v, _ in settings))
    model = sparse_tree.fit_trees(rows, variants, n_classes, n_terms, sets=list(range(K_FOLDS)))
    counts = sparse_tree.tree_confusions(model, rows, TREE_GRID["max_depth"])
    f1 = met.f1_micro_macro(counts, by=("set", "variant", "depth"), n="n").groupBy("variant", "depth").agg(
        (F.sum("f1_macro") / K_FOLDS).alias("mean"))
    means = {(r["variant"], r["depth"]): r["mean"] for r in f1.collect()}     # one row per candidate
    return [(i, c, means.get((variants.index(v), -1 if depth is None else depth), 0.0))
            for i, (c, (v, depth)) in enumerate(zip(_tree_candidates(), settings))]


def _tree_grid_best(rows: list[tuple]) -> tuple:
    return mllib.best_candidate([(i, c, round(m, 6)) for i, c, m in rows])[1]


def m7_tree_grid(spark, d):
    """Decision tree, all 384 legal candidates of the grid, 5 folds, whole vocabulary, scored by f1_macro."""
    x, vocab, _, _ = tfidf_features(spark, d, materialize=True)
    rows = _tree_grid_scores(x, lang_split(spark, d), vocab.count())
    return _grid_frame(spark, list(TREE_GRID), "criterion string, splitter string, max_depth int, min_samples_leaf int, max_features string",
                       [(i, c, round(m, 6)) for i, c, m in rows], "mean_f1_macro")


def logreg_scores(spark, d) -> DataFrame:
    """One-vs-rest scores of the language of every document, both splits."""
    return _ovr_scores(spark, d, lang_split(spark, d))


def l1_pipeline_logreg(spark, d):
    """Main flow with logistic regression: AUC, accuracy, precision, recall and F1 of both splits."""
    pred = materialize(logreg_scores(spark, d), "logreg-pred")
    lmap = feat.ordinal_label_map(lang_split(spark, d), "y")
    table_ = met.train_test_table(pred.drop("proba"), _long_proba(pred, lmap))
    return table_.select("metric", "split", _r("value").alias("value"))


def _processed_counts(pt: DataFrame, of: DataFrame):
    """(counts, vocabulary with idf, its size) of processed texts, counted where they stand; see ``count_features``."""
    keep = tuple(c for c in pt.columns if c not in ("doc_id", "processed_text"))
    long = text.explode_tokens(pt.select("doc_id", *keep, token_expr(F.col("processed_text")).alias("tokens")), keep=keep)
    tf = feat.term_counts(long, keep=keep).select("doc_id", "term", "tf")
    with settings(pt.sparkSession, **IN_BLOCKS):
        tf = materialize(tf.sortWithinPartitions("term", "doc_id"), "tf")
    idf = materialize(feat.with_idf(feat.vocabulary(tf), feat.doc_count(of)), "vocabulary")
    return tf, idf, idf.count()


def _nb_from_counts(tf: DataFrame, idf: DataFrame, split: DataFrame, v: int, alpha: float = 1.0) -> DataFrame:
    """``(doc_id, p, proba)`` of all rows of ``split`` by naive Bayes fitted on its training rows."""
    train = split.filter(F.col("split") == "train").select("doc_id", F.col("y").alias("label"))
    model = models.naive_bayes_from_sums(models.class_sums(tf, idf, train), train, v, alpha)
    return models.predict_from_counts(tf, idf, split.select("doc_id"), model)


def l1_pipeline_nb(spark, d):
    """Clean -> processed text -> TF-IDF -> 0.2 split (seed 37) -> NB -> per-split metrics."""
    tf, idf, v = _processed_counts(processed_text(docs(spark, d), block="_block"), docs(spark, d))
    sp = sampling.split_by_hash(docs(spark, d).select("doc_id", F.col("lang").alias("y")), "doc_id", 0.2, 37)
    pred = _nb_from_counts(tf, idf, sp, v).join(sp, "doc_id")
    pred = materialize(pred.select("doc_id", "split", "y", "p"), "nb-pred")      # read by both metrics
    w = met.weighted_prf(pred, by=("split",))
    a = met.accuracy(pred, by=("split",))
    return a.join(w, "split").select("split", _r("accuracy").alias("accuracy"), _r("precision").alias("precision"),
                                     _r("recall").alias("recall"), _r("f1").alias("f1"), "n")


def nb_stages(alpha: float = 1.0, test_size: float = 0.2, seed: int = 37) -> list[Stage]:
    """The main flow as stages: processed text, features, split, predictions, metrics (input: documents)."""
    def processed(_, t):
        return processed_text(t["documents"].select("doc_id", "text"))

    def features(_, t):
        """Counts with idf: TF-IDF rows in parts, as ``count_features`` keeps them."""
        tf, idf, _ = _processed_counts(t["processed"].select("doc_id", "processed_text"), t["processed"])
        return tf.join(idf.select("term", "idf"), "term").select("doc_id", "term", "tf", "idf").sortWithinPartitions("term", "doc_id")

    def split(_, t):
        return sampling.split_by_hash(t["documents"].select("doc_id", F.col("lang").alias("y")), "doc_id", test_size, seed)

    def predictions(_, t):
        x, sp = t["features"], t["split"]
        idf = materialize(x.groupBy("term").agg(F.first("idf").alias("idf")), "vocabulary")
        return _nb_from_counts(x.select("doc_id", "term", "tf"), idf, sp, idf.count(), alpha).join(sp, "doc_id").select("doc_id", "split", "y", "p")

    def metrics(_, t):
        return met.accuracy(t["predictions"], by=("split",)).join(met.weighted_prf(t["predictions"], by=("split",)), "split")

    return [Stage("processed", processed, ("documents",)), Stage("features", features, ("processed",)),
            Stage("split", split, ("documents",), {"test_size": test_size, "seed": seed}),
            Stage("predictions", predictions, ("features", "split"), {"alpha": alpha}), Stage("metrics", metrics, ("predictions",))]


def l1_staged_nb(spark, d):
    """The main flow in saved stages: the first run stops after the features, the second one goes on from what is saved."""
    root, log = fresh_path(spark, "flow"), fresh_path(spark, "flow-log")
    flow, inputs = nb_stages(), {"documents": docs(spark, d).select("doc_id", "text", "lang")}
    run_stages(spark, root, flow[:2], inputs, run_log=log)
    out = run_stages(spark, root, flow, inputs, start_from="split", run_log=log)["metrics"]
    return out.select("split", _r("accuracy").alias("accuracy"), _r("precision").alias("precision"),
                      _r("recall").alias("recall"), _r("f1").alias("f1"), "n")


def f13_feature_stage(spark, d, k: int = 4, iters: int = 200):
    """Processed text -> bounded TF-IDF -> NMF fitted to its tolerance -> doc-topic table, dominant topic and its label."""
    tf, idf, _ = _processed_counts(processed_text(docs(spark, d), block="_block"), docs(spark, d))
    vocab = feat.bounded_vocabulary(idf, feat.doc_count(docs(spark, d)), 2, 0.95)
    X = materialize(feat.tfidf(tf, vocab).select("doc_id", "term", F.col("w").alias("x")), "nmf-x")
    state, _ = topics.fit_nmf(X, k=k, max_iter=iters, seed=123, eval_every=10)
    words = topics.topic_words(state.H, 3).select(F.col("topic").cast("string").alias("idx"),
                                                  F.col("words").alias("label"))
    dom = topics.dominant_topic(state.W)
    table_ = topics.doc_topic_table(state.W, k).join(dom, "doc_id")
    return feat.decode_labels(table_, "topic", words, "topic_label").withColumnRenamed("topic", "relevant_topics")


QUERIES = {
    "m3_logreg": m3_logreg,
    "m3_logreg_table": m3_logreg_table,
    "m4_logreg_variants": m4_logreg_variants,
    "m5_tree": m5_tree,
    "m6_forest": m6_forest,
    "m7_nb_grid": m7_nb_grid,
    "m8_nb_best": m8_nb_best,
    "m7_logreg_grid": m7_logreg_grid,
    "m7_tree_grid": m7_tree_grid,
    "l1_pipeline_nb": l1_pipeline_nb,
    "l1_pipeline_logreg": l1_pipeline_logreg,
    "l1_staged_nb": l1_staged_nb,
    "l2_model_table": l2_model_table,
    "l3_forest_accuracy": l3_forest_accuracy,
    "l4_logreg_embeddings": l4_logreg_embeddings,
    "f13_feature_stage": f13_feature_stage,
}


def _unbalanced_embeddings(spark, d):
    """Embeddings with a two-class label: class "0" (one of ten) against the rest."""
    emb = table(spark, d, "embeddings")
    return emb.select("vec_id", F.when(F.col("label") == 0, F.lit("0")).otherwise(F.lit("rest")).alias("cls"), "embedding")


def g3_smote(spark, d):
    from textlane.operators.smote import smote
    out = smote(_unbalanced_embeddings(spark, d), "vec_id", "cls", "embedding", k=5, seed=7)
    return out.filter("synthetic").select(F.col("id").alias("new_id"), "src_id", "nn_id", _r("lam", 9).alias("lam"),
                                          _r(F.aggregate("vec", F.lit(0.0), lambda a, v: a + v)).alias("vec_sum"))


def g3_smote_sparse(spark, d):
    """New points of the smaller quality class among the TF-IDF rows of the training split."""
    x = tfidf_features(spark, d, materialize=True)[0]
    train = quality_split(spark, d).filter(F.col("split") == "train")
    points, entries = smote_sparse(x, train, k=5, seed=7, label="y")
    sums = entries.groupBy("id").agg(F.count(F.lit(1)).alias("n_terms"), _r(F.sum("w")).alias("w_sum"))
    return points.join(sums, "id").select(F.col("id").alias("new_id"), "src_id", "nn_id", _r("lam", 9).alias("lam"), "n_terms", "w_sum")


QUERIES["g3_smote"] = g3_smote
QUERIES["g3_smote_sparse"] = g3_smote_sparse
