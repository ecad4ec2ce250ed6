"""Classifiers: relational multinomial naive Bayes and MLlib model stages."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlane.operators.features import tfidf
from textlane.session import materialize


@dataclass
class NaiveBayesModel:
    """Fitted multinomial naive Bayes as two tables.

    ``classes``: ``(label, n_docs, log_prior, total, default_log_theta)`` —
    one row per class.  ``terms``: ``(label, term, log_theta, delta)`` for the
    (class, term) pairs seen in training only; every unseen pair has the
    class's ``default_log_theta``, so the model never holds classes x vocabulary
    rows.  ``delta = log_theta - default_log_theta``.
    """

    classes: DataFrame
    terms: DataFrame
    alpha: float

    def write(self, path: str) -> None:
        self.classes.write.mode("overwrite").parquet(f"{path}/classes")
        self.terms.write.mode("overwrite").parquet(f"{path}/terms")

    @staticmethod
    def load(spark, path: str, alpha: float = 1.0) -> "NaiveBayesModel":
        return NaiveBayesModel(spark.read.parquet(f"{path}/classes"),
                               spark.read.parquet(f"{path}/terms"), alpha)


def fit_naive_bayes(features: DataFrame, labels: DataFrame, vocab_size: Column | int,
                    alpha: float = 1.0, key: str = "doc_id", label: str = "label",
                    weight: str = "w") -> NaiveBayesModel:
    """Multinomial NB on a long feature table ``(key, term, weight)``.

    ``labels`` holds ``(key, label)`` for the training rows.  Smoothed
    ``log((N_ct + a) / (N_c + a V))`` and an unsmoothed prior ``log(n_c / n)``.
    """
    lab = labels.select(key, F.col(label).alias("label"))
    # the one pass over the features; classes, priors and thetas all read it
    counts = materialize(features.join(lab, key)
                         .groupBy("label", "term").agg(F.sum(weight).alias("n_ct")), "nb-counts")
    return naive_bayes_from_sums(counts, lab, vocab_size, alpha)


def naive_bayes_from_sums(counts: DataFrame, lab: DataFrame, vocab_size: Column | int, alpha: float = 1.0) -> NaiveBayesModel:
    """The model of the weight sums ``(label, term, n_ct)`` of training rows ``(key, label)``."""
    per_class = counts.groupBy("label").agg(F.sum("n_ct").alias("total"))
    docs = lab.groupBy("label").agg(F.count(F.lit(1)).alias("n_docs"))
    n = lab.select(F.count(F.lit(1))).scalar()
    a = F.lit(float(alpha))
    vocab_size = F.lit(vocab_size) if isinstance(vocab_size, int) else vocab_size
    classes = (docs.join(per_class, "label", "left")
               .withColumn("total", F.coalesce("total", F.lit(0.0)))
               .withColumn("log_prior", F.log(F.col("n_docs") / n))
               .withColumn("default_log_theta", F.log(a / (F.col("total") + a * vocab_size))))
    terms = (counts.join(F.broadcast(classes.select("label", "total", "default_log_theta")), "label")
             .withColumn("log_theta", F.log((F.col("n_ct") + a) / (F.col("total") + a * vocab_size)))
             .select("label", "term", "log_theta",
                     (F.col("log_theta") - F.col("default_log_theta")).alias("delta")))
    return NaiveBayesModel(classes, terms, alpha)


def class_sums(tf: DataFrame, idf: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "label") -> DataFrame:
    """``(label, term, n_ct)``: what ``fit_naive_bayes`` sums over unit-length TF-IDF rows, from their counts.

    A weight is ``tf * idf / norm``: norms are one number per row, idf is one per term, so the long table of weights is
    never made; only counts meet the terms (for the norms) and the rows.
    """
    raw = F.col("tf") * F.col("idf")
    norms = tf.join(idf.select("term", "idf"), "term").groupBy(key).agg(F.sqrt(F.sum(raw * raw)).alias("_norm"))
    rows = labels.select(key, F.col(label).alias("label")).join(norms, key)
    shares = tf.join(rows, key).groupBy("label", "term").agg(F.sum(F.col("tf") / F.col("_norm")).alias("_s"))
    return materialize(shares.join(idf.select("term", "idf"), "term").select("label", "term", (F.col("_s") * F.col("idf")).alias("n_ct")),
                       "nb-counts")


MAX_CLASSES = 100_000
#: Up to so many classes a term's numbers stand in columns of one row when documents are scored.
WIDE_CLASSES = 64


def class_rows(model: NaiveBayesModel) -> list:
    """The class table (one row per class, size-checked)."""
    rows = (model.classes.select("label", "log_prior", "default_log_theta")
            .orderBy("label").limit(MAX_CLASSES + 1).collect())
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    return rows


def class_array(rows: list) -> Column:
    """The class table as one literal array column."""
    return F.array(*[F.struct(F.lit(r["label"]).alias("label"), F.lit(float(r["log_prior"])).alias("log_prior"),
                              F.lit(float(r["default_log_theta"])).alias("default_log_theta")) for r in rows])


def naive_bayes_scores(features: DataFrame, docs: DataFrame, model: NaiveBayesModel,
                       key: str = "doc_id", weight: str = "w") -> DataFrame:
    """Joint log-likelihood ``(key, label, score)`` for every document and class.

    score = prior + default * sum(x) + sum over seen pairs of x * delta.
    With few classes the features are joined once, as they are, with one row
    per term and summed once per document; with many, one row per (document,
    term, class) is summed, and only for the documents asked for.
    """
    rows = class_rows(model)
    if 0 < len(rows) <= WIDE_CLASSES:
        return _wide_scores(features, docs, model, rows, key, weight)
    features = features.join(docs.select(key), key, "left_semi")
    sums = features.groupBy(key).agg(F.sum(weight).alias("_sx"))
    base = (docs.select(key).join(sums, key, "left")
            .select(key, F.coalesce("_sx", F.lit(0.0)).alias("_sx"), F.explode(class_array(rows)).alias("_c"))
            .select(key, F.col("_c.label").alias("label"),
                    (F.col("_c.log_prior") + F.col("_c.default_log_theta") * F.col("_sx")).alias("score")))
    seen = (features.join(model.terms, "term")
            .select(key, "label", (F.col(weight) * F.col("delta")).alias("score")))
    return base.unionByName(seen).groupBy(key, "label").agg(F.sum("score").alias("score"))


def _term_columns(model: NaiveBayesModel, rows: list, names: list[str]) -> DataFrame:
    """One row per term with the delta of every class in a column."""
    return model.terms.groupBy("term").agg(
        *[F.sum(F.when(F.col("label") == F.lit(r["label"]), F.col("delta"))).alias(name) for r, name in zip(rows, names)])


def _wide_scores(features: DataFrame, docs: DataFrame, model: NaiveBayesModel, rows: list, key: str, weight: str) -> DataFrame:
    deltas = [f"_d{c}" for c in range(len(rows))]
    sums = (features.select(key, "term", weight).join(_term_columns(model, rows, deltas), "term", "left").groupBy(key)
            .agg(F.sum(weight).alias("_sx"), *[F.sum(F.col(weight) * F.col(name)).alias(name) for name in deltas]))
    return _class_scores(sums, docs, rows, deltas, key)


def _class_scores(sums: DataFrame, docs: DataFrame, rows: list, deltas: list[str], key: str) -> DataFrame:
    zero = F.lit(0.0)
    of_class = [F.struct(F.lit(r["label"]).alias("label"),
                         (F.col("_n") * (F.lit(float(r["log_prior"])) + F.lit(float(r["default_log_theta"])) * F.coalesce("_sx", zero))
                          + F.coalesce(name, zero)).alias("score")) for r, name in zip(rows, deltas)]
    # a document that is asked for several times is one row, as in the sums of the long form
    asked = docs.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return asked.join(sums, key, "left").select(key, F.explode(F.array(*of_class)).alias("_c")).select(key, "_c.label", "_c.score")


def predict_from_counts(tf: DataFrame, idf: DataFrame, docs: DataFrame, model: NaiveBayesModel, key: str = "doc_id",
                        digits: int | None = None) -> DataFrame:
    """``predict_naive_bayes`` on unit-length TF-IDF rows, from their counts: the norm is summed beside the scores.

    Counts are joined once with one row per term and summed once per document.
    """
    rows = class_rows(model)
    if not 0 < len(rows) <= WIDE_CLASSES:
        return predict_naive_bayes(tfidf(tf, idf, key), docs, model, key, "w", digits)
    deltas = [f"_d{c}" for c in range(len(rows))]
    per_term = idf.select("term", "idf").join(_term_columns(model, rows, deltas), "term", "left")
    raw = F.col("tf") * F.col("idf")
    sums = (tf.join(per_term, "term").groupBy(key)
            .agg(F.sqrt(F.sum(raw * raw)).alias("_norm"), F.sum(raw).alias("_sx"), *[F.sum(raw * F.col(name)).alias(name) for name in deltas]))
    sums = sums.select(key, *[(F.col(c) / F.col("_norm")).alias(c) for c in ("_sx", *deltas)])
    return scores_to_predictions(_class_scores(sums, docs, rows, deltas, key), key, digits)


def scores_to_predictions(scores: DataFrame, key: str = "doc_id", digits: int | None = None) -> DataFrame:
    """``(key, p, proba)``: argmax (smallest label on ties) and softmax probabilities.

    ``proba`` is ``array<struct<label, prob>>`` sorted by label; each group is
    one document's k class scores, so the collect is bounded by k.
    """
    s = scores.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("label", "score"))).alias("_s"))
    mx = F.array_max(F.transform("_s", lambda e: e["score"]))
    lse = mx + F.log(F.aggregate(F.transform("_s", lambda e: F.exp(e["score"] - mx)),
                                 F.lit(0.0), lambda acc, v: acc + v))
    prob = (lambda v: F.round(v, digits)) if digits is not None else (lambda v: v)
    return s.select(
        key,
        F.filter("_s", lambda e: e["score"] == mx)[0]["label"].alias("p"),
        F.transform("_s", lambda e: F.struct(e["label"].alias("label"),
                                             prob(F.exp(e["score"] - lse)).alias("prob"))).alias("proba"))


def predict_naive_bayes(features: DataFrame, docs: DataFrame, model: NaiveBayesModel,
                        key: str = "doc_id", weight: str = "w", digits: int | None = None) -> DataFrame:
    return scores_to_predictions(naive_bayes_scores(features, docs, model, key, weight), key, digits)


def _grid_classes(lab: DataFrame, fl: DataFrame, fold: str, key: str) -> tuple[dict, list]:
    """Documents per (fold, class), up to one more than ``WIDE_CLASSES`` of them, and the classes."""
    docs_of = {(r[fold], r["label"]): r["d"] for r in lab.join(fl, key).groupBy(fold, "label").agg(F.count(F.lit(1)).alias("d"))
               .orderBy(fold, "label").limit(WIDE_CLASSES + 1).collect()}
    return docs_of, sorted({c for _, c in docs_of})


def _wide_grid(features: DataFrame, lab: DataFrame, fl: DataFrame, vocab_size: Column | int, alphas: list[float], k: int, classes: list,
               docs_of: dict, key: str, fold: str, weight: str) -> DataFrame:
    """``naive_bayes_grid`` with the sums of every (fold, class) in columns of the term's row."""
    known = features.select(key, "term", weight).join(lab, key).join(fl, key)
    held_sum = {(f, c): F.coalesce(F.sum(F.when((F.col(fold) == f) & (F.col("label") == F.lit(classes[c])), F.col(weight))), F.lit(0.0))
                for f in range(k) for c in range(len(classes))}
    sums = known.groupBy("term").agg(*[held.alias(f"_s{f}_{c}") for (f, c), held in held_sum.items()])
    held_out = features.select(key, "term", F.col(weight).alias("_w")).join(fl, key)
    return _grid_accuracy(sums, held_out, lab, fl, vocab_size, alphas, k, classes, docs_of, key, fold)


def naive_bayes_grid_from_counts(tf: DataFrame, idf: DataFrame, labels: DataFrame, folds: DataFrame, vocab_size: Column | int,
                                 alphas: list[float], k: int, key: str = "doc_id", label: str = "label", fold: str = "fold") -> DataFrame:
    """``naive_bayes_grid`` on unit-length TF-IDF rows, from their counts ``(key, term, tf)`` and ``(term, idf)``.

    The counts meet the norms, folds and labels of their documents once and are written so, by term; the table of weights is
    never made.
    """
    lab, fl = labels.select(key, F.col(label).alias("label")), folds.select(key, fold)
    docs_of, classes = _grid_classes(lab, fl, fold, key)
    if not 0 < len(classes) * max(k, len(alphas)) <= WIDE_CLASSES >= len(docs_of):
        return naive_bayes_grid(tfidf(tf, idf, key), labels, folds, vocab_size, alphas, k, key, label, fold)
    raw, of_class = F.col("tf") * F.col("idf"), [f"_m{c}" for c in range(len(classes))]
    norms = tf.join(idf.select("term", "idf"), "term").groupBy(key).agg(F.sqrt(F.sum(raw * raw)).alias("_norm"))
    # how often a document's labels name each class: once the one it has, but keys may repeat
    named = lab.groupBy(key).agg(*[F.count(F.when(F.col("label") == F.lit(c), 1)).cast("int").alias(name) for c, name in zip(classes, of_class, strict=True)])
    of_doc = materialize(fl.join(norms, key).join(named, key, "left").na.fill(0, of_class), "nb-grid-docs")
    rows = tf.join(of_doc, key).select(key, fold, "term", "tf", "_norm", *of_class)
    rows = materialize(rows.sortWithinPartitions("term", key), "nb-grid-rows")
    share = F.col("tf") / F.col("_norm")
    held_sum = {(f, c): F.coalesce(F.sum(F.when(F.col(fold) == f, share * F.col(f"_m{c}"))), F.lit(0.0)) for f in range(k) for c in range(len(classes))}
    sums = rows.groupBy("term").agg(*[held.alias(f"_s{f}_{c}") for (f, c), held in held_sum.items()]).join(idf.select("term", "idf"), "term")
    sums = sums.select("term", "idf", *[(F.col(f"_s{f}_{c}") * F.col("idf")).alias(f"_s{f}_{c}") for f, c in held_sum])
    norms = of_doc.select(key, fold, "_norm").distinct()
    return _grid_accuracy(sums, rows.select(key, fold, "term", F.col("tf").alias("_w")), lab, fl, vocab_size, alphas, k, classes, docs_of, key,
                          fold, norms)


def _grid_accuracy(counts: DataFrame, held_out: DataFrame, lab: DataFrame, fl: DataFrame, vocab_size: Column | int, alphas: list[float], k: int,
                   classes: list, docs_of: dict, key: str, fold: str, norms: DataFrame | None = None) -> DataFrame:
    """Accuracy per alpha and fold from the sums of every (fold, class) per term and the rows ``(key, fold, term, _w)``.

    With ``norms`` (key, fold, _norm) ``counts`` has an idf, and a weight is ``_w * idf / _norm``.
    """
    # a scalar subquery can't stand where arrays are searched, so its one number is asked for
    size = vocab_size if isinstance(vocab_size, int) else lab.sparkSession.range(1).select(vocab_size).first()[0]
    places, zero = [(f, c) for f in range(k) for c in range(len(classes))], F.lit(0.0)
    extra = ["idf"] if norms is not None else []
    # the training sums of a held-out fold: all folds' minus its own
    every = {c: sum((F.col(f"_s{f}_{c}") for f in range(1, k)), F.col(f"_s0_{c}")) for c in range(len(classes))}
    counts = materialize(counts.select("term", *extra, *[(every[c] - F.col(f"_s{f}_{c}")).alias(f"_n{f}_{c}") for f, c in places]), "nb-grid-counts")
    row = counts.agg(*[F.sum(F.when(F.col(f"_n{f}_{c}") > 0, F.col(f"_n{f}_{c}"))).alias(f"_n{f}_{c}") for f, c in places]).first()
    total = {(f, c): float(row[f"_n{f}_{c}"] or 0.0) for f, c in places}
    n_docs = {(f, c): sum(docs_of.get((g, classes[c]), 0) for g in range(k) if g != f) for f, c in places}

    def of_fold(values: list[Column]) -> Column:
        return F.element_at(F.array(*values), F.col(fold) + 1)

    def default(f: int, c: int, a: float) -> Column:
        return F.lit(math.log(a / (total[f, c] + a * size)) if size else 0.0)

    settings = [(i, c, float(a)) for i, a in enumerate(alphas) for c in range(len(classes))]
    joined = held_out.join(counts, "term", "left")
    joined = joined.select(key, fold, (F.col("_w") * F.col("idf") if extra else F.col("_w")).alias("_w"), *[of_fold([F.col(f"_n{f}_{c}") for f in range(k)]).alias(f"_n{c}") for c in range(len(classes))])
    delta = {(i, c): F.when(F.col(f"_n{c}") > 0, F.log((F.col(f"_n{c}") + a) / (of_fold([F.lit(total[f, c]) for f in range(k)]) + a * size))
                            - of_fold([default(f, c, a) for f in range(k)])) for i, c, a in settings}
    sums = joined.groupBy(key, fold).agg(F.sum("_w").alias("_sx"), *[F.sum(F.col("_w") * delta[i, c]).alias(f"_d{i}_{c}") for i, c, _ in settings])
    if norms is not None:
        sums = sums.join(norms, [key, fold]).select(key, fold, *[(F.col(c) / F.col("_norm")).alias(c) for c in sums.columns if c not in (key, fold)])
    all_docs = [sum(n_docs[f, c] for c in range(len(classes))) for f in range(k)]
    no_prior = F.lit(None).cast("double")       # a class without training rows in a fold is no candidate there

    def prior(f: int, c: int) -> Column:
        return F.lit(math.log(n_docs[f, c] / all_docs[f])) if n_docs[f, c] else no_prior

    def score(i: int, c: int, a: float) -> Column:
        base = of_fold([prior(f, c) for f in range(k)]) + of_fold([default(f, c, a) for f in range(k)]) * F.coalesce("_sx", zero)
        return F.col("_n") * base + F.coalesce(f"_d{i}_{c}", zero)

    def best(i: int, a: float) -> Column:
        found = F.array(*[F.struct((-score(i, c, a)).alias("ns"), F.lit(classes[c]).alias("label")) for c in range(len(classes))])
        return F.struct(F.lit(float(a)).alias("alpha"), F.array_min(F.filter(found, lambda e: e["ns"].isNotNull()))["label"].alias("label"))

    asked = fl.groupBy(key, fold).agg(F.count(F.lit(1)).alias("_n")).join(sums, [key, fold], "left")
    predicted = asked.select(key, fold, F.explode(F.array(*[best(i, a) for i, a in enumerate(alphas)])).alias("_b"))
    return (predicted.filter(F.col("_b.label").isNotNull()).join(lab, key).groupBy(F.col("_b.alpha").alias("alpha"), fold)
            .agg(F.avg((F.col("_b.label") == F.col("label")).cast("double")).alias("accuracy")))


def naive_bayes_grid(features: DataFrame, labels: DataFrame, folds: DataFrame, vocab_size: Column,
                     alphas: list[float], k: int, key: str = "doc_id", label: str = "label",
                     fold: str = "fold", weight: str = "w") -> DataFrame:
    """Cross-validated accuracy for every alpha, without refitting per alpha.

    Class-term sums are computed once per fold; the training sums for a
    held-out fold are the total minus that fold's part.  Alphas only change
    the smoothing.  With few classes all of it stands in columns: one row per
    term, joined once with the features, and one sum per document.  With many
    they are a literal array exploded onto the per-class rows.  ``folds`` holds ``(key, fold)`` with folds ``0..k-1``.
    Returns ``(alpha, fold, accuracy)``.
    """
    lab = labels.select(key, F.col(label).alias("label"))
    fl = folds.select(key, fold)
    docs_of, classes = _grid_classes(lab, fl, fold, key)
    if 0 < len(classes) * max(k, len(alphas)) <= WIDE_CLASSES >= len(docs_of):
        return _wide_grid(features, lab, fl, vocab_size, alphas, k, classes, docs_of, key, fold, weight)
    fold_ids = F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias(fold)
    alpha_arr = F.explode(F.array(*[F.lit(float(a)) for a in alphas])).alias("alpha")
    by_fold = (features.join(lab, key).join(fl, key)
               .groupBy(fold, "label", "term").agg(F.sum(weight).alias("s")))
    total = by_fold.groupBy("label", "term").agg(F.sum("s").alias("t"))
    train_ct = (total.select("label", "term", "t", fold_ids)
                .join(by_fold, [fold, "label", "term"], "left")
                .select(fold, "label", "term", (F.col("t") - F.coalesce("s", F.lit(0.0))).alias("n_ct"))
                .filter(F.col("n_ct") > 0))
    docs_per = lab.join(fl, key).groupBy(fold, "label").agg(F.count(F.lit(1)).alias("d"))
    n_train = (docs_per.groupBy("label").agg(F.sum("d").alias("dt"))
               .select("label", "dt", fold_ids)
               .join(docs_per, [fold, "label"], "left")
               .select(fold, "label", (F.col("dt") - F.coalesce("d", F.lit(0))).alias("n_docs")))
    tot_c = train_ct.groupBy(fold, "label").agg(F.sum("n_ct").alias("total"))
    n_all = n_train.groupBy(fold).agg(F.sum("n_docs").alias("n"))
    cls = (n_train.filter(F.col("n_docs") > 0).join(tot_c, [fold, "label"], "left").join(n_all, fold)
           .select("*", alpha_arr)
           .withColumn("total", F.coalesce("total", F.lit(0.0)))
           .withColumn("log_prior", F.log(F.col("n_docs") / F.col("n")))
           .withColumn("default", F.log(F.col("alpha") / (F.col("total") + F.col("alpha") * vocab_size))))
    # one row per (fold, class, alpha): folds x classes x alphas, all small
    delta = (train_ct.join(F.broadcast(cls.select(fold, "label", "alpha", "total", "default")), [fold, "label"])
             .select(fold, "label", "alpha", "term",
                     (F.log((F.col("n_ct") + F.col("alpha")) / (F.col("total") + F.col("alpha") * vocab_size))
                      - F.col("default")).alias("delta")))
    held = features.join(fl, key)
    sums = held.groupBy(key, fold).agg(F.sum(weight).alias("_sx"))
    base = (fl.join(sums, [key, fold], "left").join(F.broadcast(cls), fold)
            .select(key, fold, "alpha", "label",
                    (F.col("log_prior") + F.col("default") * F.coalesce("_sx", F.lit(0.0))).alias("score")))
    seen = (held.join(delta, [fold, "term"])
            .select(key, fold, "alpha", "label", (F.col(weight) * F.col("delta")).alias("score")))
    scores = base.unionByName(seen).groupBy(key, fold, "alpha", "label").agg(F.sum("score").alias("score"))
    best = scores.groupBy(key, fold, "alpha").agg(
        F.min(F.struct((-F.col("score")).alias("ns"), "label")).alias("_b"))
    return (best.join(lab, key)
            .groupBy("alpha", fold)
            .agg(F.avg((F.col("_b.label") == F.col("label")).cast("double")).alias("accuracy")))
