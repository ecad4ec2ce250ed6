"""Classification metrics from prediction tables (E1-E7).

Every metric starts from the confusion counts ``groupBy(*by, y, p)``: one
partial aggregate over the predictions, after which all work is on a table
of (groups x classes^2) rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def confusion_counts(pred: DataFrame, y: str = "y", p: str = "p", by: tuple[str, ...] = (), n: str | None = None) -> DataFrame:
    """Counts per (y, p); ``n`` names a count that each row of ``pred`` stands for (1 without it)."""
    count = F.count(F.lit(1)) if n is None else F.sum(n)
    return pred.groupBy(*by, F.col(y).alias("y"), F.col(p).alias("p")).agg(count.alias("n"))


def per_class(pred: DataFrame, y: str = "y", p: str = "p", by: tuple[str, ...] = (), n: str | None = None) -> DataFrame:
    """``(*by, label, tp, support, n_pred, precision, recall, f1)``.

    Classes that are only true or only predicted stay (full outer join);
    undefined ratios are 0.
    """
    cc = confusion_counts(pred, y, p, by, n)
    # each confusion cell feeds its true class (support, tp) and its predicted
    # class (n_pred): one explode and one aggregate, classes never seen on one
    # side keep zeros on that side
    both = F.explode(F.array(
        F.struct(F.col("y").alias("label"), F.col("n").alias("support"), F.lit(0).cast("long").alias("n_pred"),
                 F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(F.lit(0)).cast("long").alias("tp")),
        F.struct(F.col("p").alias("label"), F.lit(0).cast("long").alias("support"), F.col("n").alias("n_pred"),
                 F.lit(0).cast("long").alias("tp")))).alias("_e")
    t = (cc.select(*by, both).groupBy(*by, F.col("_e.label").alias("label"))
         .agg(F.sum("_e.tp").alias("tp"), F.sum("_e.support").alias("support"), F.sum("_e.n_pred").alias("n_pred")))
    prec = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    t = t.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                F.lit(2.0) * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
                ).otherwise(F.lit(0.0))
    return t.withColumn("f1", f1)


def accuracy(pred: DataFrame, y: str = "y", p: str = "p", by: tuple[str, ...] = ()) -> DataFrame:
    return pred.groupBy(*by).agg(F.avg((F.col(y) == F.col(p)).cast("double")).alias("accuracy"))


def weighted_prf(pred: DataFrame, y: str = "y", p: str = "p", by: tuple[str, ...] = ()) -> DataFrame:
    """Support-weighted precision, recall, F1 and the row count."""
    pc = per_class(pred, y, p, by)
    s = F.sum("support")
    return pc.groupBy(*by).agg(
        (F.sum(F.col("precision") * F.col("support")) / s).alias("precision"),
        (F.sum(F.col("recall") * F.col("support")) / s).alias("recall"),
        (F.sum(F.col("f1") * F.col("support")) / s).alias("f1"),
        s.alias("n"))


def f1_micro_macro(pred: DataFrame, y: str = "y", p: str = "p", by: tuple[str, ...] = (), n: str | None = None) -> DataFrame:
    """Micro F1 (= accuracy for single-label data) and macro F1 over true and predicted classes."""
    pc = per_class(pred, y, p, by, n)
    return pc.groupBy(*by).agg(
        (F.sum("tp") / F.sum("support")).alias("f1_micro"),
        F.avg("f1").alias("f1_macro"))


def auc_ovr(proba: DataFrame, y: str = "y", label: str = "label", score: str = "prob",
            by: tuple[str, ...] = (), buckets: int = 64) -> DataFrame:
    """One-vs-rest ROC-AUC per class and weighted by class support.

    ``proba`` is long: one row per (row, candidate class) with the true class
    ``y`` and the class score.  Ties get half credit (the rank definition).

    Rows are first aggregated by distinct score (positives/negatives per
    score), so repeated scores cost nothing.  The running count of negatives
    below each score is split in two levels so no single task has to walk a
    whole class: approximate-quantile buckets of the score, a prefix sum over
    the (few) bucket totals, and a running sum inside each bucket.  The
    result is exact whatever the bucket bounds are.
    Returns ``(*by, auc)`` and is built on ``auc_per_class``.
    """
    pc = auc_per_class(proba, y, label, score, by, buckets)
    return pc.groupBy(*by).agg((F.sum(F.col("auc") * F.col("pos")) / F.sum("pos")).alias("auc"))


def auc_per_class(proba: DataFrame, y: str = "y", label: str = "label", score: str = "prob",
                  by: tuple[str, ...] = (), buckets: int = 64) -> DataFrame:
    g = [*by, label]
    dist = (proba.groupBy(*g, F.col(score).alias("s"))
            .agg(F.sum((F.col(y) == F.col(label)).cast("long")).alias("pos"),
                 F.sum((F.col(y) != F.col(label)).cast("long")).alias("neg")))
    qs = [i / buckets for i in range(1, buckets)]
    bounds = dist.groupBy(*g).agg(F.percentile_approx("s", qs, 10000).alias("_b"))
    dist = (dist.join(bounds, g)
            .withColumn("bucket", F.size(F.filter("_b", lambda b: b < F.col("s"))))
            .drop("_b"))
    btot = dist.groupBy(*g, "bucket").agg(F.sum("neg").alias("bneg"))
    btot = btot.withColumn("neg_before", F.coalesce(F.sum("bneg").over(
        Window.partitionBy(*g).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inner = Window.partitionBy(*g, "bucket").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    dist = (dist.join(btot.select(*g, "bucket", "neg_before"), [*g, "bucket"])
            .withColumn("below", F.col("neg_before") + F.coalesce(F.sum("neg").over(inner), F.lit(0))))
    per = dist.groupBy(*g).agg(
        F.sum(F.col("pos") * (F.col("below") + F.col("neg") / F.lit(2.0))).alias("_num"),
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    return per.select(*g, "pos", "neg",
                      F.when((F.col("pos") > 0) & (F.col("neg") > 0),
                             F.col("_num") / (F.col("pos") * F.col("neg"))).alias("auc"))


def confusion_matrix(pred: DataFrame, labels: list[str] | None = None, y: str = "y", p: str = "p",
                     by: tuple[str, ...] = ()) -> DataFrame:
    """Rows = true label, one column per label, zeros filled.

    Without a list the columns are all labels that occur, true or predicted
    (one row per class reaches the driver, as for any pivot).
    """
    if labels is None:
        seen = pred.select(F.explode(F.array(F.col(y), F.col(p))).alias("label")).filter("label IS NOT NULL").distinct()
        labels = sorted(r["label"] for r in seen.collect())
    return (pred.groupBy(*by, F.col(y).alias("y")).pivot(p, labels).count()
            .na.fill(0, subset=labels))


def classification_report(pred: DataFrame, y: str = "y", p: str = "p", by: tuple[str, ...] = ()) -> DataFrame:
    """Per-class rows plus ``accuracy``, ``macro avg`` and ``weighted avg`` rows."""
    pc = per_class(pred, y, p, by)
    rows = pc.select(*by, F.col("label").cast("string").alias("row"), "precision", "recall", "f1",
                     F.col("support").cast("long").alias("support"))
    tot = F.sum("support")
    macro = pc.groupBy(*by).agg(F.lit("macro avg").alias("row"), F.avg("precision").alias("precision"),
                                F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                                tot.cast("long").alias("support"))
    weighted = pc.groupBy(*by).agg(F.lit("weighted avg").alias("row"),
                                   (F.sum(F.col("precision") * F.col("support")) / tot).alias("precision"),
                                   (F.sum(F.col("recall") * F.col("support")) / tot).alias("recall"),
                                   (F.sum(F.col("f1") * F.col("support")) / tot).alias("f1"),
                                   tot.cast("long").alias("support"))
    acc = pc.groupBy(*by).agg(F.lit("accuracy").alias("row"),
                              F.lit(None).cast("double").alias("precision"),
                              F.lit(None).cast("double").alias("recall"),
                              (F.sum("tp") / tot).alias("f1"), tot.cast("long").alias("support"))
    return rows.unionByName(acc).unionByName(macro).unionByName(weighted)


def train_test_table(pred: DataFrame, proba: DataFrame | None = None, y: str = "y", p: str = "p",
                     split: str = "split") -> DataFrame:
    """Long ``(metric, split, value)`` table of AUC, accuracy, P, R, F1 for all splits in one pass."""
    w = weighted_prf(pred, y, p, (split,))
    a = accuracy(pred, y, p, (split,))
    parts = a.join(w, split)
    if proba is not None:
        parts = parts.join(auc_ovr(proba, by=(split,)), split, "left")
    metrics = [c for c in ("auc", "accuracy", "precision", "recall", "f1") if c in parts.columns]
    return parts.select(split, F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                                                 for m in metrics])).alias("_m")) \
        .select(F.col("_m.metric").alias("metric"), split, F.col("_m.value").alias("value"))
