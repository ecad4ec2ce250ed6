"""Splits, folds, class weights and minority oversampling (G1-G4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textlane.functions.expr import unit_hash


def split_by_hash(df: DataFrame, key: str, test_size: float = 0.3, seed: int = 42,
                  out: str = "split") -> DataFrame:
    """Narrow train/test split: a row is ``test`` when hash(key, seed) < test_size.

    No shuffle, no driver work, and a row keeps its side under any
    repartitioning or re-run.  The test share is ``test_size`` in expectation.
    """
    return df.withColumn(out, F.when(unit_hash(F.col(key), seed=seed) < F.lit(test_size), F.lit("test"))
                         .otherwise(F.lit("train")))


def split_exact(df: DataFrame, key: str, test_size: float = 0.3, seed: int = 42,
                out: str = "split", bits: int = 16) -> DataFrame:
    """Train/test split with exactly ``ceil(test_size * n)`` test rows.

    Test rows are the ones with the smallest ``(hash, key)``.  Instead of a
    global sort: count rows per hash bucket (2^bits buckets, a small table),
    find the bucket where the cut falls, and order only that bucket's rows
    (about n / 2^bits of them) to place the cut exactly.
    """
    h = F.conv(F.substring(F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed)))), 1, 8), 16, 10).cast("bigint")
    d = df.withColumn("_h", h).withColumn("_bucket", F.shiftright("_h", 32 - bits))
    counts = d.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    cum = counts.select("_bucket", "_n", F.sum("_n").over(
        Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)).alias("_cum"))
    n_total = d.select(F.count(F.lit(1))).scalar()
    n_test = F.ceil(F.lit(float(test_size)) * n_total)
    # one row: the bucket holding the cut and how many of its rows go to test
    cut = (cum.filter(F.col("_cum") >= n_test).orderBy("_bucket").limit(1)
           .select("_bucket", (n_test - (F.col("_cum") - F.col("_n"))).alias("_need")).first())
    if cut is None or cut["_need"] <= 0:
        return d.withColumn(out, F.lit("train")).drop("_h", "_bucket")
    b, need = int(cut["_bucket"]), int(cut["_need"])
    edge = (d.filter(F.col("_bucket") == b).select(F.struct("_h", F.col(key)).alias("_k"))
            .orderBy("_k").limit(need).agg(F.max("_k")).scalar())
    is_test = (F.col("_bucket") < b) | ((F.col("_bucket") == b) & (F.struct("_h", F.col(key)) <= edge))
    return d.withColumn(out, F.when(is_test, F.lit("test")).otherwise(F.lit("train"))).drop("_h", "_bucket")


def grouped_rank(df: DataFrame, group: list[str], order: list[str], salt: str, out: str = "rank") -> DataFrame:
    """0-based rank inside ``group`` by ``order`` that survives one hot group.

    ``salt`` must be monotone in ``order`` (a coarse prefix of it).  Rows are
    numbered inside each ``(group, salt)`` piece; piece sizes (a small table)
    become offsets by a prefix sum over the pieces of a group.  A group that
    holds a third of all rows is spread over its pieces instead of one task.
    """
    pieces = df.groupBy(*group, salt).agg(F.count(F.lit(1)).alias("_n"))
    offsets = pieces.select(*group, salt, F.coalesce(F.sum("_n").over(
        Window.partitionBy(*group).orderBy(salt).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    w = Window.partitionBy(*group, salt).orderBy(*order)
    return (df.join(offsets, [*group, salt])
            .withColumn(out, F.col("_off") + F.row_number().over(w) - F.lit(1))
            .drop("_off"))


def stratified_folds(df: DataFrame, key: str, label: str, k: int = 5, seed: int = 37,
                     out: str = "fold", salt_buckets: int = 256) -> DataFrame:
    """Shuffled stratified k-fold: inside each class, rows in hash order get folds 0..k-1 in turn.

    Per class the fold sizes differ by at most one.  The salt is the top of
    the same hash, so salted numbering equals the plain per-class numbering.
    """
    u = unit_hash(F.col(key), seed=seed)
    d = (df.withColumn("_u", u)
         .withColumn("_salt", F.floor(F.col("_u") * F.lit(salt_buckets)).cast("int")))
    r = grouped_rank(d, [label], ["_u", key], "_salt", "_pos")
    return r.withColumn(out, (F.col("_pos") % F.lit(k)).cast("int")).drop("_u", "_salt", "_pos")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights ``n / (k * n_c)`` per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    n = df.select(F.count(F.lit(1))).scalar()
    k = counts.select(F.count(F.lit(1))).scalar()
    return counts.withColumn("weight", n / (k * F.col("n_c")))


def with_class_weight(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    w = class_weights(df, label).select(label, F.col("weight").alias(out))
    return df.join(F.broadcast(w), label)   # one row per class
