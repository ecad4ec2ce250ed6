"""Projection, filtering and cleaning operators (tickets table)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlane.functions.expr import empty_to_null, hash_key, plus_concat


def select_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns)


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def build_tickets(df: DataFrame, text: str, category: str, sub_category: str,
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw records -> ticket table.

    Keeps the complaint text and ``category + " + " + sub_category`` (null if
    either side is null), turns an empty complaint into null and drops rows
    where the complaint or the classification is null.
    """
    out = (
        df.select(*keep,
                  F.col(text).alias("complaint_what_happened"),
                  F.col(category).alias("category"),
                  F.col(sub_category).alias("sub_product"))
        .withColumn("ticket_classification",
                    plus_concat(F.col("category"), F.col("sub_product")))
        .drop("category", "sub_product")
        .withColumn("complaint_what_happened", empty_to_null(F.col("complaint_what_happened")))
    )
    return out.na.drop(subset=["complaint_what_happened", "ticket_classification"])


def dense_index(df: DataFrame, order_col: str, index_col: str = "row_index",
                partitions: int | None = None) -> DataFrame:
    """Dense 0-based row numbers in ``order_col`` order, without a global window.

    Two passes: range-partition and sort by the key, write the result to the
    shared scratch folder (so both passes see the same partitions even after
    an executor loss), count rows per partition, turn the counts into offsets
    (one row per partition: tiny, broadcast) and number rows inside each
    partition.  ``order_col`` must be unique.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, F.col(order_col))
              .sortWithinPartitions(order_col)
              .withColumn("_part", F.spark_partition_id()))
    ranged = ranged.checkpoint(eager=True)
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_part",
        (F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_offset"))
    within = Window.partitionBy("_part").orderBy(order_col)
    return (ranged.join(F.broadcast(offsets), "_part")
            .withColumn(index_col, F.coalesce(F.col("_offset"), F.lit(0))
                        + F.row_number().over(within) - F.lit(1))
            .drop("_part", "_offset"))


def shape(df: DataFrame) -> DataFrame:
    """One row ``(n_rows, n_cols)``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), col)


def sample_n(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows in a seeded pseudo-random order (top-k by a hash, no shuffle of all rows)."""
    return df.orderBy(hash_key(F.col(key), seed=seed), key).limit(n)


def head(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    return df.orderBy(key).limit(n)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def strip_masks(text: Column, pattern: str = r"x+/", literal: str = "xxxx") -> Column:
    """Remove redaction marks: regex ``pattern`` first, then every ``literal``."""
    return F.replace(F.regexp_replace(text, pattern, ""), F.lit(literal), F.lit(""))
