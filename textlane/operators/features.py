"""Term counts, vocabulary, TF-IDF, label maps (F1-F4, F9-F12)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def term_counts(long_df: DataFrame, key: str = "doc_id", term: str = "term",
                keep: tuple[str, ...] = ()) -> DataFrame:
    """``(key, *keep, term, tf)``: occurrences of each term in each document.

    All tokens of a document come from one input row, so the map-side partial
    aggregate already reduces to distinct (document, term) pairs before the
    shuffle.
    """
    return long_df.groupBy(key, *keep, term).agg(F.count(F.lit(1)).alias("tf"))


def vocabulary(tf_df: DataFrame, term: str = "term") -> DataFrame:
    """``(term, doc_freq, term_freq)`` over a term-count table."""
    return tf_df.groupBy(term).agg(F.count(F.lit(1)).alias("doc_freq"),
                                   F.sum("tf").alias("term_freq"))


def doc_count(docs: DataFrame) -> Column:
    """Number of documents as a scalar subquery (no driver round trip)."""
    return docs.select(F.count(F.lit(1))).scalar()


def bounded_vocabulary(vocab: DataFrame, n_docs: Column, min_df: int | float = 1,
                       max_df: int | float = 1.0) -> DataFrame:
    """Keep terms whose document frequency is inside the bounds.

    Integers are document counts, floats are shares of ``n_docs``
    (the vectorizer's ``min_df=2, max_df=0.95`` convention).
    """
    lo = F.lit(min_df) if isinstance(min_df, int) else F.ceil(F.lit(float(min_df)) * n_docs)
    hi = F.lit(max_df) if isinstance(max_df, int) else F.lit(float(max_df)) * n_docs
    return vocab.filter((F.col("doc_freq") >= lo) & (F.col("doc_freq") <= hi))


def with_idf(vocab: DataFrame, n_docs: Column) -> DataFrame:
    """Smooth idf: ``ln((1 + n) / (1 + df)) + 1``."""
    return vocab.withColumn("idf", F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("doc_freq"))) + F.lit(1.0))


def tfidf(tf_df: DataFrame, vocab_idf: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, term, tf, w)`` with ``w = tf * idf`` L2-normalised per document.

    The vocabulary side is joined on ``term``; its size is only known at run
    time, so the join strategy is left to AQE (broadcast when the aggregated
    vocabulary turns out small, sort-merge with skew splitting otherwise).
    """
    raw = (tf_df.join(vocab_idf.select("term", "idf"), "term")
           .withColumn("_w", F.col("tf") * F.col("idf")))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(key)))
    return raw.select(key, "term", "tf", (F.col("_w") / norm).alias("w"))


def vocab_size(vocab: DataFrame) -> DataFrame:
    return vocab.agg(F.count(F.lit(1)).alias("vocab_size"))


def label_map_from_pairs(df: DataFrame, idx: str, label: str) -> DataFrame:
    """``(idx string, label string)`` dimension; ``idx`` keys are strings as in a JSON map."""
    return df.select(F.col(idx).cast("string").alias("idx"), F.col(label).cast("string").alias("label"))


def invert_label_map(label_map: DataFrame) -> DataFrame:
    """label -> idx; when a label repeats, the largest key wins: numbers by value, before them other strings by order."""
    number = F.expr("try_cast(idx AS DECIMAL(38,0))")
    return label_map.groupBy("label").agg(F.max_by("idx", F.struct(number, "idx")).alias("idx"))


def decode_labels(df: DataFrame, col: str, label_map: DataFrame, out: str = "label") -> DataFrame:
    """idx -> label by a left join (unknown index gives null).

    Label maps hold one row per class, so the broadcast is bounded.
    """
    m = label_map.select(F.col("idx").alias("_idx"), F.col("label").alias(out))
    return (df.join(F.broadcast(m), F.col(col).cast("string") == F.col("_idx"), "left")
            .drop("_idx"))


def encode_labels(df: DataFrame, col: str, label_map: DataFrame, out: str = "label_idx") -> DataFrame:
    """label -> idx by a left join on the inverted map."""
    inv = invert_label_map(label_map).select(F.col("label").alias("_label"), F.col("idx").alias(out))
    return df.join(F.broadcast(inv), F.col(col) == F.col("_label"), "left").drop("_label")


def ordinal_label_map(df: DataFrame, col: str) -> DataFrame:
    """Classes of ``col`` numbered 0.. in sorted order (a label encoder)."""
    classes = df.select(F.col(col).cast("string").alias("label")).distinct()
    return classes.select(
        (F.row_number().over(Window.orderBy("label")) - 1).cast("string").alias("idx"), "label")


def string_argmax(*cols: str) -> Column:
    """Row-wise argmax over string columns (byte order, first wins on ties)."""
    branches = None
    for i, c in enumerate(cols):
        cond = F.lit(True)
        for other in cols[i + 1:]:
            cond = cond & (F.col(c) >= F.col(other))
        branches = F.when(cond, F.lit(i)) if branches is None else branches.when(cond, F.lit(i))
    return branches.otherwise(F.lit(len(cols) - 1))
