"""Line dedup: lines found in many documents lose all their occurrences.

Lines are exploded with their normalised key's hash, distinct documents are
counted per hash, the hashes over the threshold are joined back to the lines,
and each text is put together again from the positions that stay.

Only hashes and positions are shuffled for counting; the texts meet the list
of their dropped positions in one join, which Spark broadcasts when that list
is small and otherwise splits where a text has many copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlane.llm.common import line_hash, lines_of, normal_line, spread, text_of

MIN_DOCS = 10


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, pos, keys = [], [], []
        for row, raw in enumerate(batch.column("text").to_pylist()):
            for k, line in enumerate(raw.split(b"\n")):
                key = normal_line(line)
                if key:   # one code point at least
                    rows.append(row)
                    pos.append(k)
                    keys.append(line_hash(key))
        own = batch.select(["doc", "text_key"]).take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays([*own.columns, pa.array(pos, pa.int32()), pa.array(keys, pa.int64())],
                                         names=["doc", "text_key", "pos", "key_hash"])


def line_table(docs: DataFrame) -> DataFrame:
    """One row per line that has a key: doc (hash of doc_id and text), text_key, pos, key_hash."""
    rows = docs.filter(F.col("text").isNotNull()).select(
        F.xxhash64("doc_id", "text").alias("doc"), F.md5("text").alias("text_key"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(_lines, "doc long, text_key string, pos int, key_hash long")


def frequent_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Hashes of the keys found in at least ``min_docs`` documents (distinct rows by doc_id and text)."""
    return (line_table(docs).select("doc", "key_hash").groupBy("key_hash").agg(F.count_distinct("doc").alias("n_docs"))
            .filter(F.col("n_docs") >= min_docs))


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with n_lines, n_dropped and kept (the text of the lines that stay).

    docs: doc_id, text; other columns are carried along except n_lines,
    n_dropped and kept, which this operator sets.  A null text counts as empty
    and has one empty line.  Keys shorter than one code point (blank lines)
    are never dropped.  A repeated row (equal doc_id and text) counts as one
    document and gives one row each time.  An empty table gives an empty one.
    """
    bad = spread(frequent_lines(docs, min_docs), "frequent-lines")
    drops = spread(
        line_table(docs).join(bad.select("key_hash"), "key_hash", "left_semi")
        .groupBy("text_key").agg(F.collect_set("pos").alias("drop_pos")), "dropped-positions")
    carried = [c for c in docs.columns if c not in ("n_lines", "n_dropped", "kept")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row"), text_of().alias("body"),
                       F.md5(text_of()).alias("text_key"))
    rows = rows.join(drops, "text_key", "left").withColumn("lines", lines_of(F.col("body")))
    n_lines = F.size("lines")
    # Positions that stay, by a hash set; then each is looked up in the array of lines.
    stay = F.array_except(F.sequence(F.lit(0), n_lines - 1), F.col("drop_pos"))
    kept = F.when(F.col("drop_pos").isNull(), F.col("body")).otherwise(
        F.array_join(F.transform(stay, lambda p: F.get(F.col("lines"), p)), "\n"))
    return rows.select("row.*", n_lines.cast("bigint").alias("n_lines"),
                       F.coalesce(F.size("drop_pos"), F.lit(0)).cast("bigint").alias("n_dropped"), kept.alias("kept"))
