"""Sharding: global byte-size prefix sums from per-partition totals, cut at equal targets.

Rows are ordered by (md5 of the text, md5 of the id), so that equal texts are
neighbours.  Only ids, sizes and hashes are shuffled, never texts.  The prefix
sums are two-level: totals per bucket of the order (the first hex digits of
the hash) give each bucket's offset, and running sums inside the buckets are
added.  A group of equal texts is one row of the group table; inside a large
group ranks are again two-level, over pieces of the id's hash, so that no task
holds a hot group.

A group that is no larger than the largest single document, or than one
hundredth of a shard, goes whole into the shard of its middle byte; larger
groups are cut where the target falls.  Shards so differ from the equal
target by about such a size at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textlane.llm.common import order_hash, spread, text_of

SHARDS = 16
#: Hex digits of a hash that name a bucket: 4,096 of them.
BUCKET_DIGITS = 3
#: Groups of more than one such part of all rows (so fewer groups than this) are joined and ranked in pieces.
HOT_PARTS = 10_000
#: Hex digits of the id's hash that name a piece of a hot group.
PIECE_DIGITS = 2


def offsets(totals: DataFrame, groups: list[str], piece: str, sums: list[str]) -> DataFrame:
    """Exclusive running sums of the totals, over the pieces of each group (one window row per piece)."""
    w = W.partitionBy(*groups).orderBy(piece).rowsBetween(W.unboundedPreceding, -1)
    return totals.select(*groups, piece, *[F.coalesce(F.sum(s).over(w), F.lit(0)).alias(f"{s}_before") for s in sums])


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard (0..shards-1) and slot (position in the shard) of every row.

    docs: doc_id, text; other columns are not read.  The size is the text's
    UTF-8 bytes plus 1, a null text counts as empty (size 1, checksum 0).  A
    null doc_id is a value like any other.  Repeated rows each get a slot of
    their own.  An empty table gives an empty one; with fewer rows than shards
    some shards stay empty.
    """
    rows = spread(docs.select(
        "doc_id", (F.octet_length(text_of()) + 1).cast("bigint").alias("size"), F.crc32(text_of()).alias("text_crc32"),
        F.md5(text_of()).alias("h"), order_hash(F.col("doc_id")).alias("d")), "shard-rows")

    groups = rows.groupBy("h").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"), F.max("size").alias("one"))
    groups = spread(groups.withColumn("bucket", F.substring("h", 1, BUCKET_DIGITS)), "shard-groups")
    totals = groups.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.max("one").alias("one"))
    totals = totals.withColumns({"total": F.sum("bytes").over(W.partitionBy(F.lit(0))),
                                 "largest": F.max("one").over(W.partitionBy(F.lit(0)))})
    before = offsets(totals, ["total", "largest"], "bucket", ["n", "bytes"])
    w = W.partitionBy("bucket").orderBy("h").rowsBetween(W.unboundedPreceding, -1)
    placed = (groups.withColumns({f"{c}_in": F.coalesce(F.sum(c).over(w), F.lit(0)) for c in ("n", "bytes")})
              .join(F.broadcast(before), "bucket")   # a row per bucket: 16^BUCKET_DIGITS at most
              .select("h", F.col("bytes").alias("group_bytes"), "total",
                      (F.col("n_before") + F.col("n_in")).alias("first_row"),
                      (F.col("bytes_before") + F.col("bytes_in")).alias("first_byte"),
                      (F.col("bytes") <= F.greatest("largest", F.expr(f"total div ({shards} * 100)"))).alias("as_one")))

    # A hot group is cut into pieces by the id's hash; any other group is one piece, named "".
    hot = groups.filter(F.col("n") * HOT_PARTS > groups.select(F.sum("n")).scalar()).select("h", F.lit(True).alias("hot"))
    rows = (rows.join(F.broadcast(hot), "h", "left")   # fewer than HOT_PARTS rows
            .withColumn("piece", F.when(F.col("hot"), F.substring("d", 1, PIECE_DIGITS)).otherwise(F.lit(""))).drop("hot"))
    pieces = rows.filter(F.col("piece") != "").groupBy("h", "piece").agg(F.count("*").alias("n"))
    placed = (placed.join(offsets(pieces, ["h"], "piece", ["n"]), "h", "left")
              .fillna({"piece": "", "n_before": 0}))
    rank = F.row_number().over(W.partitionBy("h", "piece").orderBy("d", "doc_id")) - 1 + F.col("n_before")
    rows = rows.join(placed, ["h", "piece"]).withColumn("rank", rank)
    twice_mid = F.when(F.col("as_one"), 2 * F.col("first_byte") + F.col("group_bytes")).otherwise(
        2 * (F.col("first_byte") + F.col("rank") * F.col("size")) + F.col("size"))
    rows = spread(rows.select(
        "doc_id", "size", "text_crc32", (F.col("first_row") + F.col("rank")).alias("at"),
        twice_mid.alias("m"), "total")
        .withColumn("shard", F.least(F.expr(f"(m * {shards}) div (2 * total)"), F.lit(shards - 1)).cast("int"))
        .drop("m", "total"), "shard-cuts")
    first = rows.groupBy("shard").agg(F.min("at").alias("first_at"))
    return (rows.join(F.broadcast(first), "shard")   # a row per shard
            .select("doc_id", "size", "text_crc32", "shard", (F.col("at") - F.col("first_at")).alias("slot")))
