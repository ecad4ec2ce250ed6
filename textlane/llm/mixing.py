"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

1. Targets: sources share all words by weight; a target stops at ``max_repeat``
   times its source's size and the excess is reshared (water filling, solved in
   closed form over the source table).
2. Quotas: the total is a number of equal blocks of ``block_tokens`` words.  Blocks
   go to sources by the highest quotients target / (2k + 1), then each source's
   blocks go to its parts (``PARTS`` seeded hash parts, the shards of the mix) by
   the same rule over the parts' sizes.  Only the quotients near the cut are
   listed (about three per claimant), whatever the number of blocks.
3. Selection: inside (source, part) documents stand in seeded order, repeated as
   often as the quota needs; the first quota blocks of that sequence are taken.
   Positions come from two-level prefix sums, so a hot source is spread over
   PARTS x 4096 pieces.

Everything is DataFrame expressions; texts are read once and never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textlane.llm.common import WORD, order_hash, spread, text_of
from textlane.llm.sharding import offsets

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
BLOCK_TOKENS = 16
SEED = "mix-1"
#: Hex digits of the seeded hash: the first is the part, the next three the piece.
PARTS = 16


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """source, source_size -> also rank (by code point, null last) and target (words)."""
    by_name = W.orderBy(F.col("source").isNull(), "source")   # over one row per source
    cycle = F.array(*[F.lit(int(x)) for x in weights])
    t = sizes.withColumn("rank", F.row_number().over(by_name))
    t = t.withColumn("weight", F.element_at(cycle, ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
    t = t.withColumn("limit", F.lit(max_repeat).cast("bigint") * F.col("source_size"))
    up = W.orderBy(F.col("limit") / F.col("weight"), "rank").rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy(F.lit(0))
    # The level if all sources that fill earlier are at their limits; the largest of these is the common one.
    level = ((F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(up), F.lit(0)))
             / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(up), F.lit(0))))
    t = t.withColumn("level", level)
    t = t.withColumn("level", F.max("level").over(every))
    return t.select("source", "source_size", "rank",
                    F.least(F.col("limit").cast("double"), F.col("weight") * F.col("level")).alias("target"))


def sainte_lague(claims: DataFrame, group: list[str], claim: str, seats: str, tie: list[str]) -> DataFrame:
    """Adds ``won``: how many of the group's ``seats`` each claimant gets by the highest quotients claim / (2k + 1).

    A claimant's seats lie between round(claim * x) at the two scales x that
    give all claimants together surely too few and surely too many; one
    quotient for each seat between is listed and the best are taken.
    """
    g = W.partitionBy(*group) if group else W.partitionBy(F.lit(0))
    c = claims.withColumns({"_all": F.sum(claim).over(g), "_n": F.count("*").over(g)})

    def at(scale: Column) -> Column:
        return F.floor(F.col(claim) * scale / F.col("_all") + 0.5)

    live = F.col("_all") > 0
    c = c.withColumns({
        "_lo": F.when(live, F.greatest(F.lit(0), at(F.greatest(F.lit(0.0), F.col(seats) - F.col("_n") / 2)) - 1))
                .otherwise(0).cast("bigint"),
        "_hi": F.when(live, at(F.col(seats) + F.col("_n") / 2) + 1).otherwise(0).cast("bigint")})
    c = c.withColumn("_open", F.col(seats) - F.sum("_lo").over(g))
    keys = [*group, *tie]
    q = (c.filter(F.col(claim) > 0).select(*keys, claim, "_lo", "_open", F.explode(F.expr("sequence(_lo, _hi)")).alias("_k"))
         .withColumn("_q", F.col(claim) / (2 * F.col("_k") + 1)))
    order = (W.partitionBy(*group) if group else W.partitionBy(F.lit(0))).orderBy(F.desc("_q"), *tie, "_k")
    won = (q.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= F.col("_open"))
           .groupBy(*keys).agg(F.count("*").alias("_more")))
    return (c.join(won, keys, "left").withColumn("won", F.col("_lo") + F.coalesce("_more", F.lit(0)))
            .drop("_all", "_n", "_lo", "_hi", "_open", "_more"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT,
        block_tokens: int = BLOCK_TOKENS, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, taken and text_key (md5 of the text) of every row.

    docs: doc_id, text, source; other columns are not read.  A null text has
    size 0 and is taken 0 times.  The null source is a source of its own, after
    all others.  Repeated rows are rows like any other.  If all sizes are 0
    every target and take is 0; an empty table gives an empty one.
    """
    rows = spread(docs.select(
        "doc_id", "source", F.regexp_count(text_of(), F.lit(WORD)).cast("bigint").alias("size"),
        F.md5(text_of()).alias("text_key"))
        .withColumn("h", order_hash(F.col("doc_id"), F.col("text_key"), seed=seed))
        .withColumns({"part": F.substring("h", 1, 1), "piece": F.substring("h", 2, 3)}), "mix-rows")

    pieces = spread(rows.groupBy("source", "part", "piece").agg(F.sum("size").alias("words")), "mix-pieces")
    parts = pieces.groupBy("source", "part").agg(F.sum("words").alias("part_size"))
    sizes = pieces.groupBy("source").agg(F.sum("words").alias("source_size"))
    quota = targets(sizes, weights, max_repeat)
    blocks = F.round(F.sum("source_size").over(W.partitionBy(F.lit(0))) / block_tokens).cast("bigint")
    quota = sainte_lague(quota.withColumn("blocks", blocks), [], "target", "blocks", ["rank"])
    quota = spread(quota.select("source", "rank", "source_size", "target", F.col("won").alias("source_blocks")), "mix-quota")

    same = parts["source"].eqNullSafe(quota["source"])
    split = sainte_lague(parts.join(quota, same).select("rank", "part", "part_size", "source_blocks"),
                         ["rank"], "part_size", "source_blocks", ["part"])
    split = split.select("rank", "part", "part_size",
                         F.least(F.col("won") * block_tokens, max_repeat * F.col("part_size")).alias("part_quota"))
    split = spread(split, "mix-parts")
    before = offsets(pieces, ["source", "part"], "piece", ["words"])

    w = W.partitionBy("source", "part", "piece").orderBy("h", "doc_id").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("ahead", F.coalesce(F.sum("size").over(w), F.lit(0)))
    r, b, q = rows.alias("r"), before.alias("b"), quota.alias("q")
    placed = (r.join(b, F.col("r.source").eqNullSafe(F.col("b.source")) & (F.col("r.part") == F.col("b.part"))
                     & (F.col("r.piece") == F.col("b.piece")))
              .join(q, F.col("r.source").eqNullSafe(F.col("q.source")))
              .select("r.doc_id", "r.source", "r.size", "r.text_key", "r.part", "q.rank", "q.source_size", "q.target",
                      (F.col("ahead") + F.col("words_before")).alias("start"))
              .join(split, ["rank", "part"]))
    rounds = F.expr("CASE WHEN part_size > 0 THEN part_quota div part_size ELSE 0 END")
    rest = F.expr("CASE WHEN part_size > 0 THEN part_quota % part_size ELSE 0 END")
    taken = rounds * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("start")))
    return placed.select("doc_id", "source", "size", "source_size", "target", taken.cast("bigint").alias("taken"), "text_key")
