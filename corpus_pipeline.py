"""Corpus pipeline over ``documents``: quality rules, near-duplicate removal, decontamination, mixing, sharding.

Each stage is a function (spark, docs, sf_dir) -> DataFrame; its result is written as Parquet and read again as the next
stage's docs.  All but the last return the columns of their input.  Decisions are worked out on hashes and ids; the
texts are then filtered by one join with the list of decisions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlane.llm import decontaminate, jaccard_join, mixing, quality_lines, sharding
from textlane.llm.common import same_key, spread, text_of
from textlane.llm.queries import table

#: Names of the helper columns; a column of documents of that name is not touched.
_KEY, _COPIES = "_pipeline_text_key", "_pipeline_copies"


def _with_key(docs: DataFrame) -> DataFrame:
    return docs.withColumn(_KEY, F.md5(text_of()))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and aren't depleted by their host's common lines; texts stay as they are."""
    judged = quality_lines.judge(docs)
    rejected = spread(judged.filter(~F.col("kept")).select(F.col("text_in_host").alias(_KEY)).distinct(), "rejected")
    keyed = docs.withColumn(_KEY, F.xxhash64("source", text_of()))
    return keyed.join(rejected, _KEY, "left_anti").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, that of the least doc_id; documents without words stay."""
    drop, repeated = jaccard_join.duplicates(docs)
    keyed = _with_key(docs)
    drop, repeated = drop.withColumnRenamed("text_key", _KEY), repeated.withColumnRenamed("text_key", _KEY)
    kept = keyed.join(drop, same_key(keyed, drop, ["doc_id", _KEY]), "left_anti")
    if repeated.isEmpty():
        return kept.select(*docs.columns)
    # Representatives that stand in several equal rows: one of those rows stays.
    same = same_key(kept, repeated, ["doc_id", _KEY])
    once = kept.join(repeated, same, "left_semi").dropDuplicates(["doc_id", _KEY])
    return kept.join(repeated, same, "left_anti").unionByName(once).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark table."""
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"))
    leaks = spread(found.select(F.col("text_key").alias(_KEY)).distinct(), "leaks")
    return _with_key(docs).join(leaks, _KEY, "left_anti").select(*docs.columns)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: its taken words over its size, rounded half up; 0 times drops it."""
    plan = mixing.mix(docs)
    copies = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0)
    keys = ["doc_id", "source", _KEY]
    plan = spread(plan.withColumn("copies", copies.cast("int")).groupBy("doc_id", "source", F.col("text_key").alias(_KEY))
                  .agg(F.sum("copies").cast("int").alias(_COPIES), F.count("*").alias("rows")).filter(F.col(_COPIES) > 0), "mix-plan")
    keyed = _with_key(docs)

    def taken(part: DataFrame) -> DataFrame:
        part = part.drop("rows")
        return keyed.join(part, same_key(keyed, part, keys)).select(*[keyed[c] for c in keyed.columns], part[_COPIES])

    rows = taken(plan.filter(F.col("rows") == 1))
    several = plan.filter(F.col("rows") > 1)
    if not several.isEmpty():   # equal rows share their sum of copies
        rows = rows.unionByName(taken(several).dropDuplicates(keys))
    times = F.explode(F.expr(f"sequence(1, {_COPIES})")).alias("_time")
    return rows.select(*docs.columns, times).drop("_time")


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, law, shard and slot of every row of the mix."""
    return sharding.shard_by_bytes(docs).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot")


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("mixing_to_target_weights", mixing_sources),
    ("sharding", shards),
]

#: The similarity join and the windowed search can't be told in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared scratch folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = spread(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
