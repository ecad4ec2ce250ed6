"""URL filters as a sort-merge range join.

Keys reverse the host's labels, so a rule (host, path prefix) is one interval
of keys, all that begin with ``org?example#/es/`` (neither host nor path can hold ``?`` or ``#``).  A url has a
key for its host and each parent domain (as many as the host has labels), so
that rules of a domain also fit its subdomains.

Keys are range-partitioned and written with their partition's number; the
partitions' first and last keys (one row each) say which partitions a rule's
interval meets, and the rule is copied to those.  One sorted pass per partition
then keeps a stack of the rules whose intervals are open; intervals of prefixes
nest, so the stack holds the fitting rules and is as deep as rules nest.  A hot
host or url is spread by the range partitioning (keys are ordered by key and
page), and nothing is gathered per key.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlane.llm.common import LOWER, UPPER, spread

DEFAULT_VERDICT = "allow"
#: Between labels and after the last one: the characters that end a url's host and path, so that neither can hold them.
LABEL, END = "?", "#"


def _after_scheme(url: Column) -> Column:
    return F.coalesce(F.get(F.split(F.coalesce(url, F.lit("")), "://", 2), F.lit(1)), F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or end; empty without ``://``."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def reversed_labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\.", -1))


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Longest open rule of every key, in one pass over rows sorted by (part, key, is_key)."""
    part, stack = None, []
    for batch in batches:
        ids, rules, verdicts = [], [], []
        rows = zip(*[batch.column(c).to_pylist() for c in ("part", "key", "is_key", "row", "rule", "verdict")], strict=True)
        for p, key, is_key, row, rule, verdict in rows:
            if p != part:
                part, stack = p, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if is_key:
                ids.append(row)
                # Open rules are prefixes of one another: the innermost is the longest; of equal rules the first wins.
                rules.append(stack[-1][1] if stack else None)
                verdicts.append(stack[-1][2] if stack else None)
            elif not stack or stack[-1][0] != key:
                stack.append((key, rule, verdict))
        if ids:
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, type=batch.column("row").type), pa.array(rules, type=pa.string()),
                 pa.array(verdicts, type=pa.string())], names=["row", "rule", "verdict"])


def judge_urls(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url",
               default: str = DEFAULT_VERDICT) -> DataFrame:
    """page_id, host, path, rule, verdict of every page row.

    pages: page_id, url; rules: host, path, verdict; other columns are not
    read.  A rule fits its host and all subdomains if the url's path begins
    with the rule's path.  The longest fitting rule (host + path) wins, among
    equally long ones the one with the longer host; of repeated rules with
    different verdicts the least verdict in code point order.  A rule whose host
    holds ``/``, ``?`` or ``#`` fits no url.  No fitting rule:
    rule null, verdict ``default``.  A null url or one without ``://`` has an
    empty host and path.  Rules with a null part are ignored; an empty rule
    table gives every page the default; repeated rows give a row each; an empty
    page table gives an empty one.
    """
    spark = pages.sparkSession
    seen = (pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
            .groupBy("page_id", "host", "path").agg(F.count("*").alias("times")))
    labels = reversed_labels(F.col("host"))
    # Keys of the host and of each parent domain, with the row they belong to.
    keys = (seen.withColumn("labels", labels)
            .withColumn("depth", F.explode(F.sequence(F.lit(1), F.size("labels"))))
            .select(F.struct("page_id", "host", "path", "times").alias("row"),
                    F.concat(F.array_join(F.slice("labels", F.lit(1), F.col("depth")), LABEL), F.lit(END), "path").alias("key")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = spread(keys.repartitionByRange(parts, "key", "row.page_id").withColumn("part", F.spark_partition_id()), "url-keys")

    clean = (rules.select(F.translate("host", UPPER, LOWER).alias("host"), F.col("path"), F.col("verdict")).dropna()
             .filter(~F.col("host").rlike("[/?#]"))
             .groupBy("host", "path").agg(F.min("verdict").alias("verdict")))
    clean = clean.select(F.concat(F.array_join(reversed_labels(F.col("host")), LABEL), F.lit(END), "path").alias("key"),
                         F.concat("host", "path").alias("rule"), "verdict")
    # One row per partition: its first and last key.  A rule meets the partitions whose keys can begin with it.
    ends = keys.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    meets = (F.col("key") <= F.col("high")) & ((F.col("key") >= F.col("low")) | F.col("low").startswith(F.col("key")))
    copies = clean.join(F.broadcast(ends), meets).select(
        "part", "key", F.lit(False).alias("is_key"), "rule", "verdict")
    both = keys.withColumn("is_key", F.lit(True)).unionByName(copies, allowMissingColumns=True)
    swept = (both.repartition(parts, "part").sortWithinPartitions("part", "key", "is_key")
             .select("part", "key", "is_key", "row", "rule", "verdict")
             .mapInArrow(_sweep, f"row {keys.schema['row'].dataType.simpleString()}, rule string, verdict string"))
    # A shorter suffix of the host may have the longer rule: the longest of all keys' rules wins.
    best = F.max_by(F.struct("rule", "verdict"), F.struct(
        F.coalesce(F.length("rule"), F.lit(-1)), F.instr(F.coalesce("rule", F.lit("")), "/")))
    judged = swept.groupBy("row").agg(best.alias("best"))
    return judged.select(
        F.col("row.page_id").alias(page_id), F.col("row.host").alias("host"), F.col("row.path").alias("path"),
        F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        F.explode(F.expr("sequence(1, row.times)")).alias("_copy")).drop("_copy")
