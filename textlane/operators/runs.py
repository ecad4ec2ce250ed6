"""Run and model-registry analytics over long run tables (R1-R8).

Runs are long tables ``metrics(run_id, key, ts, value, ...)``; model versions
are an event table ``(name, version, stage, ts)``.  Everything is grouping,
windows and joins on those tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlane.operators.sampling import grouped_rank


def runs_wide(metrics: DataFrame, run: str, key: str, value: str, order: list[str],
              keys: list[str] | None = None) -> DataFrame:
    """One row per run, one column per metric key: the latest value (by ``order``).

    Without a list of keys every key that occurs gets a column.
    """
    latest = F.max_by(F.col(value), F.struct(*order))
    return metrics.groupBy(run).pivot(key, keys).agg(latest)


def last_values(metrics: DataFrame, run: str, key: str, value: str, order: list[str]) -> DataFrame:
    """``(run, key, value)`` latest value of each metric of each run."""
    return metrics.groupBy(run, key).agg(F.max_by(F.col(value), F.struct(*order)).alias(value))


def search_runs(runs: DataFrame, run: str, condition, tagged: DataFrame | None = None,
                excluded: DataFrame | None = None) -> DataFrame:
    """Filter runs, keep those with a matching tag row (semi join), drop deleted ones (anti join)."""
    out = runs.filter(condition)
    if tagged is not None:
        out = out.join(tagged.select(run).distinct(), run, "left_semi")
    if excluded is not None:
        out = out.join(excluded.select(run).distinct(), run, "left_anti")
    return out


def top_runs(runs: DataFrame, metric: str, run: str, n: int = 4) -> DataFrame:
    """Best ``n`` runs by ``metric`` descending, nulls last, ties by run id."""
    return runs.orderBy(F.desc_nulls_last(metric), F.asc(run)).limit(n)


def register_versions(models: DataFrame, name: str, order: list[str], salt: str,
                      out: str = "version") -> DataFrame:
    """Version numbers 1.. per model name in registration order.

    Uses the salted grouped rank, so one model with a third of all
    registrations is numbered by many tasks.
    """
    return grouped_rank(models, [name], order, salt, "_r").withColumn(out, F.col("_r") + 1).drop("_r")


def latest_versions(versions: DataFrame, name: str, stage: str, version: str = "version") -> DataFrame:
    """Latest version per (name, stage)."""
    return versions.groupBy(name, stage).agg(F.max(version).alias("latest_version"))


def stage_with_archiving(versions: DataFrame, name: str, stage: str, version: str = "version",
                         out: str = "current_stage") -> DataFrame:
    """Move each version to its stage in version order, archiving older versions in that stage.

    A version keeps its stage only if no later version entered the same
    stage; the newest per (name, stage) is a partial aggregate (skew-safe),
    joined back on the key.
    """
    newest = versions.groupBy(name, stage).agg(F.max(version).alias("_newest"))
    return (versions.join(newest, [name, stage])
            .withColumn(out, F.when(F.col(version) < F.col("_newest"), F.lit("Archived"))
                        .otherwise(F.col(stage)))
            .drop("_newest"))


def run_durations(metrics: DataFrame, run: str, ts: str) -> DataFrame:
    """Start, end and duration (microseconds) per run."""
    return metrics.groupBy(run).agg(
        F.min(ts).alias("start_ts"), F.max(ts).alias("end_ts"),
        F.timestamp_diff("MICROSECOND", F.min(ts), F.max(ts)).alias("duration_us"),
        F.count(F.lit(1)).alias("n_values"))


def run_status(metrics: DataFrame, run: str, key: str, order: list[str], finished: tuple[str, ...],
               failed: tuple[str, ...]) -> DataFrame:
    """``(run, start_ts, end_ts, status)``: the latest event (by ``order``, its first column a time) tells the status."""
    latest = F.max_by(key, F.struct(*order))
    return metrics.groupBy(run).agg(F.min(order[0]).alias("start_ts"), F.max(order[0]).alias("end_ts"), latest.alias("_last")).select(
        run, "start_ts", "end_ts", F.when(F.col("_last").isin(*failed), F.lit("FAILED"))
        .when(F.col("_last").isin(*finished), F.lit("FINISHED")).otherwise(F.lit("RUNNING")).alias("status"))
