"""Incremental run tables: latest value per (run, metric) as metric rows arrive.

A streaming aggregation keeps one state row per (run, key) holding the
latest value by ``(ts, tiebreak)``.  Each micro-batch's full result
(complete mode) replaces the output table, so readers always see a finished
table; the query's checkpoint sits in the shared checkpoint folder, so a
restarted driver continues where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlane.session import fresh_path


def metric_stream(spark: SparkSession, path: str, schema: T.StructType, file_glob: str | None = None,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if file_glob:
        r = r.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def latest_values_stream(stream: DataFrame, run: str, key: str, value: str, order: list[str]) -> DataFrame:
    return stream.groupBy(run, key).agg(F.max_by(F.col(value), F.struct(*order)).alias(value))


def run_available(agg: DataFrame, out_path: str, checkpoint: str | None = None) -> str:
    """Process everything available now (then stop), keeping ``out_path`` as the current table."""
    spark = agg.sparkSession
    checkpoint = checkpoint or fresh_path(spark, "stream-ckpt")

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(out_path)

    q = (agg.writeStream.outputMode("complete").foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return out_path
