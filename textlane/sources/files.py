"""File sources and sinks (S1-S11)."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlane.session import materialize, settings


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs -> flat columns named ``parent<sep>child`` (a schema walk, one ``select``)."""
    cols = []

    def walk(dtype: T.DataType, path: list[str]):
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                walk(f.dataType, path + [f.name])
        else:
            ref = F.col(".".join(f"`{p}`" for p in path))
            cols.append(ref.alias(sep.join(path)))

    walk(df.schema, [])
    return df.select(*cols)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
              multiline: bool = False, sep: str = ".") -> DataFrame:
    """JSON records (JSON lines, or one array per file with ``multiline``), flattened."""
    r = spark.read.option("multiLine", multiline)
    if schema is not None:
        r = r.schema(schema)
    return flatten(r.json(path), sep)


def parse_json_column(df: DataFrame, col: str, schema: str | T.StructType, sep: str = ".") -> DataFrame:
    """A JSON string column -> flattened struct columns ``col<sep>field``."""
    parsed = df.withColumn(col, F.from_json(F.col(col), schema))
    return flatten(parsed, sep)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header; quotes and embedded newlines survive a re-read with ``read_csv``."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("quoteAll", True).csv(path))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    r = (spark.read.option("header", True).option("multiLine", True).option("escape", '"'))
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", True)
    return r.csv(path)


def versioned_path(base: str, name: str, version: int) -> str:
    """One path rule for writer and reader: ``base/name/version=N``."""
    return os.path.join(base, name, f"version={version}")


def write_label_map(label_map: DataFrame, path: str) -> None:
    """``(idx, label)`` rows -> one JSON object ``{"idx": "label", ...}`` in a text file."""
    (label_map.agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct("idx", "label"))))).alias("value"))
     .coalesce(1).write.mode("overwrite").text(path))


def read_label_map(spark: SparkSession, path: str) -> DataFrame:
    """JSON object file(s) -> ``(idx string, label string)``."""
    raw = spark.read.option("wholetext", True).text(path)
    return raw.select(F.explode(F.from_json("value", "map<string,string>")).alias("idx", "label"))


def write_snapshot(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_stopword_dir(spark: SparkSession, path: str, name: str = r"([^/]+)$") -> DataFrame:
    """A folder of one-word-per-line files -> ``(lang, term)``; the language is what ``name`` finds in the file's path
    (by default the file's name)."""
    return (spark.read.option("recursiveFileLookup", True).text(path)
            .select(F.regexp_extract(F.col("_metadata.file_path"), name, 1).alias("lang"),
                    F.trim("value").alias("term"))
            .filter(F.col("term") != ""))


def to_vectors(df: DataFrame, array_col: str, out: str = "features") -> DataFrame:
    """``array<float>`` -> MLlib dense vector (JVM-side conversion)."""
    from pyspark.ml.functions import array_to_vector
    return df.withColumn(out, array_to_vector(F.col(array_col)))


# Run store ---------------------------------------------------------------

#: Options of a write of very many files: each task moves its own files in place (else the driver moves them all, one
#: after the other).
MANY_FILES = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}

#: Characters that a folder name of a partitioned write has as %XX, and the name that stands for null and ''.
_ESCAPED = re.compile(r"[\x01-\x1f\x7f\"#%'*/:=?\\{\[\]^]")
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"

RUNSTORE_METRIC_PATTERN = r"/([^/]+)/([^/]+)/metrics/([^/]+)$"


def _partition_folder(names: tuple[str, ...], values: tuple) -> str:
    """``name=value/...`` as Spark's partitioned writer names it."""
    return "/".join(f"{c}={_ESCAPED.sub(lambda m: f'%{ord(m[0]):02X}', v) if v else _NO_VALUE}" for c, v in zip(names, values, strict=True))


def _write_groups(batches: Iterator[pa.RecordBatch], root: str, by: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by ``by``: one text file per group, put in place when it is whole, so that a repeated task does no harm."""
    at, out, n = None, None, 0

    def close() -> None:
        if out is not None:
            out.close()
            os.replace(out.name, f"{os.path.dirname(out.name)}/part-0.txt")

    for batch in batches:
        *keys, lines = (c.to_pylist() for c in batch.columns)
        for values, line in zip(zip(*keys, strict=True), lines, strict=True):
            if values != at:
                close()
                folder = f"{root}/{_partition_folder(by, values)}"
                os.makedirs(folder, exist_ok=True)
                at, out, n = values, open(f"{folder}/.{uuid.uuid4().hex}", "w", encoding="utf-8", newline="\n"), n + 1  # noqa: SIM115
            out.write(f"{line}\n")
    close()
    yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["files"])


def write_file_per_group(df: DataFrame, root: str, by: tuple[str, ...], line: str = "line") -> None:
    """One text file per group of the string columns ``by``, in folders ``name=value/...``.

    The work is in the files, not in their bytes: a fixed number of tasks, each with whole groups.  On a local (shared) folder
    a task makes its files itself, as Hadoop's local file system starts a ``chmod`` process for every folder it makes, twice
    per folder in a committed write; other file systems take Spark's writer.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(*by, line).repartition(n, *by)
    local = re.fullmatch(r"file:/*(/.*)", root)
    if local is None:
        rows.write.options(**MANY_FILES).partitionBy(*by).text(root)
        return
    path = local[1]
    os.makedirs(path, exist_ok=True)
    made = rows.sortWithinPartitions(*by).mapInArrow(partial(_write_groups, root=path, by=by), "files long")
    made.agg(F.sum("files")).collect()


def many_small_files(spark: SparkSession) -> AbstractContextManager[None]:
    """Scans inside count a file's opening as 64 KB instead of 4 MB: about 2,000 tiny files to a task instead of 32; folders
    are listed by a few tasks per core instead of one task per folder."""
    return settings(spark, **{"spark.sql.files.openCostInBytes": str(64 * 1024),
                              "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(4 * max(8, spark.sparkContext.defaultParallelism))})


#: Larger files, and compressed ones, are read in pieces of lines; the others whole, as a line reader costs 5 ms per file.
WHOLE_BYTES, _COMPRESSED = 16 << 20, r"\.(gz|bz2|deflate|lz4|snappy|zst)$"


def _file_lines(spark: SparkSession, root: str) -> DataFrame:
    """``(value, _path)``: the lines of all files below ``root``."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    by_line = F.col("path").rlike(_COMPRESSED) | (F.col("length") > WHOLE_BYTES)
    others = [r["path"] for r in raw.filter(by_line).select("path").collect()]      # their number is bounded by their bytes
    content = F.regexp_replace(F.col("content").cast("string"), "^\ufeff", "")
    lines = raw.filter(~by_line).select(F.explode(F.split(content, "\r\n|\r|\n")).alias("value"), F.col("_metadata.file_path").alias("_path"))
    if others:
        lines = lines.unionByName(spark.read.text(others).select("value", F.col("_metadata.file_path").alias("_path")))
    return lines


def scan_run_metrics(spark: SparkSession, root: str, pattern: str = RUNSTORE_METRIC_PATTERN,
                     groups: tuple[int, int, int] = (1, 2, 3)) -> DataFrame:
    """File-per-metric run folders -> ``(experiment_id, run_id, key, ts_ms, value, step)``.

    Each metric file holds lines ``epoch_ms value step``; experiment, run and
    metric key come from the file path (``pattern`` with three groups).  The
    files are opened once: the rows are written to the scratch folder as one
    table.
    """
    with many_small_files(spark):
        raw = _file_lines(spark, root)
        parts = F.split(F.trim("value"), " ")
        g1, g2, g3 = groups
        rows = (raw.filter(F.col("_path").rlike(pattern)).filter(F.trim("value") != "")
                .select(F.regexp_extract("_path", pattern, g1).alias("experiment_id"),
                        F.regexp_extract("_path", pattern, g2).alias("run_id"),
                        F.regexp_extract("_path", pattern, g3).alias("key"),
                        parts[0].cast("bigint").alias("ts_ms"),
                        parts[1].cast("double").alias("value"),
                        parts[2].cast("bigint").alias("step")))
        return materialize(rows, "run-metrics")


def scan_run_texts(spark: SparkSession, root: str, kind: str = "params") -> DataFrame:
    """``params``/``tags`` folders (one raw value per file) -> ``(run_id, key, value)``."""
    pattern = rf"/([^/]+)/{kind}/([^/]+)$"
    raw = (spark.read.option("recursiveFileLookup", True).option("wholetext", True).text(root)
           .withColumn("_path", F.col("_metadata.file_path")))
    return (raw.filter(F.col("_path").rlike(pattern))
            .select(F.regexp_extract("_path", pattern, 1).alias("run_id"),
                    F.regexp_extract("_path", pattern, 2).alias("key"), F.col("value")))


def append_run_values(df: DataFrame, path: str) -> None:
    """Append ``(run_id, kind, key, value, ts, step)`` rows to the run table (Parquet, partitioned by kind)."""
    df.write.mode("append").partitionBy("kind").parquet(path)
