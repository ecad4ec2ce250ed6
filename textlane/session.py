"""Session, table and scratch-folder helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "textlane") -> SparkSession:
    """Session for tests and the bench: AQE on, UI off, UTC clock."""
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Fall back from whole-stage code when a generated method passes the
        # JIT's 8,000-byte limit (the JVM would otherwise interpret it): the
        # stemmer's step chain is such a plan.  Recommended on clusters too.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_dir(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    On a cluster this is ``spark.checkpoint.dir`` (a shared file system path
    the cluster names).  Only when it is unset and the master is local, as in
    tests, a private folder under the system temp dir is created and
    registered; on a cluster an unset folder is an error, because executors
    and driver would each write to their own disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share (master is {sc.master})")
        path = tempfile.mkdtemp(prefix="textlane-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused sub-folder of the scratch folder."""
    base = scratch_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Settings of the session that hold inside."""
    was = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in was.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


#: Joins by (block, key) of tables that are clustered by block stay where they are.
IN_BLOCKS = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared scratch folder and read it back.

    Cuts the lineage like ``checkpoint()`` (the files live in the folder the
    cluster names in ``spark.checkpoint.dir``, so they survive executor loss),
    but the data is columnar and compressed, later scans prune columns and
    push filters, and the write is a plain Spark job.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.parquet(path)
