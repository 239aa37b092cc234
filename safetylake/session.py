"""Session settings and the shared work folder."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Text stages are heavy per byte: keep small inputs spread over all cores.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
    # A case, product or term may hold a large share of the rows: split such join
    # partitions even when that costs one more exchange above the join.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
# Set only where the session does not say otherwise.
DEFAULTS = {
    # A megabyte of shuffled text becomes many of mentions: small tasks read it without spilling.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    # Shuffles begin with many partitions, which are merged up to the size above: so a task's rows, and the memory
    # for sorting or grouping them, do not grow with the input when the number of shuffle partitions stays as it is.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "512",
    # Rows are many times their compressed files in memory, and tasks that read also sort and group.
    "spark.sql.files.maxPartitionBytes": "32m",
    # A limit in bytes has every column of a batch sized again for each of its rows, which for a case takes longer than
    # to write it. Rows bound a batch instead: 4,096 reports of the public source's longest text are 130 MB.
    "spark.sql.execution.arrow.maxBytesPerBatch": "2147483647",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
    # Ids are hex digits of hashes, which take about half the space so.
    "spark.sql.parquet.compression.codec": "zstd",
    # What is dealt by case already is joined on case and term as it lies.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators are written for."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    for key, value in DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a session in one process may go without the setting; it gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        folder = tempfile.mkdtemp(prefix="safetylake-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    below = f"{_SCRATCH[-1]}/" if _SCRATCH else ""
    return f"{work_dir(spark)}/{below}{label}-{uuid.uuid4().hex}"


_SCRATCH: list[str] = []


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Paths made inside go below one folder, which is removed at the end.

    For jobs that run again and again; nothing read from those paths may be used afterwards.
    """
    name = f"scratch-{uuid.uuid4().hex}"
    _SCRATCH.append(name)
    try:
        yield
    finally:
        _SCRATCH.remove(name)
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{work_dir(spark)}/{name}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Readers then see a file scan of known size: the planner broadcasts it when the files
    are below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise. It also
    cuts the lineage, so a lost executor re-reads files instead of recomputing the inputs.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_by_key(df: DataFrame, label: str, key: str) -> DataFrame:
    """``stage_table`` in buckets of ``key``: what groups by it afterwards needs no exchange.

    For rows that are dealt by ``key`` already, so that a task writes few buckets; there are as many as shuffle partitions.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, key).option("path", path).format("parquet").saveAsTable(name)
    rows = spark.table(name).select("*")
    spark.sql(f"DROP TABLE {name}")  # the name only: the files stay, and the frame knows them
    return rows
