"""Exactly-once append of stream batches to Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from safetylake import schemas as S
from safetylake.sources.tables import DATE_PARTITION, table_path, to_table

BATCH, BUCKET = "_batch", "_bucket"
ID_BUCKETS = 64


def _schema(table: str) -> T.StructType:
    schema = T.StructType(list(S.TABLES[table].fields))
    return schema.add(BATCH, T.LongType()).add(DATE_PARTITION, T.DateType())


def write_batch(
    rows: DataFrame, warehouse: str, table: str, batch_id: int, id_column: str | None = None
) -> None:
    """Write one batch into its own folder of the table, replacing an earlier try of it.

    With ``id_column``, rows whose id is already stored by an earlier batch are left out, whatever
    their time, so a source that repeats an event adds it once. The ids of a batch are also written
    to an index of hash buckets; only the buckets that the batch falls in are looked up.
    """
    time_column = S.LAYOUT[table][0]
    dated = to_table(rows, table).withColumn(DATE_PARTITION, F.to_date(time_column))
    if id_column:
        bucket = F.pmod(F.xxhash64(id_column), F.lit(ID_BUCKETS)).cast("int")
        dated = dated.dropDuplicates([id_column]).withColumn(BUCKET, bucket)
        index = table_path(warehouse, f"{table}_ids")
        if batch_id > 0:
            touched = [r[0] for r in dated.select(BUCKET).distinct().collect()]  # at most ID_BUCKETS
            schema = T.StructType().add(id_column, rows.schema[id_column].dataType).add(BATCH, T.LongType()).add(BUCKET, T.IntegerType())
            stored = rows.sparkSession.read.schema(schema).option("basePath", index).parquet(index)
            stored = stored.filter((F.col(BATCH) < batch_id) & F.col(BUCKET).isin(touched))
            dated = dated.join(stored.select(id_column), id_column, "left_anti")
        dated.select(id_column, BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{index}/{BATCH}={batch_id}")
    folder = f"{table_path(warehouse, table)}/{BATCH}={batch_id}"
    dated.select(*S.TABLES[table].fieldNames(), DATE_PARTITION).write.mode("overwrite").partitionBy(
        DATE_PARTITION
    ).parquet(folder)


def batch_folders(spark: SparkSession, path: str) -> dict[int, object]:
    """The batch folders of a table by number."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath() for s in files.listStatus(root)]
    return {int(p.getName().split("=")[1]): p for p in found if p.getName().startswith(f"{BATCH}=")}


def newest_batch(spark: SparkSession, path: str) -> int:
    return max(batch_folders(spark, path))


def drop_batches(spark: SparkSession, path: str, before: int) -> None:
    """Remove the batch folders below ``before``, whose rows a later batch holds."""
    for number, folder in batch_folders(spark, path).items():
        if number < before:
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _stored(spark: SparkSession, warehouse: str, table: str) -> DataFrame:
    path = table_path(warehouse, table)
    return spark.read.schema(_schema(table)).option("basePath", path).parquet(path)


def stored_before(spark: SparkSession, warehouse: str, table: str, batch_id: int) -> DataFrame:
    """Rows of the batches before ``batch_id``."""
    return _stored(spark, warehouse, table).filter(F.col(BATCH) < batch_id)


def read_stream_table(spark: SparkSession, warehouse: str, table: str) -> DataFrame:
    """All rows appended so far."""
    return _stored(spark, warehouse, table).select(*S.TABLES[table].fieldNames())
