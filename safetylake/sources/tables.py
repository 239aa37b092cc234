"""Tables as Parquet folders of a warehouse path: append, read, parameterised SQL, views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from safetylake import schemas as S

DATE_PARTITION = "_date"
# Tables whose id may be left to the writer.
GENERATED_ID = {
    "raw_vaers_vax": "_row_id",
    "raw_vaers_symptoms": "_row_id",
    "agt_run": "run_id",
    "agt_step_event": "event_id",
    "agt_human_review_event": "review_id",
}


def table_path(warehouse: str, table: str) -> str:
    return f"{warehouse.rstrip('/')}/{table}"


def to_table(rows: DataFrame, table: str) -> DataFrame:
    """Rows in table column order and types; an unknown column is an error.

    Missing columns become NULL, except the load or event time, which defaults to now, and a
    generated id, which defaults to a random one.
    """
    schema = S.TABLES[table]
    unknown = [c for c in rows.columns if c not in schema.fieldNames()]
    if unknown:
        raise ValueError(f"{table} has no column {', '.join(unknown)}")
    time_column, _ = S.LAYOUT[table]
    columns = []
    for field in schema.fields:
        if field.name in rows.columns:
            value = F.col(field.name)
        elif field.name == time_column or field.name == "first_seen_at":
            value = F.current_timestamp()
        elif field.name == GENERATED_ID.get(table):
            value = F.uuid()
        else:
            value = F.lit(None)
        columns.append(value.cast(field.dataType).alias(field.name))
    return rows.select(*columns)


def laid_out(rows: DataFrame, table: str) -> DataFrame:
    """Rows with their date partition, sorted inside each task by the table's lookup columns.

    Rows are not shuffled for the layout: a date or a case with very many rows stays spread
    over the tasks that hold it, and the sort gives each file narrow column ranges.
    """
    time_column, sort_columns = S.LAYOUT[table]
    if time_column:
        rows = rows.withColumn(DATE_PARTITION, F.to_date(time_column))
        sort_columns = [DATE_PARTITION, *sort_columns]
    return rows.sortWithinPartitions(*sort_columns) if sort_columns else rows


def append(rows: DataFrame, warehouse: str, table: str) -> None:
    """Add rows to an append-only table, partitioned by date where the table has a time."""
    # Ids are hex digits of hashes, of which zstd stores half: most of a child table's bytes.
    writer = laid_out(to_table(rows, table), table).write.mode("append").option("compression", "zstd")
    if S.LAYOUT[table][0]:
        writer = writer.partitionBy(DATE_PARTITION)
    writer.parquet(table_path(warehouse, table))


def write_bucketed(rows: DataFrame, name: str, path: str, key: str, buckets: int) -> None:
    """A catalog table bucketed and sorted by a key: joins and groupings on the key then need no
    exchange. For tables that are often joined by case."""
    writer = rows.write.mode("overwrite").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def read_table(spark: SparkSession, warehouse: str, table: str) -> DataFrame:
    """A table as written; the date partition column is dropped, pruning on it still works
    through ``read_partition``."""
    return _stored(spark, warehouse, table).select(*S.TABLES[table].fieldNames())


def _stored(spark: SparkSession, warehouse: str, table: str) -> DataFrame:
    schema = T.StructType(list(S.TABLES[table].fields))
    if S.LAYOUT[table][0]:
        schema = schema.add(DATE_PARTITION, T.DateType())
    return spark.read.schema(schema).parquet(table_path(warehouse, table))


def read_partition(
    spark: SparkSession, warehouse: str, table: str, first: str, last: str
) -> DataFrame:
    """Rows of the days ``first``..``last``; other day folders are not read."""
    days = F.col(DATE_PARTITION).between(F.to_date(F.lit(first)), F.to_date(F.lit(last)))
    return _stored(spark, warehouse, table).filter(days).select(*S.TABLES[table].fieldNames())


def empty_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], S.TABLES[table])


def query(spark: SparkSession, sql: str, params: dict | None = None) -> DataFrame:
    """SQL with named ``:parameters``, typed by their Python values."""
    return spark.sql(sql, args=params or {})


def query_one(spark: SparkSession, sql: str, params: dict | None = None) -> dict | None:
    """First row of a query, or None."""
    row = query(spark, sql, params).first()
    return row.asDict() if row else None


def register_views(
    spark: SparkSession, builders: dict[str, Callable[[SparkSession], DataFrame]]
) -> list[tuple[str, str]]:
    """Register temporary views in the given order; a view that fails is skipped.

    Returns (name, status) with 'ok' or the error's whole text.
    """
    report = []
    for name, build in builders.items():
        try:
            build(spark).createOrReplaceTempView(name)
            report.append((name, "ok"))
        except Exception as error:  # noqa: BLE001 - reported, and later views still register
            report.append((name, str(error)))
    return report
