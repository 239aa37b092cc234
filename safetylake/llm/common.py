"""What several operators share: table access and packing rows against name clashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: a word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def boxed(df: DataFrame) -> DataFrame:
    """Every input column inside one struct ``row``, so that added columns cannot clash."""
    return df.select(F.struct("*").alias("row"))


def held_out(doc_id: str = "doc_id") -> Column:
    """True for rows that models must not learn from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def hash_sample(rows: DataFrame, key: str, wanted: int, total: int) -> DataFrame:
    """About ``wanted`` of ``total`` rows, chosen by a hash of ``key``; the same rows on every run."""
    if total <= wanted:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1 << 62)) < F.lit((wanted << 62) // total))
