"""Report files: read the public CSVs as text, conform them to the raw tables, append."""

from __future__ import annotations

import csv
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from safetylake import schemas as S
from safetylake.functions import text
from safetylake.session import stage_table
from safetylake.sources.tables import append, table_path

CORRUPT, KEPT_OUT = "_corrupt", "_kept_out"


@dataclass(frozen=True)
class FileSpec:
    columns: list[str]
    numeric: list[str]
    row_id: bool
    source_file: bool


SPECS = {
    "raw_vaers_data": FileSpec(S.CASE_FILE_COLUMNS, S.CASE_FILE_NUMERIC, False, True),
    "raw_vaers_vax": FileSpec(S.VAX_FILE_COLUMNS, [], True, False),
    "raw_vaers_symptoms": FileSpec(S.SYMPTOM_FILE_COLUMNS, S.SYMPTOM_FILE_NUMERIC, True, False),
}


def _options(encoding: str) -> dict[str, str]:
    return {
        "header": "true", "enforceSchema": "true", "encoding": encoding, "quote": '"', "escape": '"',
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "emptyValue": "", "nullValue": "",
    }


# A quote opens a field at its start only; inside a quoted field two quotes are one. The rest of a
# field, quoted or not, is plain text up to the next comma.
_INSIDE = r'[^"]*+(?:""[^"]*+)*+'
_FIELDS = rf'(?:(?:"{_INSIDE}"[^,]*+|[^",][^,]*+)?,)*+'
OPENS = rf'(?s)^{_FIELDS}"{_INSIDE}$'
STAYS_OPEN = rf'(?s)^{_INSIDE}(?:$|"[^,]*+,{_FIELDS}"{_INSIDE}$)'


def _lines(spark: SparkSession, path: str | list[str], encoding: str) -> DataFrame:
    """Physical lines with their file, the start of their split and what they do to a quoted field.

    ``opens``: a line that starts outside a quoted field ends inside one. ``stays``: a line that
    starts inside ends inside.
    """
    line = F.decode(F.col("value").cast("binary"), encoding)
    quoted = F.contains("line", F.lit('"'))
    return (
        spark.read.text(path)
        .select(
            F.col("_metadata.file_path").alias("_source_file"),
            F.col("_metadata.file_block_start").alias("block"),
            line.alias("line"),
        )
        .withColumn("opens", (quoted & F.col("line").rlike(OPENS)).cast("int"))
        .withColumn("stays", (~quoted | F.col("line").rlike(STAYS_OPEN)).cast("int"))
        .withColumn("id", F.monotonically_increasing_id())
    )


def _records(lines: DataFrame) -> DataFrame:
    """Records of files whose quoted fields hold line breaks: (_source_file, record).

    A line starts a record when no quoted field is open before it. A line either sets that state
    whatever it was, flips it or leaves it; so the state before a line is that of the last line
    that set it, flipped as often as lines since then flip it. Each split is summed up in one small
    row, and a large file is worked on split by split.
    """
    split = ["_source_file", "block"]
    sets = F.col("opens") == F.col("stays")
    flips = F.when((F.col("opens") == 1) & (F.col("stays") == 0), 1).otherwise(0)
    through = Window.partitionBy(*split).orderBy("id")
    earlier = through.rowsBetween(Window.unboundedPreceding, -1)
    earlier_splits = (
        Window.partitionBy("_source_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    marked = lines.withColumn("flips", F.sum(flips).over(through)).withColumn(
        "set", F.when(sets, F.struct(F.col("opens").alias("to"), F.col("flips").alias("at")))
    )
    sums = marked.groupBy(*split).agg(
        F.max("flips").alias("flips"), F.max_by("set", F.when(sets, F.col("id"))).alias("set")
    )
    # The same over the splits of a file: flips run on, a set split counts its flips after the set.
    total = F.sum("flips").over(earlier_splits)
    sums = sums.withColumn("base", F.coalesce(total, F.lit(0)))
    known = F.when(F.col("set").isNotNull(), F.struct(F.col("set.to").alias("to"), (F.col("base") + F.col("set.at")).alias("at")))
    last_set = F.last(known, ignorenulls=True).over(earlier_splits)
    open_before = sums.select(
        *split, ((F.coalesce(last_set["to"], F.lit(0)) + F.col("base") - F.coalesce(last_set["at"], F.lit(0))) % 2).alias("is_open")
    )
    before = F.last("set", ignorenulls=True).over(earlier)
    flipped = F.coalesce(F.last("flips").over(earlier), F.lit(0))
    state = F.when(before.isNull(), F.col("is_open") + flipped).otherwise(before["to"] + flipped - before["at"]) % 2
    in_split, in_order = through, Window.partitionBy(*split).orderBy("id")
    started = (
        marked.join(open_before, split)
        .withColumn("starts", (state == 0).cast("int"))
        .withColumn("nth", F.sum("starts").over(in_split))
        # A line that starts a record, as the next one of its split does, is a record: only others are put together.
        .withColumn("whole", (F.col("starts") == 1) & F.coalesce(F.lead("starts").over(in_order) == 1, F.lit(False)))
    )
    # Lines before the first start of a split continue the last record of an earlier split.
    last = F.when(F.col("n") > 0, F.struct("block", "n"))
    carried = (
        started.groupBy(*split)
        .agg(F.max("nth").alias("n"))
        .select(*split, F.last(last, ignorenulls=True).over(earlier_splits).alias("open"))
    )
    own = F.col("nth") > 0
    single = started.filter("whole").filter("not (block = 0 and nth = 1)").select("_source_file", F.col("line").alias("record"))
    joined = (
        started.filter(~F.col("whole"))
        .join(carried, split)
        .groupBy(
            "_source_file",
            F.when(own, F.col("block")).otherwise(F.col("open.block")).alias("first_block"),
            F.when(own, F.col("nth")).otherwise(F.col("open.n")).alias("first_nth"),
        )
        .agg(F.array_sort(F.collect_list(F.struct("block", "id", "line"))).alias("lines"))
        .filter("not (first_block = 0 and first_nth = 1)")  # the header line
        .select("_source_file", F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("record"))
    )
    return single.unionByName(joined).filter(text.is_filled(F.col("record")))


def read_report_csv(
    spark: SparkSession, path: str | list[str], encoding: str = "ISO-8859-1", seen: Observation | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine) of report CSVs.

    All columns are text. Only an empty field is NULL: the text "NA" stays. A row with fewer
    fields is padded with NULL; a row with more is kept out and goes to the quarantine with
    its raw text. Quoted fields may hold line breaks, and a quote inside an unquoted field is
    plain text. Files may differ in their columns and column order: each is read by its own header.

    One small row per file says whether any of its lines leaves a quoted field open. If none does,
    every line is a record; else the records are put together split by split. No file is read by a
    single task because of its size, and only the distinct headers come to the driver. ``seen`` counts, while the rows
    are used, the records that go to the quarantine (n): where there are none, it need not be read.
    """
    lines = _lines(spark, path, encoding)
    first = F.when(F.col("block") == 0, F.col("id"))
    files = lines.groupBy("_source_file").agg(F.max("opens").alias("broken"), F.min(first).alias("header_id"))
    # Written once: the planner sees how small it is and does not shuffle the lines to meet it.
    files = stage_table(files, "files")
    # Looked up apart: a text in the aggregation above would have all lines sorted by file.
    heads = lines.join(files, "_source_file").filter("id = header_id and line is not null")
    heads = stage_table(heads.select("_source_file", "broken", F.col("line").alias("header")), "headers")
    found = heads.groupBy("header").agg(F.max("broken").alias("broken")).collect()
    headers = sorted(r["header"] for r in found)
    if not headers:
        raise ValueError(f"no header line in {path}")
    tagged = lines.join(files, "_source_file")
    plain = tagged.filter("broken = 0 and id <> header_id").select("_source_file", F.col("line").alias("record"))
    plain = plain.filter(text.is_filled(F.col("record")))
    records = plain
    if any(r["broken"] for r in found):
        records = plain.unionByName(_records(tagged.filter("broken = 1").select(*lines.columns)))
    if len(headers) == 1:
        rows = _parsed(records, headers[0], encoding)
    else:
        records = records.join(heads.select("_source_file", "header"), "_source_file")
        parts = [_parsed(records.filter(F.col("header") == h), h, encoding) for h in headers]
        rows = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    good = rows if seen is None else rows.observe(seen, F.count(KEPT_OUT).alias("n"))
    return (
        good.filter(F.col(KEPT_OUT).isNull()).drop(KEPT_OUT),
        rows.filter(F.col(KEPT_OUT).isNotNull()).select("_source_file", f"{KEPT_OUT}.*"),
    )


def _parsed(records: DataFrame, header: str, encoding: str) -> DataFrame:
    """The fields of (_source_file, record) under one header line; a record with too many of them is in KEPT_OUT."""
    names = [c.strip().lower() for c in next(csv.reader([header]))]
    schema = T.StructType([*[T.StructField(n, T.StringType()) for n in names], T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_csv("record", schema.simpleString(), _options(encoding) | {"header": "false"})
    too_long = field_count(F.col("record")) > len(names)
    kept_out = F.struct(F.col(f"r.`{names[0]}`").alias("first_field"), F.col("record").alias("raw"))
    return records.select(parsed.alias("r"), "_source_file", "record").select(
        *[F.nullif(F.col(f"r.`{n}`"), F.lit("")).alias(n) for n in names], "_source_file", F.when(too_long, kept_out).alias(KEPT_OUT)
    )


def field_count(record: Column) -> Column:
    """Fields of a CSV record: commas outside quoted fields, plus one."""
    unquoted = F.regexp_replace(record, rf'(^|,)"{_INSIDE}"', "$1")
    return F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","), F.lit(""))) + 1


# Fixed value: what reads as a number in a report file.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^[+-]?(?i:inf(inity)?)$"


def number(c: Column) -> Column:
    """Number in a text field; NULL for anything else ("nan", "12d", "n/a")."""
    trimmed = text.strip(c)
    return F.when(trimmed.rlike(NUMBER), trimmed.try_cast("double"))


def conform(
    rows: DataFrame, table: str, batch_id: str, random_ids: bool = False
) -> DataFrame:
    """Rows in the shape of a raw table.

    Known columns in table order (an absent one is NULL, an unknown one dropped), numbers
    parsed (bad text is NULL), batch id and load time, a row id for child tables and the
    source file for the case table. Row ids are a hash of the row and its batch, so a
    repeated task writes the same id and exact copies share one; ``random_ids=True`` gives
    each row its own random id instead.
    """
    spec = SPECS[table]
    have = set(rows.columns)

    def column(name: str) -> Column:
        value = F.col(name) if name in have else F.lit(None).cast("string")
        if name in spec.numeric:
            value = number(value)
        return value.alias(name)

    out = rows.select(
        *[column(n) for n in spec.columns],
        *([F.col("_source_file")] if "_source_file" in have else []),
    )
    if spec.row_id:
        content = F.to_json(F.struct(*spec.columns), {"ignoreNullFields": "false"})
        row_id = F.uuid() if random_ids else F.sha2(F.concat(F.lit(batch_id), content), 256)
        out = out.withColumn("_row_id", row_id)
    out = out.withColumn("_ingested_at", F.current_timestamp()).withColumn(
        "_load_batch_id", F.lit(batch_id)
    )
    if spec.source_file and "_source_file" not in have:
        out = out.withColumn("_source_file", F.lit(None).cast("string"))
    return out.select(*S.TABLES[table].fieldNames())


def load_files(
    spark: SparkSession, paths: dict[str, str], warehouse: str, batch_id: str
) -> dict[str, int | str]:
    """Append the three report files to their raw tables; rows per table and the batch id.

    Rows and records with too many fields are counted by observations while the rows are written, not by a second pass. Records with
    too many fields are appended to ``<table>_quarantine`` and counted as ``<table>_quarantined``
    if there are any.
    """
    counts: dict[str, int | str] = {}
    for table, path in paths.items():
        apart = Observation(f"quarantine_{table}")
        rows, bad = read_report_csv(spark, path, seen=apart)
        seen = Observation(f"load_{table}")
        counted = conform(rows, table, batch_id).observe(seen, F.count(F.lit(1)).alias("n"))
        append(counted, warehouse, table)
        counts[table] = seen.get["n"]
        if not apart.get["n"]:
            continue
        kept_out = stage_table(bad.withColumn("_load_batch_id", F.lit(batch_id)), f"{table}_quarantine")
        if n := kept_out.count():
            kept_out.write.mode("append").parquet(table_path(warehouse, f"{table}_quarantine"))
            counts[f"{table}_quarantined"] = n
    counts["batch_id"] = batch_id
    return counts
