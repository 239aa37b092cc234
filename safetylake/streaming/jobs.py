"""Streams: audit append, live case status and report intake."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from safetylake import schemas as S
from safetylake.operators import surfaces
from safetylake.operators.contracts import contract_errors
from safetylake.operators.mentions import with_run_id
from safetylake.plans import case_run
from safetylake.plans.predict import Predictor
from safetylake.session import scratch, stage_table
from safetylake.sources.tables import table_path
from safetylake.streaming.sink import BATCH, drop_batches, newest_batch, stored_before, write_batch

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
QUARANTINE = "agt_step_event_quarantine"
STATUS = "case_status"
STATUS_GENERATION = 10  # status batches between two that hold the state of all cases


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def start(
    stream: DataFrame,
    each_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    follow: str | None = None,
) -> StreamingQuery:
    """Run a stream through ``each_batch``: what is there now, or every ``follow`` interval."""
    trigger = {"processingTime": follow} if follow else {"availableNow": True}
    return (
        stream.writeStream.foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(**trigger)
        .start()
    )


def step_is_sound(steps: DataFrame, contracts: tuple[str, ...] = tuple(S.STAGES)) -> DataFrame:
    """Adds ``sound``: known stage, confidence in range, and an output that is JSON.

    The output of the stages in ``contracts`` must also keep the contract of its stage.
    """
    kept = F.lit(True)
    for stage in contracts:
        errors = contract_errors(F.col("_json"), stage)
        kept = F.when(F.col("agent_name") == stage, F.size(errors) == 0).otherwise(kept)
    sound = (
        F.col("agent_name").isin(S.STAGES)
        & F.col("confidence").between(0.0, 1.0)
        & F.col("_json").isNotNull()
        & kept
    )
    parsed = steps.withColumn("_json", F.try_parse_json("output"))
    return parsed.withColumn("sound", F.coalesce(sound, F.lit(False))).drop("_json")


def audit_stream(
    steps: DataFrame,
    warehouse: str,
    checkpoint: str,
    contracts: tuple[str, ...] = tuple(S.STAGES),
    **options,
) -> StreamingQuery:
    """Append step events to the audit table once each; unsound ones go to a quarantine.

    Batch folders are replaced on a retry and stored ids are skipped, so no state is kept and
    no event is dropped for being late.
    """

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        judged = step_is_sound(batch, contracts).persist(StorageLevel.MEMORY_AND_DISK)
        write_batch(
            judged.filter("sound").drop("sound"), warehouse, "agt_step_event", batch_id, "event_id"
        )
        judged.filter(~F.col("sound")).drop("sound").write.mode("overwrite").parquet(
            f"{table_path(warehouse, QUARANTINE)}/{BATCH}={batch_id}"
        )
        judged.unpersist()

    return start(steps, each_batch, checkpoint, **options)


def status_stream(steps: DataFrame, warehouse: str, checkpoint: str, **options) -> StreamingQuery:
    """Keep the newest state of each case; every batch writes the cases it changed.

    The state is one small row per case and lives in RocksDB on the executors; events are
    folded per task before they are shuffled, so a busy case does not gather in one task.
    Every STATUS_GENERATION-th batch writes the state of all cases, so that readers need only the
    batches from there on; the folders before the last such batch but one are removed.
    """
    spark = steps.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    changed = surfaces.fold_status(surfaces.status_events(steps))
    path = table_path(warehouse, STATUS)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        rows = batch
        if batch_id and batch_id % STATUS_GENERATION == 0:
            before = _states(spark, path, batch_id - 1)
            rows = _newest(before.unionByName(batch.withColumn(BATCH, F.lit(batch_id)))).drop(BATCH)
        rows.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")
        if batch_id and batch_id % STATUS_GENERATION == 0:
            drop_batches(spark, path, batch_id - STATUS_GENERATION)

    return start(changed, each_batch, checkpoint, mode="update", **options)


def _states(spark: SparkSession, path: str, last: int) -> DataFrame:
    """Stored states up to batch ``last``, from the newest batch on that holds all cases."""
    first = last - last % STATUS_GENERATION
    return spark.read.option("basePath", path).parquet(path).filter(F.col(BATCH).between(first, last))


def _newest(states: DataFrame) -> DataFrame:
    order = Window.partitionBy("vaers_id").orderBy(F.col(BATCH).desc())
    return states.withColumn("rn", F.row_number().over(order)).filter("rn = 1").drop("rn")


def read_status(spark: SparkSession, warehouse: str, threshold: float = S.HITL_THRESHOLD) -> DataFrame:
    """Current state per case: the newest batch that changed it."""
    path = table_path(warehouse, STATUS)
    current = _newest(_states(spark, path, newest_batch(spark, path)))
    return surfaces.with_hitl(current.drop(BATCH), threshold)


def intake_stream(
    reports: DataFrame,
    ref: case_run.Reference,
    scope_cases: DataFrame,
    warehouse: str,
    checkpoint: str,
    min_chars: int = S.MIN_NARRATIVE_CHARS,
    chosen: tuple[str, ...] = tuple(S.STAGES),
    version: str = S.PIPELINE_VERSION["full"],
    skip_known: bool = True,
    predictors: dict[str, Predictor] | None = None,
    models: dict[str, str] | None = None,
    **options,
) -> StreamingQuery:
    """Process new in-scope reports with a long enough narrative and append their records.

    ``reports`` holds vaers_id, narrative and received_date. The checkpoint takes each file
    once and a retried batch replaces its folders. A report sent again has the same run id and is
    stored once, at the price of reading the stored run ids; ``skip_known=False`` stores it again.
    Stages named in ``predictors`` are done by them; a case they fail on gets a failed run record and is
    tried again when it is sent again. The reference tables are written once, before the stream starts;
    the work folders of a batch are removed when it is written.
    """
    ref = ref.written()
    scope_cases = stage_table(scope_cases, "scope-cases")

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        wanted = batch.filter(F.char_length("narrative") >= min_chars).join(
            scope_cases, "vaers_id", "left_semi"
        )
        if skip_known and batch_id > 0:
            stored = stored_before(batch.sparkSession, warehouse, "agt_run", batch_id)
            done = stored.filter("status <> 'failed'").select("run_id")
            wanted = with_run_id(wanted, version).join(done, "run_id", "left_anti").drop("run_id")
        with scratch(batch.sparkSession):
            runs, failures = case_run.run_with_predictors(wanted, ref, predictors or {}, chosen, version)
            runs = case_run.store(runs)
            records = case_run.run_record(runs, models)
            if failures is not None:
                records = records.unionByName(case_run.failed_runs(failures, version, models))
            write_batch(case_run.step_events(runs, models), warehouse, "agt_step_event", batch_id)
            write_batch(case_run.case_output(runs), warehouse, "agt_case_output", batch_id)
            write_batch(records, warehouse, "agt_run", batch_id)

    return start(reports, each_batch, checkpoint, **options)
