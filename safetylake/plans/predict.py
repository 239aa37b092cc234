"""Stage predictors supplied by the user: batch inference with failures kept apart."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from safetylake.operators.contracts import parse, validate
from safetylake.session import stage_table

# One JSON output, alone or with its input and output token counts
Answer = str | tuple[str, int, int]
# list of input texts -> list of answers, one per text
Predictor = Callable[[list[str]], list[Answer]]
USAGE = ["input_tokens", "output_tokens", "latency_ms"]
FOUND = {"output": "string", "error": "string", **dict.fromkeys(USAGE, "long")}


def in_halves(call: Callable[[list[str]], list[tuple]], texts: list[str]) -> list[tuple]:
    """Results of ``call`` for all texts in order; what fails is halved, and a single text that fails is an error row."""
    results, waiting = [], [texts]
    while waiting:
        part = waiting.pop()
        try:
            results += call(part)
        except Exception as error:  # noqa: BLE001 - any failure belongs to its row
            if len(part) == 1:
                results.append((None, str(error) or type(error).__name__, 0, 0, 0))
            else:
                middle = len(part) // 2
                waiting += [part[middle:], part[:middle]]
    return results


def predict(inputs: DataFrame, predictor: Predictor, keep: Sequence[str] = ()) -> DataFrame:
    """Run a predictor over (run_id, input_text): (run_id, output, error, the columns of USAGE and those in ``keep``).

    Each Arrow batch is one call. A batch that fails is halved until the bad row stands alone, so a bad
    row costs about two calls for each halving: it comes back with its error and without an output. A row's
    latency is its share of the call's time; token counts are 0 unless the predictor gives them. The columns in
    ``keep`` go along as they are, so that no join has to bring them back.
    """
    carried = ["run_id", *keep]
    schema = T.StructType([inputs.schema[c] for c in carried])
    for name, kind in FOUND.items():
        schema = schema.add(name, kind)
    kinds = [pa.string() if kind == "string" else pa.int64() for kind in FOUND.values()]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def call(texts):
            begun = time.perf_counter()
            answers = list(predictor(texts))
            if len(answers) != len(texts):
                raise ValueError("one output per input is required")
            spent = round(1000 * (time.perf_counter() - begun) / len(texts))
            parts = [a if isinstance(a, tuple) else (a, 0, 0) for a in answers]
            return [(output, None, int(read), int(written), spent) for output, read, written in parts]

        for batch in batches:
            if not batch.num_rows:
                continue
            results = in_halves(call, batch.column("input_text").to_pylist())
            found = [pa.array(list(values), kind) for values, kind in zip(zip(*results, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carried), *found], schema.names)

    return inputs.select(*carried, "input_text").mapInArrow(apply, schema)


def checked(predicted: DataFrame, stage: str, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Split predictions into (run_id, ``keep``, stage struct, usage_<stage>) and failures (run_id, stage, error).

    An output that breaks the stage contract fails like an error of the predictor. Predictions are written
    once with what was found, so that each is made and judged once, however often the two parts are read. Failures
    have the vaers_id if it is in ``keep``.
    """
    error = F.coalesce(
        "error",
        F.when(~F.col("valid"), F.concat(F.lit("contract: "), F.array_join("errors", "; "))),
    )
    judged = validate(predicted, "output", stage).select("run_id", "output", error.alias("error"), *USAGE, *keep)
    judged = stage_table(judged, f"judged-{stage}")
    usage = F.struct(*USAGE).alias(f"usage_{stage}")
    good = parse(judged.filter("error is null"), "output", stage).select("run_id", *keep, stage, usage)
    case = [c for c in keep if c == "vaers_id"]
    bad = judged.filter("error is not null").select("run_id", F.lit(stage).alias("stage"), "error", *case)
    return good, bad
