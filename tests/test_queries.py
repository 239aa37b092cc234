"""Named queries against DuckDB on the smallest tables."""

import os

import __spark_entry__ as entry
import compare
import pytest

from safetylake.plans import catalog

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUICK = [
    "product_scope", "pt_dictionary", "foundation_counts", "gt_case", "gt_seriousness", "eval_case",
    "eval_dashboard", "extraction_scorecard", "coding_prf", "product_recall", "signal_metrics",
    "signal_query", "screen_requests", "review_queue", "case_full", "open_cases", "csv_ingest",
    "validate_contract", "triage", "extract_case", "code_events", "ground_topk", "step_events",
    "run_two_stage", "failed_cases", "predicted_run", "stream_audit", "stream_case_status",
]
NAMES = list(catalog.QUERIES) if os.environ.get("TEST_ALL") else QUICK


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    columns, found = compare.spark_rows(entry.queries()[name](spark, SF_DIR))
    expected_columns, expected = compare.duck_rows(duck, entry.oracle_sql()[name])
    assert columns == expected_columns
    assert found == expected


def test_every_query_has_sql():
    assert set(catalog.QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
