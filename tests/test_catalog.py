"""Registered queries beside their SQL on the smallest tables; tools/check.py runs all of them."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import rows_of

SF = "/root/testdata/sf0.001"
PICK = ("entity_daily_activity", "first_seens", "feed_coverage", "iam_changes", "query_events", "record_match", "claimed_alerts",
        "deadman_fold", "sequence_two_slot", "normalize_gcp_audit", "create_then_grant", "correlated_chains", "technique_checks",
        "score_hunt", "alert_lifecycle", "incident_markdown", "sliding_window_stream", "stream_ingest",
        "rule_index_deadman", "first_seens_kept", "ordered_sequence", "absence_per_group", "sort_any_whole", "incident_reports",
        "template_sections", "keyed_state", "bounded_results", "log_search_indexed")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def test_every_query_has_sql():
    from vigilake.catalog import registry

    assert set(registry()) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", PICK)
def test_same_as_sql(spark, con, name):
    got, want = entry.queries()[name](spark, SF).toPandas(), con.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows_of(got) == rows_of(want)
