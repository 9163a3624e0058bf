"""Structural checks on the physical plans of the registered queries."""

import re

import pytest

import __spark_entry__ as se
from conftest import SF001

WRITE_PATHS = {"pipeline_run", "risk_model_run", "stream_ingest", "stream_daily_counts",
               "stream_risk_refresh", "dlq_roundtrip", "feed_export_roundtrip",
               "dim_date_insert_or_ignore", "sk_lookup", "dim_insert_if_absent", "scd2_merge",
               "warehouse_catalog", "warehouse_export", "pipeline_ledgers", "load_gate", "payload_roundtrip"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(se.queries()) - WRITE_PATHS))
def test_no_cross_joins(spark, name):
    plan = plan_of(se.queries()[name](spark, SF001))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_flagship_windows_reuse_one_exchange(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(se.queries()["agent_risk_daily"](spark, SF001))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = plan.split("\n")
    first_window = next(i for i, l in enumerate(lines) if re.search(r"\bWindow\b", l))
    # Between the topmost window and the join below it there is no exchange:
    # every window reuses the join's hash partitioning on agent_sk.
    join = next(i for i in range(first_window, len(lines)) if "Join" in lines[i])
    assert not any("Exchange" in l for l in lines[first_window:join])
    assert "SortMergeJoin" in lines[join] or "BroadcastHashJoin" in lines[join]


def test_audit_reads_events_twice_and_shuffles_keys_once(spark):
    """The executed audit: two scans of events, five exchanges, one of them of (kind, value)."""
    df = se.queries()["dq_audit"](spark, SF001)
    assert len(df.collect()) == 5
    plan = plan_of(df).split("== Initial Plan ==")[0]
    nodes = [line.lstrip(" +-:*()0123456789") for line in plan.split("\n")]
    assert sum(n.startswith("FileScan") and "events.parquet" in n for n in nodes) == 2
    exchanges = [n for n in nodes if n.startswith("Exchange")]
    assert len(exchanges) <= 5
    assert sum("kind" in n and "value" in n for n in exchanges) == 1
    assert all("account_age_tier" in n for n in nodes if "Join" in n)   # the dimension's own tier matrix
