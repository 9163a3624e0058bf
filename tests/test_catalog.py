"""The typed catalog in use, all-table export, payload names and corrupt documents."""

import json

import pytest
from pyspark.sql import functions as F

from activity_engine.plans import pipeline as pl
from activity_engine.schemas import TABLES, violations
from activity_engine.sources.payload import from_records, read_payload
from activity_engine.sources.sinks import CORRUPT_REASON, export_warehouse, read_dead_letters, write_dead_letters
from activity_engine.sources.tables import Warehouse

from test_pipeline import AGENT, CAMPAIGN, LEAD, acts


@pytest.fixture()
def wh(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "wh"))
    pl.init_warehouse(w, "2026-08-01", "2026-08-05")
    return w


def test_init_creates_every_table_and_export_has_all(spark, wh, tmp_path):
    assert {t: (wh.read(t).count(), wh.read(t).columns) for t in TABLES} == {
        t: (5 if t == "dim_date" else 0, s.names) for t, s in TABLES.items()}
    assert [f.dataType for f in wh.read("dim_campaign").schema] == [f.dataType for f in TABLES["dim_campaign"]]
    assert pl.init_warehouse(wh, "2026-08-01", "2026-08-06") == 1          # again: only the new day
    assert set(export_warehouse(wh, str(tmp_path / "out"))) == set(TABLES)
    for t, s in TABLES.items():
        assert spark.read.option("header", True).csv(str(tmp_path / "out" / t)).columns == s.names


def test_writes_are_typed(spark, wh):
    odd = spark.createDataFrame([(1, "C1", "Name", "12.5", "more")], "campaign_sk int, campaign_id string,"
                                " campaign_name string, daily_budget string, not_in_catalog string")
    wh.append("dim_campaign", odd)
    row = wh.read("dim_campaign").first()
    assert float(row.daily_budget) == 12.5 and row.status is None and "not_in_catalog" not in row.asDict()


def test_violations(spark):
    rows = spark.createDataFrame([(1, "A", 1), (1, "A", 1), (2, "A", 0), (3, None, 1)], "agent_sk long, agent_id string, is_current int")
    v = violations(rows, "dim_agent", TABLES["dim_agent"].__class__(
        [f for f in TABLES["dim_agent"] if f.name in rows.columns])).first()
    assert (v.rows, v.null_fields, v.duplicate_keys) == (4, 1, 2)      # a key twice, two current versions


def test_payload_names_and_corrupt_documents(spark, wh, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    linked = {k: v for k, v in AGENT.items() if k != "profile_url"} | {"linkedin_profile_url": "https://x/1"}
    good = acts([("E1", "AGT-001", "LEAD-0001", "2026-08-01T10:00:00Z", "INVITE_SENT")])
    (folder / "a.json").write_text(json.dumps({"agents": [linked], "campaigns": [CAMPAIGN], "leads": [LEAD], "activities": good}, indent=1))
    (folder / "b.json").write_text('{"activities": [{"event_id": "E2", ')
    (folder / "c.json").write_text("")
    p = read_payload(spark, str(folder))
    assert p.agents.first().profile_url == "https://x/1" and p.activities.count() == 1
    assert [r.record for r in p.corrupt.collect()] == ['{"activities": [{"event_id": "E2", ']
    out = pl.run_pipeline(wh, p, "run", str(tmp_path / "dlq"), now="2026-08-05 00:00:00")
    assert out["records_inserted"] == 1
    dead = read_dead_letters(spark, str(tmp_path / "dlq")).collect()
    assert [(r.failure_reason, r.run_id) for r in dead] == [(CORRUPT_REASON, "run")]
    own = read_payload(spark, str(folder), names={("agents", "agent_name"): ("linkedin_profile_url",)})
    assert own.agents.first().agent_name == AGENT["agent_name"] and own.agents.first().profile_url is None


def test_a_retry_without_dead_rows_replaces_the_earlier_ones(spark, tmp_path):
    path = str(tmp_path / "dlq")
    dead = spark.createDataFrame([(("E1",), "why")], "record struct<event_id: string>, failure_reason string") \
        .withColumn("timestamp", F.current_timestamp())
    write_dead_letters(dead, path, "run")
    write_dead_letters(dead, path, "other")
    write_dead_letters(dead.limit(0), path, "run")
    assert [r.run_id for r in read_dead_letters(spark, path).collect()] == ["other"]


def test_records_without_documents_have_none_corrupt(spark):
    assert from_records(spark).corrupt is None
