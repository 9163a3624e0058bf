"""Ingest pipeline end to end: bad-data batch, idempotency, watermark, DLQ."""

import os
import uuid

from pyspark.sql import functions as F

from activity_engine.config import DEFAULT_WATERMARK
from activity_engine.plans import pipeline as pl
from activity_engine.sources.payload import from_records
from activity_engine.sources.sinks import read_dead_letters
from activity_engine.sources.tables import Warehouse

from test_dq import BAD

AGENT = dict(agent_id="AGT-001", agent_name="Agent One", profile_url="u",
             account_age_tier="1+ Year", risk_classification="Minimal Risk",
             daily_invite_ceiling=30, daily_message_ceiling=60, status="ACTIVE")
CAMPAIGN = dict(campaign_id="CMP-101", campaign_name="Launch", target_segment="SaaS",
                daily_budget=None, start_date=None, end_date=None, status="ACTIVE")
LEAD = dict(lead_id="LEAD-0001", first_name="Ada", last_name="L", job_title="CTO",
            company_name="X", industry="Software", location="EU", target_segment="SaaS")


def acts(rows):
    return [dict(event_id=e, agent_id=a, lead_id=l, campaign_id="CMP-101",
                 date_key=int(t[:10].replace("-", "")) if t else 20260819,
                 event_timestamp=t, event_type=ty, message_length=None,
                 response_latency_hours=None, is_converted=None) for e, a, l, t, ty in rows]


def wh(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / f"wh-{uuid.uuid4().hex[:6]}"))
    pl.init_warehouse(w, "2026-08-01", "2026-08-31")
    return w


def test_bad_batch(spark, tmp_path):
    w = wh(spark, tmp_path)
    p = from_records(spark, [AGENT], [CAMPAIGN], [LEAD], acts(BAD))
    dlq = str(tmp_path / "dlq")
    out = pl.run_pipeline(w, p, "demo-bad-data-test", dlq, now="2026-08-19 14:00:00")
    assert out["records_ingested"] == 5
    assert out["records_loaded"] == 2
    assert out["records_quarantined_dlq"] == 3
    assert out["dq_score"] == 88.33
    assert out["status"] == "WARNING_DQ_THRESHOLD"
    fact = w.read("fact_outreach_activity")
    assert sorted(r.event_id for r in fact.collect()) == ["BAD-003", "GOOD-001"]
    dead = read_dead_letters(spark, dlq)
    ids = sorted(r.record.split('"event_id":"')[1].split('"')[0] for r in dead.collect())
    assert ids == ["BAD-001", "BAD-002", "BAD-004"]
    # nulls are written out in the record
    assert any('"lead_id":null' in r.record for r in dead.collect())


def test_idempotent_rerun(spark, tmp_path):
    w = wh(spark, tmp_path)
    good = [(f"E{i}", "AGT-001", "LEAD-0001", f"2026-08-{10 + i % 5:02d}T10:00:00Z",
             "INVITE_SENT") for i in range(20)]
    p = from_records(spark, [AGENT], [CAMPAIGN], [LEAD], acts(good))
    dlq = str(tmp_path / "dlq")
    r1 = pl.run_pipeline(w, p, "run-1", dlq, now="2026-08-20 00:00:00")
    n1 = w.read("fact_outreach_activity").count()
    r2 = pl.run_pipeline(w, p, "run-2", dlq, now="2026-08-20 00:00:00")
    n2 = w.read("fact_outreach_activity").count()
    assert n1 == n2 == 20
    assert r1["records_inserted"] == 20 and r2["records_inserted"] == 0
    assert r2["records_loaded"] == 20        # the source's counter counts valid rows
    assert w.read("dim_agent").count() == 1
    assert w.read("pipeline_runs").count() == 2
    # same run id again replaces its ledger rows instead of failing
    pl.run_pipeline(w, p, "run-2", dlq, now="2026-08-20 00:00:00")
    assert w.read("pipeline_runs").count() == 2
    assert w.read("dq_audit_log").count() == 10


def test_daily_counts_track_the_fact(spark, tmp_path):
    from activity_engine.operators.daily import daily_counts
    w = wh(spark, tmp_path)
    for run, days in (("a", range(1, 6)), ("b", range(4, 9))):
        rows = acts([(f"{run}{d}-{k}", "AGT-001", "LEAD-0001", f"2026-08-{d:02d}T1{k}:00:00Z",
                      ("INVITE_SENT", "MESSAGE_SENT", "INVITE_ACCEPTED")[k % 3])
                     for d in days for k in range(3)])
        pl.run_pipeline(w, from_records(spark, [AGENT], [CAMPAIGN], [LEAD], rows), run,
                        str(tmp_path / "dlq"), now="2026-08-20 00:00:00")
    kept = {tuple(r) for r in w.read("agent_daily_counts").select(
        "agent_sk", "date_key", "invites_sent", "invites_accepted", "messages_sent",
        "replies_received").collect()}
    full = {tuple(r) for r in daily_counts(w.read("fact_outreach_activity")).select(
        "agent_sk", "date_key", "invites_sent", "invites_accepted", "messages_sent",
        "replies_received").collect()}
    assert kept == full and len(full) == 8


def test_rerun_same_run_id_keeps_one_dlq_copy(spark, tmp_path):
    w = wh(spark, tmp_path)
    p = from_records(spark, [AGENT], [CAMPAIGN], [LEAD], acts(BAD))
    dlq = str(tmp_path / "dlq")
    for _ in range(2):
        pl.run_pipeline(w, p, "same-run", dlq, now="2026-08-19 14:00:00")
    assert read_dead_letters(spark, dlq).count() == 3
    pl.run_pipeline(w, p, "other-run", dlq, now="2026-08-19 14:00:00")
    assert read_dead_letters(spark, dlq).count() == 6


def test_vacuum_keeps_newest_versions(spark, tmp_path):
    w = wh(spark, tmp_path)
    for n in (1, 2, 3):
        w.rewrite("numbers", spark.range(n))
    assert len(w.versions("numbers")) == 3
    w.vacuum("numbers", keep=1)
    assert len(w.versions("numbers")) == 1
    assert w.read("numbers").count() == 3


def test_ledgers_replace_only_their_run(spark, tmp_path):
    w = wh(spark, tmp_path)
    p = from_records(spark, [AGENT], [CAMPAIGN], [LEAD], acts(BAD))
    for r in ("v1", "2026", "v1"):
        pl.run_pipeline(w, p, r, str(tmp_path / "dlq"), now="2026-08-19 14:00:00")
    assert w.versions("pipeline_runs") == [1]
    assert {r.run_id for r in w.read("pipeline_runs").collect()} == {"v1", "2026"}
    assert w.read("dq_audit_log").count() == 10
    bad = {(r.pipeline_run_id, r.value) for r in w.read("dq_invalid_values").collect()}
    assert {run for run, _ in bad} <= {"v1", "2026"}


def test_replay_on_another_day_is_ignored(spark, tmp_path):
    """An event id is unique over the whole fact, whatever day its replay carries."""
    w = wh(spark, tmp_path)
    first = acts([("E1", "AGT-001", "LEAD-0001", "2026-08-01T10:00:00Z", "INVITE_SENT")])
    again = acts([("E1", "AGT-001", "LEAD-0001", "2026-08-02T10:00:00Z", "INVITE_SENT")])
    for run, rows in (("a", first), ("b", again)):
        p = from_records(spark, [AGENT], [CAMPAIGN], [LEAD], rows)
        out = pl.run_pipeline(w, p, run, str(tmp_path / "dlq"), now="2026-08-19 14:00:00")
    assert out["records_inserted"] == 0
    assert [r.date_key for r in w.read("fact_outreach_activity").collect()] == [20260801]


def test_first_arrival_wins_within_batch(spark, tmp_path):
    w = wh(spark, tmp_path)
    rows = acts([("DUP", "AGT-001", "LEAD-0001", "2026-08-19T10:00:00Z", "INVITE_SENT"),
                 ("DUP", "AGT-001", "LEAD-0001", "2026-08-19T10:00:00Z", "MESSAGE_SENT")])
    p = from_records(spark, [AGENT], [CAMPAIGN], [LEAD], rows)
    pl.run_pipeline(w, p, "r", str(tmp_path / "dlq"), now="2026-08-20 00:00:00")
    got = w.read("fact_outreach_activity").collect()
    assert [(r.event_id, r.event_type) for r in got] == [("DUP", "INVITE_SENT")]


def test_watermark_default_and_roundtrip(spark, tmp_path):
    w = wh(spark, tmp_path)
    assert pl.get_watermark(w) == DEFAULT_WATERMARK
    p = from_records(spark, [AGENT], [CAMPAIGN], [LEAD], acts(BAD))
    out = pl.run_pipeline(w, p, "wm", str(tmp_path / "dlq"), now="2026-08-19 14:00:00")
    assert out["watermark"].startswith("2026-08-19T13:00:00")
    assert pl.get_watermark(w) == out["watermark"]
    older = acts([("OLD", "AGT-001", "LEAD-0001", "2026-08-01T00:00:00Z", "INVITE_SENT")])
    out2 = pl.run_pipeline(w, from_records(spark, [AGENT], [CAMPAIGN], [LEAD], older), "wm2",
                           str(tmp_path / "dlq"), now="2026-08-19 14:00:00")
    assert out2["watermark"] == out["watermark"]    # monotonic


def test_risk_model_upsert(spark, tmp_path):
    w = wh(spark, tmp_path)
    rows = [(f"E{d}-{k}", "AGT-001", "LEAD-0001", f"2026-08-{d:02d}T10:00:00Z",
             "INVITE_SENT" if k < 5 else "INVITE_ACCEPTED")
            for d in range(1, 16) for k in range(5 + (2 if d <= 10 else 0))]
    p = from_records(spark, [AGENT], [CAMPAIGN], [LEAD], acts(rows))
    pl.run_pipeline(w, p, "r1", str(tmp_path / "dlq"), now="2026-08-20 00:00:00")
    s1 = pl.run_risk_model(w, now="2026-08-20 00:00:00")
    assert s1["records_processed"] == 15
    s2 = pl.run_risk_model(w, now="2026-08-21 00:00:00")
    m = w.read("fact_daily_agent_metric")
    assert m.count() == 15                      # upsert, not append
    assert s2["critical_risk_count"] == s1["critical_risk_count"] >= 1
    assert m.where(F.col("recommended_invite_capacity") > 30).count() == 0


def test_scd2_option(spark, tmp_path):
    w = wh(spark, tmp_path)
    p = from_records(spark, [AGENT], [CAMPAIGN], [LEAD], [])
    pl.load_dimensions(w, p, now="2026-08-01 00:00:00")
    changed = dict(AGENT, status="PAUSED")
    p2 = from_records(spark, [changed], [CAMPAIGN], [LEAD], [])
    pl.load_dimensions(w, p2, now="2026-08-02 00:00:00", track_agent_columns=["status"])
    d = {(r.agent_sk, r.status, r.is_current) for r in w.read("dim_agent").collect()}
    assert d == {(1, "ACTIVE", 0), (2, "PAUSED", 1)}


def test_empty_partitioned_version_reads_as_absent(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "wh-empty"))
    empty = spark.createDataFrame([], "agent_id string, date_key int, n long")
    w.overwrite_partitions("t", empty, "date_key")
    assert w.versions("t") == [1] and w.read("t") is None
    w.overwrite_partitions("t", spark.createDataFrame([("A", 1, 2)], empty.schema), "date_key")
    assert w.read("t").count() == 1


def test_daily_counts_repair_after_lost_step(spark, tmp_path):
    """Fact rows appended without the counts step (a run that died between
    the two) are detected by the coverage check and recounted."""
    from activity_engine.operators.daily import daily_counts
    w = wh(spark, tmp_path)
    first = acts([(f"a{k}", "AGT-001", "LEAD-0001", "2026-08-03T10:00:00Z", "INVITE_SENT")
                  for k in range(4)])
    pl.run_pipeline(w, from_records(spark, [AGENT], [CAMPAIGN], [LEAD], first), "r1",
                    str(tmp_path / "dlq"), now="2026-08-20 00:00:00")
    fact = w.read("fact_outreach_activity")
    lost = fact.limit(1).withColumn("event_id", F.lit("lost-1"))
    w.append("fact_outreach_activity", lost.select(*fact.columns), partition_by=["date_key"])
    second = acts([("b1", "AGT-001", "LEAD-0001", "2026-08-03T11:00:00Z", "INVITE_ACCEPTED")])
    pl.run_pipeline(w, from_records(spark, [AGENT], [CAMPAIGN], [LEAD], second), "r2",
                    str(tmp_path / "dlq"), now="2026-08-20 00:00:00")
    cols = ["agent_sk", "date_key", "invites_sent", "invites_accepted"]
    kept = {tuple(r) for r in w.read("agent_daily_counts").select(*cols).collect()}
    full = {tuple(r) for r in daily_counts(w.read("fact_outreach_activity")).select(*cols).collect()}
    assert kept == full == {(1, 20260803, 5, 1)}


def test_invalid_values_are_written_by_many_tasks(spark, tmp_path):
    w = wh(spark, tmp_path)
    batch = acts((f"E{i}", "AGT-001", "LEAD-0001", "2026-08-19 10:00:00", f"TYPE-{i}") for i in range(5000))
    key = "spark.sql.adaptive.coalescePartitions.enabled"  # few rows here: they stay as dealt
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        for _ in range(2):  # the first write and one that replaces it
            pl.run_pipeline(w, from_records(spark, [AGENT], [CAMPAIGN], [LEAD], batch), "many-types", str(tmp_path / "dlq"),
                            now="2026-08-19 14:00:00")
            ledger = w.read("dq_invalid_values").where("value is not null")
            assert ledger.count() == 5000 == ledger.select("value").distinct().count()
            assert ledger.select(F.input_file_name()).distinct().count() > 1
    finally:
        spark.conf.set(key, before)
