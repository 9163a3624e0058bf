"""Payload reader, feed export, load gate, incremental filter, streaming refresh."""

import json
import os
import uuid

from pyspark.sql import functions as F

from activity_engine.plans import pipeline as pl
from activity_engine.sources.payload import from_records, read_payload
from activity_engine.sources.sinks import CORRUPT_REASON, export_warehouse, read_dead_letters
from activity_engine.sources.tables import Warehouse

from test_dq import BAD
from test_pipeline import AGENT, CAMPAIGN, LEAD, acts


def new_wh(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / f"wh-{uuid.uuid4().hex[:6]}"))
    pl.init_warehouse(w, "2026-08-01", "2026-08-31")
    return w


def test_read_payload_json(spark, tmp_path):
    d = tmp_path / "payload"
    d.mkdir()
    doc = {"agents": [AGENT], "campaigns": [dict(CAMPAIGN, daily_budget=150.0)],
           "leads": [LEAD], "activities": acts(BAD)}
    (d / "batch1.json").write_text(json.dumps(doc))
    p = read_payload(spark, str(d))
    assert p.agents.count() == 1 and p.activities.count() == 5
    # arrival order follows list position
    order = [r.event_id for r in p.activities.orderBy("ingest_order").collect()]
    assert order == [b[0] for b in BAD]
    w = new_wh(spark, tmp_path)
    out = pl.run_pipeline(w, p, "json-run", str(tmp_path / "dlq"), now="2026-08-19 14:00:00")
    assert (out["records_loaded"], out["records_quarantined_dlq"]) == (2, 3)


def test_missing_list_is_empty(spark, tmp_path):
    d = tmp_path / "p2"
    d.mkdir()
    (d / "b.json").write_text(json.dumps({"agents": [AGENT]}))
    p = read_payload(spark, str(d))
    assert p.activities.count() == 0 and p.agents.count() == 1


def test_gate_blocks_failed_batch(spark, tmp_path):
    w = new_wh(spark, tmp_path)
    p = from_records(spark, [AGENT], [CAMPAIGN], [LEAD], acts(BAD))
    out = pl.run_pipeline(w, p, "gated", str(tmp_path / "dlq"), now="2026-08-19 14:00:00",
                          gate=True)
    assert out["status"] == "WARNING_DQ_THRESHOLD" and out["records_inserted"] == 0
    assert w.read("fact_outreach_activity").isEmpty()


def test_incremental_skips_old_events(spark, tmp_path):
    w = new_wh(spark, tmp_path)
    first = acts([("A1", "AGT-001", "LEAD-0001", "2026-08-10T10:00:00Z", "INVITE_SENT")])
    pl.run_pipeline(w, from_records(spark, [AGENT], [CAMPAIGN], [LEAD], first), "i1",
                    str(tmp_path / "dlq"), now="2026-08-20 00:00:00")
    second = acts([("A0", "AGT-001", "LEAD-0001", "2026-08-05T10:00:00Z", "INVITE_SENT"),
                   ("A2", "AGT-001", "LEAD-0001", "2026-08-12T10:00:00Z", "INVITE_SENT")])
    out = pl.run_pipeline(w, from_records(spark, [AGENT], [CAMPAIGN], [LEAD], second), "i2",
                          str(tmp_path / "dlq"), now="2026-08-20 00:00:00", incremental=True)
    assert out["records_inserted"] == 1
    assert sorted(r.event_id for r in w.read("fact_outreach_activity").collect()) == ["A1", "A2"]


def test_export_feeds_csv_and_parquet(spark, tmp_path):
    w = new_wh(spark, tmp_path)
    p = from_records(spark, [AGENT], [CAMPAIGN], [LEAD], acts(BAD))
    pl.run_pipeline(w, p, "exp", str(tmp_path / "dlq"), now="2026-08-19 14:00:00")
    pl.run_risk_model(w, now="2026-08-19 14:00:00")
    for fmt in ("csv", "parquet"):
        out = str(tmp_path / f"feeds-{fmt}")
        written = export_warehouse(w, out, fmt)
        assert set(written) >= {"dim_agent", "fact_outreach_activity", "fact_daily_agent_metric",
                                "dq_audit_log", "pipeline_runs", "dim_date"}
        reader = spark.read.option("header", True).csv if fmt == "csv" else spark.read.parquet
        assert reader(f"{out}/fact_outreach_activity").count() == 2


def test_stream_with_risk_refresh(spark, tmp_path):
    from activity_engine.streaming import stream as st
    w = new_wh(spark, tmp_path)
    pl.load_dimensions(w, from_records(spark, [AGENT], [CAMPAIGN], [LEAD], []), "2026-08-01")
    src = tmp_path / "incoming"
    rows = acts([(f"S{i}", "AGT-001", "LEAD-0001", f"2026-08-{1 + i % 9:02d}T10:00:00Z",
                  "INVITE_SENT") for i in range(30)])
    spark.createDataFrame([tuple(r.values()) for r in rows],
                          "event_id string, agent_id string, lead_id string, campaign_id string,"
                          " date_key int, event_timestamp string, event_type string,"
                          " message_length int, response_latency_hours double, is_converted int") \
        .withColumn("ingest_order", F.monotonically_increasing_id()) \
        .write.mode("overwrite").parquet(str(src))
    stream = st.read_event_stream(spark, str(src), "*.parquet")
    q = st.start_ingest(stream, w, str(tmp_path / "dlq"), str(tmp_path / "ckpt"),
                        now="2026-08-20 00:00:00", refresh_risk=True)
    q.awaitTermination()
    assert w.read("fact_outreach_activity").count() == 30
    assert w.read("fact_daily_agent_metric").count() == 9
    # a second run of the same files is a no-op (checkpoint + anti join)
    q = st.start_ingest(st.read_event_stream(spark, str(src), "*.parquet"), w,
                        str(tmp_path / "dlq"), str(tmp_path / "ckpt"), now="2026-08-20 00:00:00")
    q.awaitTermination()
    assert w.read("fact_outreach_activity").count() == 30


def test_stream_replayed_file_is_deduplicated(spark, tmp_path):
    """The same events delivered again in a second file leave the fact as is."""
    from activity_engine.streaming import stream as st
    w = new_wh(spark, tmp_path)
    pl.load_dimensions(w, from_records(spark, [AGENT], [CAMPAIGN], [LEAD], []), "2026-08-01")
    rows = acts([(f"R{i}", "AGT-001", "LEAD-0001", f"2026-08-{1 + i % 5:02d}T10:00:00Z",
                  "INVITE_SENT") for i in range(40)])
    schema = ("event_id string, agent_id string, lead_id string, campaign_id string,"
              " date_key int, event_timestamp string, event_type string,"
              " message_length int, response_latency_hours double, is_converted int")
    df = spark.createDataFrame([tuple(r.values()) for r in rows], schema) \
        .withColumn("ingest_order", F.monotonically_increasing_id())
    src = str(tmp_path / "in")
    df.write.mode("append").parquet(src)
    df.write.mode("append").parquet(src)          # the replay: a second copy
    stream = st.read_event_stream(spark, src, "*.parquet", max_files=1)
    q = st.start_ingest(stream, w, str(tmp_path / "dlq"), str(tmp_path / "ck"),
                        now="2026-08-20 00:00:00")
    q.awaitTermination()
    assert w.read("fact_outreach_activity").count() == 40
    runs = w.read("pipeline_runs").collect()
    assert len(runs) >= 1 and sum(r.records_inserted for r in runs) == 40
    assert all(r.run_id.startswith("stream-") for r in runs)
    assert w.read("dq_audit_log").count() == 5 * len(runs)


def fact_rows(spark, *rows):
    return spark.createDataFrame([(f"E{i}", a, t, d) for i, (a, d, t) in enumerate(rows)],
                                 "event_id string, agent_sk long, event_type string, date_key int")


def test_stream_daily_counts_follow_the_fact(spark, tmp_path):
    """Appends of one day after another, late days among them; a restart goes on from the state."""
    from activity_engine.operators.daily import daily_counts
    from activity_engine.streaming import stream as st
    w = Warehouse(spark, str(tmp_path / "wh"))
    loads = [[(1, 20260810, "INVITE_SENT")] * 3 + [(2, 20260810, "MESSAGE_SENT")],
             [(1, 20260801, "INVITE_SENT")] * 2 + [(1, 20260810, "INVITE_ACCEPTED")],       # late
             [(2, 20260811, "REPLY_RECEIVED"), (1, 20260801, "INVITE_SENT")]]
    for load in loads:
        w.append("fact_outreach_activity", fact_rows(spark, *load), ["date_key"])
        q = st.start_daily_counts(w, str(tmp_path / "ck"), fold_every=2)
        q.awaitTermination()
        got = sorted(map(tuple, st.read_daily_counts(w).collect()))
        assert got == sorted(map(tuple, daily_counts(w.read("fact_outreach_activity")).collect()))
    assert (1, 20260801, 3, 0, 0, 0) in got and (1, 20260810, 3, 1, 0, 0) in got
    parts = {r.batch_id for r in w.read(st.COUNTS).select("batch_id").distinct().collect()}
    assert st.FOLDED in parts                                    # the third micro-batch folded
    st.fold_daily_counts(w)
    assert sorted(map(tuple, st.read_daily_counts(w).collect())) == got
    assert {r.batch_id for r in w.read(st.COUNTS).select("batch_id").distinct().collect()} == {st.FOLDED}


def test_stream_daily_counts_replayed_micro_batch(spark, tmp_path):
    """A micro-batch written twice, once after a fold, changes no total."""
    from activity_engine.streaming import stream as st
    w = Warehouse(spark, str(tmp_path / "wh"))
    totals = "agent_sk long, date_key int, invites_sent long, invites_accepted long, messages_sent long," \
             " replies_received long, as_of int, batch_id int"

    def put(batch, sent):
        w.overwrite_partitions(st.COUNTS, spark.createDataFrame([(1, 20260801, sent, 0, 0, 0, batch, batch)], totals), "batch_id")

    put(0, 2)
    put(1, 5)
    put(1, 5)
    assert st.read_daily_counts(w).first().invites_sent == 5
    st.fold_daily_counts(w)
    put(0, 2)
    put(1, 5)
    assert [r.invites_sent for r in st.read_daily_counts(w).collect()] == [5]


def test_read_activity_files_orders_by_row(spark, tmp_path):
    from activity_engine.sources.payload import read_activity_files
    rows = acts([(f"F{i}", "AGT-001", "LEAD-0001", "2026-08-02T10:00:00Z", "INVITE_SENT")
                 for i in range(50)])
    rows.append(dict(rows[0], event_type="MESSAGE_SENT"))     # a later duplicate of F0
    path = str(tmp_path / "flat")
    spark.createDataFrame([tuple(r.values()) for r in rows],
                          "event_id string, agent_id string, lead_id string, campaign_id string,"
                          " date_key int, event_timestamp string, event_type string,"
                          " message_length int, response_latency_hours double, is_converted int") \
        .coalesce(1).write.parquet(path)
    a = read_activity_files(spark, path)
    assert a.count() == 51
    w = new_wh(spark, tmp_path)
    pl.load_dimensions(w, from_records(spark, [AGENT], [CAMPAIGN], [LEAD], []), "2026-08-01")
    out = pl.ingest_activities(w, a, "flat-run", str(tmp_path / "dlq"), "2026-08-20 00:00:00")
    assert out["records_inserted"] == 50
    f0 = w.read("fact_outreach_activity").where("event_id = 'F0'").first()
    assert f0.event_type == "INVITE_SENT"                       # first arrival kept


def test_cli_steps(spark, tmp_path):
    from activity_engine.__main__ import parse, run
    d = tmp_path / "payload"
    d.mkdir()
    doc = {"agents": [AGENT], "campaigns": [CAMPAIGN], "leads": [LEAD], "activities": acts(BAD)}
    (d / "b.json").write_text(json.dumps(doc))
    root = str(tmp_path / "cli-wh")
    r = run(spark, parse(["init", "--warehouse", root, "--start", "2026-08-01",
                          "--end", "2026-08-31"]))
    assert r[0]["dates_added"] == 31
    r = run(spark, parse(["all", "--warehouse", root, "--payload", str(d), "--run-id", "cli",
                          "--format", "parquet"]))
    ingest, risk_step, export = r
    assert (ingest["records_loaded"], ingest["records_quarantined_dlq"]) == (2, 3)
    assert risk_step["records_processed"] == 1
    assert "fact_outreach_activity" in export["tables"]


def test_documents_are_parsed_once(spark, tmp_path, monkeypatch):
    """Dimensions, activities and corrupt documents come from one read: the files may change after it."""
    d = tmp_path / "once"
    d.mkdir()
    doc = {"agents": [AGENT], "campaigns": [CAMPAIGN], "leads": [LEAD], "activities": acts(BAD)}
    (d / "a.json").write_text(json.dumps(doc) + '\n{"activities": [{"event_id": \n')
    load = pl.load_dimensions

    def after_the_read(*args):
        (d / "a.json").write_text("{}\n")
        return load(*args)

    monkeypatch.setattr(pl, "load_dimensions", after_the_read)
    w, dlq = new_wh(spark, tmp_path), str(tmp_path / "once-dlq")
    out = pl.run_pipeline(w, read_payload(spark, str(d), multi_line=False), "once", dlq, now="2026-08-19 14:00:00")
    assert (out["records_loaded"], out["records_quarantined_dlq"]) == (2, 3)
    assert w.read("dim_agent").count() == w.read("dim_lead").count() == w.read("dim_campaign").count() == 1
    assert read_dead_letters(spark, dlq).where(F.col("failure_reason") == CORRUPT_REASON).count() == 1


def test_lists_of_unequal_length_side_by_side(spark, tmp_path):
    """Records keep their own position; null records, lists that are null or missing give none."""
    d = tmp_path / "uneven"
    d.mkdir()
    docs = [{"agents": [dict(AGENT, agent_id=f"A{i}") for i in range(3)], "leads": [None, LEAD], "activities": acts(BAD[:1])},
            {"agents": None, "campaigns": [], "activities": [None, *acts(BAD[1:3])]}, {}]
    (d / "a.json").write_text("\n".join(map(json.dumps, docs)))
    p = read_payload(spark, str(d), multi_line=False)
    places = {name: sorted((r[0], r.p) for r in getattr(p, name).select(key, "ingest_order.p").collect())
              for name, key in (("agents", "agent_id"), ("leads", "lead_id"), ("campaigns", "campaign_id"), ("activities", "event_id"))}
    assert places == {"agents": [("A0", 0), ("A1", 1), ("A2", 2)], "leads": [(LEAD["lead_id"], 1)], "campaigns": [],
                      "activities": sorted([(BAD[0][0], 0), (BAD[1][0], 1), (BAD[2][0], 2)])}
    assert p.corrupt.count() == 0


def test_a_value_of_another_type_makes_its_document_corrupt_in_any_list(spark, tmp_path):
    d = tmp_path / "typed"
    d.mkdir()
    rows = acts(BAD)
    rows[1]["message_length"] = "long"
    text = json.dumps({"leads": [LEAD], "activities": rows})
    (d / "a.json").write_text(text)
    p = read_payload(spark, str(d), multi_line=False)
    assert [r.record for r in p.corrupt.collect()] == [text]
    assert p.leads.count() == 1


def test_a_cached_arrival_order_is_held_as_columns(spark):
    df = spark.createDataFrame([("E1", (1, "f", 0), 5), ("E2", (1, "f", 1), 6)],
                               "event_id string, ingest_order struct<t: long, f: string, p: int>, n int")
    held, rows = pl._held(df)
    try:
        assert not [f.name for f in held.schema.fields if f.dataType.typeName() == "struct"]
        assert rows.columns == df.columns and sorted(rows.collect()) == sorted(df.collect())
        assert "InMemoryTableScan" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        held.unpersist()
