"""End-to-end runs over a Parquet warehouse.

Every step is a DataFrame plan that Spark distributes; the driver only
sees bounded scalars (row counts from ``Observation``, the five audit rows,
one run row). Each step is idempotent, so a rerun after a failure converges
to the same tables.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from activity_engine.config import (DEFAULT_WATERMARK, SOURCE_SYSTEM, CALENDAR_END,
                                    CALENDAR_START, DQConfig, RiskConfig)
from activity_engine.functions.dates import calendar
from activity_engine.operators import ingest, quality
from activity_engine.operators.dims import insert_if_absent, scd2_merge
from activity_engine.operators.keys import resolve_keys, staged_surrogate_keys
from activity_engine.plans.risk_snapshot import AGENTS_PER_PART, PARTS, SNAPSHOT, RiskSnapshot
from activity_engine.sources.event_index import EventIdIndex
from activity_engine.sources.payload import Payload
from activity_engine.sources.sinks import corrupt_letters, write_dead_letters
from activity_engine.sources.tables import Warehouse

#: Columns that tables are partitioned by: days, runs of a ledger, parts of the snapshot.
PARTITIONED = {"fact_outreach_activity": ["date_key"], "dq_audit_log": ["_run"], "pipeline_runs": ["_run"],
               SNAPSHOT: PARTS}
WATERMARK_FMT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def _now_lit(now) -> F.Column:
    if now is None:
        return F.current_timestamp()
    if isinstance(now, _dt.datetime):
        now = now.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.to_timestamp(F.lit(now))


# -- E6 ----------------------------------------------------------------------------

def init_warehouse(wh: Warehouse, start: str = CALENDAR_START, end: str = CALENDAR_END) -> int:
    """Every table of the catalog, empty, then the calendar insert-or-ignore."""
    for table in wh.catalog:
        if table != "dim_date":
            wh.create(table, PARTITIONED.get(table))
    cal = calendar(wh.spark, start, end)
    cur = wh.read("dim_date")
    new = cal if cur is None else cal.join(cur.select("date_key"), "date_key", "left_anti")
    obs = Observation("dates")
    wh.append("dim_date", new.observe(obs, F.count(F.lit(1)).alias("n")))
    return int(obs.get["n"])


# -- E1 ----------------------------------------------------------------------------

def load_dimensions(wh: Warehouse, payload: Payload, now=None,
                    track_agent_columns: list[str] | None = None) -> None:
    """Insert-if-absent for all three dimensions; optional SCD2 for agents.

    The three loads touch different tables, so their (small) jobs are
    submitted concurrently instead of one after another.
    """
    now_c = _now_lit(now)
    with ThreadPoolExecutor(max_workers=3) as pool:
        futures = [pool.submit(_load_agents, wh, payload.agents, now_c, track_agent_columns),
                   pool.submit(_load_simple_dim, wh, "dim_campaign", "campaign_id",
                               "campaign_sk", payload.campaigns, "campaign_name"),
                   pool.submit(_load_simple_dim, wh, "dim_lead", "lead_id", "lead_sk",
                               payload.leads, None)]
        for f in futures:
            f.result()


def _numbered_by(wh: Warehouse, table: str):
    """Assigns the keys of new rows of ``table``, which are staged in the warehouse."""
    return partial(staged_surrogate_keys, partial(wh.rewrite, f"{table}_staged"))


def _load_agents(wh: Warehouse, agents: DataFrame, now_c, track_agent_columns) -> None:
    """J6 (insert when no current version) or J7 (SCD2 on tracked columns)."""
    agents = agents.where(F.col("agent_id").isNotNull())
    cur = wh.read("dim_agent")
    meta = [now_c.alias("effective_date"), F.lit(None).cast("timestamp").alias("end_date"),
            F.lit(1).alias("is_current")]
    if cur is not None and track_agent_columns:
        merged = scd2_merge(cur, agents.drop("ingest_order"), "agent_id", "agent_sk",
                            track_agent_columns, now_c)
        wh.rewrite("dim_agent", merged)
        return
    base = cur if cur is not None else \
        agents.limit(0).withColumn("agent_sk", F.lit(0).cast("long")).withColumn(
            "is_current", F.lit(1))
    new = insert_if_absent(base, agents, "agent_id", "agent_sk", current_only=True,
                           order_col="ingest_order", number=_numbered_by(wh, "dim_agent"))
    cols = ["agent_sk", *[c for c in agents.columns if c != "ingest_order"]]
    out = new.select(*cols, *meta)
    wh.append("dim_agent", out if cur is None else out.select(*cur.columns))
    wh.vacuum("dim_agent_staged", 1)


def _load_simple_dim(wh: Warehouse, table: str, key: str, sk: str, recs: DataFrame,
                     required: str | None) -> None:
    """Insert-or-ignore on the natural key."""
    recs = recs.where(F.col(key).isNotNull())
    if required:  # NOT NULL columns: such records are skipped, as an ignored insert
        recs = recs.where(F.col(required).isNotNull())
    cur = wh.read(table)
    base = cur if cur is not None else recs.limit(0).withColumn(sk, F.lit(0).cast("long"))
    new = insert_if_absent(base, recs, key, sk, order_col="ingest_order", number=_numbered_by(wh, table))
    cols = [sk, *[c for c in recs.columns if c != "ingest_order"]]
    wh.append(table, new.select(*cols) if cur is None else new.select(*cur.columns))
    wh.vacuum(f"{table}_staged", 1)


# -- E2 ----------------------------------------------------------------------------

def _counted(df: DataFrame) -> DataFrame:
    """``df`` cached and filled, so that joins with it are planned by its real size."""
    df = df.persist()
    df.count()
    return df


def _held(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``df`` cached, and what reads it.

    An arrival order that is a struct is cached as columns: of these each batch of rows
    keeps a file's path once, of a struct every row keeps it.
    """
    order = next((f for f in df.schema.fields if f.name == "ingest_order"), None)
    if order is None or not isinstance(order.dataType, T.StructType):
        return df.persist(), df
    parts = [F.col(f"ingest_order.{f}").alias(f"_order_{f}") for f in order.dataType.names]
    held = df.select(*[c for c in df.columns if c != "ingest_order"], *parts).persist()
    whole = F.struct(*[F.col(f"_order_{f}").alias(f) for f in order.dataType.names]).alias("ingest_order")
    return held, held.select(*[whole if c == "ingest_order" else F.col(c) for c in df.columns])


def load_facts(wh: Warehouse, activities: DataFrame, run_id: str, dlq_path: str,
               now=None, watermark: str | None = None, corrupt: DataFrame | None = None,
               repeated: DataFrame | None = None) -> dict:
    """J1 -> F4/F5 -> S6 and P5 -> W9 -> J4 -> append (partitioned by day).

    ``repeated`` are the cached ``repeated_hashes`` of the event ids, where the caller has them.
    Returns ``valid`` (rows passing the quarantine, the studied pipeline's
    "loaded" count), ``inserted`` (new fact rows) and ``quarantined``.
    """
    spark = wh.spark
    dims = [wh.read(t) for t in ("dim_agent", "dim_lead", "dim_campaign")]
    if any(d is None for d in dims):
        raise RuntimeError("initialise the warehouse before loading facts")
    batch = activities
    if watermark is not None:  # X6: only events after the high-watermark
        ts = F.try_to_timestamp(F.col("event_timestamp").cast("string"))
        batch = batch.where(ts.isNull() | (ts > F.to_timestamp(F.lit(watermark.replace("Z", "")))))
    held, resolved = _held(resolve_keys(batch, *dims))
    new = own = None
    try:
        valid, dead = ingest.split_quarantine(resolved, list(batch.columns), _now_lit(now))
        write_dead_letters(dead, dlq_path, run_id,
                           None if corrupt is None else corrupt_letters(corrupt, _now_lit(now)))
        # Valid/quarantined counts: one aggregate over the cached batch.
        bad = ingest.quarantine_flag(resolved)
        c = resolved.agg(F.count_if(~bad).alias("valid"), F.count_if(bad).alias("dead")).first()
        rows = ingest.to_fact_rows(valid)
        if repeated is None:
            repeated = own = _counted(ingest.repeated_hashes(rows, "event_id"))
        deduped = ingest.dedupe_repeated(rows, repeated, "event_id", "ingest_order")
        # The rows to insert are cached and counted before the append, so the
        # count and both writes see the same rows (the anti join read the index
        # as it was before).
        index = EventIdIndex(wh)
        new = index.unseen(deduped, valid.select("event_id")).drop("ingest_order").persist()
        inserted = new.count()
        if inserted:
            # rebalance: few files per day partition; AQE splits a hot day into
            # several tasks and merges small ones (no task owns a skewed day).
            index.insert(new, inserted, lambda r: wh.append(
                "fact_outreach_activity", r.hint("rebalance", "date_key"), partition_by=["date_key"]))
        # Always, even with nothing new: a run that died after its append but
        # before this step is repaired by the rerun.
        refresh_daily_counts(wh, valid.select("date_key").distinct())
    finally:
        for frame in (new, own, held):
            if frame is not None:
                frame.unpersist()
    return {"valid": int(c["valid"]), "inserted": int(inserted), "quarantined": int(c["dead"])}


def _counts_with_coverage(fact: DataFrame) -> DataFrame:
    """Agent × day counts plus ``fact_rows``: how many fact rows they cover."""
    et = F.col("event_type")
    types = (("invites_sent", "INVITE_SENT"), ("invites_accepted", "INVITE_ACCEPTED"),
             ("messages_sent", "MESSAGE_SENT"), ("replies_received", "REPLY_RECEIVED"))
    return fact.groupBy("agent_sk", "date_key").agg(
        *[F.count_if(et == t).cast("long").alias(n) for n, t in types],
        F.count(F.lit(1)).alias("fact_rows"))


def refresh_daily_counts(wh: Warehouse, days: DataFrame | None = None) -> None:
    """Keep ``agent_daily_counts`` (A1 before the joins) in step with the fact.

    Of the touched ``days`` (rows of ``date_key``; None: every day) those whose
    stored coverage differs from the fact's row count are counted again from the
    fact and replaced; days that agree are left alone. The days stay a DataFrame,
    and semi-joins on the partition column let Spark read only their partitions.
    A run that died between its append and this step is repaired the same way.
    """
    fact = wh.read("fact_outreach_activity")
    if fact is None:
        return
    old = wh.read("agent_daily_counts")
    if old is not None and days is not None:
        actual = (fact.join(days, "date_key", "left_semi").groupBy("date_key")
                  .agg(F.count(F.lit(1)).alias("rows")))
        covered = old.join(days, "date_key", "left_semi").groupBy("date_key").agg(F.sum("fact_rows").alias("covered"))
        stale = (actual.join(covered, "date_key", "left")
                 .where(~F.col("rows").eqNullSafe(F.col("covered"))).select("date_key"))
        if stale.isEmpty():
            return
        fact = fact.join(stale, "date_key", "left_semi")
    elif days is not None:
        fact = fact.join(days, "date_key", "left_semi")
    counts = _counts_with_coverage(fact)
    if old is not None:
        # Which days are stale reads the table that is written: the result goes to a
        # table of its own first.
        wh.rewrite("agent_daily_counts_staged", counts)
        counts = wh.read("agent_daily_counts_staged")
    wh.overwrite_partitions("agent_daily_counts", counts.hint("rebalance", "date_key"), "date_key")


def replace_run(wh: Warehouse, table: str, rows: DataFrame, run_id: str, few: bool = True) -> None:
    """Replace one run's rows of a ledger; other runs' files are not touched.

    The marker row keeps a run's partition in place when it has no rows. Only a ledger
    of ``few`` rows, whatever the batch, is written by one task.
    """
    key = "run-" + hashlib.sha1(run_id.encode()).hexdigest()[:16]
    marker = wh.spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields])
    both = rows.withColumn("_marker", F.lit(False)).unionByName(marker.withColumn("_marker", F.lit(True)))
    keyed = both.withColumn("_run", F.lit(key))
    wh.overwrite_partitions(table, keyed.coalesce(1) if few else keyed.hint("rebalance"), "_run")


# -- watermark (S9, S10) ---------------------------------------------------------

def last_watermark(wh: Warehouse) -> tuple[str, bool]:
    """The highest watermark of all runs (the default if none has one), and whether there was a run."""
    runs = wh.read("pipeline_runs")
    if runs is None:
        return DEFAULT_WATERMARK, False
    r = runs.agg(F.max("watermark_timestamp").alias("mark"), F.count(F.lit(1)).alias("n")).first()
    return r.mark or DEFAULT_WATERMARK, r.n > 0


def get_watermark(wh: Warehouse) -> str:
    return last_watermark(wh)[0]


# -- E3 ----------------------------------------------------------------------------

def run_pipeline(wh: Warehouse, payload: Payload, run_id: str, dlq_path: str, now=None,
                 cfg: DQConfig = DQConfig(), gate: bool = False, incremental: bool = False,
                 track_agent_columns: list[str] | None = None) -> dict:
    """Dimensions -> DQ audit -> fact load -> watermark -> run ledger.

    Documents are parsed once: their records are cached for the run, filled before the
    loads of the dimensions read them side by side.
    """
    start = _dt.datetime.now(_dt.timezone.utc)
    records = payload.records
    if records is not None:
        _counted(records)
    try:
        load_dimensions(wh, payload, now, track_agent_columns)
        return ingest_activities(wh, payload.activities, run_id, dlq_path, now, cfg, gate,
                                 incremental, start, payload.corrupt, cached=records is not None)
    finally:
        if records is not None:
            records.unpersist()


def ingest_activities(wh: Warehouse, activities: DataFrame, run_id: str, dlq_path: str,
                      now=None, cfg: DQConfig = DQConfig(), gate: bool = False,
                      incremental: bool = False, start: _dt.datetime | None = None,
                      corrupt: DataFrame | None = None, cached: bool = False) -> dict:
    """E3 after the dimensions: DQ audit, fact load, watermark, run ledger.

    Also the body of every streaming micro-batch (T4). ``cached``: what ``activities``
    select from is cached by the caller.
    """
    spark = wh.spark
    start = start or _dt.datetime.now(_dt.timezone.utc)
    now_c = _now_lit(now)
    held, batch = (None, activities) if cached else _held(activities)
    kept: list[DataFrame] = []
    repeated = _counted(ingest.repeated_hashes(batch, "event_id"))   # for audit and load alike
    audit = quality.evaluate_batch(batch, wh.read("dim_agent"), wh.read("dim_campaign"),
                                   "fact_outreach_activity", run_id, now_c, cfg, kept=kept, repeated=repeated)
    prev_wm, has_prev = last_watermark(wh)
    with ThreadPoolExecutor(max_workers=1) as pool:
        load = None
        if not gate:  # without the gate the load does not wait for the audit
            load = pool.submit(load_facts, wh, batch, run_id, dlq_path, now,
                               prev_wm if incremental else None, corrupt, repeated)
        try:
            audit_rows = audit.collect()                  # five rows
        finally:
            for frame in kept:
                frame.unpersist()
        audit_df = spark.createDataFrame(audit_rows, audit.schema)
        replace_run(wh, "dq_audit_log", audit_df, run_id)
        replace_run(wh, "dq_invalid_values", quality.invalid_values(batch, allowed=cfg.allowed_event_types)
                    .select(F.lit(run_id).alias("pipeline_run_id"),
                            F.lit("fact_outreach_activity").alias("table_name"),
                            F.lit("VALIDITY").alias("dimension"),
                            F.col("event_type").cast("string").alias("value"), "rows"), run_id, few=False)
        composite = audit_rows[0]["composite_score"] if audit_rows else 100.0
        passed = bool(audit_rows[0]["passed"]) if audit_rows else True
        ingested = int(audit_rows[0]["records_evaluated"]) if audit_rows else 0
        if load is not None:
            counts = load.result()
        elif not passed:                                   # X4: load gate, default off
            counts = {"valid": 0, "inserted": 0, "quarantined": 0}
        else:
            counts = load_facts(wh, batch, run_id, dlq_path, now,
                                prev_wm if incremental else None, corrupt, repeated)
    repeated.unpersist()
    # Formatted by Spark in the session time zone (UTC), not by the driver's
    # local clock settings.
    cand = ingest.high_watermark(batch, "event_timestamp", parsed=True) \
        .select(F.date_format("watermark", WATERMARK_FMT)).first()[0]
    wm = prev_wm
    if cand is not None:   # monotonic: never moves back (the source overwrote it)
        wm = max(prev_wm, cand) if has_prev else cand
    if held is not None:
        held.unpersist()
    end = _dt.datetime.now(_dt.timezone.utc)
    status = "SUCCESS" if passed else "WARNING_DQ_THRESHOLD"
    run = spark.createDataFrame([(run_id, start, end,  # aware datetimes: exact instants
                                  SOURCE_SYSTEM, ingested, counts["valid"], counts["inserted"],
                                  counts["quarantined"], status, wm, None)],
                                "run_id string, start_time timestamp, end_time timestamp, "
                                "source_system string, records_ingested long, records_loaded long, "
                                "records_inserted long, records_quarantined_dlq long, status string, "
                                "watermark_timestamp string, error_message string")
    replace_run(wh, "pipeline_runs", run, run_id)
    return {"run_id": run_id, "status": status, "records_ingested": ingested,
            "records_loaded": counts["valid"], "records_inserted": counts["inserted"],
            "records_quarantined_dlq": counts["quarantined"], "dq_score": composite,
            "watermark": wm}


# -- E4 ----------------------------------------------------------------------------

def run_risk_model(wh: Warehouse, cfg: RiskConfig = RiskConfig(), now=None,
                   affected: DataFrame | None = None, agents_per_part: int = AGENTS_PER_PART) -> dict:
    """A1 -> W11 -> J8 -> A15 over the agent-day counts, which each load maintains.

    Without ``affected`` everything is scored. With it (T5: rows of ``agent_sk`` and
    ``date_key``, or of ``agent_sk`` alone for all days of these agents) the snapshot is
    refreshed from there, see ``RiskSnapshot.refresh``.
    """
    counts = wh.read("agent_daily_counts")
    if counts is None:
        return {"status": "SUCCESS", "records_processed": 0, "anomalies_flagged": 0,
                "critical_risk_count": 0}
    snapshot = RiskSnapshot(wh, cfg, _now_lit(now), agents_per_part)
    if affected is None:
        s = snapshot.full(counts)
    else:
        if "date_key" not in affected.columns:
            affected = counts.select("agent_sk", "date_key").join(affected.select("agent_sk"), "agent_sk", "left_semi")
        s = snapshot.refresh(counts, affected)
    return {"status": "SUCCESS", "records_processed": int(s["records_processed"]),
            "anomalies_flagged": int(s["anomalies_flagged"]),
            "critical_risk_count": int(s["critical_risk_count"])}
