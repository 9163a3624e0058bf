"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` each.

Every query reads the whole driver tables through the analogue views, with
every computed column aliased to the oracle's name. Results carry natural
keys; only the queries that check surrogate-key assignment itself
(``sk_lookup``, ``dim_insert_if_absent``, ``scd2_merge``) return the dense
ids. Write-path queries (pipeline runs, sinks, streams) write into a fresh
folder under the session's ``spark.checkpoint.dir`` and read their result
back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from activity_engine.config import TIER_LIMITS, DQConfig, RiskConfig
from activity_engine.functions.dates import date_key
from activity_engine.operators import ingest, measures, risk
from activity_engine.operators import quality as dq
from activity_engine.operators.daily import with_rates
from activity_engine.operators.keys import assign_surrogate_keys
from activity_engine.plans.star import build_star
from activity_engine.schemas import KEYS, TABLES, violations, with_long_keys
from activity_engine.session import scratch_path
from activity_engine.sources import fixtures as fx
from activity_engine.sources.payload import Payload

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


RISK_OUT = ["agent_id", "date_key", *risk.RISK_COLUMNS]
DAILY_OUT = ["agent_id", "date_key", "full_date", "account_age_tier", "daily_invite_ceiling",
             "daily_message_ceiling", "invites_sent", "invites_accepted", "messages_sent",
             "replies_received"]


# -- calendar, rollup, risk ----------------------------------------------------

@query("dim_date")
def q_dim_date(spark, sf):
    return fx.dates(spark, sf)


@query("daily_agent_activity")
def q_daily(spark, sf):
    return build_star(spark, sf).daily().select(*DAILY_OUT)


@query("daily_rates_utilization")
def q_rates(spark, sf):
    d = with_rates(build_star(spark, sf).daily())
    return d.select("agent_id", "date_key", "acceptance_rate", "reply_rate",
                    "invite_limit_utilization_pct", "message_limit_utilization_pct")


def scored_events(spark, sf, cfg: RiskConfig = RiskConfig()) -> DataFrame:
    # Windows partition on agent_sk: the dimension join already shuffled on it.
    return risk.score_daily(build_star(spark, sf).daily(), cfg, agent_key="agent_sk")


@query("agent_risk_daily")
def q_risk(spark, sf):
    return scored_events(spark, sf).select(*RISK_OUT)


@query("ewma_baseline")
def q_ewma(spark, sf):
    from activity_engine.functions.numeric import np_round
    s = scored_events(spark, sf)
    return s.select("agent_id", "date_key", np_round("rolling_mean_acc", 9).alias("rolling_mean_acc"),
                    np_round("rolling_std_acc", 9).alias("rolling_std_acc"))


@query("agent_risk_long_series")
def q_risk_long(spark, sf):
    # As many agent-days as lines at most; the count reads the files' footers.
    lines = fx.read_table(spark, sf, "lineitem").count()
    return risk.score_daily(fx.daily_long(spark, sf), agent_key="agent_id", rows=lines).select(*RISK_OUT)


@query("risk_summary")
def q_risk_summary(spark, sf):
    return risk.risk_summary(scored_events(spark, sf))


# -- data quality ----------------------------------------------------------------


DQ_NOW = "2024-01-25 00:00:00"        # fixed clock: events run to 2024-01-30
DQ_MIN = "2024-01-05 00:00:00"        # fixed lower bound: events start 2024-01-01
DQ_OUT = ["dimension", "records_evaluated", "records_failed", "dimension_score", "details"]
DOC_REQUIRED = ("doc_id", "text", "lang", "source", "quality", "toxic")


@query("dq_completeness")
def q_dq_completeness(spark, sf):
    docs = fx.read_table(spark, sf, "documents")
    labels = fx.read_table(spark, sf, "labels")
    batch = docs.join(labels, "doc_id", "left")
    return dq.check_completeness(batch, DOC_REQUIRED).select(*DQ_OUT)


@query("dq_uniqueness")
def q_dq_uniqueness(spark, sf):
    li = fx.read_table(spark, sf, "lineitem")
    return dq.check_uniqueness(li, ["l_orderkey", "l_linenumber"]).select(*DQ_OUT)


@query("dq_validity")
def q_dq_validity(spark, sf):
    return dq.check_validity(fx.events(spark, sf), "event_type").select(*DQ_OUT)


@query("dq_timeliness")
def q_dq_timeliness(spark, sf):
    return dq.check_timeliness(fx.events(spark, sf), "event_timestamp", DQ_NOW, DQ_MIN) \
        .select(*DQ_OUT)


@query("dq_referential")
def q_dq_referential(spark, sf):
    s = build_star(spark, sf)
    return dq.check_referential(s.batch, s.dim_agent, s.dim_campaign).select(
        "dimension", "records_evaluated", "records_failed", "dimension_score")


@query("dq_audit")
def q_dq_audit(spark, sf):
    s = build_star(spark, sf)
    cfg = DQConfig(min_event_ts=DQ_MIN)
    a = dq.evaluate_batch(s.batch, s.dim_agent, s.dim_campaign, "fact_outreach_activity",
                          "audit-fixture", DQ_NOW, cfg)
    return a.select("pipeline_run_id", "table_name", "dimension", "records_evaluated",
                    "records_failed", "dimension_score", "composite_score", "passed", "details")


@query("dq_invalid_values")
def q_dq_invalid_values(spark, sf):
    """A4: every distinct out-of-domain value with its rows (brands as event types)."""
    batch = fx.read_table(spark, sf, "part").select(F.col("p_brand").alias("event_type"))
    return dq.invalid_values(batch).select(F.col("event_type").alias("value"), "rows")


@query("dq_samples")
def q_dq_samples(spark, sf):
    s = build_star(spark, sf)
    ref = dq.referential_samples(s.batch, s.dim_agent, s.dim_campaign)
    li = fx.read_table(spark, sf, "lineitem")
    dup = (li.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("c"))
           .where(F.col("c") > 1)
           .select(F.concat_ws("|", F.col("l_orderkey").cast("string"),
                               F.col("l_linenumber").cast("string")).alias("sample"))
           .orderBy("sample").limit(5)
           .select(F.lit("l_orderkey|l_linenumber").alias("key_column"), "sample"))
    return ref.unionByName(dup)


# -- ingest: keys, quarantine, dedupe, idempotent load -----------------------------


@query("sk_lookup")
def q_sk_lookup(spark, sf):
    s = build_star(spark, sf, dense_keys=True)
    return s.resolved.select("event_id", "agent_id", "lead_id", "campaign_id",
                             "agent_sk", "lead_sk", "campaign_sk")


@query("quarantine")
def q_quarantine(spark, sf):
    d = build_star(spark, sf).dead
    return d.select(F.col("record.event_id").alias("event_id"),
                    F.col("record.agent_id").alias("agent_id"),
                    F.col("record.lead_id").alias("lead_id"),
                    F.col("record.campaign_id").alias("campaign_id"),
                    "failure_reason")


@query("valid_split")
def q_valid_split(spark, sf):
    s = build_star(spark, sf)
    flagged = s.resolved.select(ingest.quarantine_flag(s.resolved).alias("bad"))
    return flagged.agg(F.count(F.lit(1)).alias("records_ingested"),
                       F.count_if(~F.col("bad")).alias("records_valid"),
                       F.count_if(F.col("bad")).alias("records_quarantined"))


def replay_batch(spark, sf) -> DataFrame:
    """Every event delivered twice: the original and a replay with a changed
    value; the replay of the later half of ids arrives first."""
    e = fx.events(spark, sf)
    top = e.select(F.max("event_id")).scalar()
    orig = e.withColumn("delivery", F.lit("original")) \
        .withColumn("ingest_order", F.col("event_id") * 2)
    rep = e.withColumn("delivery", F.lit("replay")) \
        .withColumn("ingest_order", (top - F.col("event_id")) * 2 + 1) \
        .withColumn("message_length", F.coalesce(F.col("message_length"), F.lit(0)) + 1)
    return orig.unionByName(rep)


@query("dedupe_first_wins")
def q_dedupe(spark, sf):
    d = ingest.dedupe_first_wins(replay_batch(spark, sf), "event_id", "ingest_order")
    return d.select("event_id", "delivery", "ingest_order", "message_length")


@query("idempotent_load")
def q_idempotent(spark, sf):
    """First load: originals before the stream's midpoint. Second load: the
    full replay batch; only events not yet in the fact are inserted."""
    s = build_star(spark, sf)
    b = replay_batch(spark, sf)
    mid = stream_midpoint(fx.events(spark, sf))

    def load(batch):
        r = ingest.split_quarantine(
            ingest_resolve(batch, s), batch.columns)[0]
        return ingest.dedupe_first_wins(r, "event_id", "ingest_order")

    first = load(b.where((F.col("delivery") == "original") & (F.col("event_timestamp") < mid)))
    second = ingest.insert_new(load(b), first.select("event_id"))
    fact = first.unionByName(second)
    return fact.select("event_id", "delivery", "date_key")


@query("insert_or_ignore_moved_day")
def q_moved_day(spark, sf):
    """J4 over two loads: the events before the midpoint, then all events, with
    the replayed ones dated a day later. The first arrival of an id stays."""
    e = fx.events(spark, sf)
    early = F.col("event_timestamp") < stream_midpoint(e)
    cols = ["event_id", "date_key", F.lit(1).alias("load")]
    first = e.where(early).select(*cols)
    later = date_key(F.col("event_timestamp") + F.expr("INTERVAL 1 DAY"))
    second = e.select("event_id", F.when(early, later).otherwise(F.col("date_key")).alias("date_key"),
                      F.lit(2).alias("load"))
    return first.unionByName(ingest.insert_new(second, first))


def stream_midpoint(e: DataFrame):
    """Scalar subquery: the microsecond midpoint of the event time range."""
    lo, hi = F.unix_micros(F.min("event_timestamp")), F.unix_micros(F.max("event_timestamp"))
    return e.select(F.timestamp_micros(lo + F.floor((hi - lo) / 2).cast("long"))).scalar()


def ingest_resolve(batch, s):
    from activity_engine.operators.keys import resolve_keys
    return resolve_keys(batch, s.dim_agent, s.dim_lead, s.dim_campaign)


EXISTING_SEGMENTS = ("< 1 Month", "1 Month", "2–6 Months")


@query("dim_insert_if_absent")
def q_dim_insert(spark, sf):
    """Dimension holds three tiers' agents; the payload carries every agent."""
    from activity_engine.operators.dims import insert_if_absent
    incoming = fx.agents(spark, sf)
    existing = assign_surrogate_keys(
        incoming.where(F.col("account_age_tier").isin(*EXISTING_SEGMENTS)), "agent_id", "agent_sk")
    new = insert_if_absent(existing, incoming, "agent_id", "agent_sk")
    return existing.unionByName(new, allowMissingColumns=True) \
        .select("agent_id", "agent_sk", "account_age_tier")


@query("scd2_merge")
def q_scd2(spark, sf):
    """Current agents vs a payload whose status rule changed (balance < 1000)."""
    from activity_engine.operators.dims import scd2_merge
    from activity_engine.plans.star import agent_dim
    current = agent_dim(spark, sf)
    c = fx.read_table(spark, sf, "customer")
    incoming = fx.agents(spark, sf).drop("status").join(
        c.select(F.col("c_custkey").alias("agent_id"),
                 F.when(F.col("c_acctbal") < 1000, "PAUSED").otherwise("ACTIVE").alias("status")),
        "agent_id")
    merged = scd2_merge(current, incoming, "agent_id", "agent_sk", ["status"],
                        F.to_timestamp(F.lit("2024-02-01 00:00:00")))
    return merged.select("agent_id", "agent_sk", "status", "is_current")


@query("snapshot_upsert")
def q_upsert(spark, sf):
    """Old snapshot (span-14 model) upserted with today's model on days that
    saw replies."""
    from activity_engine.operators.dims import upsert
    old = scored_events(spark, sf, RiskConfig(ewma_span=14)).select(*RISK_OUT)
    new = scored_events(spark, sf).where(F.col("replies_received") > 0).select(*RISK_OUT)
    return upsert(old, new, ["agent_id", "date_key"])


def utc_wall_clock(df: DataFrame, *cols: str) -> DataFrame:
    """Timestamps as UTC wall-clock ``timestamp_ntz``: collected values then
    do not depend on the client's local time zone."""
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in cols else F.col(c)
                       for c in df.columns])


@query("high_watermark")
def q_watermark(spark, sf):
    return utc_wall_clock(ingest.high_watermark(fx.events(spark, sf), "event_timestamp"),
                          "watermark")


@query("incremental_filter")
def q_incremental(spark, sf):
    e = fx.events(spark, sf)
    wm = stream_midpoint(e)
    return ingest.incremental_filter(e, wm, "event_timestamp").select("event_id", "date_key")


# -- measures (M1-M22) --------------------------------------------------------------


def star_dims(s) -> dict:
    return {"agent": s.dim_agent, "campaign": s.dim_campaign, "date": s.dim_date,
            "lead": s.dim_lead}


@query("kpi_core")
def q_kpi_core(spark, sf):
    s = build_star(spark, sf)
    return measures.core(s.fact, star_dims(s))


@query("kpi_core_by_tier")
def q_kpi_core_tier(spark, sf):
    s = build_star(spark, sf)
    return measures.core(s.fact, star_dims(s), ["account_age_tier"])


@query("kpi_core_by_month")
def q_kpi_core_month(spark, sf):
    s = build_star(spark, sf)
    return measures.core(s.fact, star_dims(s), ["month_name"])


@query("kpi_core_rollup")
def q_kpi_core_rollup(spark, sf):
    s = build_star(spark, sf)
    return measures.core(s.fact, star_dims(s), ["campaign_name", "account_age_tier"], rollup=True)


@query("kpi_capacity")
def q_kpi_capacity(spark, sf):
    s = build_star(spark, sf)
    return measures.capacity(s.fact, star_dims(s), ["account_age_tier"])


@query("kpi_capacity_null_member")
def q_kpi_capacity_null(spark, sf):
    """Agents without a tier and facts of unknown agents share the null member."""
    s = build_star(spark, sf)
    tier = F.col("account_age_tier")
    no_tier, unknown = TIER_LIMITS[0][0], TIER_LIMITS[1][0]
    agents = s.dim_agent.where(tier != unknown).withColumn(
        "account_age_tier", F.when(tier != no_tier, tier))
    return measures.capacity(s.fact, star_dims(s) | {"agent": agents}, ["account_age_tier"])


@query("kpi_risk")
def q_kpi_risk(spark, sf):
    s = build_star(spark, sf)
    scored = risk.score_daily(s.daily(), agent_key="agent_sk")
    return measures.risk(scored, star_dims(s), ["account_age_tier"])


@query("kpi_campaign")
def q_kpi_campaign(spark, sf):
    s = build_star(spark, sf)
    return measures.campaign(s.fact, star_dims(s), ["campaign_name"])


@query("kpi_capacity_by_month")
def q_kpi_capacity_month(spark, sf):
    """M9-M12 by a calendar column: agents and ceilings of all tiers, the month's own days."""
    s = build_star(spark, sf)
    return measures.capacity(s.fact, star_dims(s), ["month_name"])


@query("kpi_capacity_rollup")
def q_kpi_capacity_rollup(spark, sf):
    """M9-M12 by tier and month with subtotals."""
    s = build_star(spark, sf)
    return measures.capacity(s.fact, star_dims(s), ["account_age_tier", "month_name"], rollup=True)


@query("kpi_capacity_campaign_day")
def q_kpi_capacity_campaign(spark, sf):
    """M9-M12 by weekday, campaign and tier with subtotals: three dimensions."""
    s = build_star(spark, sf)
    return measures.capacity(s.fact, star_dims(s), ["day_name", "campaign_name", "account_age_tier"], rollup=True)


@query("kpi_risk_by_day_name")
def q_kpi_risk_day(spark, sf):
    s = build_star(spark, sf)
    return measures.risk(risk.score_daily(s.daily(), agent_key="agent_sk"), star_dims(s), ["day_name"])


@query("kpi_risk_rollup")
def q_kpi_risk_rollup(spark, sf):
    """M13-M17 by month, tier and weekday with subtotals: two dimensions, interleaved."""
    s = build_star(spark, sf)
    return measures.risk(risk.score_daily(s.daily(), agent_key="agent_sk"), star_dims(s),
                         ["month_name", "account_age_tier", "day_name"], rollup=True)


@query("kpi_campaign_by_month")
def q_kpi_campaign_month(spark, sf):
    s = build_star(spark, sf)
    return measures.campaign(s.fact, star_dims(s), ["month_name"])


@query("kpi_campaign_rollup")
def q_kpi_campaign_rollup(spark, sf):
    """M18-M22 by campaign and tier with subtotals; a tier does not narrow a budget."""
    s = build_star(spark, sf)
    return measures.campaign(s.fact, star_dims(s), ["campaign_name", "account_age_tier"], rollup=True)


KPI_DAYS = (20240105, 20240118)


@query("kpi_filtered")
def q_kpi_filtered(spark, sf):
    """M1-M12 in a filter context: two weeks, active agents; by tier with the total."""
    s = build_star(spark, sf)
    fact, dims = measures.filtered(s.fact, star_dims(s), {"agent": F.col("status") == "ACTIVE"}, KPI_DAYS)
    by, names = ["account_age_tier"], ["account_age_tier", "grouping_id"]
    volumes = measures.core(fact, dims, by, rollup=True).drop("total_invites_sent", "total_messages_sent")
    figures = measures.capacity(fact, dims, by, rollup=True)
    keyed = [F.coalesce(F.col(n).cast("string"), F.lit("all")).alias(f"_{n}") for n in names]
    both = figures.select("*", *keyed).join(volumes.select("*", *keyed).drop(*names), [f"_{n}" for n in names], "left")
    # A tier without facts has members but no volumes: they are zero.
    return both.select(*figures.columns, *[F.coalesce(F.col(c), F.lit(0)).cast(volumes.schema[c].dataType).alias(c)
                                           for c in volumes.columns if c not in names])


# -- risk extras: tier matrix, breaches, cooldown, ghosting, reply decay --------------

@query("tier_limits_join")
def q_tier_join(spark, sf):
    return risk.tier_check(fx.agents(spark, sf)).select(
        "agent_id", "account_age_tier", "tier_risk_classification", "tier_invite_ceiling",
        "tier_message_ceiling", "cooldown_hours",
        F.col("ceiling_mismatch").cast("int").alias("ceiling_mismatch"))


@query("ceiling_breach")
def q_breach(spark, sf):
    return risk.ceiling_breaches(scored_events(spark, sf)).select(
        "agent_id", "date_key", "invites_sent", "messages_sent",
        "invite_limit_utilization_pct", "message_limit_utilization_pct")


@query("cooldown_until")
def q_cooldown(spark, sf):
    s = build_star(spark, sf)
    return utc_wall_clock(risk.cooldown_until(s.fact, s.dim_agent),
                          "last_event_ts", "cooldown_until")


@query("ghosting_runs")
def q_ghosting(spark, sf):
    return risk.ghosting_runs(build_star(spark, sf).daily(), agent_key="agent_sk").drop("agent_sk")


@query("reply_decay")
def q_reply_decay(spark, sf):
    from activity_engine.functions.numeric import np_round
    d = risk.reply_decay(build_star(spark, sf).daily(), agent_key="agent_sk")
    return d.select("agent_id", "date_key", "reply_rate",
                    np_round("reply_baseline_change", 9).alias("reply_baseline_change"),
                    "reply_decay_flag")


# -- write paths: pipeline runs, sinks, streaming ------------------------------------


RUN_NOW = "2024-02-01 00:00:00"


def fixture_payload(spark, sf) -> Payload:
    return Payload(fx.agents(spark, sf).withColumn("ingest_order", F.col("agent_id")),
                   fx.campaigns(spark, sf).withColumn("ingest_order", F.col("campaign_id")),
                   fx.leads(spark, sf).withColumn("ingest_order", F.col("lead_id")),
                   fx.events(spark, sf))


def fixture_warehouse(spark, sf, tag: str):
    from activity_engine.plans import pipeline as pl
    from activity_engine.sources.tables import Warehouse
    root = scratch_path(spark, "queries", f"{tag}-{uuid.uuid4().hex[:8]}")
    wh = Warehouse(spark, f"{root}/wh", with_long_keys(TABLES))   # the driver tables' keys are numbers
    pl.init_warehouse(wh, fx.calendar_bounds(spark, sf))
    return wh, root


def with_natural_keys(wh, fact: DataFrame) -> DataFrame:
    a = wh.read("dim_agent").select("agent_sk", "agent_id")
    return fact.join(a, "agent_sk")


@query("pipeline_run")
def q_pipeline_run(spark, sf):
    """E1-E3 twice over the same payload (the rerun inserts nothing)."""
    from activity_engine.plans import pipeline as pl
    wh, root = fixture_warehouse(spark, sf, "pipeline")
    p = fixture_payload(spark, sf)
    for run in ("run-1", "run-2"):
        pl.run_pipeline(wh, p, run, f"{root}/dlq", RUN_NOW)
    f = with_natural_keys(wh, wh.read("fact_outreach_activity"))
    return f.select("event_id", "agent_id", "date_key", "event_type", "message_length",
                    "is_converted")


@query("risk_model_run")
def q_risk_model_run(spark, sf):
    """Score the loaded fact and read the persisted snapshot back."""
    from activity_engine.plans import pipeline as pl
    wh, root = fixture_warehouse(spark, sf, "risk")
    pl.run_pipeline(wh, fixture_payload(spark, sf), "run-1", f"{root}/dlq", RUN_NOW)
    pl.run_risk_model(wh, now=RUN_NOW)
    pl.run_risk_model(wh, now=RUN_NOW)          # rerun upserts, no duplicates
    m = with_natural_keys(wh, wh.read("fact_daily_agent_metric"))
    return m.select(*RISK_OUT)


@query("dlq_roundtrip")
def q_dlq(spark, sf):
    """Dead letters written as JSON lines, read back and parsed."""
    from activity_engine.sources.sinks import read_dead_letters, write_dead_letters
    root = scratch_path(spark, "queries", f"dlq-{uuid.uuid4().hex[:8]}")
    write_dead_letters(build_star(spark, sf).dead, f"{root}/dlq", "fixture-run")
    d = read_dead_letters(spark, f"{root}/dlq")
    return d.select(F.get_json_object("record", "$.event_id").cast("long").alias("event_id"),
                    F.get_json_object("record", "$.campaign_id").cast("long").alias("campaign_id"),
                    "failure_reason", "run_id")


@query("feed_export_roundtrip")
def q_feed(spark, sf):
    """The scored snapshot exported as CSV and read back typed."""
    from activity_engine.sources.sinks import export_feed
    root = scratch_path(spark, "queries", f"feed-{uuid.uuid4().hex[:8]}")
    s = scored_events(spark, sf).select(*RISK_OUT)
    export_feed(s, f"{root}/fact_daily_agent_metric", "csv")
    return spark.read.schema(s.schema).option("header", True) \
        .csv(f"{root}/fact_daily_agent_metric")


def stream_events(spark, sf, root: str, start) -> None:
    """The events as a stream of three micro-batches: the second half of the time range,
    the first half (late), and the second half again (a replay).

    Each part's files are written with the parallelism of the scan; one run on the same
    checkpoint (``start``: event stream -> started query) takes what is new as one micro-batch.
    """
    from activity_engine.streaming import stream as st
    e = fx.read_table(spark, sf, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    mid = e.select(F.min(at) + F.floor((F.max(at) - F.min(at)) / 2).cast("long")).scalar()
    for part in (at >= mid, at < mid, at >= mid):
        e.where(part).write.mode("append").parquet(f"{root}/in")
        files = st.read_event_stream(spark, f"{root}/in", "*.parquet", schema=e.schema)
        start(fx.events_view(files)).awaitTermination()


def streamed_warehouse(spark, sf, tag: str, after=None, **options):
    """A warehouse after the three micro-batches; ``after`` runs once each is loaded."""
    from activity_engine.plans import pipeline as pl
    from activity_engine.streaming import stream as st
    wh, root = fixture_warehouse(spark, sf, tag)
    pl.load_dimensions(wh, fixture_payload(spark, sf), RUN_NOW)

    def start(events):
        q = st.start_ingest(events, wh, f"{root}/dlq", f"{root}/_ckpt_ingest", RUN_NOW, **options)
        if after:
            q.awaitTermination()
            q = after(wh, root)
        return q

    stream_events(spark, sf, root, start)
    return wh


@query("stream_ingest")
def q_stream_ingest(spark, sf):
    """The events as a stream of three micro-batches, one late, one replayed."""
    wh = streamed_warehouse(spark, sf, "stream")
    f = with_natural_keys(wh, wh.read("fact_outreach_activity"))
    return f.select("event_id", "agent_id", "date_key", "event_type", "message_length",
                    "is_converted")


@query("stream_daily_counts")
def q_stream_daily(spark, sf):
    """A1 from a stateful stream over the fact, after micro-batches one late, one replayed."""
    from activity_engine.streaming import stream as st
    wh = streamed_warehouse(spark, sf, "sdc", after=lambda w, root: st.start_daily_counts(w, f"{root}/_ckpt_counts"))
    return with_natural_keys(wh, st.read_daily_counts(wh)).select(
        "agent_id", "date_key", "invites_sent", "invites_accepted", "messages_sent", "replies_received")


@query("stream_risk_refresh")
def q_stream_risk(spark, sf):
    """T5: each micro-batch loads its events, refreshes the touched days'
    counts and rescoring the agents it touched; the snapshot is read back."""
    wh = streamed_warehouse(spark, sf, "srisk", refresh_risk=True)
    m = with_natural_keys(wh, wh.read("fact_daily_agent_metric"))
    return m.select(*RISK_OUT)


@query("dim_date_insert_or_ignore")
def q_calendar_insert(spark, sf):
    """The calendar loaded twice, the second time one year longer."""
    from activity_engine.plans import pipeline as pl
    wh, _ = fixture_warehouse(spark, sf, "cal")
    b = fx.calendar_bounds(spark, sf)
    longer = b.select("start", F.add_months("end", 12).alias("end"))
    added = pl.init_warehouse(wh, longer)
    return wh.read("dim_date").withColumn("second_load_added", F.lit(added).cast("long"))


@query("dq_composite")
def q_dq_composite(spark, sf):
    """The weighted composite and pass flag of the event batch."""
    s = build_star(spark, sf)
    a = dq.evaluate_batch(s.batch, s.dim_agent, s.dim_campaign, "fact_outreach_activity",
                          "audit-fixture", DQ_NOW, DQConfig(min_event_ts=DQ_MIN))
    return a.select("composite_score", "passed").distinct()


@query("kpi_capacity_total")
def q_kpi_capacity_total(spark, sf):
    s = build_star(spark, sf)
    return measures.capacity(s.fact, star_dims(s))


@query("kpi_risk_total")
def q_kpi_risk_total(spark, sf):
    s = build_star(spark, sf)
    scored = risk.score_daily(s.daily(), agent_key="agent_sk")
    return measures.risk(scored, star_dims(s))


@query("kpi_campaign_total")
def q_kpi_campaign_total(spark, sf):
    s = build_star(spark, sf)
    return measures.campaign(s.fact, star_dims(s), [])


# -- the warehouse itself: catalog, export, ledgers, gate, versions, payload -----------


@query("warehouse_catalog")
def q_catalog(spark, sf):
    """Every table after init and one run, with what a database would have refused."""
    from activity_engine.plans import pipeline as pl
    wh, root = fixture_warehouse(spark, sf, "catalog")
    pl.run_pipeline(wh, fixture_payload(spark, sf), "run-1", f"{root}/dlq", RUN_NOW)
    checked = [violations(wh.read(t), t, wh.catalog[t]) for t in KEYS]
    out = checked[0]
    for more in checked[1:]:
        out = out.unionByName(more)
    return out


@query("warehouse_export")
def q_export(spark, sf):
    """All eight tables exported, those without rows too, and read back: columns and rows."""
    from activity_engine.plans import pipeline as pl
    from activity_engine.sources.sinks import export_warehouse
    wh, root = fixture_warehouse(spark, sf, "export")
    pl.run_pipeline(wh, fixture_payload(spark, sf), "run-1", f"{root}/dlq", RUN_NOW)
    out = None
    for fmt in ("csv", "parquet"):
        for table in export_warehouse(wh, f"{root}/{fmt}", fmt):
            back = spark.read.format(fmt).options(**({"header": True} if fmt == "csv" else {})).load(f"{root}/{fmt}/{table}")
            row = back.agg(F.lit(fmt).alias("format"), F.lit(table).alias("table_name"),
                           F.lit(",".join(back.columns)).alias("columns"), F.count(F.lit(1)).alias("rows"))
            out = row if out is None else out.unionByName(row)
    return out


@query("pipeline_ledgers")
def q_ledgers(spark, sf):
    """The early events, then all of them incrementally: both runs' ledger rows."""
    from activity_engine.plans import pipeline as pl
    wh, root = fixture_warehouse(spark, sf, "ledgers")
    p = fixture_payload(spark, sf)
    pl.load_dimensions(wh, p, RUN_NOW)
    early = p.activities.where(F.col("event_timestamp") < stream_midpoint(p.activities))
    pl.ingest_activities(wh, early, "early", f"{root}/dlq", RUN_NOW)
    pl.ingest_activities(wh, p.activities, "all", f"{root}/dlq", RUN_NOW, incremental=True)
    audit = wh.read("dq_audit_log").groupBy(F.col("pipeline_run_id").alias("run_id")).agg(
        F.count(F.lit(1)).alias("audit_rows"), F.sum("records_failed").alias("audit_failed"))
    return wh.read("pipeline_runs").join(audit, "run_id").select(
        "run_id", "source_system", "records_ingested", "records_loaded", "records_inserted",
        "records_quarantined_dlq", "watermark_timestamp", "audit_rows", "audit_failed")


@query("load_gate")
def q_gate(spark, sf):
    """A batch under the threshold loads nothing when gated."""
    from activity_engine.plans import pipeline as pl
    wh, root = fixture_warehouse(spark, sf, "gate")
    pl.run_pipeline(wh, fixture_payload(spark, sf), "gated", f"{root}/dlq", RUN_NOW,
                    DQConfig(pass_threshold=99.0), gate=True)
    return wh.read("pipeline_runs").select(
        "run_id", "status", "records_ingested", "records_loaded", "records_inserted").withColumn(
        "fact_rows", wh.read("fact_outreach_activity").agg(F.count(F.lit(1))).scalar())


@query("agent_versions")
def q_versions(spark, sf):
    """The dates of closed, current and new agent versions."""
    from activity_engine.operators.dims import scd2_merge
    from activity_engine.plans.star import agent_dim
    began = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    current = agent_dim(spark, sf).withColumn("effective_date", began)
    c = fx.read_table(spark, sf, "customer")
    incoming = fx.agents(spark, sf).drop("status").join(
        c.select(F.col("c_custkey").alias("agent_id"),
                 F.when(F.col("c_acctbal") < 1000, "PAUSED").otherwise("ACTIVE").alias("status")), "agent_id")
    merged = scd2_merge(current, incoming, "agent_id", "agent_sk", ["status"],
                        F.to_timestamp(F.lit("2024-02-01 00:00:00")))
    return utc_wall_clock(merged.select("agent_id", "status", "is_current", "effective_date", "end_date"),
                          "effective_date", "end_date")


@query("timestamp_parse")
def q_timestamps(spark, sf):
    """Event times as texts of four forms, one of them no time."""
    from activity_engine.functions.dates import to_event_ts
    e = fx.events(spark, sf)
    at, form = F.col("event_timestamp"), F.col("event_id") % 4
    text = (F.when(form == 0, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
            .when(form == 1, F.date_format(at, "yyyy-MM-dd HH:mm:ss"))
            .when(form == 2, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'+02:00'"))
            .otherwise(F.concat(F.lit("about "), F.date_format(at, "yyyy-MM-dd"))))
    texts = e.select("event_id", text.alias("text"))
    return utc_wall_clock(texts.select("event_id", "text", to_event_ts("text").alias("event_ts")), "event_ts")


@query("ceiling_breach_low")
def q_breach_low(spark, sf):
    """Breaches when every ceiling is one a day."""
    from activity_engine.operators.daily import daily_activity
    s = build_star(spark, sf)
    one = s.dim_agent.withColumns({"daily_invite_ceiling": F.lit(1), "daily_message_ceiling": F.lit(1)})
    d = with_rates(daily_activity(s.fact, one, s.dim_date))
    return risk.ceiling_breaches(d).select("agent_id", "date_key", "invites_sent", "messages_sent",
                                           "invite_limit_utilization_pct", "message_limit_utilization_pct")


@query("tier_mismatches")
def q_tier_mismatches(spark, sf):
    """Every third agent sends more than its tier allows."""
    a = fx.agents(spark, sf).withColumn(
        "daily_invite_ceiling", F.col("daily_invite_ceiling") + F.when(F.col("agent_id") % 3 == 0, 5).otherwise(0))
    return risk.tier_check(a).where("ceiling_mismatch").select("agent_id", "account_age_tier", "tier_invite_ceiling")


@query("ewma_first_day")
def q_first_day(spark, sf):
    """A baseline from the first day on; the deviation needs one day more."""
    from activity_engine.functions.numeric import np_round
    d = scored_events(spark, sf, RiskConfig(min_points=1))
    return d.select("agent_id", "date_key", np_round("rolling_mean_acc", 9).alias("rolling_mean_acc"),
                    np_round("rolling_std_acc", 9).alias("rolling_std_acc"), "risk_level")


@query("payload_roundtrip")
def q_payload(spark, sf):
    """Agents and events as JSON documents, one line each, some cut short; read, loaded, dead letters.

    A document holds the events of one agent and hour; agents' links come under the
    source's name. Every document whose number divides by 50 loses its end.
    """
    from activity_engine.plans import pipeline as pl
    from activity_engine.schemas import ACTIVITY_BATCH
    from activity_engine.sources.payload import read_payload
    from activity_engine.sources.sinks import read_dead_letters
    from activity_engine.sources.tables import Warehouse
    root = scratch_path(spark, "queries", f"payload-{uuid.uuid4().hex[:8]}")
    e = fx.events(spark, sf)
    fields = [F.col(f.name).cast(f.dataType if f.name != "event_timestamp" else "timestamp").cast(f.dataType).alias(f.name)
              for f in ACTIVITY_BATCH.fields]
    hour = (F.unix_seconds("event_timestamp") / 3600).cast("long").alias("hour")
    # Lists are no smaller for being collected before the shuffle: the rows go there as they are.
    sent = e.select("agent_id", hour, "event_id", F.struct(*fields).alias("activity")).repartition("agent_id", "hour")
    docs = (sent.groupBy("agent_id", "hour").agg(
        F.min("event_id").alias("number"), F.sort_array(F.collect_list("activity")).alias("activities"))
        .select("number", F.to_json(F.struct("activities")).alias("value")))
    cut = F.when(F.col("number") % 50 == 0, F.expr("left(value, length(value) - 3)")).otherwise(F.col("value"))
    docs.select(cut.alias("value")).write.text(f"{root}/in")
    agents = fx.agents(spark, sf).withColumn("agent_id", F.col("agent_id").cast("string"))
    agents.select(F.to_json(F.struct(F.array(F.struct(
        *[F.col(c) for c in agents.columns if c != "profile_url"], F.col("profile_url").alias("linkedin_profile_url")))
        .alias("agents"))).alias("value")).write.mode("append").text(f"{root}/in")
    others = [(fx.leads(spark, sf), "leads", "lead_id"), (fx.campaigns(spark, sf), "campaigns", "campaign_id")]
    for df, name, key in others:
        df = df.withColumn(key, F.col(key).cast("string"))
        df.select(F.to_json(F.struct(F.array(F.struct(*df.columns)).alias(name))).alias("value")) \
            .write.mode("append").text(f"{root}/in")
    wh = Warehouse(spark, f"{root}/wh")
    pl.init_warehouse(wh, fx.calendar_bounds(spark, sf))
    pl.run_pipeline(wh, read_payload(spark, f"{root}/in", multi_line=False), "run-1", f"{root}/dlq", RUN_NOW)
    a = wh.read("dim_agent").select("agent_sk", "agent_id", "profile_url")
    loaded = wh.read("fact_outreach_activity").join(a, "agent_sk").select(
        F.lit("loaded").alias("outcome"), F.col("event_id").cast("long").alias("event_id"), "profile_url",
        F.col("event_ts").cast("timestamp_ntz").alias("event_ts"))
    dead = read_dead_letters(spark, f"{root}/dlq").groupBy("failure_reason").agg(F.count(F.lit(1)).alias("event_id"))
    return loaded.unionByName(dead.select(
        F.col("failure_reason").alias("outcome"), "event_id", F.lit(None).cast("string").alias("profile_url"),
        F.lit(None).cast("timestamp_ntz").alias("event_ts")))
