"""Typed catalog of the warehouse (S11) and the tier-limits reference data.

Each table has an explicit ``StructType`` plus its declared keys; constraints
that SQLite would enforce become checks in the operators (quarantine,
anti-join inserts, uniqueness).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from activity_engine.config import TIER_LIMITS

S, I, L, D, TS, DT = (T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(),
                      T.TimestampType(), T.DateType())


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


DIM_DATE = _st(("date_key", I, False), ("full_date", DT, False), ("day_of_week", I, True),
               ("day_name", S, True), ("month_number", I, True), ("month_name", S, True),
               ("quarter", I, True), ("year", I, True), ("is_weekend", I, True))

DIM_AGENT = _st(("agent_sk", L, False), ("agent_id", S, False), ("agent_name", S, True),
                ("profile_url", S, True), ("account_age_tier", S, True),
                ("risk_classification", S, True), ("daily_invite_ceiling", I, True),
                ("daily_message_ceiling", I, True), ("status", S, True),
                ("effective_date", TS, True), ("end_date", TS, True), ("is_current", I, False))

DIM_LEAD = _st(("lead_sk", L, False), ("lead_id", S, False), ("first_name", S, True),
               ("last_name", S, True), ("job_title", S, True), ("company_name", S, True),
               ("industry", S, True), ("location", S, True), ("target_segment", S, True))

DIM_CAMPAIGN = _st(("campaign_sk", L, False), ("campaign_id", S, False),
                   ("campaign_name", S, False), ("target_segment", S, True),
                   ("daily_budget", T.DecimalType(10, 2), True), ("start_date", DT, True),
                   ("end_date", DT, True), ("status", S, True))

FACT_ACTIVITY = _st(("event_id", S, False), ("agent_sk", L, False), ("lead_sk", L, False),
                    ("campaign_sk", L, False), ("date_key", I, False),
                    ("event_timestamp", S, False), ("event_ts", TS, True),
                    ("event_type", S, False), ("message_length", I, True),
                    ("response_latency_hours", D, True), ("is_converted", I, True))

FACT_DAILY = _st(("agent_sk", L, False), ("date_key", I, False), ("invites_sent", L, True),
                 ("invites_accepted", L, True), ("messages_sent", L, True),
                 ("replies_received", L, True), ("acceptance_rate", D, True),
                 ("reply_rate", D, True), ("invite_limit_utilization_pct", D, True),
                 ("message_limit_utilization_pct", D, True), ("anomaly_score", D, True),
                 ("risk_level", S, True), ("recommended_invite_capacity", I, True),
                 ("recommended_message_capacity", I, True), ("updated_at", TS, True))

DQ_AUDIT = _st(("pipeline_run_id", S, False), ("check_timestamp", TS, True),
               ("table_name", S, False), ("dimension", S, False),
               ("records_evaluated", L, True), ("records_failed", L, True),
               ("dimension_score", D, True), ("composite_score", D, True),
               ("passed", I, True), ("details", S, True))

PIPELINE_RUNS = _st(("run_id", S, False), ("start_time", TS, True), ("end_time", TS, True),
                    ("source_system", S, True), ("records_ingested", L, True),
                    ("records_loaded", L, True), ("records_inserted", L, True),
                    ("records_quarantined_dlq", L, True), ("status", S, True),
                    ("watermark_timestamp", S, True), ("error_message", S, True))

# Incoming activity batch (payload ``activities``); every field nullable.
ACTIVITY_BATCH = _st(("event_id", S, True), ("agent_id", S, True), ("lead_id", S, True),
                     ("campaign_id", S, True), ("date_key", I, True),
                     ("event_timestamp", S, True), ("event_type", S, True),
                     ("message_length", I, True), ("response_latency_hours", D, True),
                     ("is_converted", I, True))

AGENT_RECORD = _st(("agent_id", S, True), ("agent_name", S, True),
                   ("profile_url", S, True), ("account_age_tier", S, True),
                   ("risk_classification", S, True), ("daily_invite_ceiling", I, True),
                   ("daily_message_ceiling", I, True), ("status", S, True))
CAMPAIGN_RECORD = _st(("campaign_id", S, True), ("campaign_name", S, True),
                      ("target_segment", S, True), ("daily_budget", T.DecimalType(10, 2), True),
                      ("start_date", DT, True), ("end_date", DT, True), ("status", S, True))
LEAD_RECORD = _st(("lead_id", S, True), ("first_name", S, True), ("last_name", S, True),
                  ("job_title", S, True), ("company_name", S, True), ("industry", S, True),
                  ("location", S, True), ("target_segment", S, True))

PAYLOAD = _st(("agents", T.ArrayType(AGENT_RECORD), True),
              ("campaigns", T.ArrayType(CAMPAIGN_RECORD), True),
              ("leads", T.ArrayType(LEAD_RECORD), True),
              ("activities", T.ArrayType(ACTIVITY_BATCH), True))

KEYS = {
    "dim_date": ["date_key"],
    "dim_agent": ["agent_sk"],
    "dim_lead": ["lead_sk"],
    "dim_campaign": ["campaign_sk"],
    "fact_outreach_activity": ["event_id"],
    "fact_daily_agent_metric": ["agent_sk", "date_key"],
    "dq_audit_log": ["pipeline_run_id", "table_name", "dimension"],
    "pipeline_runs": ["run_id"],
}
NATURAL_KEYS = {"dim_agent": "agent_id", "dim_lead": "lead_id", "dim_campaign": "campaign_id"}

TABLES = {
    "dim_date": DIM_DATE, "dim_agent": DIM_AGENT, "dim_lead": DIM_LEAD,
    "dim_campaign": DIM_CAMPAIGN, "fact_outreach_activity": FACT_ACTIVITY,
    "fact_daily_agent_metric": FACT_DAILY, "dq_audit_log": DQ_AUDIT,
    "pipeline_runs": PIPELINE_RUNS,
}

#: Columns that place rows and belong to no table: a run's ledger rows, an agent's part of the snapshot.
PLACING = {"_marker": "boolean", "_run": "string", "month": "int", "agent_bucket": "int"}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the table's columns, typed; missing ones are null, others are not stored."""
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns
            else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return df.select(*cols, *[c for c in PLACING if c in df.columns])


def with_long_keys(catalog: dict[str, T.StructType]) -> dict[str, T.StructType]:
    """The catalog for sources whose natural keys are numbers."""
    keys = set(NATURAL_KEYS.values())
    return {t: T.StructType([T.StructField(f.name, L, f.nullable) if f.name in keys else f for f in s.fields])
            for t, s in catalog.items()}


def violations(df: DataFrame, table: str, schema: T.StructType) -> DataFrame:
    """(table_name, rows, null_fields, duplicate_keys): what a database would have refused.

    ``null_fields`` counts nulls in NOT NULL columns, ``duplicate_keys`` rows beyond the
    first of a key, and beyond one current version of a natural key.
    """
    required = [f.name for f in schema.fields if not f.nullable]
    keys = [KEYS[table]]
    if table in NATURAL_KEYS:
        keys.append([NATURAL_KEYS[table], *(["is_current"] if "is_current" in df.columns else [])])
    nulls = [F.count_if(F.col(c).isNull()) for c in required]
    total = df.agg(F.count(F.lit(1)).alias("rows"), sum(nulls[1:], nulls[0]).alias("null_fields"))
    copies = None
    for key in keys:
        held = df.where(F.col("is_current") == 1) if "is_current" in key else df
        more = (held.groupBy(*key).agg((F.count(F.lit(1)) - 1).alias("more"))
                .agg(F.coalesce(F.sum("more"), F.lit(0)).alias("more")))
        copies = more if copies is None else copies.unionByName(more)
    extra = copies.agg(F.sum("more").cast("long").alias("duplicate_keys"))
    return total.select(F.lit(table).alias("table_name"), "rows", "null_fields",
                        extra.scalar().alias("duplicate_keys"))


TIER_SCHEMA = _st(("account_age_tier", S, False), ("tier_risk_classification", S, True),
                  ("tier_invite_ceiling", I, False), ("tier_message_ceiling", I, False),
                  ("cooldown_hours", I, False))


def tier_limits(spark: SparkSession) -> DataFrame:
    """Five-row limits matrix; fixed size, so it is always safe to broadcast."""
    return F.broadcast(spark.createDataFrame(list(TIER_LIMITS), TIER_SCHEMA))

