"""Analogue views over the driver tables (FIXTURES.md §3).

The driver tables stand in for the outreach warehouse: customers are agents,
parts are leads, regions are campaigns, the ``events`` table is the activity
stream and ``lineitem`` per supplier per ship day is a long daily series.
Every view is a lazy projection of the whole table; nothing is sampled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from activity_engine.config import TIER_LIMITS
from activity_engine.functions.dates import calendar, date_key
from activity_engine.schemas import tier_limits

# Fixed mappings of the analogue (FIXTURES.md §3), natural order.
SEGMENT_TIER = (
    ("AUTOMOBILE", "< 1 Month"),
    ("BUILDING", "1 Month"),
    ("FURNITURE", "2–6 Months"),
    ("HOUSEHOLD", "6–12 Months"),
    ("MACHINERY", "1+ Year"),
)
EVENT_TYPE_MAP = (
    ("view", "INVITE_SENT"),
    ("click", "INVITE_ACCEPTED"),
    ("signup", "MESSAGE_SENT"),
    ("purchase", "REPLY_RECEIVED"),
)
CAMPAIGN_MODULUS = 7          # campaign id = event_id mod 7; ids 5 and 6 do not resolve
CONVERSION_VALUE = 100.0


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _map_expr(pairs, col, default=None):
    expr = None
    for k, v in pairs:
        expr = (F.when(col == k, v) if expr is None else expr.when(col == k, v))
    return expr.otherwise(default if default is not None else col)


def agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as agent records: tier by segment, ceilings from the matrix."""
    c = read_table(spark, sf_dir, "customer")
    rec = c.select(
        F.col("c_custkey").alias("agent_id"),
        F.col("c_name").alias("agent_name"),
        F.concat(F.lit("profiles/"), F.col("c_custkey").cast("string")).alias("profile_url"),
        _map_expr(SEGMENT_TIER, F.col("c_mktsegment"), F.lit(None).cast("string"))
        .alias("account_age_tier"),
        F.when(F.col("c_acctbal") < 0, "PAUSED").otherwise("ACTIVE").alias("status"),
    )
    lim = tier_limits(spark)
    return (rec.join(lim, "account_age_tier", "left")
            .select("agent_id", "agent_name", "profile_url", "account_age_tier",
                    F.col("tier_risk_classification").alias("risk_classification"),
                    F.col("tier_invite_ceiling").alias("daily_invite_ceiling"),
                    F.col("tier_message_ceiling").alias("daily_message_ceiling"),
                    "status"))


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read_table(spark, sf_dir, "region")
    return r.select(
        F.col("r_regionkey").cast("long").alias("campaign_id"),
        F.col("r_name").alias("campaign_name"),
        F.col("r_name").alias("target_segment"),
        (F.lit(50.0) * (F.col("r_regionkey") + 1)).alias("daily_budget"),
        F.lit(None).cast("date").alias("start_date"),
        F.lit(None).cast("date").alias("end_date"),
        F.lit("ACTIVE").alias("status"),
    )


def leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("lead_id"),
        F.col("p_name").alias("first_name"),
        F.lit(None).cast("string").alias("last_name"),
        F.col("p_type").alias("job_title"),
        F.col("p_brand").alias("company_name"),
        F.col("p_type").alias("industry"),
        F.lit(None).cast("string").alias("location"),
        F.col("p_brand").alias("target_segment"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as an activity batch (``v_event``)."""
    return events_view(read_table(spark, sf_dir, "events"))


def events_view(e: DataFrame) -> DataFrame:
    """The ``v_event`` projection of a batch or streaming ``events`` frame."""
    et = F.col("event_type")
    ts = F.col("ts").cast("timestamp")
    return e.select(
        F.col("event_id"),
        F.col("user_id").alias("agent_id"),
        F.get_json_object("props", "$.k").cast("long").alias("lead_id"),
        (F.col("event_id") % CAMPAIGN_MODULUS).alias("campaign_id"),
        date_key(ts).alias("date_key"),
        ts.alias("event_timestamp"),
        _map_expr(EVENT_TYPE_MAP, et).alias("event_type"),
        F.when(et == "signup", F.floor("value").cast("int")).alias("message_length"),
        F.when(et.isin("click", "purchase"), F.col("value")).alias("response_latency_hours"),
        ((et == "purchase") & (F.col("value") > CONVERSION_VALUE)).cast("int").alias("is_converted"),
        F.col("event_id").alias("ingest_order"),
    )


def calendar_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole calendar years covering the event stream (one row: start, end)."""
    e = read_table(spark, sf_dir, "events")
    return e.agg(F.make_date(F.year(F.min("ts")), F.lit(1), F.lit(1)).alias("start"),
                 F.make_date(F.year(F.max("ts")), F.lit(12), F.lit(31)).alias("end"))


def dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar(spark, calendar_bounds(spark, sf_dir))


def daily_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier × ship-day series from ``lineitem`` (``v_daily_long``)."""
    li = read_table(spark, sf_dir, "lineitem")
    sup = read_table(spark, sf_dir, "supplier")
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    daily = (li.groupBy(F.col("l_suppkey").alias("agent_id"),
                        date_key("l_shipdate").alias("date_key"))
             .agg(F.count(F.lit(1)).alias("invites_sent"),
                  F.count_if(rf == "R").alias("invites_accepted"),
                  F.count_if(ls == "O").alias("messages_sent"),
                  F.count_if((ls == "O") & (rf == "A")).alias("replies_received")))
    tiers = spark.createDataFrame(
        [(i, lab, inv, msg) for i, (lab, _c, inv, msg, _h) in enumerate(TIER_LIMITS)],
        "tier_idx int, account_age_tier string, daily_invite_ceiling int, "
        "daily_message_ceiling int")
    s = sup.select(F.col("s_suppkey").alias("agent_id"),
                   (F.col("s_nationkey") % len(TIER_LIMITS)).alias("tier_idx"))
    s = s.join(F.broadcast(tiers), "tier_idx").drop("tier_idx")
    return daily.join(s, "agent_id")
