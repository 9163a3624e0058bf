"""Hot keys: one agent with a third of the events, one id copied many times.

Results must stay whole and exact on the paths built for skew: map-side
combined aggregates, ``min_by`` dedupe, agent × day windows.
"""

from pyspark.sql import functions as F

from activity_engine.operators import ingest, quality, risk
from activity_engine.operators.daily import daily_counts
from activity_engine.operators.keys import resolve_keys


def skewed(spark, n=30000):
    # agent 0 holds a third of all rows; the rest spread over 500 agents
    return spark.range(n).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500 + 1).alias("agent_sk"),
        (F.lit(20260801) + F.col("id") % 20).cast("int").alias("date_key"),
        F.when(F.col("id") % 2 == 0, "INVITE_SENT").otherwise("INVITE_ACCEPTED").alias("event_type"),
        F.col("id").alias("ingest_order"))


def test_hot_agent_daily_counts_and_scores(spark):
    df = skewed(spark).repartition(16)
    counts = daily_counts(df)
    hot = counts.where("agent_sk = 0").agg(F.sum("invites_sent") + F.sum("invites_accepted")).first()[0]
    assert hot == 10000
    assert counts.agg(F.sum(F.col("invites_sent") + F.col("invites_accepted"))).first()[0] == 30000
    d = counts.withColumn("daily_invite_ceiling", F.lit(30)).withColumn("daily_message_ceiling", F.lit(60))
    scored = risk.score_daily(d)
    assert scored.count() == counts.count()
    assert scored.where("agent_sk = 0").count() == 20     # one row per day, not per event


def test_hot_duplicate_id_first_arrival(spark):
    base = skewed(spark, 3000)
    # id 7 delivered 10,000 more times, all later than the original
    copies = spark.range(10000).select(
        F.lit(7).cast("long").alias("event_id"), F.lit(1).cast("long").alias("agent_sk"),
        F.lit(20260801).alias("date_key"), F.lit("MESSAGE_SENT").alias("event_type"),
        (F.col("id") + 100000).alias("ingest_order"))
    batch = base.unionByName(copies).repartition(16)
    out = ingest.dedupe_first_wins(batch, "event_id", "ingest_order")
    assert out.count() == 3000
    r = out.where("event_id = 7").first()
    assert (r.event_type, r.ingest_order) == ("INVITE_ACCEPTED", 7)
    u = quality.check_uniqueness(batch, "event_id").first()
    assert u.records_failed == 10001 and u.records_evaluated == 13000


def test_null_event_type_is_quarantined(spark):
    df = spark.createDataFrame(
        [("E1", 1, 1, 1, 20260801, "2026-08-01T00:00:00Z", None),
         ("E2", 1, 1, 1, 20260801, "2026-08-01T00:00:00Z", ""),
         ("E3", 1, 1, 1, 20260801, "2026-08-01T00:00:00Z", "INVITE_SENT")],
        "event_id string, agent_sk long, lead_sk long, campaign_sk long, date_key int, "
        "event_timestamp string, event_type string")
    valid, dead = ingest.split_quarantine(df, df.columns)
    assert [r.event_id for r in valid.collect()] == ["E3"]
    assert dead.count() == 2


def test_key_resolution_without_broadcast_splits_hot_and_null_keys(spark):
    """Sort-merge joins, a third of the leads one key and a third null: Spark splits their partitions."""
    n = 60_000
    lead = F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 3 == 1, None).otherwise(F.col("id") % 5000)
    batch = spark.range(n).select(
        F.col("id").alias("event_id"), (F.col("id") % 700).alias("agent_id"), lead.alias("lead_id"),
        (F.col("id") % 40).alias("campaign_id"), F.sha2(F.col("id").cast("string"), 512).alias("body")).repartition(12)
    agents = spark.range(650).select(F.col("id").alias("agent_id"), (F.col("id") + 1).alias("agent_sk"), F.lit(1).alias("is_current"))
    leads = spark.range(4000).select(F.col("id").alias("lead_id"), (F.col("id") + 1).alias("lead_sk"))
    campaigns = spark.range(30).select(F.col("id").alias("campaign_id"), (F.col("id") + 1).alias("campaign_sk"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k", "spark.sql.shuffle.partitions": "16",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = resolve_keys(batch, agents, leads, campaigns)
        got = out.agg(F.count(F.lit(1)).alias("n"), F.count("agent_sk").alias("a"), F.count("lead_sk").alias("l"),
                      F.count("campaign_sk").alias("c"), F.max("body").alias("body"))
        row = got.collect()[0]
        plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    ids = range(n)
    leads_of = [1 if i % 3 == 0 else None if i % 3 == 1 else i % 5000 for i in ids]
    assert row.n == n and row.a == sum(i % 700 < 650 for i in ids) and row.c == sum(i % 40 < 30 for i in ids)
    assert row.l == sum(k is not None and k < 4000 for k in leads_of)
    assert "SortMergeJoin(skew=true)" in plan and "BroadcastHashJoin" not in plan

