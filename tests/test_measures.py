"""M1-M22 on a hand-computed star (DIVIDE semantics, dimension denominators)."""

import pytest

from activity_engine.functions.dates import calendar
from activity_engine.operators import measures


@pytest.fixture()
def star(spark):
    fact = spark.createDataFrame([
        (1, 1, 20260801, "INVITE_SENT", 0), (1, 1, 20260801, "INVITE_SENT", 0),
        (1, 1, 20260802, "INVITE_ACCEPTED", 1), (2, 2, 20260801, "INVITE_SENT", 0),
        (2, 2, 20260801, "MESSAGE_SENT", 0), (2, 2, 20260802, "REPLY_RECEIVED", 1),
    ], "agent_sk long, campaign_sk long, date_key int, event_type string, is_converted int")
    agents = spark.createDataFrame([
        (1, "A", "1 Month", 10, 15, "ACTIVE", 1), (2, "B", "1+ Year", 30, 60, "PAUSED", 1),
        (3, "C", "1 Month", 10, 15, "ACTIVE", 0),          # a closed historical version
    ], "agent_sk long, agent_id string, account_age_tier string, daily_invite_ceiling int, "
       "daily_message_ceiling int, status string, is_current int")
    camps = spark.createDataFrame([(1, "Alpha", 100.0), (2, "Beta", 50.0), (3, "Idle", 10.0)],
                                  "campaign_sk long, campaign_name string, daily_budget double")
    dates = calendar(spark, "2026-08-01", "2026-08-10")        # 10 days
    return fact, {"agent": agents, "campaign": camps, "date": dates}


def test_core_totals(spark, star):
    fact, dims = star
    r = measures.core(fact, dims).first()
    assert (r.total_invites_sent, r.total_invites_accepted, r.total_messages_sent,
            r.total_replies_received, r.total_conversions) == (3, 1, 1, 1, 2)
    assert r.acceptance_rate == 1 / 3 and r.reply_rate == 1.0 and r.conversion_rate == 2 / 3


def test_core_rollup_levels(spark, star):
    fact, dims = star
    rows = measures.core(fact, dims, ["campaign_name", "account_age_tier"], rollup=True).collect()
    grand = [r for r in rows if r.grouping_id == 3]
    assert len(grand) == 1 and grand[0].total_invites_sent == 3
    assert len(rows) == 2 + 2 + 1            # leaf pairs, campaign subtotals, grand total


def test_capacity_uses_dimension_denominators(spark, star):
    fact, dims = star
    got = {r.account_age_tier: r for r in measures.capacity(fact, dims, ["account_age_tier"]).collect()}
    one = got["1 Month"]
    # ceilings of all versions (10 + 10) times all 10 calendar days
    assert one.invite_capacity_utilization == 2 / (20 * 10)
    assert (one.active_agents, one.paused_or_ghosted_agents) == (1, 0)
    assert got["1+ Year"].paused_or_ghosted_agents == 1


def test_campaign_economics_and_zero_division(spark, star):
    fact, dims = star
    got = {r.campaign_name: r for r in measures.campaign(fact, dims).collect()}
    a = got["Alpha"]
    assert a.total_campaign_budget == 1000.0 and a.cost_per_invite == 500.0
    assert a.estimated_pipeline_value == 5000 and a.campaign_roi_multiplier == 5.0
    idle = got["Idle"]                     # no events: DIVIDE(x, 0, 0) = 0
    assert idle.cost_per_invite == 0.0 and idle.cost_per_conversion == 0.0


def test_risk_measures(spark, star):
    fact, dims = star
    daily = spark.createDataFrame([(1, 20260801, 0.5, "CRITICAL", 3), (1, 20260802, -1.0, "NORMAL", 10),
                                   (2, 20260801, 0.0, "WARNING", 21)],
                                  "agent_sk long, date_key int, anomaly_score double, "
                                  "risk_level string, recommended_invite_capacity int")
    got = {r.account_age_tier: r for r in measures.risk(daily, dims, ["account_age_tier"]).collect()}
    one = got["1 Month"]
    assert (one.critical_risk_days, one.warning_risk_days, one.recommended_safe_invites) == (1, 0, 13)
    assert one.avg_anomaly_z == -0.25
    assert one.throttled_capacity_variance == (200 - 13) / 200


def test_denominators_come_from_each_columns_own_dimension(spark, star):
    fact, dims = star
    got = {(r.day_name, r.account_age_tier, r.grouping_id): r
           for r in measures.capacity(fact, dims, ["day_name", "account_age_tier"], rollup=True).collect()}
    # 1 and 8 August 2026 are Saturdays: the leaf has two days, its tier's ceilings (10 + 10)
    saturday = next(d.day_name for d in dims["date"].where("date_key = 20260801").collect())
    assert got[saturday, "1 Month", 0].invite_capacity_utilization == 2 / (20 * 2)
    assert got[saturday, None, 1].invite_capacity_utilization == 3 / (50 * 2)
    assert got[None, None, 3].invite_capacity_utilization == 3 / (50 * 10)
    assert got[None, None, 3].active_agents == 1 and got[saturday, "1+ Year", 0].paused_or_ghosted_agents == 1


def test_members_without_facts_and_null_members(spark, star):
    fact, dims = star
    unknown = spark.createDataFrame([(9, 9, 20260801, "INVITE_SENT", 0)], fact.schema)
    agents = dims["agent"].unionByName(spark.createDataFrame(
        [(4, "D", None, 7, 9, "GHOSTED", 1), (5, "E", "Idle", 1, 1, "ACTIVE", 1)], dims["agent"].schema))
    rows = measures.capacity(fact.unionByName(unknown), dims | {"agent": agents}, ["account_age_tier"], rollup=True).collect()
    got = {(r.account_age_tier, r.grouping_id): r for r in rows}
    assert len(rows) == 5 and got["Idle", 0].total_invites_sent == 0 and got["Idle", 0].active_agents == 1
    assert got[None, 0].total_invites_sent == 1 and got[None, 0].paused_or_ghosted_agents == 1  # the null member
    assert got[None, 1].total_invites_sent == 4 and got[None, 1].paused_or_ghosted_agents == 2  # the total
    by_tier = measures.campaign(fact, dims | {"agent": agents}, ["account_age_tier"]).collect()
    assert {r.account_age_tier for r in by_tier} == {"1 Month", "1+ Year", "Idle", None}
    assert all(r.total_campaign_budget == 1600.0 for r in by_tier)      # a tier does not narrow budgets


def test_filter_context(spark, star):
    fact, dims = star
    from pyspark.sql import functions as F
    own, narrowed = measures.filtered(fact, dims, {"agent": F.col("status") == "ACTIVE"}, (20260801, 20260802))
    r = measures.capacity(own, narrowed).first()
    assert (r.total_invites_sent, r.active_agents, r.paused_or_ghosted_agents) == (2, 1, 0)
    assert r.invite_capacity_utilization == 2 / (20 * 2)
    own, narrowed = measures.filtered(fact, dims, {"campaign": F.col("campaign_name") == "Beta"})
    assert measures.campaign(own, narrowed, []).first().total_campaign_budget == 500.0
    assert measures.core(own, narrowed).first().total_messages_sent == 1


def test_unrelated_columns_are_refused(spark, star):
    fact, dims = star
    daily = spark.createDataFrame([], "agent_sk long, date_key int, anomaly_score double, risk_level string, "
                                      "recommended_invite_capacity int")
    with pytest.raises(ValueError):
        measures.risk(daily, dims, ["campaign_name"])
    empty = measures.risk(daily, dims).first()
    assert empty.critical_risk_days == 0 and empty.avg_anomaly_z is None and empty.throttled_capacity_variance == 1.0
