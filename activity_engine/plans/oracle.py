"""DuckDB SQL for each registered query (the correctness oracle).

Written independently of the Spark plans: the analogue views, the star
join and the EWMA (as an explicit weighted self-join) are spelled out in
plain SQL over the driver tables.
"""

from __future__ import annotations

from activity_engine.config import TIER_LIMITS

D = "::DOUBLE"


def _tier_values() -> str:
    rows = ", ".join(f"('{a}', '{b}', {c}, {d}, {e})" for a, b, c, d, e in TIER_LIMITS)
    return (f"tiers AS (SELECT * FROM (VALUES {rows}) "
            "t(account_age_tier, risk_classification, daily_invite_ceiling, "
            "daily_message_ceiling, cooldown_hours))")


DK = "CAST(year({0}) * 10000 + month({0}) * 100 + day({0}) AS INTEGER)"

BASE_CTES = [
    _tier_values(),
    """v_agent AS (
  SELECT c_custkey AS agent_id, c_name AS agent_name,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '< 1 Month' WHEN 'BUILDING' THEN '1 Month'
      WHEN 'FURNITURE' THEN '2–6 Months' WHEN 'HOUSEHOLD' THEN '6–12 Months'
      WHEN 'MACHINERY' THEN '1+ Year' END AS account_age_tier,
    CASE WHEN c_acctbal < 0 THEN 'PAUSED' ELSE 'ACTIVE' END AS status
  FROM customer)""",
    """dim_agent AS (
  SELECT row_number() OVER (ORDER BY a.agent_id) AS agent_sk, a.agent_id, a.agent_name,
    a.account_age_tier, t.risk_classification, t.daily_invite_ceiling, t.daily_message_ceiling,
    a.status, 1 AS is_current
  FROM v_agent a LEFT JOIN tiers t ON a.account_age_tier = t.account_age_tier)""",
    """dim_lead AS (SELECT row_number() OVER (ORDER BY p_partkey) AS lead_sk, p_partkey AS lead_id
  FROM part)""",
    """dim_campaign AS (
  SELECT row_number() OVER (ORDER BY r_regionkey) AS campaign_sk,
    CAST(r_regionkey AS BIGINT) AS campaign_id, r_name AS campaign_name,
    50.0::DOUBLE * (r_regionkey + 1) AS daily_budget
  FROM region)""",
    f"""bounds AS (SELECT make_date(year(min(ts)), 1, 1) AS s, make_date(year(max(ts)), 12, 31) AS e
  FROM events)""",
    f"""days AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS d FROM bounds)""",
    f"""dim_date AS (
  SELECT {DK.format('d')} AS date_key, d AS full_date,
    CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name,
    CAST(month(d) AS INTEGER) AS month_number, monthname(d) AS month_name,
    CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
    CASE WHEN isodow(d) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend
  FROM days)""",
    f"""v_event AS (
  SELECT event_id, user_id AS agent_id,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS lead_id,
    event_id % 7 AS campaign_id,
    {DK.format('ts')} AS date_key,
    ts AS event_timestamp,
    CASE event_type WHEN 'view' THEN 'INVITE_SENT' WHEN 'click' THEN 'INVITE_ACCEPTED'
      WHEN 'signup' THEN 'MESSAGE_SENT' WHEN 'purchase' THEN 'REPLY_RECEIVED'
      ELSE event_type END AS event_type,
    CASE WHEN event_type = 'signup' THEN CAST(floor(value) AS INTEGER) END AS message_length,
    CASE WHEN event_type IN ('click', 'purchase') THEN value END AS response_latency_hours,
    CAST(event_type = 'purchase' AND value > 100 AS INTEGER) AS is_converted,
    event_id AS ingest_order, value
  FROM events)""",
    """resolved AS (
  SELECT e.*, a.agent_sk, l.lead_sk, c.campaign_sk
  FROM v_event e
  LEFT JOIN dim_agent a ON e.agent_id = a.agent_id AND a.is_current = 1
  LEFT JOIN dim_lead l ON e.lead_id = l.lead_id
  LEFT JOIN dim_campaign c ON e.campaign_id = c.campaign_id)""",
    """fact AS (
  SELECT * FROM resolved
  WHERE agent_sk IS NOT NULL AND lead_sk IS NOT NULL AND campaign_sk IS NOT NULL
    AND event_timestamp IS NOT NULL AND event_type IS NOT NULL AND event_type <> ''
    AND event_id IS NOT NULL AND date_key IS NOT NULL)""",
    """daily AS (
  SELECT a.agent_id, a.account_age_tier, a.daily_invite_ceiling, a.daily_message_ceiling,
    f.date_key, d.full_date,
    count(*) FILTER (WHERE f.event_type = 'INVITE_SENT') AS invites_sent,
    count(*) FILTER (WHERE f.event_type = 'INVITE_ACCEPTED') AS invites_accepted,
    count(*) FILTER (WHERE f.event_type = 'MESSAGE_SENT') AS messages_sent,
    count(*) FILTER (WHERE f.event_type = 'REPLY_RECEIVED') AS replies_received
  FROM fact f JOIN dim_agent a ON f.agent_sk = a.agent_sk
  JOIN dim_date d ON f.date_key = d.date_key
  GROUP BY ALL)""",
]

LONG_CTES = [
    _tier_values(),
    "tier_idx AS (SELECT * FROM (VALUES " + ", ".join(
        f"({i}, '{a}', {c}, {d})" for i, (a, _b, c, d, _e) in enumerate(TIER_LIMITS))
    + ") t(i, account_age_tier, daily_invite_ceiling, daily_message_ceiling))",
    f"""daily_long AS (
  SELECT l.l_suppkey AS agent_id, {DK.format('l.l_shipdate')} AS date_key,
    count(*) AS invites_sent,
    count(*) FILTER (WHERE l_returnflag = 'R') AS invites_accepted,
    count(*) FILTER (WHERE l_linestatus = 'O') AS messages_sent,
    count(*) FILTER (WHERE l_linestatus = 'O' AND l_returnflag = 'A') AS replies_received,
    any_value(t.account_age_tier) AS account_age_tier,
    any_value(t.daily_invite_ceiling) AS daily_invite_ceiling,
    any_value(t.daily_message_ceiling) AS daily_message_ceiling
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN tier_idx t ON s.s_nationkey % 5 = t.i
  GROUP BY 1, 2)""",
]


def with_ctes(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def rates_cte(src: str, name: str = "rated") -> str:
    return f"""{name} AS (
  SELECT *,
    CASE WHEN invites_sent > 0 THEN invites_accepted{D} / invites_sent ELSE 0.0{D} END
      AS acceptance_rate,
    CASE WHEN messages_sent > 0 THEN replies_received{D} / messages_sent ELSE 0.0{D} END
      AS reply_rate,
    round_even(invites_sent{D} / daily_invite_ceiling * 100.0{D}, 2) + 0.0{D}
      AS invite_limit_utilization_pct,
    round_even(messages_sent{D} / daily_message_ceiling * 100.0{D}, 2) + 0.0{D}
      AS message_limit_utilization_pct
  FROM {src})"""


def ewm_ctes(src: str, x: str, key: str = "agent_id", prefix: str = "e", q: float = 0.75,
             min_points: int = 5) -> list[str]:
    """EW mean / bias-corrected variance of previous rows as a weighted self-join."""
    p = prefix
    w = f"power({q!r}{D}, a.t - 1 - b.t)"
    return [
        f"""{p}0 AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY date_key) - 1 AS t
  FROM {src})""",
        f"""{p}1 AS (
  SELECT a.{key}, a.t, sum({w}) AS s1, sum({w} * {w}) AS s2, sum({w} * b.{x}) / sum({w}) AS m
  FROM {p}0 a JOIN {p}0 b ON a.{key} = b.{key} AND b.t < a.t
  WHERE a.t >= {min_points} GROUP BY a.{key}, a.t)""",
        f"""{p}2 AS (
  SELECT a.{key}, a.t, a.m AS ew_mean,
    (sum({w} * (b.{x} - a.m) * (b.{x} - a.m)) / a.s1) * (a.s1 * a.s1) / (a.s1 * a.s1 - a.s2)
      AS ew_var
  FROM {p}1 a JOIN {p}0 b ON a.{key} = b.{key} AND b.t < a.t
  GROUP BY a.{key}, a.t, a.m, a.s1, a.s2)""",
        f"""{p}3 AS (SELECT x.*, y.ew_mean, y.ew_var FROM {p}0 x
  LEFT JOIN {p}2 y ON x.{key} = y.{key} AND x.t = y.t)""",
    ]


def risk_ctes(src: str, key: str = "agent_id", span: int = 7, out: str = "scored",
              p: str = "") -> list[str]:
    """W11 in SQL: rates, EWMA, backfill, z, risk level, capacities."""
    q = 1.0 - 2.0 / (span + 1.0)
    return [rates_cte(src, f"{p}rr")] + ewm_ctes(f"{p}rr", "acceptance_rate", key, f"{p}e", q) + [
        f"""{p}k1 AS (
  SELECT *,
    coalesce(ew_mean, max(CASE WHEN t = 5 THEN ew_mean END) OVER w,
             avg(acceptance_rate) OVER w) AS rolling_mean_acc,
    greatest(coalesce(sqrt(ew_var), max(CASE WHEN t = 5 THEN sqrt(ew_var) END) OVER w,
                      0.08{D}), 0.05{D}) AS rolling_std_acc
  FROM {p}e3 WINDOW w AS (PARTITION BY {key}))""",
        f"""{p}k2 AS (
  SELECT *,
    round_even(coalesce((acceptance_rate - rolling_mean_acc) / rolling_std_acc, 0.0{D}), 3)
      + 0.0{D} AS anomaly_score,
    (invites_sent > 0 AND acceptance_rate <= 0.05{D}) AS low
  FROM {p}k1)""",
        f"""{p}k3 AS (
  SELECT *, low AND coalesce(lag(low) OVER (PARTITION BY {key} ORDER BY date_key), false)
    AS two_low FROM {p}k2)""",
        f"""{p}k4 AS (
  SELECT *,
    CASE WHEN anomaly_score <= -2.0{D} OR two_low THEN 'CRITICAL'
         WHEN anomaly_score <= -1.5{D}
           OR (rolling_mean_acc >= 0.20{D} AND acceptance_rate <= 0.15{D}) THEN 'WARNING'
         ELSE 'NORMAL' END AS risk_level
  FROM {p}k3)""",
        f"""{out} AS (
  SELECT *,
    CAST(greatest(1, floor(daily_invite_ceiling * CASE risk_level WHEN 'CRITICAL' THEN 0.30{D}
      WHEN 'WARNING' THEN 0.70{D} ELSE 1.0{D} END)) AS INTEGER) AS recommended_invite_capacity,
    CAST(greatest(2, floor(daily_message_ceiling * CASE risk_level WHEN 'CRITICAL' THEN 0.30{D}
      WHEN 'WARNING' THEN 0.70{D} ELSE 1.0{D} END)) AS INTEGER) AS recommended_message_capacity
  FROM {p}k4)""",
    ]


RISK_OUT = """agent_id, date_key, invites_sent, invites_accepted, messages_sent, replies_received,
  acceptance_rate, reply_rate, invite_limit_utilization_pct, message_limit_utilization_pct,
  anomaly_score, risk_level, recommended_invite_capacity, recommended_message_capacity"""
