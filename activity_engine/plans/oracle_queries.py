"""Oracle SQL keyed by query name (same names as ``catalog.QUERIES``)."""

from __future__ import annotations

from activity_engine.config import QUARANTINE_REASON, SOURCE_SYSTEM, TIER_LIMITS
from activity_engine.schemas import TABLES
from activity_engine.plans.oracle import (BASE_CTES, D, LONG_CTES, RISK_OUT, risk_ctes,
                                          with_ctes, rates_cte)

ORACLE: dict[str, str] = {}


def sql(name: str, text: str) -> None:
    ORACLE[name] = text


sql("dim_date", with_ctes(BASE_CTES, "SELECT * FROM dim_date"))

sql("daily_agent_activity", with_ctes(BASE_CTES, """
SELECT agent_id, date_key, full_date, account_age_tier, daily_invite_ceiling,
  daily_message_ceiling, invites_sent, invites_accepted, messages_sent, replies_received
FROM daily"""))

sql("daily_rates_utilization", with_ctes(BASE_CTES + [rates_cte("daily")], """
SELECT agent_id, date_key, acceptance_rate, reply_rate, invite_limit_utilization_pct,
  message_limit_utilization_pct
FROM rated"""))

sql("agent_risk_daily", with_ctes(BASE_CTES + risk_ctes("daily"), f"SELECT {RISK_OUT} FROM scored"))

sql("ewma_baseline", with_ctes(BASE_CTES + risk_ctes("daily"), """
SELECT agent_id, date_key, round_even(rolling_mean_acc, 9) + 0.0 AS rolling_mean_acc,
  round_even(rolling_std_acc, 9) + 0.0 AS rolling_std_acc
FROM scored"""))

sql("agent_risk_long_series", with_ctes(LONG_CTES + risk_ctes("daily_long"),
                                        f"SELECT {RISK_OUT} FROM scored"))

sql("risk_summary", with_ctes(BASE_CTES + risk_ctes("daily"), """
SELECT count(*) AS records_processed,
  count(*) FILTER (WHERE risk_level <> 'NORMAL') AS anomalies_flagged,
  count(*) FILTER (WHERE risk_level = 'CRITICAL') AS critical_risk_count
FROM scored"""))


# -- data quality ------------------------------------------------------------------

def score(f: str, cells: str) -> str:
    return (f"round_even(greatest(0.0::DOUBLE, 100.0::DOUBLE * (1.0::DOUBLE - ({f})::DOUBLE"
            f" / greatest(1, {cells})::DOUBLE)), 2) + 0.0::DOUBLE")


DOC_COLS = ("doc_id", "text", "lang", "source", "quality", "toxic")
miss = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS m_{c}" for c in DOC_COLS)
msum = " + ".join(f"m_{c}" for c in DOC_COLS)
mjson = ", ".join(f"'{c}', m_{c}" for c in DOC_COLS)
sql("dq_completeness", f"""
WITH b AS (SELECT d.doc_id, d.text, d.lang, d.source, l.quality, l.toxic
           FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
c AS (SELECT count(*) AS n, {miss} FROM b)
SELECT 'COMPLETENESS' AS dimension, n AS records_evaluated,
  CAST({msum} AS BIGINT) AS records_failed, {score(msum, 'n * 6')} AS dimension_score,
  CASE WHEN n = 0 THEN '{{}}' ELSE CAST(json_object({mjson}) AS VARCHAR) END AS details
FROM c""")


def sample_json(src: str, col: str, wrap: str | None = None) -> str:
    lst = f"coalesce(list({col} ORDER BY {col}), []::VARCHAR[])"
    body = f"CAST(json_object('{wrap}', {lst}) AS VARCHAR)" if wrap else f"CAST(to_json({lst}) AS VARCHAR)"
    return f"(SELECT {body} FROM (SELECT {col} FROM {src} ORDER BY {col} NULLS FIRST LIMIT 5))"


sql("dq_uniqueness", f"""
WITH g AS (SELECT l_orderkey, l_linenumber, count(*) AS c FROM lineitem GROUP BY ALL),
dup AS (SELECT concat_ws('|', l_orderkey, l_linenumber) AS k FROM g WHERE c > 1),
a AS (SELECT CAST(coalesce(sum(c), 0) AS BIGINT) AS n,
             CAST(coalesce(sum(c) FILTER (WHERE c > 1), 0) AS BIGINT) AS f FROM g)
SELECT 'UNIQUENESS' AS dimension, n AS records_evaluated, f AS records_failed,
  {score('f', 'n')} AS dimension_score, {sample_json('dup', 'k')} AS details
FROM a""")

ALLOWED = "('INVITE_SENT', 'INVITE_ACCEPTED', 'MESSAGE_SENT', 'REPLY_RECEIVED', 'CONNECTION_WITHDRAWN')"
INVALID = f"NOT coalesce(event_type IN {ALLOWED}, false)"

sql("dq_validity", with_ctes(BASE_CTES, f""",
bad AS (SELECT DISTINCT event_type AS v FROM v_event WHERE {INVALID}),
a AS (SELECT count(*) AS n, count(*) FILTER (WHERE {INVALID}) AS f FROM v_event)
SELECT 'VALIDITY' AS dimension, n AS records_evaluated, f AS records_failed,
  {score('f', 'n')} AS dimension_score,
  {sample_json('bad', 'v', 'invalid_event_types')} AS details
FROM a""").replace("\n,\nbad", ",\nbad"))

TS_NOW, TS_MIN = "TIMESTAMP '2024-01-25 00:00:00'", "TIMESTAMP '2024-01-05 00:00:00'"
sql("dq_timeliness", with_ctes(BASE_CTES, f""",
a AS (SELECT count(*) AS n,
        count(*) FILTER (WHERE event_timestamp > {TS_NOW}) AS future_events,
        count(*) FILTER (WHERE event_timestamp < {TS_MIN}) AS stale_events,
        count(*) FILTER (WHERE event_timestamp IS NULL) AS unparseable_dates FROM v_event)
SELECT 'TIMELINESS' AS dimension, n AS records_evaluated,
  future_events + stale_events + unparseable_dates AS records_failed,
  {score('future_events + stale_events + unparseable_dates', 'n')} AS dimension_score,
  CAST(json_object('future_events', future_events, 'stale_events', stale_events,
                   'unparseable_dates', unparseable_dates) AS VARCHAR) AS details
FROM a""").replace("\n,\na AS", ",\na AS"))

REF = """,
ua AS (SELECT DISTINCT agent_id FROM v_event
       WHERE agent_id IS NULL OR agent_id NOT IN (SELECT agent_id FROM dim_agent)),
uc AS (SELECT DISTINCT campaign_id FROM v_event
       WHERE campaign_id IS NULL OR campaign_id NOT IN (SELECT campaign_id FROM dim_campaign)),
ref AS (SELECT (SELECT count(*) FROM v_event) AS n,
               (SELECT count(*) FROM ua) + (SELECT count(*) FROM uc) AS f)"""

sql("dq_referential", with_ctes(BASE_CTES, f"""{REF}
SELECT 'REFERENTIAL_INTEGRITY' AS dimension, n AS records_evaluated, f AS records_failed,
  {score('f', 'n')} AS dimension_score FROM ref""").replace("\n,\nua", ",\nua"))

sql("dq_audit", with_ctes(BASE_CTES, f"""{REF},
comp AS (SELECT count(*) AS n,
  count(*) FILTER (WHERE event_id IS NULL) + count(*) FILTER (WHERE agent_id IS NULL)
  + count(*) FILTER (WHERE lead_id IS NULL) + count(*) FILTER (WHERE campaign_id IS NULL)
  + count(*) FILTER (WHERE event_timestamp IS NULL)
  + count(*) FILTER (WHERE event_type IS NULL) AS f FROM v_event),
uq AS (SELECT coalesce(sum(c) FILTER (WHERE c > 1), 0) AS f
       FROM (SELECT event_id, count(*) AS c FROM v_event GROUP BY 1)),
va AS (SELECT count(*) FILTER (WHERE {INVALID}) AS f FROM v_event),
ti AS (SELECT count(*) FILTER (WHERE event_timestamp > {TS_NOW})
            + count(*) FILTER (WHERE event_timestamp < {TS_MIN})
            + count(*) FILTER (WHERE event_timestamp IS NULL) AS f FROM v_event),
missing AS (SELECT 0 AS o, 'event_id' AS c, count(*) FILTER (WHERE event_id IS NULL) AS m FROM v_event
  UNION ALL SELECT 1 AS o, 'agent_id' AS c, count(*) FILTER (WHERE agent_id IS NULL) AS m FROM v_event
  UNION ALL SELECT 2 AS o, 'lead_id' AS c, count(*) FILTER (WHERE lead_id IS NULL) AS m FROM v_event
  UNION ALL SELECT 3 AS o, 'campaign_id' AS c, count(*) FILTER (WHERE campaign_id IS NULL) AS m FROM v_event
  UNION ALL SELECT 4 AS o, 'event_timestamp' AS c, count(*) FILTER (WHERE event_timestamp IS NULL) AS m FROM v_event
  UNION ALL SELECT 5 AS o, 'event_type' AS c, count(*) FILTER (WHERE event_type IS NULL) AS m FROM v_event),
copied AS (SELECT CAST(event_id AS VARCHAR) AS v FROM v_event GROUP BY 1 HAVING count(*) > 1 ORDER BY v LIMIT 5),
bad AS (SELECT DISTINCT event_type AS v FROM v_event WHERE {INVALID}),
late AS (SELECT count(*) FILTER (WHERE event_timestamp > {TS_NOW}) AS fu, count(*) FILTER (WHERE event_timestamp < {TS_MIN}) AS st,
  count(*) FILTER (WHERE event_timestamp IS NULL) AS un FROM v_event),
lost AS (SELECT k, coalesce(string_agg('"' || v || '"', ',' ORDER BY v), '') AS v FROM (
    SELECT * FROM (SELECT 'agent_id' AS k, CAST(agent_id AS VARCHAR) AS v FROM ua ORDER BY v NULLS FIRST LIMIT 5)
    UNION ALL SELECT * FROM (SELECT 'campaign_id', CAST(campaign_id AS VARCHAR) AS v FROM uc ORDER BY v NULLS FIRST LIMIT 5))
  GROUP BY k),
dims AS (
  SELECT 'COMPLETENESS' AS dimension, n, f, {score('f', 'n * 6')} AS s FROM comp
  UNION ALL SELECT 'UNIQUENESS', (SELECT n FROM comp), f, {score('f', '(SELECT n FROM comp)')} FROM uq
  UNION ALL SELECT 'VALIDITY', (SELECT n FROM comp), f, {score('f', '(SELECT n FROM comp)')} FROM va
  UNION ALL SELECT 'TIMELINESS', (SELECT n FROM comp), f, {score('f', '(SELECT n FROM comp)')} FROM ti
  UNION ALL SELECT 'REFERENTIAL_INTEGRITY', n, f, {score('f', 'n')} FROM ref),
w AS (SELECT round_even(
    (SELECT s FROM dims WHERE dimension = 'COMPLETENESS') * 0.25::DOUBLE
  + (SELECT s FROM dims WHERE dimension = 'UNIQUENESS') * 0.25::DOUBLE
  + (SELECT s FROM dims WHERE dimension = 'VALIDITY') * 0.20::DOUBLE
  + (SELECT s FROM dims WHERE dimension = 'REFERENTIAL_INTEGRITY') * 0.20::DOUBLE
  + (SELECT s FROM dims WHERE dimension = 'TIMELINESS') * 0.10::DOUBLE, 2) + 0.0::DOUBLE AS c)
SELECT 'audit-fixture' AS pipeline_run_id, 'fact_outreach_activity' AS table_name, dimension,
  CAST(n AS BIGINT) AS records_evaluated, CAST(f AS BIGINT) AS records_failed,
  s AS dimension_score, (SELECT c FROM w) AS composite_score,
  CASE WHEN (SELECT c FROM w) >= 95.0 THEN 1 ELSE 0 END AS passed,
  CASE dimension WHEN 'COMPLETENESS' THEN (SELECT '{{' || string_agg('"' || c || '":' || m, ',' ORDER BY o) || '}}' FROM missing)
    WHEN 'UNIQUENESS' THEN (SELECT '[' || coalesce(string_agg('"' || v || '"', ',' ORDER BY v), '') || ']' FROM copied)
    WHEN 'VALIDITY' THEN (SELECT {sample_json('bad', 'v', 'invalid_event_types')})
    WHEN 'TIMELINESS' THEN (SELECT '{{"future_events":' || fu || ',"stale_events":' || st || ',"unparseable_dates":' || un || '}}' FROM late)
    ELSE (SELECT '{{' || coalesce(string_agg('"unresolved_' || k || 's":[' || v || ']', ',' ORDER BY k), '') || '}}' FROM lost) END AS details
FROM dims""").replace("\n,\nua", ",\nua"))

sql("dq_samples", with_ctes(BASE_CTES, f"""{REF}
SELECT * FROM (SELECT 'agent_id' AS key_column, CAST(agent_id AS VARCHAR) AS sample FROM ua
               ORDER BY sample NULLS FIRST LIMIT 5)
UNION ALL
SELECT * FROM (SELECT 'campaign_id', CAST(campaign_id AS VARCHAR) AS sample FROM uc
               ORDER BY sample NULLS FIRST LIMIT 5)
UNION ALL
SELECT * FROM (SELECT 'l_orderkey|l_linenumber', concat_ws('|', l_orderkey, l_linenumber) AS s
               FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
               ORDER BY s LIMIT 5)""").replace("\n,\nua", ",\nua"))


# -- ingest -------------------------------------------------------------------------

sql("sk_lookup", with_ctes(BASE_CTES, """
SELECT event_id, agent_id, lead_id, campaign_id, agent_sk, lead_sk, campaign_sk FROM resolved"""))

QREASON = "Foreign key lookup failed or missing mandatory timestamp/event_type/event_id"
sql("quarantine", with_ctes(BASE_CTES, f"""
SELECT event_id, agent_id, lead_id, campaign_id, '{QREASON}' AS failure_reason
FROM resolved WHERE event_id NOT IN (SELECT event_id FROM fact)"""))

sql("valid_split", with_ctes(BASE_CTES, """
SELECT (SELECT count(*) FROM resolved) AS records_ingested,
  (SELECT count(*) FROM fact) AS records_valid,
  (SELECT count(*) FROM resolved) - (SELECT count(*) FROM fact) AS records_quarantined"""))

REPLAY = """,
rb AS (
  SELECT event_id, 'original' AS delivery, event_id * 2 AS ingest_order, message_length,
         event_timestamp, date_key FROM v_event
  UNION ALL
  SELECT event_id, 'replay', ((SELECT max(event_id) FROM v_event) - event_id) * 2 + 1,
         coalesce(message_length, 0) + 1, event_timestamp, date_key FROM v_event),
first_arrival AS (
  SELECT * FROM rb QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingest_order) = 1)"""

sql("dedupe_first_wins", with_ctes(BASE_CTES, f"""{REPLAY}
SELECT event_id, delivery, ingest_order, message_length FROM first_arrival""")
    .replace("\n,\nrb", ",\nrb"))

MID = ("make_timestamp(epoch_us(min(event_timestamp)) + "
       "CAST(floor((epoch_us(max(event_timestamp)) - epoch_us(min(event_timestamp))) / 2) AS BIGINT))")

sql("idempotent_load", with_ctes(BASE_CTES, f"""{REPLAY},
mid AS (SELECT {MID} AS m FROM v_event),
valid_ids AS (SELECT event_id FROM fact),
load1 AS (SELECT event_id, delivery, date_key FROM rb
          WHERE delivery = 'original' AND event_timestamp < (SELECT m FROM mid)
            AND event_id IN (SELECT event_id FROM valid_ids)),
load2 AS (SELECT event_id, delivery, date_key FROM first_arrival
          WHERE event_id IN (SELECT event_id FROM valid_ids)
            AND event_id NOT IN (SELECT event_id FROM load1))
SELECT * FROM load1 UNION ALL SELECT * FROM load2""").replace("\n,\nrb", ",\nrb"))

sql("dim_insert_if_absent", with_ctes(BASE_CTES, """,
ex AS (SELECT agent_id, account_age_tier FROM v_agent
       WHERE account_age_tier IN ('< 1 Month', '1 Month', '2–6 Months')),
ex_k AS (SELECT agent_id, row_number() OVER (ORDER BY agent_id) AS agent_sk, account_age_tier
         FROM ex),
nw AS (SELECT agent_id, (SELECT coalesce(max(agent_sk), 0) FROM ex_k)
              + row_number() OVER (ORDER BY agent_id) AS agent_sk, account_age_tier
       FROM v_agent WHERE agent_id NOT IN (SELECT agent_id FROM ex))
SELECT agent_id, agent_sk, account_age_tier FROM ex_k
UNION ALL SELECT agent_id, agent_sk, account_age_tier FROM nw""").replace("\n,\nex", ",\nex"))

sql("scd2_merge", with_ctes(BASE_CTES, """,
inc AS (SELECT c_custkey AS agent_id,
          CASE WHEN c_acctbal < 1000 THEN 'PAUSED' ELSE 'ACTIVE' END AS new_status FROM customer),
j AS (SELECT d.agent_id, d.agent_sk, d.status, i.new_status,
        i.agent_id IS NOT NULL AND d.status IS DISTINCT FROM i.new_status AS changed
      FROM dim_agent d LEFT JOIN inc i ON d.agent_id = i.agent_id)
SELECT agent_id, agent_sk, status, CASE WHEN changed THEN 0 ELSE 1 END AS is_current FROM j
UNION ALL
SELECT agent_id, (SELECT max(agent_sk) FROM dim_agent) + row_number() OVER (ORDER BY agent_id),
  new_status, 1 FROM j WHERE changed""").replace("\n,\ninc", ",\ninc"))

sql("snapshot_upsert", with_ctes(
    BASE_CTES + risk_ctes("daily", span=14, out="old_s", p="o_") + risk_ctes("daily"), f"""
SELECT {RISK_OUT} FROM old_s
WHERE (agent_id, date_key) NOT IN (SELECT (agent_id, date_key) FROM scored WHERE replies_received > 0)
UNION ALL
SELECT {RISK_OUT} FROM scored WHERE replies_received > 0"""))

sql("high_watermark", with_ctes(BASE_CTES, "SELECT max(event_timestamp) AS watermark FROM v_event"))

sql("incremental_filter", with_ctes(BASE_CTES, f"""
SELECT event_id, date_key FROM v_event
WHERE event_timestamp > (SELECT {MID} FROM v_event)"""))


# -- measures -------------------------------------------------------------------------

def sdiv(a: str, b: str) -> str:
    return f"coalesce(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 0.0::DOUBLE)"


CORE_AGG = """
  CAST(count(*) FILTER (WHERE f.event_type = 'INVITE_SENT') AS BIGINT) AS total_invites_sent,
  CAST(count(*) FILTER (WHERE f.event_type = 'INVITE_ACCEPTED') AS BIGINT) AS total_invites_accepted,
  CAST(count(*) FILTER (WHERE f.event_type = 'MESSAGE_SENT') AS BIGINT) AS total_messages_sent,
  CAST(count(*) FILTER (WHERE f.event_type = 'REPLY_RECEIVED') AS BIGINT) AS total_replies_received,
  CAST(count(*) FILTER (WHERE f.is_converted = 1) AS BIGINT) AS total_conversions"""


def core_sql(by: list[str], group: str) -> str:
    sel = "".join(f"{b}, " for b in by)
    return with_ctes(BASE_CTES, f""",
agg AS (SELECT {sel}{CORE_AGG}
  FROM fact f LEFT JOIN dim_agent a ON f.agent_sk = a.agent_sk
  LEFT JOIN dim_campaign c ON f.campaign_sk = c.campaign_sk
  LEFT JOIN dim_date d ON f.date_key = d.date_key
  {group})
SELECT {sel}total_invites_sent, total_invites_accepted,
  {sdiv('total_invites_accepted', 'total_invites_sent')} AS acceptance_rate,
  total_messages_sent, total_replies_received,
  {sdiv('total_replies_received', 'total_messages_sent')} AS reply_rate,
  total_conversions, {sdiv('total_conversions', 'total_invites_sent')} AS conversion_rate
FROM agg""").replace("\n,\nagg", ",\nagg")


sql("kpi_core", core_sql([], ""))
sql("kpi_core_by_tier", core_sql(["account_age_tier"], "GROUP BY account_age_tier"))
sql("kpi_core_by_month", core_sql(["month_name"], "GROUP BY month_name"))
sql("kpi_core_rollup", core_sql(["campaign_name", "account_age_tier"],
                                "GROUP BY ROLLUP (campaign_name, account_age_tier)")
    .replace("agg AS (SELECT ", "agg AS (SELECT grouping_id(campaign_name, account_age_tier) AS grouping_id, ")
    .replace("SELECT campaign_name, account_age_tier, total_invites_sent,",
             "SELECT campaign_name, account_age_tier, grouping_id, total_invites_sent,"))

sql("kpi_capacity", with_ctes(BASE_CTES, f""",
a AS (SELECT account_age_tier,
        count(DISTINCT CASE WHEN is_current = 1 AND status = 'ACTIVE' THEN agent_sk END)
          AS active_agents,
        count(DISTINCT CASE WHEN is_current = 1 AND status IN ('PAUSED', 'GHOSTED')
          THEN agent_sk END) AS paused_or_ghosted_agents,
        sum(daily_invite_ceiling) AS ic, sum(daily_message_ceiling) AS mc
      FROM dim_agent GROUP BY 1),
f AS (SELECT a.account_age_tier,
        count(*) FILTER (WHERE f.event_type = 'INVITE_SENT') AS inv,
        count(*) FILTER (WHERE f.event_type = 'MESSAGE_SENT') AS msg
      FROM fact f LEFT JOIN dim_agent a ON f.agent_sk = a.agent_sk GROUP BY 1),
nd AS (SELECT count(DISTINCT date_key) AS days FROM dim_date)
SELECT a.account_age_tier, active_agents, paused_or_ghosted_agents,
  CAST(coalesce(inv, 0) AS BIGINT) AS total_invites_sent,
  CAST(coalesce(msg, 0) AS BIGINT) AS total_messages_sent,
  {sdiv('coalesce(inv, 0)', 'ic * (SELECT days FROM nd)')} AS invite_capacity_utilization,
  {sdiv('coalesce(msg, 0)', 'mc * (SELECT days FROM nd)')} AS message_capacity_utilization
FROM a LEFT JOIN f ON a.account_age_tier IS NOT DISTINCT FROM f.account_age_tier""")
    .replace("\n,\na AS", ",\na AS"))

sql("kpi_risk", with_ctes(BASE_CTES + risk_ctes("daily"), f""",
m AS (SELECT a.account_age_tier, avg(s.anomaly_score) AS z,
        count(*) FILTER (WHERE s.risk_level = 'CRITICAL') AS crit,
        count(*) FILTER (WHERE s.risk_level = 'WARNING') AS warn,
        sum(s.recommended_invite_capacity) AS rec
      FROM scored s LEFT JOIN dim_agent a ON s.agent_id = a.agent_id GROUP BY 1),
c AS (SELECT account_age_tier, sum(daily_invite_ceiling) AS ceil FROM dim_agent GROUP BY 1),
nd AS (SELECT count(DISTINCT date_key) AS days FROM dim_date)
SELECT c.account_age_tier, round_even(m.z, 9) + 0.0 AS avg_anomaly_z,
  CAST(coalesce(crit, 0) AS BIGINT) AS critical_risk_days,
  CAST(coalesce(warn, 0) AS BIGINT) AS warning_risk_days,
  CAST(coalesce(rec, 0) AS BIGINT) AS recommended_safe_invites,
  {sdiv('ceil * (SELECT days FROM nd) - coalesce(rec, 0)', 'ceil * (SELECT days FROM nd)')}
    AS throttled_capacity_variance
FROM c LEFT JOIN m ON c.account_age_tier IS NOT DISTINCT FROM m.account_age_tier""")
    .replace("\n,\nm AS", ",\nm AS"))

sql("kpi_campaign", with_ctes(BASE_CTES, f""",
nd AS (SELECT count(DISTINCT date_key) AS days FROM dim_date),
b AS (SELECT campaign_name, sum(daily_budget * (SELECT days FROM nd)) AS budget
      FROM dim_campaign GROUP BY 1),
f AS (SELECT c.campaign_name,
        count(*) FILTER (WHERE f.event_type = 'INVITE_SENT') AS inv,
        count(*) FILTER (WHERE f.is_converted = 1) AS conv
      FROM fact f LEFT JOIN dim_campaign c ON f.campaign_sk = c.campaign_sk GROUP BY 1)
SELECT b.campaign_name, budget AS total_campaign_budget,
  {sdiv('budget', 'coalesce(inv, 0)')} AS cost_per_invite,
  {sdiv('budget', 'coalesce(conv, 0)')} AS cost_per_conversion,
  CAST(coalesce(conv, 0) * 5000 AS BIGINT) AS estimated_pipeline_value,
  {sdiv('coalesce(conv, 0) * 5000', 'budget')} AS campaign_roi_multiplier
FROM b LEFT JOIN f ON b.campaign_name IS NOT DISTINCT FROM f.campaign_name""")
    .replace("\n,\nnd AS", ",\nnd AS"))


# -- risk extras ----------------------------------------------------------------------

sql("tier_limits_join", with_ctes(BASE_CTES, """
SELECT a.agent_id, a.account_age_tier, t.risk_classification AS tier_risk_classification,
  t.daily_invite_ceiling AS tier_invite_ceiling, t.daily_message_ceiling AS tier_message_ceiling,
  t.cooldown_hours,
  CASE WHEN t.daily_invite_ceiling IS NULL OR d.daily_invite_ceiling <> t.daily_invite_ceiling
    OR d.daily_message_ceiling <> t.daily_message_ceiling THEN 1 ELSE 0 END AS ceiling_mismatch
FROM v_agent a LEFT JOIN tiers t ON a.account_age_tier = t.account_age_tier
JOIN dim_agent d ON a.agent_id = d.agent_id"""))

sql("ceiling_breach", with_ctes(BASE_CTES + risk_ctes("daily"), """
SELECT agent_id, date_key, invites_sent, messages_sent, invite_limit_utilization_pct,
  message_limit_utilization_pct
FROM scored WHERE invite_limit_utilization_pct > 100 OR message_limit_utilization_pct > 100"""))

sql("cooldown_until", with_ctes(BASE_CTES, """,
last AS (SELECT agent_sk, max(event_timestamp) AS last_event_ts FROM fact GROUP BY 1)
SELECT a.agent_id, a.account_age_tier, l.last_event_ts, t.cooldown_hours,
  l.last_event_ts + to_hours(CAST(coalesce(t.cooldown_hours, 0) AS BIGINT)) AS cooldown_until
FROM last l JOIN dim_agent a ON l.agent_sk = a.agent_sk
LEFT JOIN tiers t ON a.account_age_tier = t.account_age_tier""").replace("\n,\nlast", ",\nlast"))

sql("ghosting_runs", with_ctes(BASE_CTES, """,
g AS (SELECT agent_id, date_key,
        CAST(strptime(CAST(date_key AS VARCHAR), '%Y%m%d') AS DATE) - DATE '1970-01-01'
        - row_number() OVER (PARTITION BY agent_id ORDER BY date_key) AS grp
      FROM daily
      WHERE invites_sent + messages_sent > 0 AND invites_accepted + replies_received = 0)
SELECT agent_id, min(date_key) AS run_start, max(date_key) AS run_end,
  count(*) AS run_days, CASE WHEN count(*) >= 5 THEN 1 ELSE 0 END AS is_ghosting
FROM g GROUP BY agent_id, grp""").replace("\n,\ng AS", ",\ng AS"))

sql("reply_decay", with_ctes(BASE_CTES + [rates_cte("daily", "rd")]
                             + __import__("activity_engine.plans.oracle", fromlist=["x"])
                             .ewm_ctes("rd", "reply_rate", "agent_id", "r"), """,
c AS (SELECT *, ew_mean / nullif(lag(ew_mean, 7) OVER (PARTITION BY agent_id ORDER BY date_key), 0.0) - 1.0
        AS ch FROM r3)
SELECT agent_id, date_key, reply_rate, round_even(ch, 9) + 0.0 AS reply_baseline_change,
  CASE WHEN coalesce(ch <= -0.4::DOUBLE, false) THEN 1 ELSE 0 END AS reply_decay_flag
FROM c""").replace("\n,\nc AS", ",\nc AS"))


# -- write paths ------------------------------------------------------------------------

FACT_OUT = """
SELECT CAST(f.event_id AS VARCHAR) AS event_id, f.agent_id, f.date_key, f.event_type,
  coalesce(f.message_length, 0) AS message_length, coalesce(f.is_converted, 0) AS is_converted
FROM fact f"""

sql("pipeline_run", with_ctes(BASE_CTES, FACT_OUT))
sql("stream_ingest", with_ctes(BASE_CTES, FACT_OUT))
sql("risk_model_run", ORACLE["agent_risk_daily"])
sql("feed_export_roundtrip", ORACLE["agent_risk_daily"])

sql("dlq_roundtrip", with_ctes(BASE_CTES, f"""
SELECT event_id, campaign_id, '{QREASON}' AS failure_reason, 'fixture-run' AS run_id
FROM resolved WHERE event_id NOT IN (SELECT event_id FROM fact)"""))

sql("stream_daily_counts", with_ctes(BASE_CTES, """
SELECT agent_id, date_key, invites_sent, invites_accepted, messages_sent, replies_received FROM daily"""))

sql("stream_risk_refresh", ORACLE["agent_risk_daily"])

sql("dim_date_insert_or_ignore", with_ctes(BASE_CTES, """,
b2 AS (SELECT s, CAST(e + INTERVAL 1 YEAR AS DATE) AS e FROM bounds),
d2 AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS d FROM b2)
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key, d AS full_date,
  CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name,
  CAST(month(d) AS INTEGER) AS month_number, monthname(d) AS month_name,
  CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
  CASE WHEN isodow(d) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend,
  (SELECT count(*) FROM d2) - (SELECT count(*) FROM days) AS second_load_added
FROM d2""").replace("\n,\nb2", ",\nb2"))


sql("dq_composite", ORACLE["dq_audit"][:ORACLE["dq_audit"].index("SELECT 'audit-fixture'")]
    + "SELECT c AS composite_score, CASE WHEN c >= 95.0 THEN 1 ELSE 0 END AS passed FROM w")

sql("kpi_capacity_total", with_ctes(BASE_CTES, f""",
a AS (SELECT count(DISTINCT CASE WHEN is_current = 1 AND status = 'ACTIVE' THEN agent_sk END)
          AS active_agents,
        count(DISTINCT CASE WHEN is_current = 1 AND status IN ('PAUSED', 'GHOSTED')
          THEN agent_sk END) AS paused_or_ghosted_agents,
        sum(daily_invite_ceiling) AS ic, sum(daily_message_ceiling) AS mc FROM dim_agent),
f AS (SELECT count(*) FILTER (WHERE event_type = 'INVITE_SENT') AS inv,
             count(*) FILTER (WHERE event_type = 'MESSAGE_SENT') AS msg FROM fact),
nd AS (SELECT count(DISTINCT date_key) AS days FROM dim_date)
SELECT active_agents, paused_or_ghosted_agents,
  CAST(inv AS BIGINT) AS total_invites_sent, CAST(msg AS BIGINT) AS total_messages_sent,
  {sdiv('inv', 'ic * (SELECT days FROM nd)')} AS invite_capacity_utilization,
  {sdiv('msg', 'mc * (SELECT days FROM nd)')} AS message_capacity_utilization
FROM a, f""").replace("\n,\na AS", ",\na AS"))

sql("kpi_risk_total", with_ctes(BASE_CTES + risk_ctes("daily"), f""",
m AS (SELECT avg(anomaly_score) AS z,
        count(*) FILTER (WHERE risk_level = 'CRITICAL') AS crit,
        count(*) FILTER (WHERE risk_level = 'WARNING') AS warn,
        sum(recommended_invite_capacity) AS rec FROM scored),
c AS (SELECT sum(daily_invite_ceiling) AS ceil FROM dim_agent),
nd AS (SELECT count(DISTINCT date_key) AS days FROM dim_date)
SELECT round_even(m.z, 9) + 0.0 AS avg_anomaly_z,
  CAST(crit AS BIGINT) AS critical_risk_days, CAST(warn AS BIGINT) AS warning_risk_days,
  CAST(coalesce(rec, 0) AS BIGINT) AS recommended_safe_invites,
  {sdiv('ceil * (SELECT days FROM nd) - coalesce(rec, 0)', 'ceil * (SELECT days FROM nd)')}
    AS throttled_capacity_variance
FROM m, c""").replace("\n,\nm AS", ",\nm AS"))

sql("kpi_campaign_total", with_ctes(BASE_CTES, f""",
nd AS (SELECT count(DISTINCT date_key) AS days FROM dim_date),
b AS (SELECT sum(daily_budget * (SELECT days FROM nd)) AS budget FROM dim_campaign),
f AS (SELECT count(*) FILTER (WHERE event_type = 'INVITE_SENT') AS inv,
             count(*) FILTER (WHERE is_converted = 1) AS conv FROM fact)
SELECT budget AS total_campaign_budget,
  {sdiv('budget', 'inv')} AS cost_per_invite, {sdiv('budget', 'conv')} AS cost_per_conversion,
  CAST(conv * 5000 AS BIGINT) AS estimated_pipeline_value,
  {sdiv('conv * 5000', 'budget')} AS campaign_roi_multiplier
FROM b, f""").replace("\n,\nnd AS", ",\nnd AS"))


sql("insert_or_ignore_moved_day", with_ctes(BASE_CTES, f""",
mid AS (SELECT {MID} AS m FROM v_event)
SELECT event_id, date_key, CASE WHEN event_timestamp < (SELECT m FROM mid) THEN 1 ELSE 2 END AS load
FROM v_event""").replace("\n,\nmid", ",\nmid"))

sql("dq_invalid_values", "SELECT p_brand AS value, count(*) AS rows FROM part GROUP BY 1")

sql("kpi_capacity_null_member", with_ctes(BASE_CTES, f""",
known AS (SELECT * REPLACE (CASE WHEN account_age_tier <> '{TIER_LIMITS[0][0]}' THEN account_age_tier END
            AS account_age_tier)
          FROM dim_agent WHERE account_age_tier <> '{TIER_LIMITS[1][0]}'),
a AS (SELECT account_age_tier,
        count(DISTINCT CASE WHEN is_current = 1 AND status = 'ACTIVE' THEN agent_sk END)
          AS active_agents,
        count(DISTINCT CASE WHEN is_current = 1 AND status IN ('PAUSED', 'GHOSTED')
          THEN agent_sk END) AS paused_or_ghosted_agents,
        sum(daily_invite_ceiling) AS ic, sum(daily_message_ceiling) AS mc
      FROM known GROUP BY 1),
f AS (SELECT a.account_age_tier,
        count(*) FILTER (WHERE f.event_type = 'INVITE_SENT') AS inv,
        count(*) FILTER (WHERE f.event_type = 'MESSAGE_SENT') AS msg
      FROM fact f LEFT JOIN known a ON f.agent_sk = a.agent_sk GROUP BY 1),
nd AS (SELECT count(DISTINCT date_key) AS days FROM dim_date)
SELECT coalesce(a.account_age_tier, f.account_age_tier) AS account_age_tier,
  coalesce(active_agents, 0) AS active_agents,
  coalesce(paused_or_ghosted_agents, 0) AS paused_or_ghosted_agents,
  CAST(coalesce(inv, 0) AS BIGINT) AS total_invites_sent,
  CAST(coalesce(msg, 0) AS BIGINT) AS total_messages_sent,
  {sdiv('coalesce(inv, 0)', 'ic * (SELECT days FROM nd)')} AS invite_capacity_utilization,
  {sdiv('coalesce(msg, 0)', 'mc * (SELECT days FROM nd)')} AS message_capacity_utilization
FROM a FULL JOIN f ON a.account_age_tier IS NOT DISTINCT FROM f.account_age_tier""")
    .replace("\n,\nknown", ",\nknown"))


# -- measures by columns of several dimensions ------------------------------------------

MEMBER_OF = {"account_age_tier": "agent", "status": "agent", "campaign_name": "campaign",
             "month_name": "date", "day_name": "date"}
DIM_KEY = {"agent": "agent_sk", "campaign": "campaign_sk", "date": "date_key"}
DIM_FIGURES = {
    "agent": """count(DISTINCT CASE WHEN is_current = 1 AND status = 'ACTIVE' THEN agent_sk END) AS active_agents,
      count(DISTINCT CASE WHEN is_current = 1 AND status IN ('PAUSED', 'GHOSTED') THEN agent_sk END)
        AS paused_or_ghosted_agents,
      sum(daily_invite_ceiling) AS ic, sum(daily_message_ceiling) AS mc""",
    "campaign": "sum(daily_budget) AS budgets",
    "date": "count(DISTINCT date_key) AS days"}
EVENT_FIGURES = """count(*) FILTER (WHERE event_type = 'INVITE_SENT') AS inv,
      count(*) FILTER (WHERE event_type = 'MESSAGE_SENT') AS msg,
      count(*) FILTER (WHERE is_converted = 1) AS conv"""
RISK_FIGURES = """avg(anomaly_score) AS z, count(*) FILTER (WHERE risk_level = 'CRITICAL') AS crit,
      count(*) FILTER (WHERE risk_level = 'WARNING') AS warn, sum(recommended_invite_capacity) AS rec"""
CAPACITY_OUT = f"""CAST(coalesce(active_agents, 0) AS BIGINT) AS active_agents,
  CAST(coalesce(paused_or_ghosted_agents, 0) AS BIGINT) AS paused_or_ghosted_agents,
  CAST(coalesce(inv, 0) AS BIGINT) AS total_invites_sent, CAST(coalesce(msg, 0) AS BIGINT) AS total_messages_sent,
  {sdiv('coalesce(inv, 0)', 'ic * days')} AS invite_capacity_utilization,
  {sdiv('coalesce(msg, 0)', 'mc * days')} AS message_capacity_utilization"""
RISK_KPI_OUT = f"""round_even(z, 9) + 0.0 AS avg_anomaly_z, CAST(coalesce(crit, 0) AS BIGINT) AS critical_risk_days,
  CAST(coalesce(warn, 0) AS BIGINT) AS warning_risk_days, CAST(coalesce(rec, 0) AS BIGINT) AS recommended_safe_invites,
  {sdiv('ic * days - coalesce(rec, 0)', 'ic * days')} AS throttled_capacity_variance"""
CAMPAIGN_OUT = f"""budgets * days AS total_campaign_budget, {sdiv('budgets * days', 'coalesce(inv, 0)')} AS cost_per_invite,
  {sdiv('budgets * days', 'coalesce(conv, 0)')} AS cost_per_conversion,
  CAST(coalesce(conv, 0) * 5000 AS BIGINT) AS estimated_pipeline_value,
  {sdiv('coalesce(conv, 0) * 5000', 'budgets * days')} AS campaign_roi_multiplier"""


def level_sql(by: list[str], kept: list[str], figures: str, out: str, fact: str, used: list[str], mark: bool) -> str:
    """One subtotal level: the fact by the kept columns, beside each dimension by its own ones."""
    def same(a: str, b: str, cols: list[str]) -> str:
        return " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in cols) or "true"

    def grouped(cols: list[str], what: str, source: str) -> str:
        return f"(SELECT {', '.join([*cols, what])} FROM {source}{' GROUP BY ' + ', '.join(cols) if cols else ''})"

    owners = sorted({MEMBER_OF[c] for c in by})
    star = fact + "".join(f" LEFT JOIN (SELECT {DIM_KEY[o]}, {', '.join(c for c in by if MEMBER_OF[c] == o)} FROM dim_{o}) d{o}"
                          f" USING ({DIM_KEY[o]})" for o in owners)
    rows = grouped(kept, figures, star)
    if len(owners) == 1 and kept:
        own = f"(SELECT DISTINCT {', '.join(kept)} FROM dim_{owners[0]})"
        names = ", ".join(f"coalesce(f.{c}, m.{c}) AS {c}" for c in kept)
        rows = f"(SELECT f.* EXCLUDE ({', '.join(kept)}), {names} FROM {rows} f FULL JOIN {own} m ON {same('f', 'm', kept)})"
    joins = "".join(
        f" LEFT JOIN {grouped(cols, DIM_FIGURES[d], 'dim_' + d)} {d}_part ON {same('r', d + '_part', cols)}"
        for d in used for cols in [[c for c in kept if MEMBER_OF[c] == d]])
    shown = [f"r.{c}" if c in kept else f"CAST(NULL AS VARCHAR) AS {c}" for c in by]
    level = sum(1 << len(by) - 1 - i for i, c in enumerate(by) if c not in kept)
    return f"SELECT {', '.join([*shown, *([f'CAST({level} AS BIGINT) AS grouping_id'] if mark else []), out])} FROM {rows} r{joins}"


def slices_sql(by: list[str], figures: str, out: str, used: list[str], rollup: bool = False,
               fact: str = "fact", ctes: list[str] = BASE_CTES) -> str:
    levels = [by[:j] for j in range(len(by), -1, -1)] if rollup else [by]
    return with_ctes(ctes, " UNION ALL ".join(level_sql(by, k, figures, out, fact, used, rollup) for k in levels))


RISK_FACT = "(SELECT s.*, a.agent_sk FROM (SELECT agent_id, date_key, anomaly_score, risk_level," \
            " recommended_invite_capacity FROM scored) s JOIN (SELECT agent_id, agent_sk FROM dim_agent) a USING (agent_id))"
RISK_CTES = BASE_CTES + risk_ctes("daily")

sql("kpi_capacity_by_month", slices_sql(["month_name"], EVENT_FIGURES, CAPACITY_OUT, ["agent", "date"]))
sql("kpi_capacity_rollup", slices_sql(["account_age_tier", "month_name"], EVENT_FIGURES, CAPACITY_OUT,
                                      ["agent", "date"], rollup=True))
sql("kpi_capacity_campaign_day", slices_sql(["day_name", "campaign_name", "account_age_tier"], EVENT_FIGURES,
                                            CAPACITY_OUT, ["agent", "date"], rollup=True))
sql("kpi_risk_by_day_name", slices_sql(["day_name"], RISK_FIGURES, RISK_KPI_OUT, ["agent", "date"],
                                       fact=RISK_FACT, ctes=RISK_CTES))
sql("kpi_risk_rollup", slices_sql(["month_name", "account_age_tier", "day_name"], RISK_FIGURES, RISK_KPI_OUT,
                                  ["agent", "date"], rollup=True, fact=RISK_FACT, ctes=RISK_CTES))
sql("kpi_campaign_by_month", slices_sql(["month_name"], EVENT_FIGURES, CAMPAIGN_OUT, ["campaign", "date"]))
sql("kpi_campaign_rollup", slices_sql(["campaign_name", "account_age_tier"], EVENT_FIGURES, CAMPAIGN_OUT,
                                      ["campaign", "date"], rollup=True))

FILTERED_CTES = BASE_CTES + [
    "chosen_agents AS (SELECT * FROM dim_agent WHERE status = 'ACTIVE')",
    "chosen_days AS (SELECT * FROM dim_date WHERE date_key BETWEEN 20240105 AND 20240118)",
    """chosen AS (SELECT f.*, a.account_age_tier FROM fact f JOIN chosen_agents a USING (agent_sk)
      JOIN chosen_days USING (date_key))"""]
FILTERED_LEVEL = f"""SELECT {{tier}} AS account_age_tier, CAST({{level}} AS BIGINT) AS grouping_id, {CAPACITY_OUT},
  coalesce(acc, 0) AS total_invites_accepted, coalesce({sdiv('acc', 'inv')}, 0.0) AS acceptance_rate,
  coalesce(rep, 0) AS total_replies_received, coalesce({sdiv('rep', 'msg')}, 0.0) AS reply_rate,
  coalesce(conv, 0) AS total_conversions, coalesce({sdiv('conv', 'inv')}, 0.0) AS conversion_rate
FROM (SELECT {{group}} {DIM_FIGURES['agent']} FROM chosen_agents {{by}}) a
LEFT JOIN (SELECT {{group}} {EVENT_FIGURES}, count(*) FILTER (WHERE event_type = 'INVITE_ACCEPTED') AS acc,
  count(*) FILTER (WHERE event_type = 'REPLY_RECEIVED') AS rep FROM chosen {{by}}) f ON {{on}},
(SELECT {DIM_FIGURES['date']} FROM chosen_days)"""
sql("kpi_filtered", with_ctes(FILTERED_CTES, " UNION ALL ".join([
    FILTERED_LEVEL.format(tier="a.account_age_tier", level=0, group="account_age_tier,", by="GROUP BY 1",
                          on="a.account_age_tier = f.account_age_tier"),
    FILTERED_LEVEL.format(tier="CAST(NULL AS VARCHAR)", level=1, group="", by="", on="true")])))


# -- the warehouse itself ---------------------------------------------------------------

TABLE_ROWS = {
    "dim_date": "(SELECT count(*) FROM dim_date)", "dim_agent": "(SELECT count(*) FROM customer)",
    "dim_lead": "(SELECT count(*) FROM part)", "dim_campaign": "(SELECT count(*) FROM region)",
    "fact_outreach_activity": "(SELECT count(*) FROM fact)", "fact_daily_agent_metric": "0",
    "dq_audit_log": "5", "pipeline_runs": "1"}
sql("warehouse_catalog", with_ctes(BASE_CTES, " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST({n} AS BIGINT) AS rows, CAST(0 AS BIGINT) AS null_fields, CAST(0 AS BIGINT) AS duplicate_keys"
    for t, n in TABLE_ROWS.items())))
sql("warehouse_export", with_ctes(BASE_CTES, " UNION ALL ".join(
    f"SELECT '{f}' AS format, '{t}' AS table_name, '{','.join(TABLES[t].names)}' AS columns, CAST({n} AS BIGINT) AS rows"
    for f in ("csv", "parquet") for t, n in TABLE_ROWS.items())))

RUN = """SELECT '{run}' AS run_id, '{source}' AS source_system, CAST((SELECT count(*) FROM v_event WHERE {seen}) AS BIGINT) AS records_ingested,
  (SELECT count(*) FROM fact WHERE {loaded}) AS records_loaded, (SELECT count(*) FROM fact WHERE {loaded}) AS records_inserted,
  (SELECT count(*) FROM resolved WHERE {loaded}) - (SELECT count(*) FROM fact WHERE {loaded}) AS records_quarantined_dlq,
  (SELECT strftime(max(event_timestamp), '%Y-%m-%dT%H:%M:%S.%fZ') FROM v_event WHERE {seen}) AS watermark_timestamp,
  CAST(5 AS BIGINT) AS audit_rows,
  CAST((SELECT count(*) FROM v_event WHERE {seen} AND {invalid})
    + (SELECT count(DISTINCT campaign_id) FROM v_event WHERE {seen} AND campaign_id >= 5) AS BIGINT) AS audit_failed"""
FIRST_HALF = f"event_timestamp < (SELECT {MID} FROM v_event)"
sql("pipeline_ledgers", with_ctes(BASE_CTES, " UNION ALL ".join([
    RUN.format(run="early", source=SOURCE_SYSTEM, seen=FIRST_HALF, loaded=FIRST_HALF, invalid=INVALID),
    RUN.format(run="all", source=SOURCE_SYSTEM, seen="true", invalid=INVALID,
               loaded=f"event_timestamp > (SELECT max(event_timestamp) FROM v_event WHERE {FIRST_HALF})")])))

sql("load_gate", """SELECT 'gated' AS run_id, 'WARNING_DQ_THRESHOLD' AS status, count(*) AS records_ingested,
  CAST(0 AS BIGINT) AS records_loaded, CAST(0 AS BIGINT) AS records_inserted, CAST(0 AS BIGINT) AS fact_rows FROM events""")

sql("agent_versions", with_ctes(BASE_CTES, """,
j AS (SELECT d.agent_id, d.status, CASE WHEN c_acctbal < 1000 THEN 'PAUSED' ELSE 'ACTIVE' END AS new_status
      FROM dim_agent d JOIN customer ON c_custkey = d.agent_id)
SELECT agent_id, status, CASE WHEN status = new_status THEN 1 ELSE 0 END AS is_current,
  TIMESTAMP '2024-01-01 00:00:00' AS effective_date,
  CASE WHEN status <> new_status THEN TIMESTAMP '2024-02-01 00:00:00' END AS end_date FROM j
UNION ALL
SELECT agent_id, new_status, 1, TIMESTAMP '2024-02-01 00:00:00', NULL FROM j WHERE status <> new_status""")
    .replace("\n,\nj AS", ",\nj AS"))

sql("timestamp_parse", """SELECT event_id,
  CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
    WHEN 2 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S+02:00') ELSE 'about ' || strftime(ts, '%Y-%m-%d') END AS text,
  CASE event_id % 4 WHEN 0 THEN ts WHEN 1 THEN date_trunc('second', ts)
    WHEN 2 THEN date_trunc('second', ts) - INTERVAL 2 HOUR END AS event_ts
FROM events""")

sql("ceiling_breach_low", with_ctes(BASE_CTES, f"""
SELECT agent_id, date_key, invites_sent, messages_sent,
  round_even(invites_sent{D} * 100.0{D}, 2) + 0.0{D} AS invite_limit_utilization_pct,
  round_even(messages_sent{D} * 100.0{D}, 2) + 0.0{D} AS message_limit_utilization_pct
FROM daily WHERE invites_sent > 1 OR messages_sent > 1"""))

sql("tier_mismatches", with_ctes(BASE_CTES, """
SELECT a.agent_id, a.account_age_tier, t.daily_invite_ceiling AS tier_invite_ceiling
FROM v_agent a JOIN tiers t ON a.account_age_tier = t.account_age_tier WHERE a.agent_id % 3 = 0"""))

FIRST_DAY_CTES = [c.replace("a.t >= 5", "a.t >= 1").replace("(a.s1 * a.s1 - a.s2)", "nullif(a.s1 * a.s1 - a.s2, 0)")
                  .replace("WHEN t = 5 THEN ew_mean", "WHEN t = 1 THEN ew_mean")
                  .replace("WHEN t = 5 THEN sqrt(ew_var)", "WHEN t = 2 THEN sqrt(ew_var)") for c in risk_ctes("daily")]
sql("ewma_first_day", with_ctes(BASE_CTES + FIRST_DAY_CTES, """
SELECT agent_id, date_key, round_even(rolling_mean_acc, 9) + 0.0 AS rolling_mean_acc,
  round_even(rolling_std_acc, 9) + 0.0 AS rolling_std_acc, risk_level
FROM scored"""))

sql("payload_roundtrip", with_ctes(BASE_CTES, """,
docs AS (SELECT agent_id, epoch_us(event_timestamp) // 3600000000 AS hour, min(event_id) % 50 = 0 AS cut
         FROM v_event GROUP BY 1, 2),
sent AS (SELECT r.*, d.cut FROM resolved r JOIN docs d
         ON r.agent_id = d.agent_id AND epoch_us(r.event_timestamp) // 3600000000 = d.hour)
SELECT 'loaded' AS outcome, event_id, 'profiles/' || agent_id AS profile_url, event_timestamp AS event_ts
FROM sent WHERE NOT cut AND campaign_sk IS NOT NULL
UNION ALL
SELECT '""" + QUARANTINE_REASON.replace("'", "''") + """', count(*), NULL, NULL FROM sent WHERE NOT cut AND campaign_sk IS NULL
UNION ALL
SELECT 'Document could not be parsed', count(*), NULL, NULL FROM docs WHERE cut""").replace("\n,\ndocs", ",\ndocs"))
