"""Agent × day rollup (A1, J2) and daily rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activity_engine.functions.numeric import safe_ratio, utilization_pct

COUNT_TYPES = (
    ("invites_sent", "INVITE_SENT"),
    ("invites_accepted", "INVITE_ACCEPTED"),
    ("messages_sent", "MESSAGE_SENT"),
    ("replies_received", "REPLY_RECEIVED"),
)
AGENT_ATTRS = ("agent_id", "account_age_tier", "daily_invite_ceiling", "daily_message_ceiling")


def daily_counts(fact: DataFrame, agent_key: str = "agent_sk") -> DataFrame:
    """Four conditional counts per (agent, day), before any join.

    Grouping on the fact's own keys first is the same result as the star
    join followed by grouping on agent attributes (they depend on the key),
    but the joins then see one row per agent-day instead of one per event,
    and partial aggregation shrinks each map task before the shuffle.
    """
    et = F.col("event_type")
    return fact.groupBy(agent_key, "date_key").agg(
        *[F.count_if(et == t).cast("long").alias(name) for name, t in COUNT_TYPES])


def daily_activity(fact: DataFrame, agents: DataFrame, dates: DataFrame | None,
                   agent_key: str = "agent_sk", precounted: bool = False) -> DataFrame:
    """A1 + J2: counts joined to agent attributes and the calendar (inner).

    ``precounted``: ``fact`` already holds ``daily_counts`` rows.
    """
    counts = fact if precounted else daily_counts(fact, agent_key)
    a = agents.select(agent_key, *[c for c in AGENT_ATTRS if c != agent_key and c in agents.columns])
    out = counts.join(a, agent_key)
    if dates is not None:
        # No hint: the calendar's size depends on how it was initialised, so
        # AQE broadcasts it from its measured size (a few thousand rows).
        out = out.join(dates.select("date_key", "full_date"), "date_key")
    return out


def with_rates(daily: DataFrame) -> DataFrame:
    """Acceptance and reply rates, ceiling utilisation."""
    return daily.select(
        "*",
        safe_ratio("invites_accepted", "invites_sent").alias("acceptance_rate"),
        safe_ratio("replies_received", "messages_sent").alias("reply_rate"),
        utilization_pct("invites_sent", "daily_invite_ceiling").alias("invite_limit_utilization_pct"),
        utilization_pct("messages_sent", "daily_message_ceiling").alias("message_limit_utilization_pct"),
    )
