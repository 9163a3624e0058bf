"""Risk model: EWMA z-score anomalies and capacity recommendations.

All per-agent series logic is window functions over one hash partitioning
by agent (W1-W8, W11). The series grain is agent × day, so even an agent
with a third of all events contributes at most one row per day here.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from activity_engine.config import RiskConfig
from activity_engine.functions.numeric import np_round
from activity_engine.operators.daily import with_rates
from activity_engine.schemas import tier_limits

RISK_COLUMNS = (
    "invites_sent", "invites_accepted", "messages_sent", "replies_received",
    "acceptance_rate", "reply_rate", "invite_limit_utilization_pct",
    "message_limit_utilization_pct", "anomaly_score", "risk_level",
    "recommended_invite_capacity", "recommended_message_capacity",
)


def ewm_block_size(q: float) -> int:
    """Rows per block so that q**block < e**-40 (below double resolution)."""
    return int(math.ceil(40.0 / math.log(1.0 / q)))


#: What the rows up to a day hand on to the next ones: rows so far (``n``), decayed sums of
#: the weights, their squares, the values and their squares, and whether the day was low.
STATE = ("n", "s1", "s2", "sx", "sxx", "low")


#: Agent-days that one task of the windows sorts, about: their memory must not grow with the input.
ROWS_PER_TASK = 500_000


def ewm_previous(df: DataFrame, part: str | list[str], order: str, x: str,
                 alpha: float, min_points: int, prefix: str, base: str | None = None,
                 derive: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """EW mean and bias-corrected EW variance of the *previous* rows.

    Matches ``x.shift(1).ewm(alpha, adjust=True, min_periods).mean()/.var()``:
    at 0-based row t, weights are ``q**(t-1-i)`` for rows ``i < t`` and the
    result is null while ``t < min_points``.

    Computed in O(n) with running sums instead of an O(n·K) frame: each row
    is weighted relative to the start of its block of B rows (``q**-r``,
    bounded by e**40, so no overflow at any series length). Row t combines
    the running sums of its own block with the totals of the previous block,
    each rescaled by a power of q. Rows two or more blocks back carry weight
    below q**B < e**-40 relative to the newest and are below double
    resolution, so the result equals the unbounded definition.

    ``base`` names a struct column, the same for all rows of a series, with the ``STATE``
    after the rows that came before (null: none): decayed sums are mergeable, so k rows
    later they count by a factor ``q**k``. ``<prefix>_state`` has the sums after each row.

    ``derive`` adds columns to the rows, ``x`` may be one of them: after both sorts, which
    hold all rows of a task in memory and so see the columns of ``df`` alone.
    """
    parts = [part] if isinstance(part, str) else list(part)
    q = 1.0 - alpha
    B = ewm_block_size(q)
    p = f"_{prefix}"
    w_row = Window.partitionBy(*parts).orderBy(order)
    t = F.col(f"{p}t")
    blk, r = F.col(f"{p}blk"), F.col(f"{p}r")
    df = (df.withColumn(f"{p}t", F.row_number().over(w_row) - 1)
          .withColumn(f"{p}blk", F.floor(t / F.lit(B)).cast("int"))
          .sortWithinPartitions(*parts, f"{p}blk", order))
    df = (derive(df) if derive else df).withColumn(f"{p}r", (t % F.lit(B)).cast("int"))
    u = F.pow(F.lit(q), -r)
    xv = F.col(x).cast("double")
    terms = {"u": u, "y": xv * u, "z": xv * xv * u, "v": u * u}
    df = df.select("*", *[e.alias(f"{p}{k}") for k, e in terms.items()])
    w_in = (Window.partitionBy(*parts, f"{p}blk").orderBy(order)
            .rowsBetween(Window.unboundedPreceding, -1))
    w_prev = Window.partitionBy(*parts).orderBy(f"{p}blk").rangeBetween(-1, -1)
    sums = []
    for k in terms:
        sums.append(F.coalesce(F.sum(f"{p}{k}").over(w_in), F.lit(0.0)).alias(f"{p}c{k}"))
        sums.append(F.coalesce(F.sum(f"{p}{k}").over(w_prev), F.lit(0.0)).alias(f"{p}p{k}"))
    df = df.select("*", *sums)
    a = F.pow(F.lit(q), (r - 1).cast("double"))
    b = F.pow(F.lit(q), (r - 1 + B).cast("double"))

    def comb(k, sq=False):
        aa, bb = (a * a, b * b) if sq else (a, b)
        return aa * F.col(f"{p}c{k}") + bb * F.col(f"{p}p{k}")

    sums = {"s1": comb("u"), "s2": comb("v", sq=True), "sx": comb("y"), "sxx": comb("z")}
    before = F.lit(0).cast("long")
    if base:
        fade = F.pow(F.lit(q), t.cast("double"))
        sums = {k: e + F.coalesce(F.col(base)[k] * (fade * fade if k == "s2" else fade), F.lit(0.0))
                for k, e in sums.items()}
        before = F.coalesce(F.col(base)["n"], before)
    df = df.select("*", *[e.alias(f"{p}{k}") for k, e in sums.items()]).withColumn(f"{p}t", t + before)
    s1, s2 = F.col(f"{p}s1"), F.col(f"{p}s2")
    enough = t >= F.lit(min_points)
    mean = F.try_divide(F.col(f"{p}sx"), s1)
    var_b = F.greatest(F.try_divide(F.col(f"{p}sxx"), s1) - mean * mean, F.lit(0.0))
    var = var_b * F.try_divide(s1 * s1, s1 * s1 - s2)
    after = {"s1": s1 * q + 1.0, "s2": s2 * (q * q) + 1.0,
             "sx": F.col(f"{p}sx") * q + F.coalesce(xv, F.lit(0.0)),
             "sxx": F.col(f"{p}sxx") * q + F.coalesce(xv * xv, F.lit(0.0))}
    state = F.struct((t + 1).cast("long").alias("n"), *[e.alias(k) for k, e in after.items()])
    df = df.select("*", F.when(enough, mean).alias(f"{prefix}_mean"),
                   F.when(enough, var).alias(f"{prefix}_var"), state.alias(f"{prefix}_state"))
    # The block number stays as ``<prefix>_blk``: it is monotonic in the row
    # order, so later windows can order by (blk, order) and reuse this sort.
    helpers = [c for c in df.columns if c.startswith(p) and c not in (f"{p}t", f"{p}blk")]
    return (df.drop(*helpers).withColumnRenamed(f"{p}t", f"{prefix}_t")
            .withColumnRenamed(f"{p}blk", f"{prefix}_blk"))


def settled(cfg: RiskConfig) -> int:
    """Rows after which no earlier score changes: the first mean and deviation, which fill
    the rows before them (W4), are known, and the group mean (W5) is not used."""
    return max(cfg.min_points, 2) + 1


def score_daily(daily: DataFrame, cfg: RiskConfig = RiskConfig(), agent_key: str = "agent_sk",
                order: str = "date_key", base: str | None = None, keep_state: bool = False,
                rows: int | None = None) -> DataFrame:
    """The full scoring operator over agent × day rows.

    Input needs the four counts and both ceilings; output adds rates,
    utilisation, anomaly score, risk level and recommended capacities. One
    shuffle (by agent); every window reuses it.

    ``base`` names a struct column with the agent's ``STATE`` before its first row here,
    null where the rows are the whole series. It must hold ``settled`` rows or more; the
    scores are then those of the whole series. ``keep_state`` adds column ``state``.

    ``rows``, no fewer than ``daily`` has, sets the number of the windows' tasks. Without it
    Spark sizes them by the bytes shuffled, which are packed and a fraction of what a task sorts.
    """
    if rows and rows > ROWS_PER_TASK:
        daily = daily.repartition(math.ceil(rows / ROWS_PER_TASK), agent_key)
    d = ewm_previous(daily, agent_key, order, "acceptance_rate", cfg.alpha, cfg.min_points, "acc", base, with_rates)
    t = F.col("acc_t")
    w_all = Window.partitionBy(agent_key)
    # (block, day) is the same order as day; it matches the sort already done.
    w_row = Window.partitionBy(agent_key).orderBy("acc_blk", order)
    # Nulls only precede the first baseline, so backfill is a partition
    # lookup of the first non-null mean and of the first non-null deviation
    # (with min_points=1 the deviation starts one row later than the mean).
    first_mean = F.min_by("acc_mean", F.when(F.col("acc_mean").isNotNull(), t)).over(w_all)
    first_std = F.min_by(F.sqrt("acc_var"), F.when(F.col("acc_var").isNotNull(), t)).over(w_all)
    mean = F.coalesce(F.col("acc_mean"), first_mean,
                      F.avg("acceptance_rate").over(w_all))                 # W5
    std = F.greatest(F.coalesce(F.sqrt("acc_var"), first_std, F.lit(cfg.std_fallback)),
                     F.lit(cfg.std_floor))                                  # W6
    d = d.select("*", mean.alias("rolling_mean_acc"), std.alias("rolling_std_acc"))
    z = F.try_divide(F.col("acceptance_rate") - F.col("rolling_mean_acc"),
                     F.col("rolling_std_acc"))
    d = d.withColumn("anomaly_score", np_round(F.coalesce(z, F.lit(0.0)), 3))   # W7, P18
    low = (F.col("invites_sent") > 0) & (F.col("acceptance_rate") <= F.lit(cfg.low_acceptance))
    d = d.withColumn("_low", low)
    low_before = [F.lag("_low").over(w_row), *([F.col(base)["low"]] if base else [])]
    two_low = F.col("_low") & F.coalesce(*low_before, F.lit(False))                 # W8
    z = F.col("anomaly_score")
    critical = (z <= F.lit(cfg.z_critical)) | two_low                          # F10
    warning = (z <= F.lit(cfg.z_warning)) | (
        (F.col("rolling_mean_acc") >= F.lit(cfg.warn_baseline))
        & (F.col("acceptance_rate") <= F.lit(cfg.warn_rate)))                  # F11
    risk = F.when(critical, "CRITICAL").when(warning, "WARNING").otherwise("NORMAL")  # P10
    d = d.withColumn("risk_level", risk)
    mult = (F.when(F.col("risk_level") == "CRITICAL", F.lit(cfg.mult_critical))
            .when(F.col("risk_level") == "WARNING", F.lit(cfg.mult_warning))
            .otherwise(F.lit(1.0)))                                            # P11
    d = d.select(
        "*",
        F.greatest(F.lit(cfg.min_invites),
                   F.floor(F.col("daily_invite_ceiling") * mult)).cast("int")
        .alias("recommended_invite_capacity"),                                # P12
        F.greatest(F.lit(cfg.min_messages),
                   F.floor(F.col("daily_message_ceiling") * mult)).cast("int")
        .alias("recommended_message_capacity"))
    if keep_state:
        d = d.withColumn("state", F.struct(*[F.col("acc_state")[k].alias(k) for k in STATE[:-1]],
                                           F.col("_low").alias("low")))
    return d.drop("_low", "acc_mean", "acc_var", "acc_blk", "acc_state")


def risk_summary(scored: DataFrame) -> DataFrame:
    """Rows, anomalies (not NORMAL) and criticals in one pass."""
    rl = F.col("risk_level")
    return scored.agg(F.count(F.lit(1)).alias("records_processed"),
                      F.count_if(rl != "NORMAL").alias("anomalies_flagged"),
                      F.count_if(rl == "CRITICAL").alias("critical_risk_count"))


def ceiling_breaches(scored: DataFrame) -> DataFrame:
    """Agent-days whose sends exceeded the tier ceiling."""
    return scored.where((F.col("invite_limit_utilization_pct") > 100)
                        | (F.col("message_limit_utilization_pct") > 100))


def tier_check(agents: DataFrame) -> DataFrame:
    """Agents joined to the limits matrix by tier label.

    Flags ceilings that differ from the matrix and carries the cooldown.
    """
    lim = tier_limits(agents.sparkSession)
    j = agents.join(lim, "account_age_tier", "left")
    return j.select(
        "*",
        (F.col("tier_invite_ceiling").isNull()
         | (F.col("daily_invite_ceiling") != F.col("tier_invite_ceiling"))
         | (F.col("daily_message_ceiling") != F.col("tier_message_ceiling")))
        .alias("ceiling_mismatch"))


def cooldown_until(fact: DataFrame, agents: DataFrame, agent_key: str = "agent_sk") -> DataFrame:
    """Last event per agent plus its tier's cooldown hours.

    ``max`` is combined map-side, so a hot agent never lands whole in one
    task; the agent join sees one row per agent.
    """
    last = fact.groupBy(agent_key).agg(F.max("event_ts").alias("last_event_ts"))
    a = tier_check(agents).select(agent_key, "agent_id", "account_age_tier", "cooldown_hours")
    j = last.join(a, agent_key)
    return j.select(
        "agent_id", "account_age_tier", "last_event_ts", "cooldown_hours",
        (F.col("last_event_ts")
         + F.make_interval(hours=F.coalesce(F.col("cooldown_hours"), F.lit(0))))
        .alias("cooldown_until"))


def ghosting_runs(daily: DataFrame, cfg: RiskConfig = RiskConfig(),
                  agent_key: str = "agent_sk") -> DataFrame:
    """Runs of consecutive calendar days with sends but no responses.

    Gaps-and-islands: for flagged days, ``day_number - row_number`` is
    constant inside a run of consecutive days. Returns one row per run.
    """
    sends = F.col("invites_sent") + F.col("messages_sent")
    resp = F.col("invites_accepted") + F.col("replies_received")
    day = F.to_date(F.col("date_key").cast("string"), "yyyyMMdd")
    flagged = daily.where((sends > 0) & (resp == 0)).select(
        agent_key, *(["agent_id"] if "agent_id" in daily.columns and agent_key != "agent_id" else []),
        "date_key", F.datediff(day, F.lit("1970-01-01")).alias("_dn"))
    w = Window.partitionBy(agent_key).orderBy("date_key")
    isl = flagged.withColumn("_g", F.col("_dn") - F.row_number().over(w))
    keys = [agent_key] + (["agent_id"] if "agent_id" in flagged.columns and agent_key != "agent_id" else [])
    runs = isl.groupBy(*keys, "_g").agg(F.min("date_key").alias("run_start"),
                                        F.max("date_key").alias("run_end"),
                                        F.count(F.lit(1)).alias("run_days"))
    return runs.drop("_g").withColumn(
        "is_ghosting", (F.col("run_days") >= F.lit(cfg.ghosting_days)).cast("int"))


def reply_decay(daily: DataFrame, cfg: RiskConfig = RiskConfig(),
                agent_key: str = "agent_sk", lookback: int | None = None) -> DataFrame:
    """EW reply-rate baseline now vs ``lookback`` rows earlier.

    Flags a decay when the baseline fell by at least ``reply_decay_pct``.
    """
    lookback = lookback or cfg.ewma_span
    rates = with_rates if "reply_rate" not in daily.columns else None
    d = ewm_previous(daily, agent_key, "date_key", "reply_rate", cfg.alpha, cfg.min_points, "rep", derive=rates)
    w = Window.partitionBy(agent_key).orderBy("rep_blk", "date_key")
    prev = F.lag("rep_mean", lookback).over(w)
    d = d.withColumn("reply_baseline_prev", prev)
    change = F.try_divide(F.col("rep_mean"), F.col("reply_baseline_prev")) - F.lit(1.0)
    return d.select(
        "*", change.alias("reply_baseline_change"),
        F.coalesce(change <= F.lit(-cfg.reply_decay_pct), F.lit(False)).cast("int")
        .alias("reply_decay_flag")).drop("rep_var", "rep_blk", "rep_state")


__all__ = ["ewm_previous", "score_daily", "risk_summary", "ceiling_breaches", "tier_check",
           "cooldown_until", "ghosting_runs", "reply_decay", "RISK_COLUMNS"]
