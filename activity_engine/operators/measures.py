"""The BI measure library (M1-M22) as DataFrame aggregates over the star.

A measure is evaluated in a filter context: ``by`` lists attributes of any
dimensions to group on (``rollup=True`` adds every subtotal level, told apart
from null members by ``grouping_id``), and ``filtered`` narrows the model first.
The fact is reduced on its own foreign keys, which is exact for additive counts
and shrinks the joins from one row per event to one row per key combination;
only the dimensions that ``by`` needs are joined (left, so unmatched facts
stay in a null member, as a BI model shows them).

Figures that the source model takes from dimension tables (agents, ceilings,
budgets, distinct calendar days) follow its single-direction relationships: each
comes from its own dimension, under those columns of ``by`` that belong to it, for
every member and subtotal, and never from the fact. A slice by columns of one
dimension has all its members; one by columns of several has the combinations that
occur in the fact, and every subtotal of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activity_engine.config import DEAL_VALUE
from activity_engine.functions.numeric import np_round, safe_divide

FK = {"agent": "agent_sk", "lead": "lead_sk", "campaign": "campaign_sk", "date": "date_key"}

def core_counts(*names: str) -> dict[str, Column]:
    """M1, M2, M4, M5, M7 as count predicates (built lazily: needs a session)."""
    et = F.col("event_type")
    allc = {
        "total_invites_sent": et == "INVITE_SENT",
        "total_invites_accepted": et == "INVITE_ACCEPTED",
        "total_messages_sent": et == "MESSAGE_SENT",
        "total_replies_received": et == "REPLY_RECEIVED",
        "total_conversions": F.col("is_converted") == 1,
    }
    return {k: allc[k] for k in names} if names else allc


def _owner(dims: dict[str, DataFrame], col: str) -> str:
    for name, d in dims.items():
        if col in d.columns:
            return name
    raise KeyError(f"no dimension has column {col!r}")


def filtered(fact: DataFrame, dims: dict[str, DataFrame], where: dict[str, Column] | None = None,
             date_range: tuple[int, int] | None = None) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The model under a filter: conditions on dimensions, and an inclusive range of day keys.

    A filtered dimension keeps its members that pass and, of the facts related to it,
    only those of these members: facts of unknown members go, as in a BI model. The
    day range reaches the scan of a fact partitioned by day.
    """
    where = dict(where or {})
    if date_range is not None:
        inside = F.col("date_key").between(*date_range)
        where["date"] = where["date"] & inside if "date" in where else inside
        if "date_key" in fact.columns:
            fact = fact.where(inside)
    dims = {n: d.where(where[n]) if n in where else d for n, d in dims.items()}
    for n in where:
        if FK[n] in fact.columns:
            fact = fact.join(dims[n].select(FK[n]), FK[n], "left_semi")
    return fact, dims


class _Slices:
    """The rows of one evaluation: sums of the fact by ``by``, to which dimensions add their figures."""

    LEVEL, PREFIX = "grouping_id", "_kept"

    def __init__(self, fact: DataFrame, dims: dict[str, DataFrame], by: list[str], partial: dict[str, Column],
                 rollup: bool = False):
        self.dims, self.by, self.rollup = dims, list(by), rollup
        self.owners = {c: _owner(dims, c) for c in self.by}
        owners = sorted(set(self.owners.values()))
        missing = [o for o in owners if FK[o] not in fact.columns]
        if missing:
            raise ValueError(f"the fact is not related to {', '.join(missing)}")
        pre = fact.groupBy(*[FK[o] for o in owners]).agg(*[c.alias(n) for n, c in partial.items()])
        for o in owners:
            pre = pre.join(dims[o].select(FK[o], *self.columns_of(o)), FK[o], "left")
        self.rows = self._grouped(pre, self.by, [F.sum(n).alias(n) for n in partial])
        self.whole: dict[str, Column] = {}

    def columns_of(self, owner: str) -> list[str]:
        return [c for c in self.by if self.owners[c] == owner]

    def _grouped(self, df: DataFrame, cols: list[str], aggs: list[Column]) -> DataFrame:
        """``df`` by ``cols`` and their subtotals; grouping_id has a bit for each column summed over."""
        if self.rollup and cols:
            return df.rollup(*cols).agg(*aggs, F.grouping_id().alias(self.LEVEL))
        return df.groupBy(*cols).agg(*aggs, F.lit(0).cast("long").alias(self.LEVEL))

    def _kept_of(self, cols: list[str]) -> Column:
        """How many of ``cols`` a row's level keeps (a level keeps the first columns of ``by``)."""
        depth = len(self.by) - F.bit_count(self.LEVEL)
        counts = [sum(c in cols for c in self.by[:j]) for j in range(len(self.by) + 1)]
        return F.element_at(F.array(*map(F.lit, counts)), depth + 1)

    def add(self, owner: str, figures: dict[str, Column]) -> "_Slices":
        """Join figures of a dimension, aggregated under its own columns of ``by`` at each level."""
        cols, aggs = self.columns_of(owner), [c.alias(n) for n, c in figures.items()]
        if not cols:
            whole = self.dims[owner].agg(*aggs)
            self.whole |= {n: whole.select(n).scalar() for n in figures}
            return self
        part = self._grouped(self.dims[owner], cols, aggs)
        if self.rollup:
            part = part.withColumn(self.PREFIX, len(cols) - F.bit_count(self.LEVEL)).drop(self.LEVEL)
        else:
            part = part.withColumn(self.PREFIX, F.lit(len(cols))).drop(self.LEVEL)
        renamed = part.select(*[F.col(c).alias(f"_m_{c}") for c in cols], self.PREFIX, *figures)
        same = self._kept_of(cols) == F.col(self.PREFIX)
        for c in cols:
            same = same & F.col(c).eqNullSafe(F.col(f"_m_{c}"))
        alone = cols == self.by               # members without facts stay
        joined = self.rows.join(renamed, same, "full_outer" if alone else "left")
        if alone:
            # A row of the dimension only: its columns, and the level that keeps as many.
            level = (F.pow(F.lit(2), len(cols) - F.col(self.PREFIX)) - 1).cast("long")
            joined = joined.withColumns({c: F.when(F.col(self.LEVEL).isNull(), F.col(f"_m_{c}")).otherwise(F.col(c))
                                         for c in cols}).withColumn(self.LEVEL, F.coalesce(self.LEVEL, level))
        self.rows = joined.drop(self.PREFIX, *[f"_m_{c}" for c in cols])
        return self

    def members(self) -> "_Slices":
        """All members of the dimension if only one is sliced by."""
        owners = set(self.owners.values())
        return self.add(*owners, {"_members": F.count(F.lit(1))}) if len(owners) == 1 else self

    def select(self, *figures) -> DataFrame:
        return self.rows.withColumns(self.whole).select(*self.by, *([self.LEVEL] if self.rollup else []), *figures)


def _counts(*names: str) -> dict[str, Column]:
    return {n: F.count_if(c) for n, c in core_counts(*names).items()}


def _count(name: str) -> Column:
    """A sum of counts; none is none, not null."""
    return F.coalesce(F.col(name), F.lit(0)).cast("long").alias(name)


#: DISTINCTCOUNT(dim_date[date_key])
def _days() -> dict[str, Column]:
    return {"_days": F.count_distinct("date_key")}


def _capacity_days(ceilings: str) -> Column:
    return F.col(ceilings) * F.col("_days")


def core(fact: DataFrame, dims: dict[str, DataFrame], by: list[str] = (),
         rollup: bool = False) -> DataFrame:
    """M1-M8: outreach volumes, acceptance, replies, conversions (slices that have facts)."""
    s = _Slices(fact, dims, by, _counts(), rollup)
    return s.select(
        *[F.col(n).cast("long").alias(n) for n in ("total_invites_sent", "total_invites_accepted")],
        safe_divide("total_invites_accepted", "total_invites_sent").alias("acceptance_rate"),
        *[F.col(n).cast("long").alias(n) for n in ("total_messages_sent", "total_replies_received")],
        safe_divide("total_replies_received", "total_messages_sent").alias("reply_rate"),
        F.col("total_conversions").cast("long").alias("total_conversions"),
        safe_divide("total_conversions", "total_invites_sent").alias("conversion_rate"))


def capacity(fact: DataFrame, dims: dict[str, DataFrame], by: list[str] = (),
             rollup: bool = False) -> DataFrame:
    """M9-M12, by columns of any dimensions.

    Agent counts (current versions) and ceilings (all versions) come from
    ``dim_agent``, days from the calendar.
    """
    cur = F.col("is_current") == 1
    sk = F.col("agent_sk")
    s = _Slices(fact, dims, by, _counts("total_invites_sent", "total_messages_sent"), rollup).members()
    s.add("agent", {
        "active_agents": F.count_distinct(F.when(cur & (F.col("status") == "ACTIVE"), sk)),
        "paused_or_ghosted_agents": F.count_distinct(F.when(cur & F.col("status").isin("PAUSED", "GHOSTED"), sk)),
        "_invite_ceilings": F.sum("daily_invite_ceiling").cast("long"),
        "_message_ceilings": F.sum("daily_message_ceiling").cast("long")}).add("date", _days())
    inv, msg = _count("total_invites_sent"), _count("total_messages_sent")
    return s.select(
        _count("active_agents"), _count("paused_or_ghosted_agents"), inv, msg,
        safe_divide(inv, _capacity_days("_invite_ceilings")).alias("invite_capacity_utilization"),
        safe_divide(msg, _capacity_days("_message_ceilings")).alias("message_capacity_utilization"))


def risk(daily_metric: DataFrame, dims: dict[str, DataFrame], by: list[str] = (),
         rollup: bool = False) -> DataFrame:
    """M13-M17 over the scored agent-day table, by columns of agents and the calendar."""
    rl = F.col("risk_level")
    s = _Slices(daily_metric, dims, by, {
        "_z": F.sum("anomaly_score"), "_n": F.count("anomaly_score"),
        "critical_risk_days": F.count_if(rl == "CRITICAL"), "warning_risk_days": F.count_if(rl == "WARNING"),
        "recommended_safe_invites": F.sum("recommended_invite_capacity")}, rollup).members()
    s.add("agent", {"_ceilings": F.sum("daily_invite_ceiling").cast("long")}).add("date", _days())
    cap, rec = _capacity_days("_ceilings"), _count("recommended_safe_invites")
    return s.select(
        np_round(F.try_divide("_z", "_n"), 9).alias("avg_anomaly_z"),
        _count("critical_risk_days"), _count("warning_risk_days"), rec,
        safe_divide(cap - rec, cap).alias("throttled_capacity_variance"))


def campaign(fact: DataFrame, dims: dict[str, DataFrame], by: list[str] = ("campaign_name",),
             rollup: bool = False) -> DataFrame:
    """M18-M22, by columns of any dimensions; budgets come from ``dim_campaign``."""
    s = _Slices(fact, dims, by, _counts("total_invites_sent", "total_conversions"), rollup).members()
    s.add("campaign", {"_budgets": F.sum(F.col("daily_budget").cast("double"))}).add("date", _days())
    budget = F.col("_budgets") * F.col("_days")
    inv, conv = _count("total_invites_sent"), _count("total_conversions")
    value = (conv * F.lit(DEAL_VALUE)).cast("long")
    return s.select(
        budget.alias("total_campaign_budget"),
        safe_divide(budget, inv).alias("cost_per_invite"),
        safe_divide(budget, conv).alias("cost_per_conversion"),
        value.alias("estimated_pipeline_value"),
        safe_divide(value, budget).alias("campaign_roi_multiplier"))
