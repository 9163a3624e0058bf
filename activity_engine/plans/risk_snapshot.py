"""The risk snapshot, and the states from which a refresh goes on.

Three tables: the snapshot itself, one row per agent and day; the model's state after
each of these rows; and each agent's last state. The first two are partitioned by month
and by a hash bucket of the agent, the third by the bucket. The decayed sums of a state
are mergeable, so a refresh scores only the days from the earliest one that changed,
going on from the last state before it, and writes only the parts that hold such days.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from activity_engine.config import RiskConfig
from activity_engine.operators import risk
from activity_engine.operators.daily import COUNT_TYPES, daily_activity
from activity_engine.sources.tables import Warehouse

SNAPSHOT, STATES, LAST = "fact_daily_agent_metric", "agent_risk_states", "agent_risk_last"
CHANGED = "agent_risk_changed"
PARTS = ["month", "agent_bucket"]
#: Agents of one bucket: sets the number of buckets, at each full run, from the number of agents.
AGENTS_PER_PART = 16384
_DAY = ["agent_sk", "date_key"]
_COUNTS = [name for name, _ in COUNT_TYPES]


class RiskSnapshot:
    """The snapshot of one warehouse under one configuration of the model."""

    def __init__(self, wh: Warehouse, cfg: RiskConfig = RiskConfig(), now: Column | None = None,
                 agents_per_part: int = AGENTS_PER_PART):
        self.wh, self.cfg, self.agents_per_part = wh, cfg, agents_per_part
        self.now = F.current_timestamp() if now is None else now

    def _score(self, counts: DataFrame, buckets: int, bases: DataFrame | None = None) -> DataFrame:
        """Scored agent-days with their state and parts; ``bases``: (agent_sk, base)."""
        daily = daily_activity(counts, self.wh.read("dim_agent"), self.wh.read("dim_date"), precounted=True)
        if bases is not None:
            daily = daily.join(bases, "agent_sk")
        scored = risk.score_daily(daily, self.cfg, base=None if bases is None else "base", keep_state=True)
        bucket = F.pmod(F.xxhash64(F.col("agent_sk").cast("long")), F.lit(buckets)).cast("int")
        return scored.select(*_DAY, *risk.RISK_COLUMNS, self.now.alias("updated_at"), "state",
                             F.floor(F.col("date_key") / 100).cast("int").alias("month"),
                             bucket.alias("agent_bucket"))

    def _clustered(self, rows: DataFrame, parts: list[str]) -> DataFrame:
        """O1 without a global sort: rows meet by part and are sorted by day inside each task."""
        order = [c for c in (*parts, "date_key", "agent_sk") if c in rows.columns]
        return rows.hint("rebalance", *parts).sortWithinPartitions(*order)

    @staticmethod
    def _last(rows: DataFrame) -> DataFrame:
        return rows.groupBy("agent_sk", "agent_bucket").agg(
            F.min("date_key").alias("first_day"), F.max("date_key").alias("last_day"),
            F.max_by("state", "date_key").alias("state"))

    # -- whole history -----------------------------------------------------------------
    def full(self, counts: DataFrame) -> Row:
        """Score every agent-day of ``counts`` and write new versions of all three tables.

        Returns the summary (A15).
        """
        wh = self.wh
        agents = wh.read("dim_agent").count()
        buckets = 1
        while buckets * self.agents_per_part < agents:
            buckets *= 2
        wh.write_state(SNAPSHOT, {})
        out = self._score(counts, buckets).persist()
        try:
            s = risk.risk_summary(out).first()
            jobs = ((SNAPSHOT, out.drop("state"), PARTS), (STATES, out.select(*_DAY, "state", *PARTS), PARTS),
                    (LAST, self._last(out), PARTS[1:]))
            with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
                for f in [pool.submit(wh.rewrite, t, self._clustered(rows, parts), parts) for t, rows, parts in jobs]:
                    f.result()
        finally:
            out.unpersist()
        if s["records_processed"]:
            wh.write_state(SNAPSHOT, {"buckets": buckets, "config": asdict(self.cfg)})
        return s

    # -- what changed ------------------------------------------------------------------
    def refresh(self, counts: DataFrame, touched: DataFrame) -> Row:
        """Score what the agent-days ``touched`` (agent_sk, date_key) change; the summary of those rows.

        Per agent that is the days from the earliest touched one, also when it is late:
        the last state before it is the start. An agent with fewer rows than
        ``risk.settled`` before it is scored whole, for its first rows borrow from later
        ones. Days whose counts changed and that no refresh was told of are scored by the
        next full run. Without a snapshot of this configuration, or after a refresh that
        died while it wrote, everything is scored.
        """
        wh = self.wh
        kept = wh.read_state(SNAPSHOT) or {}
        if kept.get("config") != asdict(self.cfg):
            return self.full(counts)
        buckets = kept["buckets"]
        touched = touched.select(F.col("agent_sk").cast("long").alias("agent_sk"),
                                 F.col("date_key").cast("int").alias("date_key")).dropna().distinct().persist()
        plan = None
        try:
            span = touched.agg(F.min("date_key").alias("lo"), F.max("date_key").alias("hi")).first()
            if span.lo is None:
                return risk.risk_summary(wh.read(SNAPSHOT).limit(0)).first()
            plan = self._starts(touched, buckets).persist()
            # One row a bucket, of which there are few thousand at most.
            near = plan.groupBy("agent_bucket").agg(F.min("restart").alias("restart")).collect()
            in_parts = F.col("agent_bucket").isin([r.agent_bucket for r in near])
            later = F.col("month") >= min(r.restart for r in near) // 100
            new = counts.where(F.col("date_key").between(span.lo, span.hi)).select(*_DAY, *_COUNTS) \
                .join(touched, _DAY, "left_semi")
            old = (wh.read(SNAPSHOT, PARTS).where(in_parts & later).join(plan.select("agent_sk", "restart"), "agent_sk")
                   .where(F.col("date_key") >= F.col("restart")).select(*_DAY, *_COUNTS)
                   .join(touched, _DAY, "left_anti"))
            scored = self._score(new.unionByName(old), buckets, plan.select("agent_sk", "base"))
            wh.rewrite(CHANGED, scored)
            changed = wh.read(CHANGED)
            if changed is None:                  # no touched day counts: quarantined, or outside the calendar
                return risk.risk_summary(wh.read(SNAPSHOT).limit(0)).first()
            self._replace(changed, in_parts, later)
            wh.write_state(SNAPSHOT, kept)
            return risk.risk_summary(changed).first()
        finally:
            touched.unpersist()
            if plan is not None:
                plan.unpersist()
            wh.vacuum(CHANGED, 1)

    def _starts(self, touched: DataFrame, buckets: int) -> DataFrame:
        """(agent_sk, agent_bucket, restart, base): each touched agent's first day to score."""
        bucket = F.pmod(F.xxhash64("agent_sk"), F.lit(buckets)).cast("int")
        starts = touched.groupBy("agent_sk").agg(F.min("date_key").alias("start")).withColumn("agent_bucket", bucket)
        held = [r[0] for r in starts.select("agent_bucket").distinct().collect()]
        in_parts = F.col("agent_bucket").isin(held)
        known = starts.join(self.wh.read(LAST).where(in_parts).drop("agent_bucket"), "agent_sk", "left")
        late = known.where(F.col("start") <= F.col("last_day")).select("agent_sk", "start")
        base = F.when(F.col("start") > F.col("last_day"), F.col("state"))
        newest = late.agg(F.max("start")).first()[0]
        if newest is not None:
            before = (self.wh.read(STATES).where(in_parts & (F.col("month") <= newest // 100)).join(late, "agent_sk")
                      .where(F.col("date_key") < F.col("start")).groupBy("agent_sk")
                      .agg(F.max_by("state", "date_key").alias("earlier")))
            known = known.join(before, "agent_sk", "left")
            base = F.coalesce(base, F.col("earlier"))
        known = known.withColumn("base", base)
        enough = F.coalesce(F.col("base")["n"] >= risk.settled(self.cfg), F.lit(False))
        return known.select("agent_sk", "agent_bucket",
                            F.when(enough, F.col("start")).otherwise(F.least("start", "first_day")).alias("restart"),
                            F.when(enough, F.col("base")).alias("base"))

    def _replace(self, changed: DataFrame, in_parts: Column, later: Column) -> None:
        """Write the parts that hold a changed day, and the changed agents' last states.

        What stays of these parts is read from the tables that are written: the result goes to
        tables of its own first. The state without a configuration marks the time of writing.
        """
        wh = self.wh
        pairs = changed.select(*PARTS).distinct()
        days = changed.select(*_DAY)
        last = wh.read(LAST).where(in_parts)
        ends = self._last(changed).withColumnRenamed("first_day", "_first")
        ends = (ends.join(last.select("agent_sk", "first_day"), "agent_sk", "left")
                .withColumn("first_day", F.least("_first", "first_day")).drop("_first"))
        work = [(LAST, ends.unionByName(last.join(ends.select("agent_sk"), "agent_sk", "left_anti")
                                        .join(pairs.select("agent_bucket").distinct(), "agent_bucket", "left_semi")),
                 PARTS[1:])]
        for table, rows in ((SNAPSHOT, changed.drop("state")), (STATES, changed.select(*_DAY, "state", *PARTS))):
            stay = (wh.read(table, PARTS).where(in_parts & later).join(pairs, PARTS, "left_semi")
                    .join(days, _DAY, "left_anti"))
            work.append((table, rows.unionByName(stay.select(*rows.columns)), PARTS))
        with ThreadPoolExecutor(max_workers=len(work)) as pool:
            for f in [pool.submit(wh.rewrite, f"{t}_staged", self._clustered(rows, parts)) for t, rows, parts in work]:
                f.result()
            wh.write_state(SNAPSHOT, {})
            for f in [pool.submit(wh.overwrite_partitions, t, self._clustered(wh.read(f"{t}_staged"), parts), parts)
                      for t, _, parts in work]:
                f.result()
        for t, _, _ in work:
            wh.vacuum(f"{t}_staged", 1)
