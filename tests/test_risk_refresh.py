"""A refreshed risk snapshot equals one that is scored whole, and touches only its own parts."""

import os
import random

import pytest
from pyspark.sql import functions as F

from activity_engine.config import RiskConfig
from activity_engine.operators import risk
from activity_engine.plans import pipeline as pl
from activity_engine.plans.risk_snapshot import LAST, SNAPSHOT, STATES
from activity_engine.sources.tables import Warehouse

COUNTS = "agent_sk long, date_key int, invites_sent long, invites_accepted long, messages_sent long, replies_received long"
NOW = "2026-12-01 00:00:00"


def new_warehouse(spark, tmp_path, agents=6):
    w = Warehouse(spark, str(tmp_path / "wh"))
    pl.init_warehouse(w, "2026-01-01", "2026-12-31")
    w.append("dim_agent", spark.createDataFrame(
        [(a, f"A{a}", "1+ Year", 30, 60, 1) for a in range(1, agents + 1)],
        "agent_sk long, agent_id string, account_age_tier string, daily_invite_ceiling int, "
        "daily_message_ceiling int, is_current int"))
    return w


def put_counts(w, counts: dict) -> None:
    rows = w.spark.createDataFrame([(*k, *v) for k, v in counts.items()], COUNTS)
    w.rewrite("agent_daily_counts", rows.coalesce(1))


def random_counts(rng):
    sent = rng.choice([0, 5, 10, 20])
    return sent, rng.choice([0, 0, sent // 4, sent // 2, sent]), rng.randint(0, 9), rng.randint(0, 5)


def day(i: int) -> int:
    return (1 + i // 28) * 100 + 1 + i % 28 + 20260000


def snapshot(w):
    return {(r.agent_sk, r.date_key): r for r in w.read(SNAPSHOT).drop("updated_at").collect()}


def assert_same(got, want):
    assert got.keys() == want.keys()
    for k, r in want.items():
        assert {**got[k].asDict(), "anomaly_score": 0} == {**r.asDict(), "anomaly_score": 0}, k
        assert got[k].anomaly_score == pytest.approx(r.anomaly_score, abs=1.1e-3), k


@pytest.mark.parametrize("seed,min_points", [(1, 5), (2, 1)])
def test_refreshes_equal_a_full_run(spark, tmp_path, seed, min_points):
    """Random batches with new, changed, late and first days, agents of few rows, and quiet months."""
    rng, cfg = random.Random(seed), RiskConfig(min_points=min_points)
    w = new_warehouse(spark, tmp_path)
    days = {a: [day(i) for i in range(130 if a < 3 else 4 * a) if i < 20 or i > 60] for a in range(1, 6)}
    counts = {(a, d): random_counts(rng) for a in days for d in days[a] if rng.random() < 0.6}
    put_counts(w, counts)
    pl.run_risk_model(w, cfg, NOW, agents_per_part=2)
    for step in range(4):
        touched = {(a, rng.choice(days[a][-3:] if step % 2 else days[a])) for a in rng.sample(sorted(days), 2)}
        touched |= {(6, day(100 + step)), (6, 20310101)} if step > 1 else set()      # a new agent; outside the calendar
        counts.update({k: random_counts(rng) for k in touched})
        put_counts(w, counts)
        pairs = spark.createDataFrame(sorted(touched), "agent_sk long, date_key int")
        done = pl.run_risk_model(w, cfg, NOW, affected=pairs, agents_per_part=2)
        assert 0 < done["records_processed"] < len(counts)
    got = snapshot(w)
    last = {r.agent_sk: (r.first_day, r.last_day, r.state.n) for r in w.read(LAST).collect()}
    states = w.read(STATES).count()
    pl.run_risk_model(w, cfg, NOW, agents_per_part=2)
    assert_same(got, snapshot(w))
    assert states == len(got)
    assert last == {r.agent_sk: (r.first_day, r.last_day, r.state.n) for r in w.read(LAST).collect()}


def files(w, table):
    top = w.current_path(table)
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(top) for f in names if f.endswith(".parquet")}


def test_one_agent_touches_its_part_only(spark, tmp_path):
    rng = random.Random(4)
    w = new_warehouse(spark, tmp_path)
    counts = {(a, day(i)): random_counts(rng) for a in range(1, 7) for i in range(100)}
    put_counts(w, counts)
    assert pl.run_risk_model(w, now=NOW, agents_per_part=1)["records_processed"] == 600
    before = {t: files(w, t) for t in (SNAPSHOT, STATES, LAST)}
    counts[(3, day(100))] = random_counts(rng)
    counts[(3, day(101))] = random_counts(rng)
    put_counts(w, counts)
    pairs = spark.createDataFrame([(3, day(100)), (3, day(101)), (3, None), (None, day(101))], "agent_sk long, date_key int")
    assert pl.run_risk_model(w, now=NOW, affected=pairs, agents_per_part=1)["records_processed"] == 2
    for table, old in before.items():
        new = files(w, table)
        gone = {os.path.dirname(p) for p in old if new.get(p) != old[p]}
        fresh = {os.path.dirname(p) for p in new if p not in old}
        assert len(fresh) == 1 and gone <= fresh, table
        assert table == LAST or "month=202604" in fresh.pop()
    none = spark.createDataFrame([], "agent_sk long, date_key int")
    now_files = files(w, SNAPSHOT)
    assert pl.run_risk_model(w, now=NOW, affected=none)["records_processed"] == 0
    assert files(w, SNAPSHOT) == now_files


def test_a_refresh_that_died_or_another_configuration_scores_everything(spark, tmp_path):
    rng = random.Random(5)
    w = new_warehouse(spark, tmp_path)
    counts = {(a, day(i)): random_counts(rng) for a in range(1, 4) for i in range(12)}
    put_counts(w, counts)
    pairs = spark.createDataFrame([(1, day(11))], "agent_sk long, date_key int")
    assert pl.run_risk_model(w, now=NOW, affected=pairs)["records_processed"] == 36      # no snapshot yet
    assert pl.run_risk_model(w, now=NOW, affected=pairs)["records_processed"] == 1
    w.write_state(SNAPSHOT, {})                                                          # died while writing
    assert pl.run_risk_model(w, now=NOW, affected=pairs)["records_processed"] == 36
    assert pl.run_risk_model(w, RiskConfig(ewma_span=5), NOW, affected=pairs)["records_processed"] == 36
    agent = spark.createDataFrame([(2,)], "agent_sk long")                               # all days of an agent
    assert pl.run_risk_model(w, RiskConfig(ewma_span=5), NOW, affected=agent)["records_processed"] == 12


def test_states_merge(spark):
    """Scores of a series in one go equal those of its tail from the state before it."""
    rng = random.Random(6)
    rows = [(1, day(i), *random_counts(rng), 30, 60) for i in range(60)]
    df = spark.createDataFrame(rows, COUNTS + ", daily_invite_ceiling int, daily_message_ceiling int")
    whole = {r.date_key: r for r in risk.score_daily(df, keep_state=True).collect()}
    for cut in (7, 30):
        base = spark.createDataFrame([(1, whole[day(cut - 1)].state)], "agent_sk long, base struct<n:long,s1:double,"
                                     "s2:double,sx:double,sxx:double,low:boolean>")
        tail = risk.score_daily(df.where(F.col("date_key") >= day(cut)).join(base, "agent_sk"), base="base",
                                keep_state=True).collect()
        assert len(tail) == 60 - cut
        for r in tail:
            want = whole[r.date_key]
            assert (r.anomaly_score, r.risk_level, r.state.n) == (want.anomaly_score, want.risk_level, want.state.n)
            assert tuple(r.state)[1:5] == pytest.approx(tuple(want.state)[1:5], rel=1e-12)
