"""Risk model: pandas-equivalent EWMA, collapse detection, capacity rules."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from activity_engine.config import RiskConfig
from activity_engine.operators import risk

SCHEMA = ("agent_sk long, agent_id string, account_age_tier string, daily_invite_ceiling int, "
          "daily_message_ceiling int, date_key int, invites_sent long, invites_accepted long, "
          "messages_sent long, replies_received long")


def series(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_collapse_series(spark):
    rows = []
    for d in range(15):
        acc = 2 if d < 10 else 0
        rows.append((1, "AGT-TEST", "< 1 Month", 5, 10, 20260801 + d, 5, acc, 5, 1))
    out = risk.score_daily(series(spark, rows)).orderBy("date_key").collect()
    last3 = [r.risk_level for r in out[-3:]]
    assert any(r in ("CRITICAL", "WARNING") for r in last3)
    assert all(r.recommended_invite_capacity <= 5 for r in out)
    assert all(r.recommended_message_capacity <= 10 for r in out)
    assert out[-1].risk_level == "CRITICAL"
    assert out[-1].recommended_invite_capacity == 1     # max(1, floor(5 * 0.3))
    assert out[-1].recommended_message_capacity == 3    # max(2, floor(10 * 0.3))


def test_empty_in_empty_out(spark):
    assert risk.score_daily(series(spark, [])).count() == 0


@pytest.mark.parametrize("span", [7, 20])
def test_ewm_matches_pandas(spark, span):
    rng = np.random.default_rng(span)
    rows = []
    for agent, n in enumerate([1, 3, 5, 6, 7, 40, 141, 290, 700]):
        for t in range(n):
            rows.append((agent, t, float(rng.choice([0.0, 0.2, 0.5, 1.0, rng.random()]))))
    df = spark.createDataFrame(rows, "a long, t long, x double")
    alpha = 2.0 / (span + 1)
    got = risk.ewm_previous(df, "a", "t", "x", alpha, 5, "p").toPandas()
    got = got.sort_values(["a", "t"])
    for a, g in got.groupby("a"):
        s = g["x"].shift(1)
        m = s.ewm(span=span, min_periods=5).mean().to_numpy()
        v = s.ewm(span=span, min_periods=5).var().to_numpy()
        assert np.array_equal(np.isnan(m), g["p_mean"].isna().to_numpy())
        ok = ~np.isnan(m)
        assert np.allclose(g["p_mean"].to_numpy()[ok], m[ok], rtol=0, atol=1e-13)
        assert np.allclose(np.sqrt(g["p_var"].to_numpy()[ok].astype(float)),
                           np.sqrt(v[ok]), rtol=0, atol=1e-12)


def test_backfill_and_fallbacks(spark):
    # Four rows: no EWMA baseline at all -> own mean and std 0.08.
    rows = [(1, "A", "1 Month", 10, 15, 20260801 + d, 10, acc, 0, 0)
            for d, acc in enumerate([5, 5, 5, 0])]
    out = risk.score_daily(series(spark, rows)).orderBy("date_key").collect()
    mean = (0.5 * 3 + 0.0) / 4
    assert all(abs(r.rolling_mean_acc - mean) < 1e-15 for r in out)
    assert all(r.rolling_std_acc == 0.08 for r in out)
    assert out[-1].anomaly_score == round((0.0 - mean) / 0.08, 3)


def test_two_low_rows_are_critical_first_row_not(spark):
    rows = [(1, "A", "1 Month", 10, 15, 20260801 + d, 10, 0, 0, 0) for d in range(3)]
    out = risk.score_daily(series(spark, rows)).orderBy("date_key").collect()
    assert [r.risk_level for r in out][1:] == ["CRITICAL", "CRITICAL"]


def test_ghosting_runs(spark):
    rows = [(1, "A", "1 Month", 10, 15, 20260801 + d, 3, 0, 0, 0) for d in range(6)]
    rows += [(1, "A", "1 Month", 10, 15, 20260810, 3, 1, 0, 0)]
    rows += [(1, "A", "1 Month", 10, 15, 20260811 + d, 3, 0, 0, 0) for d in range(2)]
    runs = {(r.run_start, r.run_days, r.is_ghosting)
            for r in risk.ghosting_runs(series(spark, rows)).collect()}
    assert runs == {(20260801, 6, 1), (20260811, 2, 0)}


def test_tier_check_flags_mismatch(spark):
    agents = spark.createDataFrame([("A", "1 Month", 10, 15), ("B", "1 Month", 99, 15)],
                                   "agent_id string, account_age_tier string, "
                                   "daily_invite_ceiling int, daily_message_ceiling int")
    got = {r.agent_id: (r.ceiling_mismatch, r.cooldown_hours)
           for r in risk.tier_check(agents).collect()}
    assert got == {"A": (False, 24), "B": (True, 24)}


def test_span_must_exceed_one():
    with pytest.raises(ValueError):
        RiskConfig(ewma_span=1)


def test_dense_keys_unique_and_dense(spark):
    from activity_engine.operators.keys import assign_surrogate_keys
    df = spark.range(5000).select((F.col("id") * 7919 % 100003).alias("k")).repartition(7)
    out = assign_surrogate_keys(df, "k", "sk", 10).collect()
    sks = sorted(r.sk for r in out)
    assert sks == list(range(11, 5011))
    by_key = sorted(out, key=lambda r: r.k)
    assert [r.sk for r in by_key] == sks          # ids follow natural-key order


def test_ewm_long_series_many_blocks(spark):
    rng = np.random.default_rng(7)
    n = 5000
    x = rng.random(n) * rng.choice([0.0, 1.0, 2.0], n)
    df = spark.createDataFrame([(0, t, float(v)) for t, v in enumerate(x)], "a long, t long, x double")
    got = risk.ewm_previous(df, "a", "t", "x", 0.25, 5, "p").toPandas().sort_values("t")
    s = pd.Series(x).shift(1)
    m = s.ewm(span=7, min_periods=5).mean().to_numpy()
    v = s.ewm(span=7, min_periods=5).var().to_numpy()
    ok = ~np.isnan(m)
    assert np.max(np.abs(got["p_mean"].to_numpy()[ok] - m[ok])) < 1e-14
    assert np.max(np.abs(np.sqrt(got["p_var"].to_numpy()[ok].astype(float)) - np.sqrt(v[ok]))) < 1e-13


def test_min_points_one_backfills_the_first_deviation(spark):
    """With one point the mean starts a row before the deviation, which is backfilled."""
    rates = [0.5, 0.2, 0.7, 0.1, 0.4]
    rows = [(1, 20260801 + i, 10, int(r * 10), 0, 0, 20, 20) for i, r in enumerate(rates)]
    df = spark.createDataFrame(rows, "agent_sk long, date_key int, invites_sent long, invites_accepted long,"
                                     " messages_sent long, replies_received long, daily_invite_ceiling int,"
                                     " daily_message_ceiling int")
    got = {r.date_key: r.rolling_std_acc for r in risk.score_daily(df, RiskConfig(min_points=1)).collect()}
    s = pd.Series(rates).shift(1).ewm(span=7, min_periods=1).std().bfill().clip(lower=RiskConfig().std_floor)
    for i, want in enumerate(s):
        assert abs(got[20260801 + i] - want) < 1e-9


def test_windows_sort_narrow_rows_in_tasks_that_follow_the_rows(spark, monkeypatch):
    rows = [(a, f"A{a}", "< 1 Month", 5, 10, 20260101 + 100 * (d // 28) + d % 28, 1 + (a * d) % 7, (a + d) % 2, 3, d % 4)
            for a in range(40) for d in range(300)]
    daily = series(spark, rows)
    monkeypatch.setattr(risk, "ROWS_PER_TASK", 1000)
    sized = risk.score_daily(daily, rows=len(rows))
    assert sized.rdd.getNumPartitions() == 12
    plain = risk.score_daily(daily)
    assert sized.exceptAll(plain).isEmpty() and plain.exceptAll(sized).isEmpty()
    plan = sized._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    nodes = [line.lstrip(" +-:*()0123456789") for line in plan.split("\n")]
    windows = [i for i, n in enumerate(nodes) if n.startswith("Window")]
    sorts = [i for i, n in enumerate(nodes) if n.startswith("Sort ")]
    assert len(sorts) == 2
    # Rates and weighted terms are computed above both sorts: the rows they hold are narrow.
    below = "\n".join(nodes[sorts[0]:])
    assert windows and "acceptance_rate" not in below and "_accu" not in below
