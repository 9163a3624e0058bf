"""Property tests: random batches against pandas statements of the rules."""

import math

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from activity_engine.config import ALLOWED_EVENT_TYPES
from activity_engine.operators import ingest, quality, risk

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

ids = st.one_of(st.none(), st.sampled_from(["E1", "E2", "E3", "E4", "E5"]))
types = st.one_of(st.none(), st.sampled_from(list(ALLOWED_EVENT_TYPES) + ["BOGUS", ""]))
rows = st.lists(st.tuples(ids, types), min_size=0, max_size=40)


def pd_score(failed, total):
    return round(max(0.0, 100.0 * (1.0 - failed / max(1, total))), 2)


@SETTINGS
@given(rows)
def test_dq_scores_match_pandas_rules(spark, data):
    df = spark.createDataFrame(data, "event_id string, event_type string")
    pdf = pd.DataFrame(data, columns=["event_id", "event_type"])
    n = len(pdf)
    comp = quality.check_completeness(df, ["event_id", "event_type", "absent"]).first()
    missing = int(pdf["event_id"].isna().sum() + pdf["event_type"].isna().sum()) + n
    assert comp.records_failed == missing
    assert comp.dimension_score == (pd_score(missing, n * 3) if n else 100.0)
    uniq = quality.check_uniqueness(df, "event_id").first()
    dup = int(pdf.duplicated(subset=["event_id"], keep=False).sum())
    assert uniq.records_failed == dup
    assert uniq.dimension_score == (pd_score(dup, n) if n else 100.0)
    val = quality.check_validity(df).first()
    bad = int((~pdf["event_type"].isin(ALLOWED_EVENT_TYPES)).sum())
    assert val.records_failed == bad


batch = st.lists(st.tuples(st.sampled_from(["A", "B", "C", "D"]),
                           st.integers(0, 1000), st.integers(0, 9)), min_size=1, max_size=60)


@SETTINGS
@given(batch)
def test_first_arrival_wins(spark, data):
    df = spark.createDataFrame(data, "event_id string, ingest_order int, payload int")
    got = {r.event_id: (r.ingest_order, r.payload)
           for r in ingest.dedupe_first_wins(df, "event_id", "ingest_order").collect()}
    pdf = pd.DataFrame(data, columns=["event_id", "ingest_order", "payload"])
    first = pdf.groupby("event_id")["ingest_order"].min()
    assert set(got) == set(first.index)
    for k, (order, payload) in got.items():
        assert order == first[k]
        assert (k, order, payload) in set(data)


series = st.lists(st.floats(0, 2, allow_nan=False, width=32), min_size=1, max_size=30)


@SETTINGS
@given(series, st.integers(2, 15))
def test_ewm_matches_pandas(spark, xs, span):
    df = spark.createDataFrame([(0, t, float(v)) for t, v in enumerate(xs)],
                               "a long, t long, x double")
    got = risk.ewm_previous(df, "a", "t", "x", 2.0 / (span + 1), 5, "p").toPandas().sort_values("t")
    s = pd.Series([float(v) for v in xs]).shift(1)
    m = s.ewm(span=span, min_periods=5).mean().to_numpy()
    v = s.ewm(span=span, min_periods=5).var().to_numpy()
    for i in range(len(xs)):
        gm, gv = got["p_mean"].iloc[i], got["p_var"].iloc[i]
        if math.isnan(m[i]):
            assert pd.isna(gm)
        else:
            assert abs(gm - m[i]) < 1e-12
            assert abs(math.sqrt(max(gv, 0.0)) - math.sqrt(max(v[i], 0.0))) < 1e-6


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["A", "B", "C", "D", None]),
                          st.integers(0, 1000), st.integers(0, 9)), min_size=1, max_size=60))
def test_first_arrival_wins_among_repeated_keys(spark, data):
    df = spark.createDataFrame(data, "event_id string, ingest_order int, payload int")
    repeated = ingest.repeated_hashes(df)
    want = sorted(map(str, ingest.dedupe_first_wins(df).collect()))
    assert sorted(map(str, ingest.dedupe_repeated(df, repeated).collect())) == want
    more = repeated.union(df.select(ingest.key_hash("event_id"))).distinct()     # a superset changes nothing
    assert sorted(map(str, ingest.dedupe_repeated(df, more).collect())) == want
