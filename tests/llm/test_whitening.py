"""Operator 13 against whole-number products and numpy."""

import math

import numpy as np
import pytest
from hypothesis import given, settings as hypothesis_settings
from hypothesis import strategies as st

from activity_engine.llm import embedding_whitening as ew


@hypothesis_settings(max_examples=60, deadline=None)
@given(st.integers(1, 200), st.integers(1, 5), st.sampled_from([1, 6, 1000, 2**31, 2**60]), st.integers(0, 9))
def test_block_products_are_exact(rows, d, width, seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(-width, width, (rows, d))
    n, sums, cross = ew.block_moments(x)
    whole = x.astype(object)
    assert n == rows and sums == whole.sum(axis=0).tolist() and (cross == whole.T @ whole).all()


@pytest.mark.parametrize("value", [0, 1, -1, 2**30, -2**30, 2**200 + 7, -2**200 - 7])
def test_limbs(value):
    assert sum(v << ew.LIMB * k for k, v in enumerate(ew._limbs(value))) == value


def plain(vectors, size):
    """(kept rows, n, sums, eigenvalues, components, trace) by whole-number products."""
    kept = [(i, tuple(math.floor(64 * float(c)) + 1_000_000 for c in v)) for i, v in vectors
            if v is not None and len(v) == size and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({x for _, x in kept}), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = n * fit - sums
    v = np.array([[int(c) / n**3 for c in row] for row in centred.T @ centred])
    e, u = np.linalg.eigh(v)
    order = np.argsort(-e)[:16]
    return kept, n, sums, e[order], u[:, order], e.sum()


def vectors():
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=20) * np.linspace(3, 0.3, 20)).tolist()) for i in range(300)]
    rows += [(300 + i, rows[0][1]) for i in range(150)]                      # one vector for a third of the rows
    rows += [(500, None), (501, []), (502, [float("nan")] * 20), (503, [None] + [0.0] * 19), (504, [float("inf")] * 20),
             (505, [1.0, 2.0]), (None, rows[1][1]), (7, rows[7][1])]
    return rows


def test_whitened_rows(spark):
    rows = vectors()
    docs = spark.createDataFrame([(i, v, 5, "x") for i, v in rows], "vec_id long, embedding array<double>, n int, component string")
    got = ew.whiten(docs).collect()
    kept, n, sums, e, u, trace = plain(rows, 20)
    assert n == 300 and len(got) == 16 * len(kept)
    want = {}
    for i, x in kept:
        own = (n * np.array(x, dtype=object) - sums)
        want[i] = (int((own * own).sum()), (own.astype(float) / n) @ u / np.sqrt(e))
    signs = {}
    for r in got:
        deviation, white = want[r.vec_id]
        assert (r.n, r.deviation) == (n, deviation)
        value = white[r.component - 1]
        sign = signs.setdefault(r.component, 1 if r.whitened * value > 0 else -1)
        assert abs(r.whitened - sign * value) < 1e-9 and abs(r.explained - e[r.component - 1] / trace) < 1e-12
        assert r.identity_error < 1e-9


def test_defined_results(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert ew.whiten(make([])).collect() == [] and ew.whiten(make([(1, None), (2, [])])).collect() == []
    alone = ew.whiten(make([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()        # no variance at all
    assert len(alone) == 4 and all(r.whitened is None and r.deviation == 0 and r.n == 1 and r.identity_error is None for r in alone)
    flat = ew.whiten(make([(i, [float(i), 2.0]) for i in range(5)])).collect()    # none in one dimension
    assert {(r.component, r.whitened is None) for r in flat} == {(1, False), (2, True)}
    assert all(r.identity_error < 1e-12 for r in flat)
    huge = ew.whiten(make([(i, [1e30 * (-1) ** i, float(i)]) for i in range(6)])).collect()
    assert len(huge) == 12 and all(r.deviation is None for r in huge)
