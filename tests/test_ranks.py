"""Mean ranks and their correlation against NumPy."""

import numpy as np
import pytest

from colsieve.operators import ranks
from colsieve.operators.similarity import rank_correlation


def brute(x):
    """Mean rank: smaller values, and half of the equal ones."""
    return np.column_stack([((c[:, None] > c).sum(1) + ((c[:, None] == c).sum(1) + 1) / 2) for c in x.T])


def rows(n=600):
    rng = np.random.default_rng(4)
    hot = np.where(rng.random(n) < 0.4, 7.0, rng.normal(size=n) * 9)  # one value holds two fifths
    few = rng.integers(0, 3, n).astype(float)
    return np.column_stack([hot, few, rng.normal(size=n), np.where(rng.random(n) < 0.5, 0.0, -0.0)])


def frame(spark, x, extra=()):
    return spark.createDataFrame([*[tuple(map(float, r)) for r in x], *extra], "`a.x` double, b double, c double, d double")


NAMES = ["a.x", "b", "c", "d"]


@pytest.mark.parametrize("slice_rows, heavy", [(100_000, 1000), (20, 1000), (20, 8), (2, 50)])
def test_ranks_at_any_number_of_slices(spark, monkeypatch, slice_rows, heavy):
    monkeypatch.setattr(ranks, "SLICE_ROWS", slice_rows)
    monkeypatch.setattr(ranks, "HEAVY", heavy)
    x = rows()
    gaps = [(None, 1.0, 1.0, 1.0), (1.0, float("nan"), 1.0, 1.0)]
    got = sorted(tuple(r["ranks"]) for r in ranks.mean_ranks(frame(spark, x, gaps), NAMES).collect())
    assert np.array(got) == pytest.approx(np.array(sorted(map(tuple, brute(x)))))
    want = np.corrcoef(brute(x)[:, :3].T)
    pairs = {(r["i"], r["j"]): r["s"] for r in rank_correlation(frame(spark, x, gaps), NAMES).collect()}
    assert [pairs[i, j] for i in range(3) for j in range(3)] == pytest.approx(want.ravel().tolist(), abs=1e-9)


def test_extremes_and_empty_tables(spark):
    x = np.array([[-np.inf, 1.0, 1.0, 1.0], [np.inf, 1.0, 2.0, 1.7e308], [0.0, 1.0, 3.0, -1.7e308], [np.inf, 1.0, 3.0, 0.0]])
    got = sorted(tuple(r["ranks"]) for r in ranks.mean_ranks(frame(spark, x), NAMES).collect())
    assert got == sorted(map(tuple, brute(x)))
    assert ranks.mean_ranks(frame(spark, x).limit(0), NAMES).count() == 0


def test_shuffles_do_not_grow_with_the_columns(spark):
    def shuffles(names):
        plan = ranks.mean_ranks(frame(spark, rows(50)), names)._jdf.queryExecution().sparkPlan().toString()
        full = ranks.mean_ranks(frame(spark, rows(50)), names)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Join") == 1
        return full.count("Exchange hashpartitioning")

    assert shuffles(NAMES) == shuffles(NAMES[:2]) <= 4
