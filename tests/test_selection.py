"""Order statistics found by counts, against sorting."""

import math

import numpy as np
import pytest

from colsieve.operators import selection
from colsieve.operators.profile import quantiles
from colsieve.operators.selection import order_statistics, pattern, value


def test_patterns_sort_like_their_values():
    x = np.array([-np.inf, -1e300, -2.5, -2.0, -1e-320, 0.0, 5e-324, 1.0, 1.5, 1e308, np.inf])
    assert (np.diff(pattern(x).astype(object)) > 0).all() and (value(pattern(x)) == x).all()
    assert pattern(np.array([-0.0])) == pattern(np.array([0.0]))


@pytest.fixture(scope="module")
def cells():
    g = np.random.default_rng(2)
    n = 5000
    x = np.column_stack([
        g.normal(size=n) * 10.0 ** g.integers(-12, 12, n), g.integers(-3, 4, n), g.normal(size=n), np.full(n, 4.25),
        np.where(g.random(n) < 0.6, np.nan, g.random(n)), 1e9 + g.random(n) * 1e-6, np.full(n, np.nan), g.choice([-np.inf, 0.0, -0.0, np.inf], n)])
    x[1:, 4] = np.where(np.arange(1, n) < 30, x[1:, 4], np.nan)  # a few values only
    return x


@pytest.mark.parametrize("held", [1 << 22, 300])
def test_all_ranks(spark, cells, monkeypatch, held):
    monkeypatch.setattr(selection, "CELLS", held)
    monkeypatch.setattr(selection, "HELD_VALUES", 4000)
    names = [f"c{k}" for k in range(cells.shape[1])]
    df = spark.createDataFrame([tuple(None if math.isnan(v) else float(v) for v in r) for r in cells], ", ".join(f"{c} double" for c in names))
    probs = [0.0, 0.025, 0.3, 0.5, 0.777, 1.0]
    found = order_statistics(df.repartition(7), probs)
    assert 6 not in found
    for p in set(range(len(names))) - {6}:
        x = np.sort(cells[~np.isnan(cells[:, p]), p])
        n, ranks, values = found[p]
        assert n == len(x) and (values == x[ranks]).all()
    got = {r["col"]: r["q"] for r in quantiles(df, names[:6], probs).collect()}
    for p in range(6):
        assert got[f"c{p}"] == pytest.approx(np.nanquantile(cells[:, p], probs).tolist(), rel=1e-12)


def test_nothing_there(spark):
    df = spark.createDataFrame([], "a double, b double")
    assert order_statistics(df, [0.5]) == {}
    assert {r["col"]: r["q"] for r in quantiles(df, ["a", "b"], [0.5]).collect()} == {"a": None, "b": None}
    one = spark.createDataFrame([(3.0, None)], "a double, b double")
    assert {r["col"]: r["q"] for r in quantiles(one, ["a", "b"], [0.0, 0.4]).collect()} == {"a": [3.0, 3.0], "b": None}


def test_what_moves_does_not_follow_the_rows(spark):
    """Tasks send counts of parts: at most one record per task and column in a step."""
    df = spark.range(200_000, numPartitions=4).selectExpr("cast(id as double) a")
    assert order_statistics(df, [0.5])[0][2].tolist() == [99_999.0, 100_000.0]


def test_groups_stay_small_with_many_tasks(spark, monkeypatch):
    """A group holds the parts of one chunk once, however many tasks counted them."""
    monkeypatch.setattr(selection, "CELLS", 4096)
    monkeypatch.setattr(selection, "CHUNK_BITS", 5)
    x = np.random.default_rng(5).normal(size=20_000)
    df = spark.createDataFrame([(float(v),) for v in x], "a double").repartition(16)
    sizes, real = [], selection.Intervals.__init__
    monkeypatch.setattr(selection.Intervals, "__init__", lambda self, *a: (real(self, *a), sizes.append(len(self.low) << self.bits))[0])
    probs = [k / 200 for k in range(201)]
    n, ranks, values = order_statistics(df, probs)[0]
    assert n == len(x) and (values == np.sort(x)[ranks]).all()
    assert max(sizes) <= 4096
    assert selection.CHUNK_BITS == 5 and "chunk" in selection.FIELDS
    assert "binary" not in selection.PARTIAL  # Spark adds up the tasks' parts, no Python group gathers them
