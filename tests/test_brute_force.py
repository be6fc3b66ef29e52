"""Queries without SQL, against plain NumPy on the smallest tables."""

import hashlib
import math

import numpy as np
import pytest

from colsieve.models.grid import SIZES
from colsieve.operators.vif import RIDGE
from colsieve.plans.catalog import CATALOG
from colsieve.plans.catalog.common import USABLE, features
from colsieve.plans.catalog.models import DIMS, _embedded


@pytest.fixture(scope="module")
def cells(spark, small):
    return features(spark, small, USABLE).toPandas().to_numpy(dtype=float)


def scores(x):
    from statistics import NormalDist

    out = np.zeros_like(x)
    probs = np.linspace(0, 1, 101)
    for j in range(x.shape[1]):
        seen = ~np.isnan(x[:, j])
        knots = np.quantile(x[seen, j], probs)
        knots = np.where(np.abs(knots - np.round(knots, 12)) < 1e-15, np.round(knots, 12), knots)
        u = np.clip(np.interp(x[seen, j], knots, probs), 1e-12, 1 - 1e-12)
        out[seen, j] = [NormalDist().inv_cdf(v) for v in u]
    return out


def test_direct_elimination(spark, small, cells):
    got = [(r["col"], r["vif"]) for r in CATALOG["vif_eliminate_direct"][0](spark, small).orderBy("removed_order").collect()]
    names, left, want = list(USABLE), cells, []
    while True:
        whole = left[~np.isnan(left).any(axis=1)]
        whole = (whole - whole.mean(0)) / whole.std(0)
        vif = []
        for j in range(whole.shape[1]):
            design = np.column_stack([np.ones(len(whole)), np.delete(whole, j, axis=1)])
            res = whole[:, j] - design @ np.linalg.lstsq(design, whole[:, j], rcond=None)[0]
            vif.append(whole[:, j].var() / res.var() if res.var() > 1e-18 else np.inf)
        worst = int(np.argmax(vif))
        if vif[worst] < 10:
            break
        want.append((names.pop(worst), vif[worst]))
        left = np.delete(left, worst, axis=1)
    assert [n for n, _ in got] == [n for n, _ in want]
    for (_, a), (_, b) in zip(got, want):
        assert a == pytest.approx(b, rel=1e-3)


def test_elimination_by_correlation(spark, small, cells):
    got = [(r["col"], r["survivor"]) for r in CATALOG["vif_eliminate_correlation"][0](spark, small).orderBy("removed_order").collect()]
    corr = np.corrcoef(scores(cells).T)
    alive, want = list(range(8)), []

    def fit(idx):
        out = []
        for j in idx:
            rest = [k for k in idx if k != j]
            r = corr[j, rest]
            r2 = r @ np.linalg.solve(corr[np.ix_(rest, rest)] + RIDGE * np.eye(len(rest)), r)
            out.append(min(max(r2, 0.0), 0.9999))
        return np.array(out)

    while True:
        r2 = fit(alive)
        vif = 1 / (1 - r2)
        worst = int(np.argmax(vif))
        if vif[worst] < 10:
            break
        rest = alive[:worst] + alive[worst + 1 :]
        fall = np.delete(r2, worst) - fit(rest)
        heir = USABLE[rest[int(np.argmax(fall))]] if fall.max() > 0 else None
        want.append((USABLE[alive[worst]], heir))
        alive = rest
    assert got == want


def test_linear_experiments(spark, small):
    got = {(r["model_name"], r["n_descriptors"]): r for r in CATALOG["train_linear"][0](spark, small).collect()}
    assert len(got) == 9
    table = _embedded(spark, small).toPandas()
    order = np.argsort([hashlib.md5(f"{i}|42".encode()).hexdigest() for i in table["vec_id"]])
    table = table.iloc[order]
    n = len(table)
    held = math.ceil(n * 0.2)
    x, y = table[DIMS[:20]].to_numpy(dtype=float), table["label"].to_numpy(dtype=float)
    train = slice(held, n)
    x = (x - x[train].mean(0)) / x[train].std(0)

    def ridge(rows):
        a, b = x[rows], y[rows]
        ac = a - a.mean(0)
        beta = np.linalg.solve(ac.T @ ac + np.eye(20), ac.T @ (b - b.mean()))
        return beta, b.mean() - a.mean(0) @ beta

    def r2(rows, beta, b0):
        e = y[rows] - x[rows] @ beta - b0
        return 1 - (e**2).sum() / ((y[rows] - y[rows].mean()) ** 2).sum()

    fold = np.full(n, -1)
    fold[train] = np.arange(n - held) * 5 // (n - held)
    scored = [r2(fold == k, *ridge((fold >= 0) & (fold != k))) for k in range(5)]
    beta, b0 = ridge(fold >= 0)
    row = got["Ridge", 20]
    assert row["kfold_r2_mean"] == pytest.approx(np.mean(scored), abs=1e-4)
    assert row["kfold_r2_std"] == pytest.approx(np.std(scored), abs=1e-4)
    assert row["holdout_r2"] == pytest.approx(r2(fold < 0, beta, b0), abs=1e-4)
    errors = np.abs(y[:held] - x[:held] @ beta - b0)
    assert row["holdout_mae"] == pytest.approx(errors.mean(), abs=1e-4)
    high = np.percentile(y[:held], 80)
    top = y[:held] > high
    if top.any():
        assert row["extreme_high_mae"] == pytest.approx(errors[top].mean(), abs=1e-4)


def test_reduced_columns(spark, small):
    rows = {r["col"]: r for r in CATALOG["reduce_columns"][0](spark, small).collect()}
    members = [set([c, *filter(None, r["alternatives"].split(","))]) for c, r in rows.items()]
    assert sum(len(m) for m in members) == len(set().union(*members))  # one owner each
    assert any({"f2", "f5", "f6"} <= m for m in members)
    assert not {"f9", "f10"} & set().union(*members)


@pytest.mark.parametrize("name", ["train_trees", "train_boosted", "train_gaussian_process"])
def test_other_models_give_whole_results(spark, small, name):
    rows = CATALOG[name][0](spark, small).collect()
    assert [r["n_descriptors"] for r in rows] == list(SIZES)
    for row in rows:
        assert row["train_r2"] >= row["holdout_r2"] and math.isfinite(row["kfold_r2_mean"])
        assert row["overfitting_gap"] == pytest.approx(row["train_r2"] - row["holdout_r2"], abs=2e-4)
