import math

import numpy as np
import pytest

from colsieve.operators import profile as P
from colsieve.sources.tables import as_features


@pytest.fixture(scope="module")
def awkward(spark):
    rng = np.random.default_rng(3)
    n = 3000
    hot = np.where(rng.random(n) < 0.4, 7.0, rng.normal(size=n))  # one value in 40 % of rows
    rows = []
    for i in range(n):
        rows.append((
            float(hot[i]), 5.0, None, float("nan") if i % 3 else 1.0 * i,
            float("inf") if i == 0 else float(i % 5), None if i % 2 else float(rng.exponential()),
        ))
    raw = spark.createDataFrame(rows, "hot double, flat double, empty double, holes double, inf double, half double")
    return as_features(raw, raw.columns)


@pytest.mark.parametrize("slice_rows", [50, 1_000_000])
def test_quantiles_equal_numpy(awkward, monkeypatch, slice_rows):
    monkeypatch.setattr(P, "SLICE_ROWS", slice_rows)
    probs = [0.0, 0.025, 0.5, 0.9, 1.0]
    found = {r["col"]: r["q"] for r in P.quantiles(awkward, awkward.columns, probs).collect()}
    assert set(found) == set(awkward.columns)
    for c, q in found.items():
        values = [r[0] for r in awkward.select(c).collect() if r[0] is not None]
        if values:
            assert q == pytest.approx(list(np.quantile(values, probs)), abs=1e-12)
        else:
            assert not q or all(v is None for v in q)


def test_columns_of_one_job_do_not_matter(awkward, monkeypatch):
    one = {r["col"]: r for r in P.profile(awkward, awkward.columns).collect()}
    monkeypatch.setattr(P, "COLUMNS_PER_JOB", 1)
    two = {r["col"]: r for r in P.profile(awkward, awkward.columns).collect()}
    assert one == two and set(one) == set(awkward.columns)


def test_empty_table_gives_a_row_per_column(awkward):
    rows = P.profile(awkward.filter("false"), awkward.columns).collect()
    assert {r["col"] for r in rows} == set(awkward.columns)
    assert all(r["n_total"] == 0 and r["n_valid"] == 0 for r in rows)


def test_nan_and_infinity_are_missing(awkward):
    p = {r["col"]: r for r in P.profile(awkward, awkward.columns).collect()}
    assert p["holes"]["n_valid"] == 1000
    assert p["inf"]["n_missing"] == 1 and p["inf"]["max"] == 4.0
    assert p["empty"]["n_valid"] == 0 and p["empty"]["norm_variance"] == 0.0
    assert all(math.isfinite(r["norm_variance"]) for r in p.values())


def test_reasons(awkward):
    reasons = {
        r["col"]: r["reason"]
        for r in P.profile(awkward, awkward.columns).select("col", P.keep_reason().alias("reason")).collect()
    }
    assert reasons["flat"] == "variance" and reasons["empty"] == "variance"
    assert reasons["holes"] == "missing"
    assert reasons["hot"] == "keep"


def test_cdf_is_monotone(awkward):
    for r in P.cdf_tables(awkward, ["hot", "half"], 1000).collect():
        assert len(r["cdf"]) == 1000
        assert all(a <= b for a, b in zip(r["cdf"], r["cdf"][1:]))


def test_average_ranks(spark, monkeypatch):
    monkeypatch.setattr(P, "SLICE_ROWS", 3)
    df = spark.createDataFrame([(float(v),) for v in [3, 1, 1, 2, 3, 3, 9]], "x double")
    ranks = {r["value"]: r["rank"] for r in P.average_ranks(df, ["x"]).collect()}
    assert ranks == {1.0: 1.5, 2.0: 3.0, 3.0: 5.0, 9.0: 7.0}
