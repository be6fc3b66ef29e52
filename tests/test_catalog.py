"""Every named query against its SQL at the smallest scale."""

import pytest

from colsieve.plans.catalog import CATALOG
from oracle import compare, connect

SLOW = {"train_trees", "train_boosted", "train_gaussian_process", "train_fourier_process", "train_linear", "reduce_columns"}


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(set(CATALOG) - SLOW))
def test_query(spark, duck, small, name):
    function, sql = CATALOG[name]
    outcome, _, _ = compare(spark, duck, small, name, function, sql)
    assert outcome.startswith(("ok", "rows-only")), outcome
