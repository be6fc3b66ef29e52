"""Queries run the operators at their own sizes, not a smaller job."""

import numpy as np
import pytest

from colsieve.config import Filtering
from colsieve.functions.hashing import projections
from colsieve.models.grid import SIZES
from colsieve.operators import similarity as S
from colsieve.plans.catalog import CATALOG, models, similarities


@pytest.mark.parametrize("name, model", [
    ("train_trees", "RandomForest"), ("train_boosted", "XGBoost"), ("train_gaussian_process", "GPR"),
    ("train_fourier_process", "FourierGPR")])
def test_training_runs_with_default_sizes(spark, small, monkeypatch, name, model):
    runs = []

    class Recorded(models.Experiments):
        def run(self, sizes=SIZES, mode="sequential", models=()):
            runs.append((self.folds, self.tree_options, tuple(sizes), list(models)))
            return self.table()

    monkeypatch.setattr(models, "Experiments", Recorded)
    CATALOG[name][0](spark, small)
    assert runs == [(5, {}, SIZES, [model])]


def test_reduction_runs_with_default_filtering(spark, small, monkeypatch):
    seen = []

    class Stopped(Exception):
        pass

    def reduction(spark, config, df):
        seen.append(config.filtering)
        raise Stopped

    monkeypatch.setattr(models, "Reduction", reduction)
    with pytest.raises(Stopped):
        CATALOG["reduce_columns"][0](spark, small)
    assert seen == [Filtering()]


def dependence(z, weights, draws):
    """Lower medians over repetitions of means over draws, from the definition."""
    blocks = []
    for w in weights:
        waves = np.sin(z[:, :, None] * w[None, :, :])
        unit = (waves - waves.mean(axis=0)) / waves.std(axis=0, ddof=1)
        blocks.append(np.einsum("nil,njl->ij", unit, unit) / (len(z) * w.shape[1]))
    means = np.array(blocks).reshape(-1, draws, z.shape[1], z.shape[1]).mean(axis=1)
    return np.sort(means, axis=0)[(len(means) - 1) // 2]


@pytest.mark.parametrize("name, kind, features, draws", [
    ("hsic_like_defaults", "hsic", 50, 1), ("rdc_like_defaults", "rdc", 20, 10)])
def test_dependence_at_its_own_sizes(spark, small, name, kind, features, draws):
    part = similarities._part(spark, small)
    x = np.array(part.collect(), dtype=float)
    z = S.scores_of(x, similarities._knots(part, similarities.PART))
    want = dependence(z, projections(42, kind, 8 * draws, x.shape[1], features), draws)
    got = {(r.i, r.j): r.s for r in CATALOG[name][0](spark, small).collect()}
    assert len(got) == 6
    assert got == pytest.approx({key: want[key] for key in got}, abs=2e-6)
