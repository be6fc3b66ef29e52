"""Results that once were stale, lost or wrong."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from colsieve import config
from colsieve.functions.text import to_number
from colsieve.models import evaluate
from colsieve.models.ensembles import forest
from colsieve.models.trees import SPECS
from colsieve.models.grid import Experiments
from colsieve.operators import sampling
from colsieve.operators.featurize import apply_guarded
from colsieve.plans.ingest import process_all
from colsieve.plans.reduction import Reduction

FAST = {"filtering__r": 1, "filtering__hsic_D": 4, "filtering__rdc_d": 2, "filtering__rdc_seeds": 1,
        "filtering__cdf_points": 50, "filtering__min_effective_n": 10}


def write_columns(spark, path, shift):
    rows = spark.range(300).select(
        "id", *[(F.sin(F.col("id") * (k + 1)) + shift).alias(f"c{k}") for k in range(3)])
    rows.coalesce(1).write.mode("overwrite").parquet(path)


def test_rewritten_input_is_read_again(spark, tmp_path):
    path = str(tmp_path / "in")
    conf = config.load(env={}, io__parquet_glob=path, io__n_metadata=1, io__output_dir=str(tmp_path / "out"), **FAST)
    means = []
    for shift in (0.0, 1000.0):
        write_columns(spark, path, shift)
        means.append(Reduction(spark, conf).statistics().filter("col = 'c0'").first()["mean"])
    assert abs(means[1] - means[0] - 1000) < 1e-6


def test_second_input_into_the_same_folder(spark, tmp_path):
    counts = []
    for name, rows in (("a", 150), ("b", 200)):
        path = str(tmp_path / f"{name}.parquet")
        spark.range(rows).select(
            F.col("id").cast("string").alias("CID"), F.lit(None).cast("string").alias("InChI::Standard"),
            F.concat(F.repeat(F.lit("C"), F.col("id").cast("int") % 17 + 1), F.repeat(F.lit("N"), F.col("id").cast("int") % 5),
                     F.repeat(F.lit("=O"), F.col("id").cast("int") % 3)).alias("SMILES::Absolute"),
        ).write.parquet(path)
        conf = config.load(env={}, io__output_dir=str(tmp_path / "out"), **FAST)
        process_all(spark, path, conf)
        metrics = spark.read.csv(f"{tmp_path}/out/metrics", sep="\t", header=True, inferSchema=True)
        counts.append(max(v for r in metrics.collect() for v in r if isinstance(v, int)))
    assert counts == [150, 200]
    summary = spark.read.csv(f"{tmp_path}/out/batch_summary", sep="\t", header=True, inferSchema=True).first()
    assert (summary["n_total"], summary["n_success"], summary["n_timeout"]) == (200, 200, 0)
    assert spark.read.csv(f"{tmp_path}/out/timeouts", sep="\t", header=True).count() == 0


@pytest.fixture(scope="module")
def line(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 3))
    y = 2 * x[:, 0] - x[:, 1] + rng.normal(size=4000) * 0.5
    return spark.createDataFrame([(k, *map(float, r), float(v)) for k, (r, v) in enumerate(zip(x, y, strict=True))],
                                 "id long, `a.x` double, b double, c double, y double")


@pytest.mark.parametrize("models", [["Ridge", "Lasso"], ["GPR"]])
def test_scores_do_not_depend_on_the_targets_offset(line, models):
    found = []
    for offset in (0.0, 1e8):
        runs = Experiments(line.withColumn("y", F.col("y") + offset), "y", ["id"], ["a.x", "b", "c"], folds=3)
        found.append([(r["model_name"], r["holdout_r2"], r["holdout_rmse"], r["holdout_mae"]) for r in runs.run([3], models=models).collect()])
        runs.close()
    for a, b in zip(*found, strict=True):
        assert a[0] == b[0] and a[1:] == pytest.approx(b[1:], rel=1e-4)
    assert found[0][0][1] > 0.9


def test_failed_experiments_are_rows(line):
    runs = Experiments(line, "y", ["id"], ["a.x", "b"], folds=2, tree_options={"maxDepth": -3})
    out = {r["model_name"]: r for r in runs.run([2], models=["RandomForest", "Ridge"]).collect()}
    assert out["Ridge"]["error"] is None and out["Ridge"]["holdout_r2"] > 0.9
    assert out["RandomForest"]["error"] and out["RandomForest"]["holdout_r2"] is None
    assert evaluate.best(runs.table()).first()["model_name"] == "Ridge"
    runs.close()


def test_best_per_model_puts_the_best_first(spark):
    rows = spark.createDataFrame([("A", 5, 0.1), ("Z", 5, 0.9), ("Z", 10, 0.8), ("M", 5, None)], "model_name string, n_descriptors int, holdout_r2 double")
    assert [r["model_name"] for r in evaluate.best_per_model(rows).collect()][:2] == ["Z", "A"]


def test_extra_trees_keep_their_feature_subsets():
    assert SPECS["ExtraTrees", True].node_columns == "sqrt" and SPECS["ExtraTrees", False].node_columns == "all"
    assert forest(regularised=True).getFeatureSubsetStrategy() == "sqrt"


def test_time_limit_reaches_through_functions_that_catch_exceptions(spark):
    def make():
        def slow(value):
            out = {}
            for name in ("a", "b"):
                try:
                    time.sleep(1.0 if value == "slow" else 0.0)
                    out[name] = 1.0
                except Exception:
                    out[name] = None
            return out
        return slow

    rows = spark.createDataFrame([("slow",), ("fast",)], "text string")
    out = {r["text"]: r["descriptor_status"] for r in apply_guarded(rows, "text", ["a", "b"], make, 0.3).collect()}
    assert out == {"slow": "failed(skip)", "fast": "success"}


def test_only_groups_that_missed_come_back_whole(spark, monkeypatch):
    df = spark.range(4000).select((F.col("id") % 2).alias("g"), "id")
    plain = {tuple(r) for r in sampling.sample_per_group(df, "g", ["id"], 30).collect()}
    order = sorted((r[0], r[1], r[2]) for r in df.select("g", sampling.hash_key(["id"], 42), "id").collect())
    want = {(g, i) for g in (0, 1) for _, _, i in [x for x in order if x[0] == g][:30]}
    assert plain == want
    monkeypatch.setattr(sampling.math, "sqrt", lambda v: -1e9)  # a cut that drops every row
    assert {tuple(r) for r in sampling.sample_per_group(df, "g", ["id"], 30).collect()} == want


@pytest.mark.parametrize("text, value", [
    ("[1.5]", 1.5), (" [ -2e3 ] ", -2000.0), ("7", 7.0), ("[1, 2]", None), ("[]", None), ("[[1]]", None), ("x", None), (None, None)])
def test_numbers_in_brackets(spark, text, value):
    assert spark.createDataFrame([(text,)], "t string").select(to_number(F.col("t"))).first()[0] == value
