"""Whole runs: reduction with resume, experiments, command line."""

import json

import numpy as np
import pytest

from colsieve import cli, config, sinks
from colsieve.models.grid import Experiments
from colsieve.plans.catalog.common import features
from colsieve.plans.reduction import Reduction

FAST = {"filtering__r": 2, "filtering__hsic_D": 6, "filtering__rdc_d": 4, "filtering__rdc_seeds": 2, "filtering__cdf_points": 200}


@pytest.fixture(scope="module")
def wide(spark, small, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("wide") / "t")
    df = features(spark, small)
    df.selectExpr("uuid() AS id", "*").repartition(3).write.parquet(path)
    return path


def test_reduction_and_resume(spark, wide, tmp_path):
    conf = config.load(env={}, io__parquet_glob=wide, io__n_metadata=1, io__output_dir=str(tmp_path / "o"), **FAST)
    first = Reduction(spark, conf)
    out = first.run()
    assert out["initial_count"] == 10 and out["pass1_removed"] == 2
    owners = {}
    for name, entry in out["final_cluster_info"]["descriptors"].items():
        for member in entry["all_cluster_members"]:
            assert member not in owners
            owners[member] = name
    for group in ({"f2", "f5", "f6"}, {"f1", "f7"}):
        assert len({owners[c] for c in group}) == 1
    before = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "o").iterdir()}
    again = Reduction(spark, conf)
    assert again.run()["final_columns"] == out["final_columns"]
    same = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "o").iterdir()}
    assert all(same[k] == v for k, v in before.items() if k.startswith("pass"))
    other = Reduction(spark, config.set_path(conf, "filtering.spearman_threshold", 0.9999))
    other.run()
    assert len(other.columns_p2) > len(again.columns_p2)  # an old result was not taken


def test_sampled_reduction_and_small_tables(spark, wide, tmp_path):
    conf = config.load(env={}, io__parquet_glob=wide, io__n_metadata=1, io__output_dir=str(tmp_path / "o"),
                       filtering__sample_per_file=20, **FAST)
    run = Reduction(spark, conf)
    assert run.sample().count() == 60
    with pytest.raises(ValueError, match="min_effective_n"):
        Reduction(spark, conf).statistics()


def test_experiments(spark):
    g = np.random.default_rng(6)
    x = g.normal(size=(300, 6))
    y = 3 * x[:, 0] - 2 * x[:, 1] + np.sin(2 * x[:, 2]) + 0.1 * g.normal(size=300)
    x[g.random((300, 6)) < 0.05] = np.nan
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r], float(t)) for i, (r, t) in enumerate(zip(x, y))]
    names = [f"x{k}" for k in range(6)]
    df = spark.createDataFrame(rows, "id long, " + ", ".join(f"{n} double" for n in names) + ", y double")
    runs = Experiments(df, "y", ["id"], names, folds=3, tree_options={"numTrees": 5})
    results = {(r["model_name"], r["n_descriptors"]): r for r in runs.run([2, 6, 99], models=["Ridge", "Lasso", "RandomForest", "GPR"]).collect()}
    assert set(n for _, n in results) == {2, 6} and len(results) == 8
    ridge = results["Ridge", 6]
    assert ridge["holdout_r2"] > 0.85 and ridge["kfold_r2_mean"] > 0.8 and ridge["holdout_rmse"] > 0
    assert ridge["feature_importance"]["x0"] > ridge["feature_importance"]["x5"]
    assert results["GPR", 6]["holdout_r2"] > 0.7
    assert results["RandomForest", 6]["train_r2"] > 0.3
    assert ridge["extreme_high_n"] == 12
    held = runs.predictions("Ridge", names)
    assert held.count() == 60
    mae = held.selectExpr("avg(abs(y - p))").first()[0]
    assert mae == pytest.approx(ridge["holdout_mae"], rel=1e-6)
    runs.close()


def test_command_line(spark, wide, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(cli, "build_session", lambda: spark)
    out = str(tmp_path / "o")
    assert cli.main(["filter", "pass1", "--parquet-glob", wide, "--n-metadata", "1", "--output-dir", out]) == 0
    kept = json.loads(capsys.readouterr().out.strip().splitlines()[-1])["kept"]
    assert "f9" not in kept and "f1" in kept
    models = str(tmp_path / "m")
    args = ["train", "--input", wide, "--target-col", "f6", "--key", "id", "--output-dir", models,
            "--descriptor-sizes", "2,4", "--models", "Ridge,Lasso", "--cv-folds", "3"]
    assert cli.main(args) == 0
    results = sinks.read_document(spark, f"{models}/ml_results.json")
    assert len(results) == 4 and sinks.read_document(spark, f"{models}/best_model.json")["model_name"] in ("Ridge", "Lasso")
    assert spark.read.csv(f"{models}/plot_residuals", header=True).count() > 0
    csv = tmp_path / "records.csv"
    csv.write_text("CID,SMILES::Absolute\n" + "\n".join(f"{i},{'C' * (i % 7 + 1)}{'N' * (i % 3)}O" for i in range(150)))
    assert cli.main(["preprocess", "calc", "--input", str(csv), "--output", str(tmp_path / "d")]) == 0
    table = spark.read.parquet(str(tmp_path / "d"))
    assert table.count() == 150 and table.columns[:2] == ["CID", "isomeric_smiles"]
    assert cli.main(["preprocess", "schema", "--input", str(tmp_path / "d"), "--output", str(tmp_path / "s.json")]) == 0
    assert json.loads((tmp_path / "s.json").read_text())[0] == "CID"


def test_a_failed_experiment_leaves_the_charts(spark, wide, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(cli, "build_session", lambda: spark)

    def broken(self, plans):
        raise ValueError("no trees today")

    monkeypatch.setattr(Experiments, "_grown", broken)
    out = str(tmp_path / "m")
    args = ["train", "--input", wide, "--target-col", "f6", "--key", "id", "--output-dir", out,
            "--descriptor-sizes", "2", "--models", "XGBoost,Ridge", "--cv-folds", "3"]
    assert cli.main(args) == 0
    results = sinks.read_document(spark, f"{out}/ml_results.json")
    assert {r["model_name"]: "no trees today" in (r.get("error") or "") for r in results} == {"XGBoost": True, "Ridge": False}
    assert spark.read.csv(f"{out}/plot_predictions", header=True).count() > 0


def test_a_folder_without_its_mark_is_made_again(spark, tmp_path):
    path = tmp_path / "t"
    spark.range(3).write.parquet(str(path))
    assert sinks.read_saved(spark, str(path)).count() == 3
    (path / "_SUCCESS").unlink()
    assert sinks.read_saved(spark, str(path)) is None and sinks.read_saved(spark, str(tmp_path / "none")) is None
    assert sinks.saved(spark, str(path), lambda: spark.range(5)).count() == 5
