import numpy as np
import pytest
from pyspark.sql import functions as F

from colsieve import config, sinks
from colsieve.functions.ranking import with_group_rank
from colsieve.models import linear
from colsieve.models.prepare import choose_descriptors, with_blocks
from colsieve.functions import hashing
from colsieve.operators import lineage, sampling
from colsieve.sources import tables


def test_names():
    assert tables.dedup_names(["ABC", "ABC", "DEF", "ABC"]) == ["ABC", "ABC_1", "DEF", "ABC_2"]
    assert tables.drop_overlap(["MolWt"], ["molwt", "TPSA"]) == ["TPSA"]


def test_flattened_structs(spark):
    df = spark.sql("SELECT named_struct('x', 1, 'y', named_struct('z', 2)) AS a, 3 AS b")
    assert tables.flatten_names(df).columns == ["a_x", "a_y_z", "b"]


def test_schema_drift_and_forced_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT 1 AS a, 2.5D AS b").write.parquet(path)
    spark.sql("SELECT 4 AS a, 'x' AS extra").write.mode("append").parquet(path)
    df = tables.read_parquet(spark, path)
    assert set(df.columns) == {"a", "b", "extra"} and df.filter("b IS NULL").count() == 1
    forced = tables.enforce_schema(df, tables.master_schema(["b", "c"], metadata=["CID"]))
    assert forced.columns == ["CID", "b", "c"] and forced.filter("c IS NOT NULL").count() == 0
    addressed = tables.with_row_address(df)
    assert addressed.select("source_path", "row_index").distinct().count() == 2


def test_directory_of_mixed_files(spark, tmp_path):
    folder = tmp_path / "mixed"
    spark.sql("SELECT 1 AS a").write.parquet(str(folder / "one"))
    spark.sql("SELECT 2 AS a, 3 AS b").write.option("header", True).csv(str(folder / "two"))
    df = tables.read_directory(spark, str(folder))
    assert sorted((r["a"], r["b"]) for r in df.fillna(0).collect()) == [(1, 0), (2, 3)]
    with pytest.raises(ValueError):
        tables.read_table(spark, "x.json")


def test_labelled_csv_with_gaps(spark, tmp_path):
    path = tmp_path / "l.csv"
    path.write_text("name,conc,stdev\nx,1e-3,\ny,2.5e-7,1e-8\nz,,\n")
    df = tables.read_csv(spark, str(path))
    assert tables.feature_columns(df, exclude=["NAME"]) == ["conc", "stdev"]
    assert df.filter("conc IS NULL").count() == 1


def test_samples_are_exact_and_independent_of_other_files(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") < 6000, "big").when(F.col("id") < 8990, "mid").otherwise("tiny").alias("f"), "id"
    )
    picked = {r["f"]: r["count"] for r in sampling.sample_per_group(df, "f", ["id"], 50).groupBy("f").count().collect()}
    assert picked == {"big": 50, "mid": 50, "tiny": 10}
    plan = sampling.sample_per_group(df, "f", ["id"], 50)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # before and after the shuffle
    large = sampling.sample_per_group(df, "f", ["id"], 2000)
    alone = sampling.sample_per_group(df.filter("f = 'big'"), "f", ["id"], 2000)
    assert large.groupBy("f").count().filter("f <> 'tiny'").select("count").distinct().first()[0] == 2000
    assert {r["id"] for r in large.filter("f = 'big'").collect()} == {r["id"] for r in alone.collect()}


def test_group_rank_with_a_hot_and_a_null_group(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 9 == 0, F.lit(None)).otherwise("cold").alias("g"), "id"
    )
    got = with_group_rank(df, ["g"], "id", "r", slices=16)
    assert got.count() == 3000
    want = {}
    for row in sorted(df.collect(), key=lambda r: r["id"]):
        want.setdefault(row["g"], []).append(row["id"])
    for r in got.collect():
        assert want[r["g"]][r["r"] - 1] == r["id"]


def test_blocks_are_exact(spark):
    df = spark.range(103)
    sizes = {r["block"]: r["count"] for r in with_blocks(df, ["id"], 5, 0.2).groupBy("block").count().collect()}
    assert sizes[5] == 21 and sum(sizes.values()) == 103
    assert max(sizes[k] for k in range(5)) - min(sizes[k] for k in range(5)) <= 1


def test_lineage_chain(spark):
    links = spark.createDataFrame([("a", "b", 2), ("b", "c", 3), ("c", "d", 4), ("e", "d", 2)], "removed string, survivor string, step int")
    kept = spark.createDataFrame([("d",), ("z",)], "col string")
    rows = {r["col"]: r for r in lineage.final_clusters(kept, links).collect()}
    assert rows["d"]["alternative_descriptors"] == ["a", "b", "c", "e"] and rows["d"]["cluster_size"] == 5
    assert rows["d"]["removal_history"]["pass2"] == ["a", "e"] and rows["d"]["removal_history"]["pass3"] == ["b"]
    assert rows["z"]["cluster_size"] == 1 and rows["z"]["alternative_descriptors"] == []
    document = lineage.to_document(lineage.final_clusters(kept, links))
    assert document["statistics"]["removal_distribution"] == {"pass2_only": 0, "pass3_only": 0, "both_passes": 1}
    assert document["metadata"]["standalone_descriptors"] == 1


def test_columns_without_survivor_stay_in_the_lineage(spark):
    links = spark.createDataFrame(
        [("a", "d", 2), ("m", "o", 2), ("o", None, 3), ("p", None, 3), ("p", "d", 2)], "removed string, survivor string, step int")
    kept = spark.createDataFrame([("d",)], "col string")
    lost = lineage.ownerless(kept, links)
    assert sorted(map(tuple, lost.collect())) == [("m", 2), ("o", 3), ("p", 3)]
    document = lineage.to_document(lineage.final_clusters(kept, links), lost)
    assert document["ownerless"] == ["m", "o", "p"] and document["metadata"]["ownerless_descriptors"] == 3
    assert document["descriptors"]["d"]["alternative_descriptors"] == ["a"]


def test_hash_cuts_narrow_their_buckets(spark, monkeypatch):
    df = spark.range(5000)
    plain = hashing.hash_cuts(df, ["id"], 7, lambda n: [0, 1, n // 3, n])
    monkeypatch.setattr(hashing, "BUCKET_ROWS", 1)
    monkeypatch.setattr(hashing, "DIGITS", 1)
    assert hashing.hash_cuts(df, ["id"], 7, lambda n: [0, 1, n // 3, n]) == plain
    order = sorted(r[0] for r in df.select(hashing.hash_key(["id"], 7)).collect())
    assert plain == ["", order[0], order[5000 // 3 - 1], order[-1]]
    assert hashing.hash_cuts(df.filter("false"), ["id"], 7, lambda n: [0]) == [""]


def test_cyclic_links_are_refused(spark):
    links = spark.createDataFrame([("a", "b", 2), ("b", "c", 2), ("c", "a", 2)], "removed string, survivor string, step int")
    with pytest.raises(ValueError):
        lineage.resolve(links)


def test_descriptor_choice():
    clusters = {
        "p": {"cluster_size": 3, "all_cluster_members": ["p", "q", "gone"], "alternative_descriptors": ["q", "gone"]},
        "r": {"cluster_size": 1, "all_cluster_members": ["r"], "alternative_descriptors": []},
    }
    have = ["q", "r", "p", "s"]
    assert choose_descriptors(have, 2) == ["q", "r"]
    assert choose_descriptors(have, 5, "representative", clusters) == ["p", "r"]
    assert choose_descriptors(have, 5, "mixed", clusters) == ["p", "r"]
    assert choose_descriptors(have, 5, "mixed", clusters, 2) == ["p", "q", "r"]
    assert set(choose_descriptors(have, 2, "random_alternative", clusters)) <= {"p", "q", "r"}
    assert choose_descriptors(have, 2, "representative", None) == ["q", "r"]
    with pytest.raises(ValueError):
        choose_descriptors(have, 2, "other")


def test_linear_fits_from_sums(spark):
    g = np.random.default_rng(4)
    x = g.normal(size=(400, 4))
    y = 2 * x[:, 0] - x[:, 2] + 0.1 * g.normal(size=400) + 3
    total = np.column_stack([np.ones(400), x, y])
    sums = linear.Sums(total.T @ total)
    beta, b0 = linear.fit("Ridge", sums)
    xc, yc = x - x.mean(0), y - y.mean()
    assert beta == pytest.approx(np.linalg.solve(xc.T @ xc + np.eye(4), xc.T @ yc), rel=1e-9)
    r2, rmse = linear.score(sums, beta, b0)
    res = y - b0 - x @ beta
    assert r2 == pytest.approx(1 - (res**2).sum() / (yc**2).sum()) and rmse == pytest.approx(np.sqrt((res**2).mean()))
    for model, ratio in linear.L1_RATIO.items():
        beta, _ = linear.fit(model, sums)
        gradient = xc.T @ (yc - xc @ beta) / 400 - 0.1 * (1 - ratio) * beta
        for j in range(4):  # optimality of the penalised fit
            if beta[j]:
                assert gradient[j] == pytest.approx(0.1 * ratio * np.sign(beta[j]), abs=1e-7)
            else:
                assert abs(gradient[j]) <= 0.1 * ratio + 1e-9
        assert beta[1] == 0 or model == "ElasticNet"


def test_settings(tmp_path):
    path = tmp_path / "c.json"
    path.write_text('{"filtering": {"vif_threshold": 5, "trim_lower": 2.5, "trim_upper": 97.5}}')
    with pytest.warns(UserWarning):
        conf = config.load(str(path), env={"COLSIEVE_FILTERING__VIF_THRESHOLD": "7"}, system__random_seed=1)
    assert conf.filtering.vif_threshold == 7 and conf.filtering.trim_lower == pytest.approx(0.025)
    assert conf.system.random_seed == 1
    assert config.difference(conf, config.Config())["filtering.vif_threshold"] == (7, 10.0)
    for name in ("s.json", "s.yaml"):
        config.save(conf, str(tmp_path / name))
        assert config.load(str(tmp_path / name), env={}) == conf
    path.write_text('{"filtering": {"nope": 1}}')
    with pytest.raises(KeyError):
        config.load(str(path), env={})
    with pytest.raises(ValueError):
        config.Filtering(w_hsic=0, w_rdc=0)
    with pytest.raises(KeyError):
        config.set_path(conf, "filtering.nope", 1)


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "names")
    sinks.write_names(spark, ["b", "a", "c d"], path)
    assert sinks.read_names(spark, path) == ["b", "a", "c d"]
    assert sinks.read_names(spark, path + "x") is None
    sinks.write_document(spark, {"k": [1, 2]}, path)
    assert sinks.read_document(spark, path) == {"k": [1, 2]} and sinks.read_document(spark, path + "x") is None
    parts = str(tmp_path / "parts")
    spark.range(100).repartition(4).write.parquet(parts)
    assert {r["chunk"] for r in sinks.finished_parts(spark, parts).collect()} == {0, 1, 2, 3}
    sinks.consolidate(spark, parts, str(tmp_path / "one"))
    assert len(list((tmp_path / "one").glob("*.parquet"))) == 1
    for kind in ("csv", "tsv", "json"):
        sinks.write_table(spark.range(3), str(tmp_path / kind), kind)
    with pytest.raises(ValueError):
        sinks.write_table(spark.range(3), str(tmp_path / "n"), "orc?")


def test_large_samples_move_few_rows(spark):
    df = spark.range(40000).select((F.col("id") % 2).alias("f"), "id")
    picked = sampling.sample_per_group(df, "f", ["id"], 1200)
    assert picked.count() == 2400
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
