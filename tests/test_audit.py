"""Broken and empty files are reported and don't stop the others."""

import gzip

import numpy as np

from colsieve.models.grid import Experiments
from colsieve.plans.ingest import read_records
from colsieve.sources.audit import listed_files, skipped_files
from colsieve.sources.tables import read_parquet, read_table

RECORD = ("<PC-Compound><PC-Compound_id><PC-CompoundType><PC-CompoundType_id><PC-CompoundType_id_cid>{}"
          "</PC-CompoundType_id_cid></PC-CompoundType_id></PC-CompoundType></PC-Compound_id></PC-Compound>")


def test_xml_files_without_a_record_are_rows(spark, tmp_path):
    folder = tmp_path / "in" / "deep er"
    folder.mkdir(parents=True)
    (folder / "good one.xml").write_text(f"<all>{RECORD.format(1)}{RECORD.format(2)}</all>")
    (folder / "good.xml.gz").write_bytes(gzip.compress(f"<all>{RECORD.format(3)}</all>".encode()))
    (folder / "cut.xml.gz").write_bytes(b"\x1f\x8b\x08\x00 this is no gzip")
    (folder / "none.xml").write_text("<all></all>")
    (folder / "void.xml").write_text("")
    (folder / "notes.txt").write_text("not looked at")
    errors = str(tmp_path / "errors")
    read_records(spark, str(tmp_path / "in"), errors)
    got = spark.read.option("header", "true").option("sep", "\t").csv(f"{errors}_files").collect()
    assert {(r["source_file"].rsplit("/", 1)[1], r["reason"]) for r in got} == {
        ("cut.xml.gz", "nothing read"), ("none.xml", "nothing read")}
    assert len(got) == 2


def test_parquet_files_that_were_passed_over(spark, tmp_path):
    folder = tmp_path / "p"
    spark.range(5).coalesce(1).write.parquet(str(folder))
    (folder / "bad.parquet").write_text("PAR1 broken")
    rows = read_parquet(spark, str(folder), skip_corrupt=True)
    assert rows.count() == 5
    named = rows.select("_metadata.file_path")
    missed = skipped_files(listed_files(spark, str(folder), "*.parquet"), named, "file_path").collect()
    assert [r["source_file"].rsplit("/", 1)[1] for r in missed] == ["bad.parquet"]


def test_gzipped_csv(spark, tmp_path):
    (tmp_path / "c").mkdir()
    path = tmp_path / "c" / "t.csv.gz"
    path.write_bytes(gzip.compress(b"a,b\n1,x\n2,y\n"))
    (tmp_path / "c" / "u.csv").write_text("a,b\n3,z\n")
    assert read_table(spark, str(path)).count() == 2
    assert sorted(r["b"] for r in read_table(spark, str(tmp_path / "c")).collect()) == ["x", "y", "z"]


def test_alternatives_of_clusters_reach_the_experiments(spark):
    x = np.random.default_rng(1).normal(size=(60, 5))
    rows = [(k, *map(float, r), float(r[0] + r[3])) for k, r in enumerate(x)]
    names = ["a", "b", "c", "d", "e"]
    df = spark.createDataFrame(rows, "id long, " + ", ".join(f"{n} double" for n in names) + ", y double")
    clusters = {"a": {"alternative_descriptors": ["b", "c"]}, "d": {"alternative_descriptors": ["e"]}}
    runs = Experiments(df, "y", ["id"], names, clusters=clusters, folds=2)
    (plain,) = runs.run([4], "mixed", ["Ridge"]).collect()
    assert plain["descriptors"] == ["a", "d"]
    more = runs.run([4], "mixed", ["Ridge"], random_per_cluster=1).collect()[-1]["descriptors"]
    assert len(more) == 4 and more[0] == "a" and more[1] in "bc" and more[2:] == ["d", "e"]
    runs.close()
