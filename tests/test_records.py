import gzip
import time

import pytest
from pyspark.sql import functions as F

from colsieve.functions.hashing import sketch_bucket, sketch_parameters, sketch_sign
from colsieve.operators import quality, structures
from colsieve.operators.featurize import SMILES_FEATURES, apply_guarded, describe
from colsieve.operators.properties import filter_by_range, matching_value, range_counts
from colsieve.sources.records import as_rows, read_xml, rejected
from colsieve.streaming.ingest import ingest_new_files

NAMESPACE = 'xmlns="http://www.ncbi.nlm.nih.gov"'


def info(label, name, tag, value):
    named = f"<PC-Urn_name>{name}</PC-Urn_name>" if name else ""
    return (f"<PC-InfoData><PC-InfoData_urn><PC-Urn><PC-Urn_label>{label}</PC-Urn_label>{named}</PC-Urn>"
            f"</PC-InfoData_urn><PC-InfoData_value><PC-InfoData_value_{tag}>{value}</PC-InfoData_value_{tag}>"
            f"</PC-InfoData_value></PC-InfoData>")


def record(cid, *infos):
    ident = (f"<PC-Compound_id><PC-CompoundType><PC-CompoundType_id><PC-CompoundType_id_cid>{cid}"
             "</PC-CompoundType_id_cid></PC-CompoundType_id></PC-CompoundType></PC-Compound_id>") if cid else ""
    return f"<PC-Compound>{ident}<PC-Compound_props>{''.join(infos)}</PC-Compound_props></PC-Compound>"


@pytest.fixture(scope="module")
def xml_folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("xml")
    good = [
        record(1, info("Count", "Hydrogen Bond Donor", "ival", 2), info("SMILES", "Absolute", "sval", "CCO"),
               info("Molecular Formula", "", "sval", "old"), info("Molecular Formula", "", "sval", "C2H6O")),
        record(2, info("Count", "Hydrogen Bond Donor", "sval", "many"), info("Mass", "Exact", "fval", 46.04)),
        record(None, info("SMILES", "Absolute", "sval", "C")),
        record(4, info("Log P", "XLogP9", "fval", 1.5), info("Count", "Hydrogen Bond Donor", "ival", 7)),
    ]
    (folder / "a.xml").write_text(f"<PC-Compounds {NAMESPACE}>{''.join(good)}</PC-Compounds>")
    with gzip.open(folder / "b.xml.gz", "wt") as out:
        out.write(f"<PC-Compounds {NAMESPACE}>{record(5, info('SMILES', 'Absolute', 'sval', 'N'))}</PC-Compounds>")
    cut = record(6, info("SMILES", "Absolute", "sval", "O")) + record(7, info("SMILES", "Absolute", "sval", "P"))[:-40]
    (folder / "c.xml").write_text(f"<PC-Compounds {NAMESPACE}>{cut}")
    return str(folder)


def test_records_from_plain_gzipped_and_truncated_files(spark, xml_folder):
    records = read_xml(spark, xml_folder, recursive=True)
    rows = {r["CID"]: r for r in as_rows(records).collect()}
    assert set(rows) == {"1", "2", "4", "5", "6"}
    assert rows["1"]["Molecular Formula"] == "C2H6O"  # the last of two
    assert rows["1"]["H-Bond Donor Count"] == "2"  # through an alias
    assert rows["4"]["Log P::XLogP3"] == "1.5"  # same base label
    assert rows["2"]["Mass::Exact"] == "46.04" and rows["2"]["Charge"] == ""
    errors = {(r["cid"], r["error"]) for r in rejected(records).collect()}
    assert ("UNKNOWN", "No CID found") in errors
    assert all(not r["recoverable"] for r in rejected(records).collect())


def test_property_filter_and_counts(spark, xml_folder):
    records = read_xml(spark, xml_folder, recursive=True).filter("cid IS NOT NULL")
    value = matching_value(F.col("props"), "H-Bond Donor Count", ["Count::Hydrogen Bond Donor"])
    assert [r["cid"] for r in filter_by_range(records, value, 1, 5).collect()] == ["1"]
    counts = range_counts(records, value, 1, 5).first()
    assert (counts["checked"], counts["passed"], counts["filtered"], counts["missing"]) == (5, 1, 1, 3)


def test_describe_and_counts_from_text(spark):
    df = spark.createDataFrame(
        [("1", "CC(=O)Cl", None), ("2", None, "1S/CH4/h1H4"), ("3", " ", ""), ("4", "[Na+].C#N", "")],
        "CID string, smi string, inc string",
    )
    rows = {r["CID"]: r for r in describe(df, "smi", "inc", "CID", SMILES_FEATURES).collect()}
    assert rows["1"]["HeavyAtomCount"] == 4 and rows["1"]["HalogenCount"] == 1
    assert rows["1"]["standardization_status"] == "success"
    assert rows["2"]["standardized_smiles"] == "InChI=1S/CH4/h1H4"
    assert rows["2"]["standardization_status"] == "success_via_inchi"
    assert rows["3"]["standardization_status"] == "failed(parsing)" and rows["3"]["HeavyAtomCount"] is None
    assert rows["4"]["FragmentCount"] == 2 and rows["4"]["TripleBondCount"] == 1 and rows["4"]["NitrogenCount"] == 1


def test_guarded_calls_time_out_and_fail_alone(spark):
    def make():
        def one(text):
            if text == "slow":
                time.sleep(30)
            if text == "bad":
                raise RuntimeError("no")
            return {"n": float(len(text)), "odd": float("inf")}

        return one

    df = spark.createDataFrame([("fine",), ("slow",), ("bad",), ("also",)], "t string").coalesce(1)
    started = time.time()
    rows = {r["t"]: r for r in apply_guarded(df, "t", ["n", "odd"], make, 0.5).collect()}
    assert time.time() - started < 25
    assert rows["slow"]["descriptor_status"] == "failed(skip)" and rows["slow"]["n"] is None
    assert rows["bad"]["descriptor_status"] == "failed(descriptor)"
    assert rows["fine"]["n"] == 4 and rows["fine"]["odd"] is None and rows["also"]["n"] == 4


def test_structure_resolution_statuses(spark):
    Toolkit = structures.Toolkit

    def fake_toolkit():
        def read(text):
            if "?" in text:
                raise ValueError(text)
            return text

        def shaky(s):
            if "~" in s:
                raise ValueError(s)
            return s.upper()

        def check(s):
            if "!" in s:
                raise ValueError(s)
            return s

        return Toolkit(read, read, str, check, [("Cleanup", shaky)])

    df = spark.createDataFrame(
        [("a", None), ("a~", None), ("?", "x"), ("a!", "y"), ("a!", "y~"), ("a!", None), (None, None)],
        "smi string, inc string",
    )
    rows = structures.with_structures(df, "smi", "inc", fake_toolkit).collect()
    found = [(r["standardized_smiles"], r["parse_source"], r["standardization_status"]) for r in rows]
    assert found == [
        ("A", "smiles", "success"),
        ("a~", "smiles", "partial_success(Cleanup)"),
        ("INCHI=X", "inchi_fallback", "success_via_inchi"),
        ("INCHI=Y", "inchi_fallback_after_std", "success_via_inchi"),
        ("InChI=y~", "inchi_fallback_after_std", "partial_success_via_inchi(Cleanup)"),
        (None, "smiles", "failed(FinalSanitize)"),
        (None, "none", "failed(parsing)"),
    ]


def test_error_examples_are_limited_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).cast("string").alias("k"), "id")
    out = quality.error_summary(df, "k", "id")
    assert {r["k"]: list(r["examples"]) for r in out.collect()} == {"0": [0, 2, 4], "1": [1, 3, 5]}
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_sketch_hash_of_large_ids(spark):
    ids = [0, 1, 2**60, 2**61 - 1, 2**62, -1]
    df = spark.createDataFrame([(i,) for i in ids], "x long")
    size, (a1, b1, c1, a2, b2, c2) = sketch_parameters(8192, 42)
    assert size == 8192
    for r in df.select("x", sketch_bucket(F.col("x"), 8192, 42).alias("b"), sketch_sign(F.col("x"), 8192, 42).alias("s")).collect():
        x = r["x"] % 2**64
        assert r["b"] == ((a1 * (x ^ b1) + c1) % 2**64 & (2**61 - 1)) % 8192
        assert r["s"] == (1.0 if ((a2 * (x ^ b2) + c2) % 2**64) % 2 == 0 else -1.0)
    assert sketch_parameters(1000, 1)[0] == 1024 and sketch_parameters(64, 1)[0] == 64


def test_stream_reads_each_file_once(spark, tmp_path):
    source, target, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    spark.createDataFrame([("1", "CC"), ("2", "N")], "CID string, smi string").coalesce(1).write.parquet(source)
    schema = spark.read.parquet(source).schema
    step = lambda df: describe(df, "smi", None, "CID", SMILES_FEATURES)

    def drain():
        query = ingest_new_files(spark, source, "parquet", schema, step, target, check)
        query.awaitTermination()
        return spark.read.parquet(target).count()

    assert drain() == 2
    assert drain() == 2
    spark.createDataFrame([("3", "O")], "CID string, smi string").coalesce(1).write.mode("append").parquet(source)
    assert drain() == 3
