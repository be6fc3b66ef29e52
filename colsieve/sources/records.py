"""XML compound records as rows of named string properties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colsieve.functions.text import RECORD_COLUMNS, PROPERTY_ALIASES, norm_label, norm_text, property_key

# Element names of the public compound XML format.
ROW_TAG = "PC-Compound"
VALUE_TAGS = ["PC-InfoData_value_sval", "PC-InfoData_value_fval", "PC-InfoData_value_ival",
              "PC-InfoData_value_binary"]
CORRUPT = "_corrupt_record"


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


_TEXT = T.StringType()
_INFO = T.StructType(
    [
        T.StructField(
            "PC-InfoData_urn",
            T.StructType(
                [T.StructField("PC-Urn", _struct(**{"PC-Urn_label": _TEXT, "PC-Urn_name": _TEXT}))]
            ),
        ),
        T.StructField("PC-InfoData_value", _struct(**{t: _TEXT for t in VALUE_TAGS})),
    ]
)
_ID = _struct(**{"PC-CompoundType": _struct(**{
    "PC-CompoundType_id": _struct(**{"PC-CompoundType_id_cid": _TEXT})})})
RECORD_SCHEMA = T.StructType(
    [
        T.StructField("PC-Compound_id", _ID),
        T.StructField("PC-Compound_props", _struct(**{"PC-InfoData": T.ArrayType(_INFO)})),
        T.StructField(CORRUPT, _TEXT),
    ]
)


def read_xml(spark: SparkSession, path: str | list[str], recursive: bool = False) -> DataFrame:
    """Parsed records of plain or gzipped files; a broken record keeps only its raw text, a broken
    file gives what was read before the fault (``sources.audit`` lists files that gave nothing)."""
    reader = (
        spark.read.format("xml").option("rowTag", ROW_TAG).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT).option("ignoreNamespace", "true")
        .option("ignoreCorruptFiles", "true").schema(RECORD_SCHEMA)
    )
    if recursive:
        reader = reader.option("recursiveFileLookup", "true").option(
            "pathGlobFilter", "*.{xml,xml.gz}"
        )
    paths = path if isinstance(path, str) else ",".join(path)
    return with_properties(reader.load(paths).withColumn("source_file", F.input_file_name()))


def parse_xml(df: DataFrame, text: str) -> DataFrame:
    """The same records from a column of XML strings."""
    options = {"rowTag": ROW_TAG, "ignoreNamespace": "true", "columnNameOfCorruptRecord": CORRUPT}
    # inline keeps later filters above the parser, so each text is parsed once.
    record = F.array(F.from_xml(F.col(text), _ddl(RECORD_SCHEMA), options))
    others = [c for c in df.columns if c != text]
    return with_properties(df.select(*others, F.inline(record)))


def _ddl(kind: T.DataType) -> str:
    """DDL text with quoted names."""
    if isinstance(kind, T.StructType):
        return "STRUCT<" + ", ".join(f"`{f.name}`: {_ddl(f.dataType)}" for f in kind) + ">"
    if isinstance(kind, T.ArrayType):
        return f"ARRAY<{_ddl(kind.elementType)}>"
    return kind.simpleString().upper()


def _filled(c: Column) -> Column:
    """Trimmed text; NULL where there is none."""
    return F.nullif(F.trim(c), F.lit(""))


def _value(info: Column) -> Column:
    return F.coalesce(*[_filled(info["PC-InfoData_value"][t]) for t in VALUE_TAGS])


def with_properties(raw: DataFrame) -> DataFrame:
    """Add cid and props: distinct ``(key, nkey, value)`` in document order, last value wins."""
    infos = F.col("`PC-Compound_props`.`PC-InfoData`")

    def entry(info):
        urn = info["PC-InfoData_urn"]["PC-Urn"]
        return F.struct(
            property_key(F.trim(urn["PC-Urn_label"]), F.trim(urn["PC-Urn_name"])).alias("key"),
            _value(info).alias("value"),
        )

    labelled = F.filter(
        F.coalesce(infos, F.array()),
        lambda i: _filled(i["PC-InfoData_urn"]["PC-Urn"]["PC-Urn_label"]).isNotNull(),
    )
    cid = F.col("`PC-Compound_id`.`PC-CompoundType`.`PC-CompoundType_id`.`PC-CompoundType_id_cid`")
    wide = raw.select(
        "*", _filled(cid).alias("cid"), F.transform(labelled, entry).alias("_all")
    )
    keys = F.array_distinct(F.transform("_all", lambda e: e["key"]))
    last = F.transform(
        keys,
        lambda k: F.struct(
            k.alias("key"), norm_label(k).alias("nkey"),
            F.element_at(F.filter("_all", lambda e: e["key"] == k), -1)["value"].alias("value"),
        ),
    )
    hidden = ("_all", "PC-Compound_id", "PC-Compound_props")
    kept = [F.col(c) for c in wide.columns if c not in hidden]
    return wide.select(F.inline(F.array(F.struct(*kept, last.alias("props")))))


def _first_value(props: Column, test) -> Column:
    return F.try_element_at(F.filter(props, test), F.lit(1))["value"]


def resolve_column(name: str, props: Column | None = None) -> Column:
    """Exact key, else an equal or alias spelling, else the same base label; '' if none."""
    props = F.col("props") if props is None else props
    spellings = list(dict.fromkeys(norm_text(s) for s in [name, *PROPERTY_ALIASES.get(name, [])]))
    tries = [
        _first_value(props, lambda e: e["key"] == name),
        _first_value(
            props, lambda e: e["nkey"].isin(spellings) & (F.coalesce(e["value"], F.lit("")) != "")
        ),
    ]
    if "::" in name:
        base = name.split("::")[0]
        tries.append(_first_value(props, lambda e: e["key"].startswith(base)))
    return F.coalesce(*tries, F.lit(""))


def as_rows(records: DataFrame, columns: list[str] = RECORD_COLUMNS) -> DataFrame:
    """One string column per requested property; CID is the record id."""
    values = [
        (F.col("cid") if c == "CID" else resolve_column(c)).alias(c) for c in columns
    ]
    return accepted(records, columns).select(*values)


def reject_reason(columns: list[str] = RECORD_COLUMNS) -> Column:
    """Why a record yields no row; NULL if it does."""
    reason = F.when(F.col(CORRUPT).isNotNull(), "parse error").when(
        F.col("cid").isNull(), "No CID found"
    )
    if "CID" not in columns:
        filled = [resolve_column(c) != "" for c in columns]
        anything = filled[0]
        for f in filled[1:]:
            anything = anything | f
        reason = reason.when(~anything, "No data extracted for any column")
    return reason


def accepted(records: DataFrame, columns: list[str] = RECORD_COLUMNS) -> DataFrame:
    return records.filter(reject_reason(columns).isNull())


def rejected(records: DataFrame, columns: list[str] = RECORD_COLUMNS) -> DataFrame:
    """Error log: id, reason and whether the record could be read again."""
    return records.withColumn("error", reject_reason(columns)).filter("error IS NOT NULL").select(
        *[c for c in records.columns if c not in ("props", CORRUPT, "cid")],
        F.when(F.col("error") == "parse error", "FATAL")
        .otherwise(F.coalesce("cid", F.lit("UNKNOWN"))).alias("cid"),
        "error", F.lit(False).alias("recoverable"),
    )


def count_elements(text: Column, tag: str) -> Column:
    """Occurrences of an opening tag in a text."""
    return F.regexp_count(text, F.lit(f"<{tag}>"))
