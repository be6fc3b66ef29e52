import datetime

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
#: Columns with the names that operators use themselves.
EXTRA = [T.StructField(n, T.DateType()) for n in (
    "score", "row", "size", "label", "rep", "component_id", "held_out", "kept", "place", "block", "kept_id", "key", "line")]


def words(start: int, count: int) -> str:
    return " ".join(f"word{k}x{k * 7919 % 97}" for k in range(start, start + count))


def awkward_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    base = words(0, 60)
    rows = [
        (1, base, "en", "a", 10), (2, base, "en", "a", 10), (3, base + " tail", None, None, None),
        (4, None, "fr", "a", None), (5, "", "fr", "b", 0), (6, " \n\t ", None, "b", 3), (7, "one two", "en", "b", 7),
        (8, "One TWO", "en", None, 7), (9, words(500, 30_000), "en", "a", 1), (None, base, "en", "a", 10),
        (None, "lost id", None, None, None), (10, words(900, 40), "de", "c", 1), (10, words(900, 40), "de", "c", 1),
        (11, "###### ||| $$$", "en", "c", 1), (12, "123 456 789", "en", "c", 1), (13, "éè \U0001f600 中文", "fr", "c", 1),
    ]
    return rows + [(20 + k, words(1000 + 50 * k, 45), ("en", "de")[k % 2], "abc"[k % 3], 1) for k in range(20)]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), DOCS)


@pytest.fixture(scope="session")
def clashing(spark):
    """The same rows with extra columns whose names clash with those used inside."""
    day = datetime.date(2024, 1, 1)
    return spark.createDataFrame([(*r, *[day] * len(EXTRA)) for r in awkward_rows()], T.StructType([*DOCS.fields, *EXTRA]))


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(k, k % 2, (k // 2) % 2) for k in range(1, 40)] + [(5, 1, 1), (5, 0, 0), (None, 1, 1), (6, None, None), (999, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def plain(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
