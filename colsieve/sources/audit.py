"""Files that a read passed over: they are listed, and compared with those that gave rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

XML_FILES = "*.{xml,xml.gz}"


def listed_files(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    """Files below a path on any store: ``(source_file, length)``; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select(F.col("_metadata.file_path").alias("source_file"), "length")


def holds_files(spark: SparkSession, path: str, pattern: str) -> bool:
    return not listed_files(spark, path, pattern).isEmpty()


def _name(c: Column) -> Column:
    return F.regexp_replace(c, "^file:/+", "file:/")  # local names come with one or three slashes


def skipped_files(files: DataFrame, rows: DataFrame, source: str = "source_file") -> DataFrame:
    """Listed files without any row: ``(source_file, length, reason)``.

    A broken file and one without a record look the same to a reader that goes on after errors, so
    the reason is ``nothing read`` for both. Spark lists no files of zero bytes, so these don't
    appear. Rows without a file name take no part.
    """
    seen = rows.select(_name(F.col(f"`{source}`")).alias("name")).filter("name <> ''").distinct()
    missed = files.withColumn("name", _name(F.col("source_file"))).join(seen, "name", "left_anti")
    return missed.select("source_file", "length", F.lit("nothing read").alias("reason"))
