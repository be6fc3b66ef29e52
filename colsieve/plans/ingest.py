"""From raw records to a descriptor table, and on to the reduced columns."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colsieve import sinks
from colsieve.config import Config
from colsieve.operators.featurize import (
    SMILES_FEATURES, apply_guarded, choose, describe, toolkit_available, toolkit_descriptors,
    toolkit_names, with_features,
)
from colsieve.operators.properties import filter_by_range, matching_value, range_counts
from colsieve.operators.quality import combine_summaries, error_summary, outcome_metrics
from colsieve.operators.structures import rdkit_toolkit, with_structures
from colsieve.functions.text import PROPERTY_ALIASES
from colsieve.plans.reduction import Reduction
from colsieve.session import cut_lineage
from colsieve.sources.audit import XML_FILES, holds_files, listed_files, skipped_files
from colsieve.sources.records import as_rows, read_xml, rejected
from colsieve.sources.tables import (
    METADATA, TABLE_FILES, enforce_schema, files_identity, is_glob, load_master_schema, master_schema, read_table,
)


def read_records(
    spark: SparkSession, path: str, errors: str | None = None, filter_property: str | None = None,
    low: float | None = None, high: float | None = None,
) -> DataFrame:
    """Record rows from XML, CSV or Parquet.

    XML rejects go to ``errors``, their number by kind to ``errors``_summary, files that gave no
    record to ``errors``_files, and what the filter let pass to ``errors``_filter. A broken file
    doesn't stop the others.
    """
    names = path.lower()
    one_file = names.endswith((".xml", ".xml.gz"))
    folder_of_xml = not (one_file or names.endswith(TABLE_FILES) or is_glob(path)) and holds_files(spark, path, XML_FILES)
    if not (one_file or folder_of_xml):
        return read_table(spark, path)
    records = read_xml(spark, path, recursive=folder_of_xml)
    if errors:
        records = cut_lineage(records)  # parsed once, used twice
        missed = skipped_files(listed_files(spark, path, XML_FILES if folder_of_xml else None), records)
        sinks.write_table(missed, f"{errors}_files", "tsv")
        bad = rejected(records)
        sinks.write_table(bad, errors, "csv")
        counted = error_summary(bad, "error", "cid")
        sinks.write_table(counted.withColumn("examples", F.array_join("examples", ", ")), f"{errors}_summary", "tsv")
    if filter_property:
        value = matching_value(F.col("props"), filter_property, PROPERTY_ALIASES.get(filter_property))
        if errors:
            sinks.write_table(range_counts(records, value, low, high), f"{errors}_filter", "tsv")
        records = filter_by_range(records, value, low, high)
    return as_rows(records)


def descriptors(records: DataFrame, config: Config, schema: str | None = None) -> DataFrame:
    """Descriptor rows in the order of the master schema.

    With the structure toolkit installed its descriptors are computed under a time limit per
    record; otherwise counts read from the text stand in.
    """
    p, d = config.preprocessing, config.descriptor
    registry = choose(SMILES_FEATURES, list(d.descriptor_include), list(d.descriptor_exclude))
    inchi = p.inchi_col if p.inchi_col in records.columns else None
    if toolkit_available():
        options = {"core": p.std_core, "normalizer": p.use_normalizer, "reionizer": p.use_reionizer,
                   "metals": p.use_metal_disconnector, "largest_fragment": p.keep_largest_fragment}
        base = records.select(
            F.col(f"`{p.primary_id_col}`").cast("string").alias("CID"),
            F.col(f"`{p.smiles_col}`").alias("isomeric_smiles"),
            (F.col(f"`{inchi}`") if inchi else F.lit(None).cast("string")).alias("_inchi"),
        )
        parsed = with_structures(base, "isomeric_smiles", "_inchi", partial(rdkit_toolkit, **options))
        table = with_features(parsed.drop("_inchi"), "standardized_smiles", registry)
        taken = {c.lower() for c in table.columns}
        names = [n for n in toolkit_names() if n.lower() not in taken]
        table = apply_guarded(
            table, "standardized_smiles", names, toolkit_descriptors, d.per_record_timeout_sec
        )
        failed = F.col("descriptor_status").startswith("failed(")
        table = table.withColumn(
            "standardization_status",
            F.when(failed, F.col("descriptor_status")).otherwise(F.col("standardization_status")),
        ).drop("descriptor_status")
    else:
        table = describe(records, p.smiles_col, inchi, p.primary_id_col, registry)
    master = load_master_schema(schema) if schema else master_schema(
        [c for c in table.columns if c not in METADATA]
    )
    return enforce_schema(table, master)


def process_all(
    spark: SparkSession, path: str, config: Config, schema: str | None = None, **filters
) -> dict:
    """Records, descriptors, quality counters and the reduction in one go."""
    out = config.io.output_dir.rstrip("/")
    records = read_records(spark, path, f"{out}/record_errors", **filters)
    settings = [files_identity(spark, path), asdict(config.preprocessing), asdict(config.descriptor), filters,
                load_master_schema(schema) if schema else None]
    key = hashlib.md5(json.dumps(settings, default=str, sort_keys=True).encode()).hexdigest()[:12]
    table = sinks.saved(spark, f"{out}/descriptors-{key}", lambda: descriptors(records, config, schema),
                        reuse=config.system.checkpoint)
    metrics = outcome_metrics(table, ["source_file"], F.col("standardization_status"))
    sinks.write_table(metrics, f"{out}/metrics", "tsv")
    totals = combine_summaries(metrics, ["n_total", "n_success", "n_failed", "n_timeout"])
    sinks.write_table(totals, f"{out}/batch_summary", "tsv")
    late = table.filter("standardization_status = 'failed(skip)'").select("CID", "source_file")
    sinks.write_table(late, f"{out}/timeouts", "tsv")
    sized = replace(config, io=replace(config.io, n_metadata=len(METADATA)))
    return Reduction(spark, sized, table).run()
