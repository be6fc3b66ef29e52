"""Command line: run, filter, preprocess, process-all, train, lineage."""

from __future__ import annotations

import argparse
import json
import logging

from pyspark.sql import functions as F

from colsieve import __version__, config as settings, sinks
from colsieve.models.evaluate import best_per_model, residual_histogram, score_matrix, top_importances
from colsieve.models.grid import MODELS, SIZES, Experiments
from colsieve.models.prepare import MODES, load_clusters
from colsieve.operators.featurize import declared_schema
from colsieve.operators.lineage import rebuild_from_steps
from colsieve.plans import ingest
from colsieve.plans.reduction import Reduction
from colsieve.session import build_session
from colsieve.sources.tables import ML_METADATA, discover_schema, feature_columns, read_table, save_master_schema

FILTER_FLAGS = {
    "sample_per_file": int, "variance_threshold": float, "max_missing_ratio": float,
    "min_effective_n": int, "trim_lower": float, "trim_upper": float,
    "spearman_threshold": float, "vif_threshold": float, "nonlinear_threshold": float,
    "quantile_strategy": str,
}


def _common(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--config", help="settings file (JSON or YAML)")
    parser.add_argument("--output-dir", required=True)
    parser.add_argument("--random-seed", type=int)
    parser.add_argument("--no-checkpoint", action="store_true")
    parser.add_argument("--verbose", action="store_true")
    for name, kind in FILTER_FLAGS.items():
        parser.add_argument(f"--{name.replace('_', '-')}", type=kind)


def _settings(args, **extra):
    values = {f"filtering__{n}": getattr(args, n) for n in FILTER_FLAGS if getattr(args, n, None) is not None}
    if args.random_seed is not None:
        values["system__random_seed"] = args.random_seed
    if args.no_checkpoint:
        values["system__checkpoint"] = False
    return settings.load(args.config, io__output_dir=args.output_dir, **values, **extra)


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="colsieve", description=__doc__)
    parser.add_argument("--version", action="version", version=__version__)
    commands = parser.add_subparsers(dest="command", required=True)

    run = commands.add_parser("run", help="all passes over a Parquet table")
    run.add_argument("--parquet-glob", required=True)
    run.add_argument("--n-metadata", type=int)
    _common(run)

    filt = commands.add_parser("filter", help="up to one pass")
    filt.add_argument("stage", choices=["pass0", "pass1", "pass234", "all"])
    filt.add_argument("--parquet-glob", required=True)
    filt.add_argument("--n-metadata", type=int)
    _common(filt)

    pre = commands.add_parser("preprocess", help="records, schema or descriptors alone")
    steps = pre.add_subparsers(dest="step", required=True)
    xml = steps.add_parser("xml")
    xml.add_argument("--input", required=True)
    xml.add_argument("--output", required=True)
    xml.add_argument("--filter-property")
    xml.add_argument("--filter-min", type=float)
    xml.add_argument("--filter-max", type=float)
    schema = steps.add_parser("schema")
    schema.add_argument("--input", nargs="*", default=[], help="sample tables; none: declared names")
    schema.add_argument("--output", required=True)
    calc = steps.add_parser("calc")
    calc.add_argument("--input", required=True)
    calc.add_argument("--output", required=True)
    calc.add_argument("--schema")
    calc.add_argument("--timeout", type=float, default=30.0)

    whole = commands.add_parser("process-all", help="raw records to reduced columns")
    whole.add_argument("--input", required=True)
    whole.add_argument("--smiles-col", default="SMILES::Absolute")
    whole.add_argument("--id-col", default="CID")
    whole.add_argument("--schema")
    whole.add_argument("--mol-timeout", type=float, default=30.0)
    whole.add_argument("--filter-property")
    whole.add_argument("--filter-min", type=float)
    whole.add_argument("--filter-max", type=float)
    _common(whole)

    train = commands.add_parser("train", help="models over descriptor counts")
    train.add_argument("--input", required=True)
    train.add_argument("--test-input")
    train.add_argument("--cluster-info")
    train.add_argument("--target-col", default="pLeach")
    train.add_argument("--key", nargs="+", required=True, help="columns that identify a row")
    train.add_argument("--output-dir", default="ml_output")
    train.add_argument("--descriptor-sizes", default=",".join(map(str, SIZES)))
    train.add_argument("--descriptor-mode", choices=MODES, default="sequential")
    train.add_argument("--random-per-cluster", type=int, default=0, help="alternatives drawn per cluster in mode mixed")
    train.add_argument("--models")
    train.add_argument("--test-size", type=float, default=0.2)
    train.add_argument("--cv-folds", type=int, default=5)
    train.add_argument("--random-seed", type=int, default=42)
    train.add_argument("--regularization", action="store_true")
    train.add_argument("--no-plots", action="store_true", help="skip the plot data")
    train.add_argument("--verbose", action="store_true")

    lineage = commands.add_parser("lineage", help="rebuild lineage from saved passes")
    lineage.add_argument("--pass2", required=True, help="table (representative, removed)")
    lineage.add_argument("--pass3", required=True, help="table (removed, correlated array)")
    lineage.add_argument("--survivors", required=True, help="table (col)")
    lineage.add_argument("--output", required=True)
    return parser


def _reduce(spark, args, stage: str) -> dict:
    extra = {"io__parquet_glob": args.parquet_glob}
    if args.n_metadata is not None:
        extra["io__n_metadata"] = args.n_metadata
    run = Reduction(spark, _settings(args, **extra))
    if stage == "pass0":
        return {"rows": run.sample().count()}
    if stage == "pass1":
        run.statistics()
        return {"kept": run.columns_p1}
    return run.run()


def _train(spark, args) -> dict:
    table = read_table(spark, args.input)
    test = read_table(spark, args.test_input) if args.test_input else None
    descriptors = feature_columns(table, exclude=[*ML_METADATA, args.target_col, *args.key])
    runs = Experiments(
        table, args.target_col, args.key, descriptors, test,
        load_clusters(args.cluster_info) if args.cluster_info else None, args.test_size,
        args.cv_folds, args.random_seed, args.regularization,
    )
    try:
        sizes = [int(s) for s in args.descriptor_sizes.split(",")]
        models = args.models.split(",") if args.models else MODELS
        results = runs.run(sizes, args.descriptor_mode, models, args.random_per_cluster)
        runs.save(args.output_dir)
        if not args.no_plots and runs.results:
            save_plot_data(runs, results, args.output_dir)
    finally:
        runs.close()
    return {"experiments": len(runs.results), "output": args.output_dir}


def save_plot_data(runs: Experiments, results, folder: str) -> None:
    """The tables behind the charts: scores, sizes, importances, residuals, predictions."""
    sizes = sorted({r["n_descriptors"] for r in runs.results})
    sinks.write_table(best_per_model(results), f"{folder}/plot_model_scores", "csv")
    sinks.write_table(score_matrix(results, sizes), f"{folder}/plot_score_matrix", "csv")
    scored = [r for r in runs.results if r.get("error") is None and r["holdout_r2"] is not None]
    if not scored:
        return
    top = max(scored, key=lambda r: r["holdout_r2"])
    chosen = results.filter(
        (F.col("model_name") == top["model_name"]) & (F.col("n_descriptors") == top["n_descriptors"])
    )
    sinks.write_table(top_importances(chosen), f"{folder}/plot_importances", "csv")
    held = runs.predictions(top["model_name"], top["descriptors"]).withColumnRenamed(runs.target, "y")
    sinks.write_table(held.orderBy("y"), f"{folder}/plot_predictions", "csv")
    sinks.write_table(residual_histogram(held), f"{folder}/plot_residuals", "csv")


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO if getattr(args, "verbose", False) else logging.WARNING)
    spark = build_session()
    if args.command == "run":
        out = _reduce(spark, args, "all")
    elif args.command == "filter":
        out = _reduce(spark, args, args.stage)
    elif args.command == "preprocess" and args.step == "xml":
        rows = ingest.read_records(
            spark, args.input, f"{args.output}_errors", args.filter_property, args.filter_min, args.filter_max
        )
        sinks.write_records_csv(rows, args.output)
        out = {"output": args.output}
    elif args.command == "preprocess" and args.step == "schema":
        tables = [read_table(spark, p) for p in args.input]
        names = discover_schema(tables) if tables else declared_schema()
        save_master_schema(names, args.output)
        out = {"columns": len(names)}
    elif args.command == "preprocess":
        conf = settings.load(descriptor__per_record_timeout_sec=args.timeout)
        sinks.write_table(ingest.descriptors(ingest.read_records(spark, args.input), conf, args.schema), args.output)
        out = {"output": args.output}
    elif args.command == "process-all":
        conf = _settings(
            args, preprocessing__smiles_col=args.smiles_col, preprocessing__primary_id_col=args.id_col,
            descriptor__per_record_timeout_sec=args.mol_timeout,
        )
        out = ingest.process_all(
            spark, args.input, conf, args.schema, filter_property=args.filter_property,
            low=args.filter_min, high=args.filter_max,
        )
    elif args.command == "train":
        out = _train(spark, args)
    else:
        owned = rebuild_from_steps(*[spark.read.parquet(p) for p in (args.pass2, args.pass3, args.survivors)])
        sinks.write_table(owned, args.output)
        out = {"output": args.output}
    print(json.dumps({k: v for k, v in out.items() if k != "final_cluster_info"}))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
