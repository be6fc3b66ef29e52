"""From a wide table to few columns: sample, profile, cluster, eliminate, detect, trace."""

from __future__ import annotations

import hashlib
import json
import logging
from dataclasses import asdict

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colsieve import sinks
from colsieve.config import Config
from colsieve.operators import graph, lineage, similarity, vif
from colsieve.operators.gram import STATE_BYTES
from colsieve.operators.profile import keep_reason, profile
from colsieve.operators.sampling import sample_per_group
from colsieve.sources.tables import as_features, feature_columns, identity, read_parquet, with_row_address

log = logging.getLogger(__name__)

LINKS = "removed string, survivor string, step int"


def pair_matrix(pairs: DataFrame, wanted: list[int]) -> np.ndarray:
    """Similarities among some columns as a matrix; its size follows the schema."""
    p = len(wanted)
    if 8 * p * p > STATE_BYTES:
        raise ValueError(f"{p} columns are too many for elimination on one machine")
    at = pairs.sparkSession.createDataFrame([(c, k) for k, c in enumerate(wanted)], "c int, k int")
    rows = at.select(F.col("c").alias("i"), F.col("k").alias("ki"))
    cols = at.select(F.col("c").alias("j"), F.col("k").alias("kj"))
    found = pairs.join(F.broadcast(rows), "i").join(F.broadcast(cols), "j")
    table = found.select("ki", "kj", "s").toPandas()
    out = np.eye(p)
    out[table["ki"], table["kj"]] = table["s"]
    return out


class Reduction:
    """One run over one table; every pass leaves a table that a later run can take up.

    Saved results are found by a key made of path, length and modification time of every input
    file and all settings up to that pass, so neither a changed threshold nor a rewritten input
    meets an old result.
    """

    def __init__(self, spark: SparkSession, config: Config, table: DataFrame | None = None):
        self.spark, self.config = spark, config
        self.out = config.io.output_dir.rstrip("/")
        self.table = table if table is not None else read_parquet(spark, config.io.parquet_glob)
        given = config.io.descriptor_columns
        self.columns = list(given) if given else feature_columns(self.table, config.io.n_metadata)
        self._key = ""

    # -- saved results ----------------------------------------------------------------------

    def _advance(self, *settings) -> None:
        text = json.dumps([self._key, *settings], default=str)
        self._key = hashlib.md5(text.encode()).hexdigest()[:12]

    def _path(self, name: str) -> str:
        return f"{self.out}/{name}-{self._key}"

    def _saved(self, name: str, make) -> DataFrame:
        reuse = self.config.system.checkpoint and not self.config.filtering.force_recompute
        return sinks.saved(self.spark, self._path(name), make, reuse)

    # -- passes -----------------------------------------------------------------------------

    def sample(self) -> DataFrame:
        """Pass 0: a fixed number of rows per source file, metadata columns kept."""
        k = self.config.filtering.sample_per_file
        self._advance(identity(self.table), self.columns, k, self.config.system.random_seed)
        if k is None:
            return self.table

        def make():
            addressed = with_row_address(self.table)
            picked = sample_per_group(
                addressed, "source_path", ["source_path", "row_index"], k,
                self.config.system.random_seed,
            )
            return picked.drop("source_path", "row_index")

        return self._saved("pass0_sample", make)

    def statistics(self) -> DataFrame:
        """Pass 1: profile with CDF tables and the reason each column stays or goes."""
        f = self.config.filtering
        rows = self.sample()
        self.features = as_features(rows, self.columns)
        self.n_rows = rows.count()
        self._advance(
            self.n_rows, f.trim_lower, f.trim_upper, f.cdf_points, f.quantile_strategy,
            f.variance_threshold, f.max_missing_ratio, f.min_effective_n,
        )

        def make():
            measured = profile(
                self.features, self.columns, (f.trim_lower, f.trim_upper), f.quantile_strategy,
                self.n_rows, f.cdf_points,
            )
            reason = keep_reason(f.variance_threshold, f.max_missing_ratio, f.min_effective_n)
            return measured.withColumn("reason", reason)

        self.profile = self._saved("pass1_profile", make)
        kept = self.profile.filter("reason = 'keep'").orderBy("pos").select("col").collect()
        self.columns_p1 = [r["col"] for r in kept]  # one name per column
        if not self.columns_p1:
            counts = {r["reason"]: r["count"] for r in self.profile.groupBy("reason").count().collect()}
            raise ValueError(
                f"no column passed the filter over {self.n_rows} rows: {counts}; "
                f"min_effective_n is {f.min_effective_n}"
            )
        return self.profile

    def correlation_clusters(self) -> DataFrame:
        """Pass 2: one representative per component of highly correlated columns."""
        f = self.config.filtering
        self._advance(f.spearman_threshold)
        columns = self.columns_p1
        self.position = self.spark.createDataFrame(
            [(i, c) for i, c in enumerate(columns)], "pos int, col string"
        )
        self.knots = similarity.collect_cdfs(
            self.profile.join(F.broadcast(self.position.select("col")), "col", "left_semi"), columns
        )
        self.pairs = self._saved(
            "pass2_similarity",
            lambda: similarity.normal_scores_correlation(self.features, columns, self.knots),
        )

        def make():
            nodes = self.position.select(F.col("pos").alias("i"))
            labels = graph.components(nodes, graph.threshold_edges(self.pairs, f.spearman_threshold))
            # Scores relate to the largest variance among the columns that passed.
            passed = self.position.join(self.profile.drop("pos"), "col")
            elected = graph.elect_by_quality(passed, labels)
            heads = self.position.select(
                F.col("pos").alias("representative"), F.col("col").alias("survivor")
            )
            return elected.join(heads, "representative")

        self.clusters2 = self._saved("pass2_clusters", make)
        kept = self.clusters2.filter("is_representative").orderBy("pos").collect()
        self.columns_p2 = [r["col"] for r in kept]
        self.links2 = self.clusters2.filter("NOT is_representative").select(
            F.col("col").alias("removed"), "survivor", F.lit(2).alias("step")
        )
        return self.clusters2

    def eliminate(self) -> list[vif.Removal]:
        """Pass 3: variance inflation, from complete rows or from the correlations."""
        f = self.config.filtering
        self._advance(f.vif_threshold)
        columns = self.columns_p2
        index = {c: i for i, c in enumerate(self.columns_p1)}
        path = self._path("pass3_vif")
        reuse = self.config.system.checkpoint and not f.force_recompute
        found = sinks.read_document(self.spark, path) if reuse else None
        if found is None:
            corr = pair_matrix(self.pairs, [index[c] for c in columns])
            members: dict[str, list[str]] = {}
            for r in self.links2.collect():  # one row per removed column
                members.setdefault(r["survivor"], []).append(r["removed"])
            if vif.use_direct(self.n_rows, len(columns)):
                stats = {r["col"]: r for r in self.profile.drop("cdf").collect()}
                rows = vif.CompleteRows(
                    self.features, columns, {c: stats[c]["n_missing"] for c in columns},
                    np.array([stats[c]["mean"] for c in columns]),
                    np.array([stats[c]["std"] + 1e-10 for c in columns]),
                )
                kept, removed = vif.eliminate_directly(rows, corr, f.vif_threshold, members)
            else:
                kept, removed = vif.eliminate_by_correlation(corr, columns, f.vif_threshold, members)
            found = {"kept": kept, "removed": [asdict(r) for r in removed]}
            sinks.write_document(self.spark, found, path)
        self.removals = [vif.Removal(**r) for r in found["removed"]]
        self.columns_p3 = found["kept"]
        links = [(r.column, r.survivor, 3) for r in self.removals]
        self.links3 = self.spark.createDataFrame(links, LINKS)
        return self.removals

    def dependence_clusters(self) -> DataFrame:
        """Pass 4: one representative per component of columns with dependent sine features."""
        f, seed = self.config.filtering, self.config.system.random_seed
        self._advance(
            f.nonlinear_threshold, f.r, f.hsic_D, f.rdc_d, f.rdc_seeds, f.w_hsic, f.w_rdc, seed
        )
        columns = self.columns_p3
        index = {c: i for i, c in enumerate(self.columns_p1)}
        knots = self.knots[[index[c] for c in columns]]
        p = len(columns)
        position = self.spark.createDataFrame(
            [(i, c) for i, c in enumerate(columns)], "pos int, col string"
        )

        def similarities():
            if f.w_hsic > 0 and f.w_rdc > 0:
                return similarity.both_dependences(
                    self.features, columns, knots, seed, f.r, f.hsic_D, f.rdc_d, f.rdc_seeds
                )
            # A part without weight needs no scan.
            nothing = similarity.pairs_of(self.spark, np.eye(p))
            if f.w_hsic > 0:
                return similarity.hsic_like(
                    self.features, columns, knots, seed, f.hsic_D, f.r
                ), nothing
            return nothing, similarity.rdc_like(
                self.features, columns, knots, seed, f.rdc_d, f.r, f.rdc_seeds
            )

        fused = self._saved(
            "pass4_similarity", lambda: similarity.fuse(*similarities(), f.w_hsic, f.w_rdc)
        )

        def make():
            nodes = position.select(F.col("pos").alias("i"))
            labels = graph.components(nodes, graph.threshold_edges(fused, f.nonlinear_threshold))
            elected = graph.elect_by_similarity(fused, labels)
            heads = position.select(
                F.col("pos").alias("representative"), F.col("col").alias("survivor")
            )
            return elected.join(heads, "representative").join(position, "pos")

        self.clusters4 = self._saved("pass4_clusters", make)
        kept = self.clusters4.filter("is_representative").orderBy("pos").collect()
        self.columns_final = [r["col"] for r in kept]
        self.links4 = self.clusters4.filter("NOT is_representative").select(
            F.col("col").alias("removed"), "survivor", F.lit(4).alias("step")
        )
        return self.clusters4

    def trace(self) -> DataFrame:
        """What each final column stands for, as a table and as one document."""
        kept = self.spark.createDataFrame([(c,) for c in self.columns_final], "col string")
        links = self.links2.unionByName(self.links3).unionByName(self.links4)
        clusters = self._saved("lineage", lambda: lineage.final_clusters(kept, links))
        lost = self._saved("lineage_ownerless", lambda: lineage.ownerless(kept, links))
        self.document = lineage.to_document(clusters, lost)
        sinks.write_document(self.spark, self.document, f"{self.out}/final_cluster_info")
        sinks.write_names(self.spark, self.columns_final, f"{self.out}/final_descriptors")
        return clusters

    def run(self) -> dict:
        self.statistics()
        self.correlation_clusters()
        self.eliminate()
        self.dependence_clusters()
        self.lineage = self.trace()
        sizes = [len(c) for c in (self.columns, self.columns_p1, self.columns_p2,
                                  self.columns_p3, self.columns_final)]
        log.info("columns after each pass: %s", sizes)
        return {
            "initial_count": sizes[0], "final_count": sizes[-1],
            "final_columns": self.columns_final,
            **{f"pass{k}_removed": sizes[k - 1] - sizes[k] for k in range(1, 5)},
            "final_cluster_info": self.document,
        }
