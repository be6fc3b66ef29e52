"""Splits, scaling, linear fits, metrics, rankings, and the end-to-end runs."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import functions as F

from colsieve.config import load
from colsieve.models import evaluate as E
from colsieve.models import linear
from colsieve.models.grid import SIZES, Experiments
from colsieve.models.prepare import by_cluster_size, fill_statistics, scale, with_blocks, with_folds, with_split
from colsieve.plans.catalog.common import FEATURES, USABLE, features, features_sql, query, r6, table
from colsieve.plans.catalog.graphs import LINKS_SQL, _sizes
from colsieve.plans.catalog.similarities import DIMS
from colsieve.plans.reduction import Reduction
from colsieve.session import ensure_checkpoint_dir
from colsieve.sources.tables import explode_vector


def _ranked_sql(source: str, key: str, seed: int, extra: str = "") -> str:
    return (
        f"SELECT {key}{extra}, row_number() OVER (ORDER BY md5(concat_ws('|', {key}, '{seed}')), {key}) AS rk, "
        f"count(*) OVER () AS n FROM {source}"
    )


@query(f"SELECT o_orderkey, rk <= ceil(n * 0.2) AS is_test FROM ({_ranked_sql('orders', 'o_orderkey', 42)})")
def split_assign(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey")
    return with_split(orders, ["o_orderkey"]).select("o_orderkey", "is_test")


@query(f"SELECT doc_id, CAST((rk - 1) * 5 // n AS INTEGER) AS fold FROM ({_ranked_sql('documents', 'doc_id', 7)})")
def kfold_assign(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id")
    return with_folds(docs, ["doc_id"], 5, 7).select("doc_id", "fold")


BLOCK_SQL = """CASE WHEN rk <= ceil(n * 0.2) THEN 5
  ELSE (rk - ceil(n * 0.2)::BIGINT - 1) * 5 // (n - ceil(n * 0.2)::BIGINT) END"""


@query(f"""
SELECT CAST({BLOCK_SQL} AS INTEGER) AS block, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids
FROM ({_ranked_sql('events', 'event_id', 42)}) GROUP BY 1
""")
def block_assign(spark, folder):
    events = table(spark, folder, "events").select("event_id")
    return with_blocks(events, ["event_id"]).groupBy("block").agg(
        F.count("*").alias("n"), F.sum("event_id").alias("ids")
    )


@query("""
WITH g AS (SELECT event_id, CASE WHEN event_type <> 'view' THEN value END AS v,
             event_id % 5 <> 0 AS train FROM events),
m AS (SELECT avg(v) FILTER (train) AS m FROM g),
f AS (SELECT event_id, train, coalesce(v, m) AS v, m FROM g, m),
s AS (SELECT stddev_pop(v) FILTER (train) AS sd FROM f)
SELECT event_id, round((v - m) / sd, 6) AS v FROM f, s
""")
def impute_scale(spark, folder):
    """Gaps filled with the training mean, then standardised by the training rows."""
    events = table(spark, folder, "events").select(
        "event_id", F.when(F.col("event_type") != "view", F.col("value")).alias("v")
    )
    statistics = fill_statistics(events, ["v"], F.col("event_id") % 5 != 0)
    return scale(events, ["v"], statistics).select("event_id", r6("v").alias("v"))


PREDICTED_SQL = "SELECT *, l_extendedprice AS y, 2000 * l_quantity + 1000 * l_tax AS p FROM lineitem"


def _predicted(spark, folder):
    return table(spark, folder, "lineitem").withColumns({
        "y": F.col("l_extendedprice"), "p": 2000 * F.col("l_quantity") + 1000 * F.col("l_tax"),
    })


@query(f"""
SELECT l_returnflag, count(*) AS n, round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2,
  round(sqrt(avg((y - p) * (y - p))), 3) AS rmse, round(avg(abs(y - p)), 3) AS mae
FROM ({PREDICTED_SQL}) GROUP BY 1
""")
def regression_metrics(spark, folder):
    m = E.metrics(_predicted(spark, folder), by=["l_returnflag"])
    return m.select("l_returnflag", "n", r6("r2").alias("r2"), F.round("rmse", 3).alias("rmse"),
                    F.round("mae", 3).alias("mae"))


@query(f"""
WITH t AS ({PREDICTED_SQL}), c AS (SELECT quantile_cont(y, 0.8) AS hi, quantile_cont(y, 0.2) AS lo FROM t)
SELECT round(avg(abs(y - p)) FILTER (y > hi), 3) AS extreme_high_mae, count(*) FILTER (y > hi) AS extreme_high_n,
  round(avg(abs(y - p)) FILTER (y < lo), 3) AS extreme_low_mae, count(*) FILTER (y < lo) AS extreme_low_n
FROM t, c
""")
def tail_mae(spark, folder):
    t = E.tail_metrics(_predicted(spark, folder))
    return t.withColumns({c: F.round(c, 3) for c in ("extreme_high_mae", "extreme_low_mae")})


@query("""
WITH f AS (SELECT p_size % 5 AS fold, p_retailprice AS y, 900 + 20 * p_size AS p FROM part),
s AS (SELECT fold, 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2 FROM f GROUP BY 1)
SELECT round(avg(r2), 6) AS kfold_r2_mean, round(stddev_pop(r2), 6) AS kfold_r2_std FROM s
""")
def cv_summary(spark, folder):
    part = table(spark, folder, "part").select(
        (F.col("p_size") % 5).alias("fold"), F.col("p_retailprice").alias("y"),
        (900 + 20 * F.col("p_size")).alias("p"),
    )
    c = E.cv_summary(E.metrics(part, by=["fold"]))
    return c.select(r6("kfold_r2_mean").alias("kfold_r2_mean"), r6("kfold_r2_std").alias("kfold_r2_std"))


def _fit(spark, folder, model, names, target):
    li = features(spark, folder, [*names, target])
    stats = li.agg(
        *[F.avg(c) for c in names], *[F.stddev_pop(c) for c in names]
    ).first()  # one row
    p = len(names)
    sums = linear.fold_sums(li, names, target, F.lit(0), 1, np.array(stats[:p]), np.array(stats[p:]))[0]
    return linear.fit(model, sums)


RIDGE_SQL = f"""
WITH li AS ({features_sql(['f2', 'f3', 'f6'])}),
z AS (SELECT (f2 - avg(f2) OVER ()) / stddev_pop(f2) OVER () AS a,
             (f3 - avg(f3) OVER ()) / stddev_pop(f3) OVER () AS b, f6 AS y FROM li),
s AS (SELECT sum(a * a) + 1 AS aa, sum(b * b) + 1 AS bb, sum(a * b) AS ab, sum(a * (y - m)) AS ay,
        sum(b * (y - m)) AS by_, any_value(m) AS m FROM z, (SELECT avg(y) AS m FROM z))
SELECT round((bb * ay - ab * by_) / (aa * bb - ab * ab), 2) AS beta_price,
  round((aa * by_ - ab * ay) / (aa * bb - ab * ab), 2) AS beta_discount, round(m, 2) AS intercept FROM s
"""


@query(RIDGE_SQL)
def ridge_two_features(spark, folder):
    beta, b0 = _fit(spark, folder, "Ridge", ["f2", "f3"], "f6")
    row = [tuple(round(float(v), 2) for v in (*beta, b0))]
    return spark.createDataFrame(row, "beta_price double, beta_discount double, intercept double")


@query(f"""
WITH li AS ({features_sql(['f1', 'f7'])}),
z AS (SELECT (f1 - avg(f1) OVER ()) / stddev_pop(f1) OVER () AS a, f7 AS y FROM li),
c AS (SELECT covar_pop(a, y) AS ay, avg(y) AS m FROM z)
SELECT 'Lasso' AS model, round(sign(ay) * greatest(abs(ay) - 0.1, 0), 4) AS beta, round(m, 3) AS intercept FROM c
UNION ALL
SELECT 'ElasticNet', round(sign(ay) * greatest(abs(ay) - 0.05, 0) / 1.05, 4), round(m, 3) FROM c
""")
def sparse_one_feature(spark, folder):
    rows = []
    for model in ("Lasso", "ElasticNet"):
        beta, b0 = _fit(spark, folder, model, ["f1"], "f7")
        rows.append((model, round(float(beta[0]), 4), round(b0, 3)))
    return spark.createDataFrame(rows, "model string, beta double, intercept double")


@query(f"""
WITH r AS ({_ranked_sql('part', 'p_partkey', 42, ', p_size, p_retailprice')}),
b AS (SELECT p_size AS x, p_retailprice AS y, {BLOCK_SQL} AS block FROM r),
t AS (SELECT avg(x) AS m, stddev_pop(x) AS sd FROM b WHERE block < 5),
z AS (SELECT (x - m) / sd AS z, y, block FROM b, t),
folds AS (SELECT unnest(range(5)) AS k),
fit AS (SELECT k, covar_pop(z, y) * count(*) / (var_pop(z) * count(*) + 1) AS beta,
          avg(y) - avg(z) * covar_pop(z, y) * count(*) / (var_pop(z) * count(*) + 1) AS b0
        FROM z, folds WHERE block < 5 AND block <> k GROUP BY k),
sc AS (SELECT k, 1 - sum((y - b0 - beta * z) * (y - b0 - beta * z)) / (var_pop(y) * count(*)) AS r2
       FROM z JOIN fit ON z.block = fit.k GROUP BY k),
whole AS (SELECT covar_pop(z, y) * count(*) / (var_pop(z) * count(*) + 1) AS beta,
          avg(y) - avg(z) * covar_pop(z, y) * count(*) / (var_pop(z) * count(*) + 1) AS b0 FROM z WHERE block < 5),
held AS (SELECT 1 - sum((y - b0 - beta * z) * (y - b0 - beta * z)) / (var_pop(y) * count(*)) AS r2,
          sqrt(avg((y - b0 - beta * z) * (y - b0 - beta * z))) AS rmse, avg(abs(y - b0 - beta * z)) AS mae
         FROM z, whole WHERE block = 5)
SELECT round(avg(sc.r2), 5) AS kfold_r2_mean, round(stddev_pop(sc.r2), 5) AS kfold_r2_std,
  round(any_value(held.r2), 5) AS holdout_r2, round(any_value(held.rmse), 4) AS holdout_rmse,
  round(any_value(held.mae), 4) AS holdout_mae FROM sc, held
""")
def ridge_experiment(spark, folder):
    """Folds, hold-out split, scaling, fit and scores of one model, checked end to end."""
    part = table(spark, folder, "part").select(
        "p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice"
    )
    runs = Experiments(part, "p_retailprice", ["p_partkey"], ["p_size"])
    try:
        out = runs.run([1], models=["Ridge"])
    finally:
        runs.close()
    return out.select(
        *[F.round(c, 5).alias(c) for c in ("kfold_r2_mean", "kfold_r2_std", "holdout_r2")],
        *[F.round(c, 4).alias(c) for c in ("holdout_rmse", "holdout_mae")],
    )


RESULTS_SQL = """
results AS (SELECT l_returnflag AS model_name, l_linenumber AS n_descriptors,
  round(avg(l_quantity), 6) AS holdout_r2, round(stddev_pop(l_tax), 9) AS holdout_rmse FROM lineitem GROUP BY 1, 2)
"""


def _results(spark, folder):
    return table(spark, folder, "lineitem").groupBy(
        F.col("l_returnflag").alias("model_name"), F.col("l_linenumber").alias("n_descriptors")
    ).agg(r6(F.avg("l_quantity")).alias("holdout_r2"), F.round(F.stddev_pop("l_tax"), 9).alias("holdout_rmse"))


@query("WITH " + RESULTS_SQL + """
(SELECT 'r2' AS metric, * FROM results ORDER BY holdout_r2 DESC, model_name, n_descriptors LIMIT 1) UNION ALL
(SELECT 'rmse', * FROM results ORDER BY holdout_rmse, model_name, n_descriptors LIMIT 1)
""")
def best_model(spark, folder):
    results = _results(spark, folder)
    pick = lambda m: E.best(results, f"holdout_{m}").select(F.lit(m).alias("metric"), "*")
    return pick("r2").unionByName(pick("rmse"))


@query("WITH " + RESULTS_SQL + """
SELECT model_name, n_descriptors, holdout_r2 FROM (SELECT *, row_number() OVER (
  PARTITION BY model_name ORDER BY holdout_r2 DESC, n_descriptors) AS r FROM results) WHERE r = 1
""")
def best_per_model(spark, folder):
    return E.best_per_model(_results(spark, folder))


@query("WITH " + RESULTS_SQL + "SELECT model_name, " + ", ".join(
    f'max(holdout_r2) FILTER (n_descriptors = {k}) AS "{k}"' for k in range(1, 8)) + " FROM results GROUP BY 1")
def score_matrix(spark, folder):
    return E.score_matrix(_results(spark, folder), list(range(1, 8)))


@query("""
WITH r AS (SELECT l_quantity - 500 * l_tax AS r FROM lineitem),
e AS (SELECT min(r) AS lo, max(r) AS hi FROM r)
SELECT CAST(least(floor((r - lo) / ((hi - lo) / 15)), 14) AS INTEGER) AS bin, count(*) AS n FROM r, e GROUP BY 1
""")
def residual_histogram(spark, folder):
    li = table(spark, folder, "lineitem").select(
        F.col("l_quantity").alias("y"), (500 * F.col("l_tax")).alias("p")
    )
    return E.residual_histogram(li)


IMPORTANT = [c for c in USABLE if c != "f6"]


@query("WITH li AS (" + features_sql(USABLE) + ") SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS descriptor, round(abs(corr({c}, f6)), 6) AS importance FROM li" for c in IMPORTANT
) + ") ORDER BY importance DESC, descriptor LIMIT 5")
def top_importances(spark, folder):
    li = features(spark, folder, USABLE)
    cells = [x for c in IMPORTANT for x in (F.lit(c), r6(F.abs(F.corr(c, "f6"))))]
    return E.top_importances(li.agg(F.create_map(*cells).alias("feature_importance")), 5)


@query(f"""SELECT o_orderkey, o_totalprice AS y FROM ({_ranked_sql('orders', 'o_orderkey', 42, ', o_totalprice')})
WHERE rk <= ceil(n * 0.2) ORDER BY o_totalprice""")
def ordered_predictions(spark, folder):
    held = with_split(table(spark, folder, "orders"), ["o_orderkey"]).filter("is_test")
    return E.ordered_predictions(held.select("o_orderkey", F.col("o_totalprice").alias("y")))


@query("WITH RECURSIVE " + LINKS_SQL + "SELECT col, cluster_size FROM sizes ORDER BY cluster_size DESC, col")
def descriptors_by_cluster_size(spark, folder):
    return by_cluster_size(_sizes(spark, folder))


# -- whole runs, checked by row only ------------------------------------------------------------

def _embedded(spark, folder):
    wide = table(spark, folder, "embeddings").select("vec_id", "embedding", F.col("label").cast("double").alias("label"))
    return explode_vector(wide, "embedding", 64)


def _experiments(spark, folder, models, sizes=SIZES):
    runs = Experiments(_embedded(spark, folder), "label", ["vec_id"], DIMS)
    try:
        out = runs.run(sizes, models=models)
        runs.check()  # what is shown has no column for errors
    finally:
        runs.close()
    shown = ["kfold_r2_mean", "kfold_r2_std", "train_r2", "holdout_r2", "holdout_rmse", "holdout_mae",
             "overfitting_gap", "extreme_high_mae", "extreme_low_mae"]
    return out.select("model_name", "n_descriptors", *[F.round(c, 4).alias(c) for c in shown])


@query()
def train_linear(spark, folder):
    return _experiments(spark, folder, linear.LINEAR_MODELS, [5, 20, 50])


@query()
def train_trees(spark, folder):
    return _experiments(spark, folder, ["RandomForest"])


@query()
def train_boosted(spark, folder):
    return _experiments(spark, folder, ["XGBoost"])


@query()
def train_gaussian_process(spark, folder):
    return _experiments(spark, folder, ["GPR"])


@query()
def train_fourier_process(spark, folder):
    return _experiments(spark, folder, ["FourierGPR"])


@query()
def reduce_columns(spark, folder):
    """Passes 1 to 4 and the lineage on the planted columns."""
    out = f"{ensure_checkpoint_dir(spark)}/reduction-{uuid.uuid4().hex}"
    config = load(env={}, io__output_dir=out, io__n_metadata=0)
    run = Reduction(spark, config, features(spark, folder, FEATURES))
    run.run()
    return run.lineage.select(
        "col", "cluster_size", F.array_join("alternative_descriptors", ",").alias("alternatives")
    )
