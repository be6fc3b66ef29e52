"""Column statistics, quantiles and the variance filter."""

from __future__ import annotations

from pyspark.sql import functions as F

from colsieve.operators import profile as P
from colsieve.plans.catalog.common import FEATURES, features, features_sql, long_sql, query, r6, table

PROBS = P.cdf_probs()
PROBS_SQL = "[" + ", ".join(repr(p) for p in PROBS) + "]"

# Fixed statistics of every feature column, as the profile defines them.
PROFILE_SQL = f"""
WITH li AS ({features_sql()}), long AS ({long_sql(FEATURES, 'li')}),
m AS (SELECT col, count(*) AS n_total, count(value) AS n_valid, avg(value) AS mean,
        stddev_pop(value) AS std, min(value) AS min, max(value) AS max,
        quantile_cont(value, 0.025) AS q_lo, quantile_cont(value, 0.975) AS q_hi
      FROM long GROUP BY col),
p AS (SELECT *, n_total - n_valid AS n_missing, (n_total - n_valid) / n_total AS missing_ratio,
        std * std AS variance, greatest(max - min, 1e-6) AS range,
        greatest(q_hi - q_lo, 1e-6) AS trimmed_range FROM m),
s AS (SELECT *, variance / (range * range) AS norm_variance,
        variance / (trimmed_range * trimmed_range) AS norm_variance_robust FROM p)
"""


def _profile(spark, folder):
    return P.profile(features(spark, folder), FEATURES)


@query(PROFILE_SQL + """
SELECT col, n_total, n_valid, n_missing, round(missing_ratio, 6) AS missing_ratio,
  round(mean, 4) AS mean, round(std, 4) AS std, round(min, 4) AS min, round(max, 4) AS max,
  round(range, 4) AS range, round(trimmed_range, 4) AS trimmed_range,
  round(norm_variance, 6) AS norm_variance, round(norm_variance_robust, 6) AS norm_variance_robust
FROM s
""")
def column_profile(spark, folder):
    p = _profile(spark, folder)
    r4 = lambda c: F.round(c, 4).alias(c)
    return p.select(
        "col", "n_total", "n_valid", "n_missing", r6("missing_ratio").alias("missing_ratio"),
        *[r4(c) for c in ("mean", "std", "min", "max", "range", "trimmed_range")],
        r6("norm_variance").alias("norm_variance"),
        r6("norm_variance_robust").alias("norm_variance_robust"),
    )


REASON_SQL = """CASE WHEN norm_variance < 0.002 THEN 'variance' WHEN missing_ratio > 0.5 THEN 'missing'
  WHEN n_valid < 100 THEN 'effective_n' ELSE 'keep' END"""


@query(PROFILE_SQL + f"SELECT col, {REASON_SQL} AS reason FROM s")
def variance_filter(spark, folder):
    return _profile(spark, folder).select("col", P.keep_reason().alias("reason"))


@query(PROFILE_SQL + f"SELECT {REASON_SQL} AS reason, count(*) AS n_columns FROM s GROUP BY 1")
def removal_reasons(spark, folder):
    return _profile(spark, folder).groupBy(P.keep_reason().alias("reason")).agg(
        F.count("*").alias("n_columns")
    )


@query(PROFILE_SQL + f"SELECT col, n_valid, round(mean, 4) AS mean FROM s WHERE {REASON_SQL} = 'keep'")
def stats_subset(spark, folder):
    p = _profile(spark, folder)
    return P.stats_of(p, P.kept(p)).select("col", "n_valid", F.round("mean", 4).alias("mean"))


CDF_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
@query(f"""
SELECT col, round(greatest(quantile_cont(value, 0.975) - quantile_cont(value, 0.025), 1e-6), 4) AS trimmed_range
FROM ({long_sql(CDF_COLUMNS, 'lineitem')}) GROUP BY col
""")
def trimmed_range(spark, folder):
    q = P.quantiles(table(spark, folder, "lineitem"), CDF_COLUMNS, [0.025, 0.975])
    spread = F.greatest(F.col("q")[1] - F.col("q")[0], F.lit(P.RANGE_EPS))
    return q.select("col", F.round(spread, 4).alias("trimmed_range"))


CDF_SQL = f"""
WITH long AS ({long_sql(CDF_COLUMNS, 'lineitem')}),
q AS (SELECT col, quantile_cont(value, {PROBS_SQL}) AS cdf FROM long GROUP BY col)
SELECT col, CAST(i AS BIGINT) AS idx, round(v, 6) AS value FROM (
  SELECT col, unnest(range({P.CDF_POINTS})) AS i, unnest(cdf) AS v FROM q)
"""


def _cdf_rows(tables):
    return tables.select("col", F.posexplode("cdf").alias("idx", "value")).select(
        "col", F.col("idx").cast("long").alias("idx"), r6("value").alias("value")
    )


@query(CDF_SQL)
def cdf_table(spark, folder):
    return _cdf_rows(P.cdf_tables(table(spark, folder, "lineitem"), CDF_COLUMNS))


@query("""
WITH b AS (SELECT quantile_cont(o_totalprice, 0.1) AS lo, quantile_cont(o_totalprice, 0.9) AS hi FROM orders)
SELECT o_orderkey, round(greatest(least(o_totalprice, hi), lo), 4) AS o_totalprice FROM orders, b
""")
def clip_to_bounds(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    low, high = P.quantiles(orders, ["o_totalprice"], [0.1, 0.9]).first()["q"]
    clipped = P.clip_to_bounds(orders, {"o_totalprice": (low, high)})
    return clipped.select("o_orderkey", F.round("o_totalprice", 4).alias("o_totalprice"))
