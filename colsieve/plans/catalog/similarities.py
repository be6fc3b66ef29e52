"""Normal scores, correlation matrices, VIF and random-feature dependence."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from colsieve.functions.hashing import projections
from colsieve.functions.normal import PROB_EPS, phi_inv_sql
from colsieve.operators import profile as P
from colsieve.operators import similarity as S
from colsieve.operators import vif as V
from colsieve.operators.gram import collect_blocks, correlation_of, cross_products
from colsieve.plans.catalog.common import (
    USABLE, features, features_sql, name_pairs, query, r6, table,
)
from colsieve.plans.catalog.profiles import PROBS_SQL
from colsieve.plans.reduction import pair_matrix
from colsieve.session import cut_lineage
from colsieve.sources.tables import explode_vector

POINTS = P.CDF_POINTS


def scores_sql(wide: str, names: list[str], keep: str = "") -> str:
    """CTEs ending in ``scores(id, col, z)``: normal scores of every cell, gaps at 0."""
    kept = f"{keep}, " if keep else ""
    cells = " UNION ALL ".join(
        f"SELECT id, {kept}{i} AS pos, CAST({n} AS DOUBLE) AS value FROM wide" for i, n in enumerate(names)
    )
    return f"""
wide AS MATERIALIZED (SELECT *, row_number() OVER () AS id FROM ({wide})),
cells AS MATERIALIZED ({cells}),
tables AS (SELECT pos, quantile_cont(value, {PROBS_SQL}) AS cdf FROM cells GROUP BY pos),
knots AS (SELECT pos, unnest(cdf) AS v, unnest(range({POINTS})) AS idx FROM tables),
steps AS (SELECT pos, v, max(idx) AS idx FROM knots GROUP BY pos, v),
spans AS (SELECT pos, v, idx, lead(v) OVER (PARTITION BY pos ORDER BY v) AS nv FROM steps),
placed AS (SELECT c.id, {kept.replace(keep, 'c.' + keep) if keep else ''}c.pos,
  greatest(least(CASE WHEN s.nv IS NULL THEN 1.0::DOUBLE
    ELSE s.idx / {POINTS - 1}.0::DOUBLE + (1.0::DOUBLE / {POINTS - 1}) / (s.nv - s.v) * (c.value - s.v) END,
    1e0 - {PROB_EPS!r}), {PROB_EPS!r}) AS u
  FROM (SELECT * FROM cells WHERE value IS NOT NULL) c ASOF JOIN spans s ON c.pos = s.pos AND c.value >= s.v),
scores AS MATERIALIZED (
  SELECT id, {kept}pos, {phi_inv_sql('u')} AS z FROM placed
  UNION ALL SELECT id, {kept}pos, 0e0 FROM cells WHERE value IS NULL)
"""


def pairs_sql(names: list[str], having: str = "") -> str:
    name = lambda p: "CASE " + " ".join(
        f"WHEN {p} = {i} THEN '{n}'" for i, n in enumerate(names)) + " END"
    return f"""
SELECT {name('a.pos')} AS a, {name('b.pos')} AS b, round(corr(a.z, b.z), 6) AS s
FROM scores a JOIN scores b ON a.id = b.id AND a.pos < b.pos GROUP BY a.pos, b.pos {having}
"""


def _knots(df, names):
    return S.collect_cdfs(P.cdf_tables(df, names, POINTS), names)


@query("WITH " + scores_sql("SELECT o_orderkey, o_totalprice FROM orders", ["o_totalprice"], "o_orderkey") + """
SELECT o_orderkey, round(z, 6) AS z FROM scores
""")
def copula_scores(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_totalprice").alias("z"))
    return S.with_normal_scores(orders, ["z"], _knots(orders, ["z"])).select("o_orderkey", r6("z").alias("z"))


@query("WITH " + scores_sql(features_sql(USABLE), USABLE) + pairs_sql(USABLE))
def normal_scores_corr(spark, folder):
    li = features(spark, folder, USABLE)
    return name_pairs(S.normal_scores_correlation(li, USABLE, _knots(li, USABLE)), USABLE)


def _pearson_sql(names: list[str], source: str, digits: int = 6) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), {digits}) AS s FROM {source}"
        for i, a in enumerate(names) for b in names[i + 1 :]
    )


@query(f"WITH li AS ({features_sql(USABLE)}) " + _pearson_sql(USABLE, "li"))
def corr_matrix(spark, folder):
    return name_pairs(S.pearson_pairwise(features(spark, folder, USABLE), USABLE), USABLE)


RANKED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("""
WITH r AS (SELECT """ + ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in RANKED
) + " FROM lineitem) " + _pearson_sql(RANKED, "r"))
def rank_corr(spark, folder):
    return name_pairs(S.rank_correlation(table(spark, folder, "lineitem"), RANKED), RANKED)


DIMS = [f"d{i:02d}" for i in range(64)]


@query("""
WITH e AS (SELECT vec_id, unnest(range(64)) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings)
SELECT CAST(a.i AS INTEGER) AS i, CAST(b.i AS INTEGER) AS j, round(corr(a.v, b.v), 6) AS s
FROM e a JOIN e b ON a.vec_id = b.vec_id AND a.i < b.i GROUP BY a.i, b.i
""")
def corr_embeddings(spark, folder):
    wide = explode_vector(table(spark, folder, "embeddings").select("embedding"), "embedding", 64)
    total = cross_products(wide, DIMS)
    return S.correlation_pairs(total).filter("i < j").select("i", "j", r6("s").alias("s"))


@query("""
WITH e AS (SELECT vec_id, unnest(range(64)) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings),
c AS (SELECT a.i, b.i AS j, CASE WHEN a.i = b.i THEN 1 ELSE corr(a.v, b.v) END AS s
      FROM e a JOIN e b ON a.vec_id = b.vec_id GROUP BY a.i, b.i)
SELECT CAST(i AS INTEGER) AS i, round(avg(s), 6) AS centrality FROM c GROUP BY i
""")
def similarity_centrality(spark, folder):
    wide = explode_vector(table(spark, folder, "embeddings").select("embedding"), "embedding", 64)
    pairs = S.correlation_pairs(cross_products(wide, DIMS))
    return S.centrality(pairs).select("i", r6("centrality").alias("centrality"))


# -- variance inflation -----------------------------------------------------------------------

_RIDGE = V.RIDGE


@query(f"""
WITH c AS (SELECT corr(f1, f7) AS r17, corr(f2, f5) AS r25 FROM ({features_sql(USABLE)}))
SELECT pair, round(1 / (1 - least(greatest(r * r / (1 + {_RIDGE}), 0), 0.9999)), 3) AS vif FROM (
  SELECT 'f1,f7' AS pair, r17 AS r FROM c UNION ALL SELECT 'f2,f5', r25 FROM c)
""")
def vif_pair(spark, folder):
    names = ["f1", "f7", "f2", "f5"]
    total = collect_blocks(cross_products(*_standardised(features(spark, folder, names), names)), 1, 5)[0]
    corr = correlation_of(total)
    rows = []
    for i in (0, 2):
        vif = V.vif_from_correlation(corr[i : i + 2, i : i + 2])
        rows.append((f"{names[i]},{names[i + 1]}", round(float(vif[0]), 3)))
    return spark.createDataFrame(rows, "pair string, vif double")


def _standardised(df, names):
    stats = {r["col"]: r for r in P.moments(df, names).collect()}
    return (df, names, np.array([stats[c]["mean"] for c in names]),
            np.array([stats[c]["std"] + 1e-10 for c in names]))


@query(f"""
WITH c AS (SELECT corr(f2, f5) AS a, corr(f2, f3) AS b, corr(f5, f3) AS d FROM ({features_sql(USABLE)})),
q AS (SELECT 1 + 2*a*b*d - a*a - b*b - d*d AS det, a, b, d FROM c)
SELECT 'f2' AS col, round((1 - d*d) / det, 3) AS vif FROM q UNION ALL
SELECT 'f5', round((1 - b*b) / det, 3) FROM q UNION ALL
SELECT 'f3', round((1 - a*a) / det, 3) FROM q
""")
def vif_triple(spark, folder):
    names = ["f2", "f5", "f3"]
    total = collect_blocks(cross_products(*_standardised(features(spark, folder, names), names)), 1, 4)[0]
    vif = V.direct_vif(correlation_of(total))
    return spark.createDataFrame([(n, round(float(v), 3)) for n, v in zip(names, vif)], "col string, vif double")


@query(f"""
WITH c AS (SELECT corr(f2, f5) AS a, corr(f2, f3) AS b, corr(f5, f3) AS d FROM ({features_sql(USABLE)}))
SELECT 'f5' AS col, round(0.7 * abs((a - b*d) / sqrt((1 - b*b) * (1 - d*d))) + 0.3 * abs(a), 5) AS score FROM c
UNION ALL
SELECT 'f3', round(0.7 * abs((b - a*d) / sqrt((1 - a*a) * (1 - d*d))) + 0.3 * abs(b), 5) FROM c
""")
def neighbour_scores(spark, folder):
    """How strongly f5 and f3 are tied to f2, by partial and marginal correlation."""
    names = ["f2", "f5", "f3"]
    total = collect_blocks(cross_products(*_standardised(features(spark, folder, names), names)), 1, 4)[0]
    corr = correlation_of(total)
    score = V.neighbour_score(corr, np.linalg.inv(corr), 0)
    rows = [(n, round(float(s), 5)) for n, s in zip(names[1:], score[1:])]
    return spark.createDataFrame(rows, "col string, score double")


REMOVALS = "col string, vif double, removed_order int, survivor string"


def _removal_rows(spark, removed):
    return spark.createDataFrame(
        [(r.column, round(r.vif, 3), r.order, r.survivor) for r in removed], REMOVALS
    )


@query()
def vif_eliminate_correlation(spark, folder):
    li = features(spark, folder, USABLE)
    pairs = cut_lineage(S.normal_scores_correlation(li, USABLE, _knots(li, USABLE)))
    _, removed = V.eliminate_by_correlation(pair_matrix(pairs, list(range(8))), USABLE)
    return _removal_rows(spark, removed)


@query()
def vif_eliminate_direct(spark, folder):
    li = features(spark, folder, USABLE)
    pairs = cut_lineage(S.normal_scores_correlation(li, USABLE, _knots(li, USABLE)))
    stats = {r["col"]: r for r in P.moments(li, USABLE).collect()}
    rows = V.CompleteRows(
        li, USABLE, {c: stats[c]["n_total"] - stats[c]["n_valid"] for c in USABLE},
        np.array([stats[c]["mean"] for c in USABLE]),
        np.array([stats[c]["std"] + 1e-10 for c in USABLE]),
    )
    _, removed = V.eliminate_directly(rows, pair_matrix(pairs, list(range(8))))
    return _removal_rows(spark, removed)


@query("WITH " + scores_sql(features_sql(USABLE), USABLE) + ", pairs AS (" + pairs_sql(USABLE) + """),
both_ways AS (SELECT a, b, s FROM pairs UNION ALL SELECT b, a, s FROM pairs)
SELECT a AS col, arg_max(b, abs(s)) AS survivor, max(abs(s)) AS strength
FROM both_ways GROUP BY a HAVING max(abs(s)) >= 0.7
""")
def best_survivor(spark, folder):
    li = features(spark, folder, USABLE)
    pairs = S.normal_scores_correlation(li, USABLE, _knots(li, USABLE))
    corr = np.round(pair_matrix(pairs, list(range(8))), 6)
    rows = []
    for i, name in enumerate(USABLE):
        heir, strength = V.best_survivor(corr, i, [j for j in range(8) if j != i])
        if heir is not None:
            rows.append((name, USABLE[heir], strength))
    return spark.createDataFrame(rows, "col string, survivor string, strength double")


# -- random-feature dependence ----------------------------------------------------------------

PART = ["p_size", "p_retailprice", "area", "bend"]
PART_EXPR = {
    "p_size": "p_size", "p_retailprice": "p_retailprice", "area": "p_size * p_retailprice",
    "bend": "(p_size - 25) * (p_size - 25)",
}
PART_SQL = "SELECT " + ", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in PART_EXPR.items()) + " FROM part"


def _part(spark, folder):
    return table(spark, folder, "part").select(
        *[F.expr(e).cast("double").alias(n) for n, e in PART_EXPR.items()]
    )


def _weights_sql(weights: np.ndarray) -> str:
    rows = ", ".join(
        f"({b}, {i}, {l}, {weights[b, i, l]:.17e}::DOUBLE)"
        for b in range(weights.shape[0]) for i in range(weights.shape[1]) for l in range(weights.shape[2])
    )
    return f"(VALUES {rows}) AS w(block, pos, l, w)"


def _dependence_ctes(weights: np.ndarray) -> str:
    features_per_block = weights.shape[2]
    return "WITH " + scores_sql(PART_SQL, PART) + f""",
waves AS MATERIALIZED (SELECT id, s.pos, block, l, sin(z * w.w) AS y FROM scores s JOIN {_weights_sql(weights)} ON s.pos = w.pos),
scale AS MATERIALIZED (SELECT pos, block, l, avg(y) AS m, stddev_samp(y) AS sd FROM waves GROUP BY 1, 2, 3),
unit AS MATERIALIZED (SELECT id, w.pos, w.block, w.l, (y - m) / CASE WHEN sd < 1e-10 THEN 1 ELSE sd END AS y
  FROM waves w JOIN scale s ON w.pos = s.pos AND w.block = s.block AND w.l = s.l),
rows AS (SELECT count(DISTINCT id) AS n FROM unit),
blocks AS (SELECT a.block, a.pos AS i, b.pos AS j,
  greatest(least(sum(a.y * b.y) / (any_value(n) * {features_per_block}), 1), -1) AS s
  FROM unit a JOIN unit b ON a.id = b.id AND a.block = b.block AND a.l = b.l, rows GROUP BY 1, 2, 3)
"""


W_FIXED = projections(1, "hsic", 1, len(PART), 5)
W_HSIC = projections(42, "hsic", 4, len(PART), 6)
W_RDC = projections(42, "rdc", 8, len(PART), 4)  # 4 repetitions of 2 draws


@query(_dependence_ctes(W_FIXED) + "SELECT i, j, round(s, 6) AS s FROM blocks WHERE i < j")
def dependence_fixed_weights(spark, folder):
    part = _part(spark, folder)
    pairs = S.sine_dependence(part, PART, _knots(part, PART), W_FIXED)
    return pairs.filter("i < j").select("i", "j", r6("s").alias("s"))


_HSIC_SQL = "SELECT i, j, CASE WHEN i = j THEN 1 ELSE quantile_disc(s, 0.5) END AS s FROM {blocks} GROUP BY i, j"


@query(_dependence_ctes(W_HSIC) + "SELECT i, j, round(s, 6) AS s FROM (" + _HSIC_SQL.format(blocks="blocks") + ") WHERE i < j")
def hsic_like(spark, folder):
    part = _part(spark, folder)
    pairs = S.hsic_like(part, PART, _knots(part, PART), 42, 6, 4)
    return pairs.filter("i < j").select("i", "j", r6("s").alias("s"))


_RDC_RUNS = "(SELECT block // 2 AS block, i, j, avg(s) AS s FROM blocks GROUP BY 1, 2, 3)"


@query(_dependence_ctes(W_RDC) + "SELECT i, j, round(s, 6) AS s FROM (" + _HSIC_SQL.format(blocks=_RDC_RUNS) + ") WHERE i < j")
def rdc_like(spark, folder):
    part = _part(spark, folder)
    pairs = S.rdc_like(part, PART, _knots(part, PART), 42, 4, 4, 2)
    return pairs.filter("i < j").select("i", "j", r6("s").alias("s"))


# The two queries above are as small as their SQL; these run the operators' own sizes.

@query()
def hsic_like_defaults(spark, folder):
    part = _part(spark, folder)
    pairs = S.hsic_like(part, PART, _knots(part, PART))
    return pairs.filter("i < j").select("i", "j", r6("s").alias("s"))


@query()
def rdc_like_defaults(spark, folder):
    part = _part(spark, folder)
    pairs = S.rdc_like(part, PART, _knots(part, PART))
    return pairs.filter("i < j").select("i", "j", r6("s").alias("s"))


@query("""
SELECT p_partkey // 8 AS k, quantile_disc(p_retailprice * (p_partkey % 3), 0.5) AS mid FROM part GROUP BY 1
""")
def lower_median(spark, folder):
    blocks = table(spark, folder, "part").select(
        F.expr("p_partkey div 8").alias("i"), F.lit(-1).alias("j"),
        (F.col("p_retailprice") * (F.col("p_partkey") % 3)).alias("s"),
    )
    return S.lower_median(blocks).select(F.col("i").alias("k"), F.col("s").alias("mid"))


@query(f"WITH li AS ({features_sql(USABLE)}), h AS (" + _pearson_sql(USABLE, "li", 12) + "), r AS (" + _pearson_sql(
    USABLE, "(SELECT " + ", ".join(f"sqrt(abs({c})) AS {c}" for c in USABLE) + " FROM li)", 12) + """)
SELECT h.a, h.b, round(greatest(least(0.75 * h.s + 0.25 * r.s, 1), -1), 6) AS s
FROM h JOIN r ON h.a = r.a AND h.b = r.b
""")
def fuse_similarity(spark, folder):
    li = features(spark, folder, USABLE)
    rooted = li.select(*[F.sqrt(F.abs(c)).alias(c) for c in USABLE])
    fused = S.fuse(S.pearson_pairwise(li, USABLE), S.pearson_pairwise(rooted, USABLE), 3.0, 1.0)
    return name_pairs(fused, USABLE)
