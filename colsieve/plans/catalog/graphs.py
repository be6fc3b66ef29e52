"""Threshold graphs, representatives, nearest neighbours and lineage."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from colsieve.operators import communities as C
from colsieve.operators import graph as G
from colsieve.operators import lineage as L
from colsieve.operators import profile as P
from colsieve.operators import similarity as S
from colsieve.operators.gram import cross_products
from colsieve.plans.catalog.common import (
    USABLE, features, features_sql, long_sql, name_pairs, named, query, r6, table,
)
from colsieve.plans.catalog.similarities import DIMS, _pearson_sql
from colsieve.session import cut_lineage
from colsieve.sources.tables import explode_vector

PEARSON = f"li AS ({features_sql(USABLE)}), pairs AS (" + _pearson_sql(USABLE, "li") + ")"
NODES_SQL = "nodes AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{c}', {i})" for i, c in enumerate(USABLE)) + ") AS t(col, pos))"


def components_sql(threshold: float) -> str:
    return f"""
WITH RECURSIVE {PEARSON}, {NODES_SQL},
edges AS (SELECT a, b FROM pairs WHERE abs(s) >= {threshold} UNION ALL
          SELECT b, a FROM pairs WHERE abs(s) >= {threshold}),
reach AS (SELECT col, col AS other FROM nodes UNION
          SELECT r.col, e.b FROM reach r JOIN edges e ON r.other = e.a),
comp AS (SELECT r.col AS col, min(n.pos) AS component FROM reach r JOIN nodes n ON r.other = n.col
         GROUP BY r.col)
"""


def _pairs(spark, folder):
    return cut_lineage(S.pearson_pairwise(features(spark, folder, USABLE), USABLE))


def _labels(spark, pairs, threshold=0.95):
    nodes = spark.createDataFrame([(i,) for i in range(len(USABLE))], "i int")
    return G.components(nodes, G.threshold_edges(pairs, threshold))


@query(f"WITH {PEARSON} SELECT a, b, s FROM pairs WHERE abs(s) >= 0.95")
def corr_edges(spark, folder):
    return name_pairs(G.threshold_edges(_pairs(spark, folder), 0.95), USABLE)


@query(components_sql(0.95) + "SELECT col, component FROM comp")
def components(spark, folder):
    labels = _labels(spark, _pairs(spark, folder))
    return labels.select(named(USABLE, "i").alias("col"), "component")


QUALITY_SQL = f""",
stats AS (SELECT col, 1 - count(value) / count(*) AS missing, var_pop(value) AS variance
          FROM ({long_sql(USABLE, 'li')}) GROUP BY col),
scored AS (SELECT c.col, n.pos, component, 5 * (1 - missing)
             + 3 * variance / ((SELECT max(variance) FROM stats) + 1e-10) + 0.5 AS quality
           FROM comp c JOIN stats s ON c.col = s.col JOIN nodes n ON n.col = c.col),
ranked AS (SELECT *, row_number() OVER (PARTITION BY component ORDER BY quality DESC, pos) AS r,
             count(*) OVER (PARTITION BY component) AS size FROM scored)
"""


def _elected(spark, folder):
    labels = _labels(spark, _pairs(spark, folder))
    profiled = cut_lineage(P.profile(features(spark, folder, USABLE), USABLE))  # one row per column
    return G.elect_by_quality(profiled, labels)


@query(components_sql(0.95) + QUALITY_SQL + """
SELECT col, component, size, round(quality, 6) AS quality, r = 1 AS is_representative FROM ranked
""")
def representatives(spark, folder):
    return _elected(spark, folder).select(
        "col", "component", "size", r6("quality").alias("quality"), "is_representative"
    )


@query(components_sql(0.95) + QUALITY_SQL + """
SELECT x.col AS removed, h.col AS survivor FROM ranked x JOIN ranked h
  ON x.component = h.component AND h.r = 1 WHERE x.r > 1
""")
def cluster_removed(spark, folder):
    elected = cut_lineage(_elected(spark, folder))
    return elected.filter("NOT is_representative").select(
        F.col("col").alias("removed"), named(USABLE, "representative").alias("survivor")
    )


@query(components_sql(0.7) + f""",
full_pairs AS (SELECT a, b, s FROM pairs UNION ALL SELECT b, a, s FROM pairs
               UNION ALL SELECT col, col, 1 FROM nodes),
scored AS (SELECT p.a AS col, c.component, n.pos, sum(abs(s)) AS total, count(*) AS size
  FROM full_pairs p JOIN comp c ON p.a = c.col JOIN comp d ON p.b = d.col AND c.component = d.component
  JOIN nodes n ON n.col = p.a GROUP BY 1, 2, 3)
SELECT col, component, round(CASE WHEN size > 1 THEN total / (size - 1) ELSE 1 END, 4) AS mean_similarity,
  row_number() OVER (PARTITION BY component ORDER BY total DESC, pos) = 1 AS is_representative
FROM scored
""")
def representatives_by_similarity(spark, folder):
    pairs = _pairs(spark, folder)
    elected = G.elect_by_similarity(pairs, _labels(spark, pairs, 0.7))
    return elected.select(
        named(USABLE, "pos").alias("col"), "component",
        F.round("mean_similarity", 4).alias("mean_similarity"), "is_representative",
    )


@query("""
WITH e AS (SELECT vec_id, unnest(range(64)) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings),
c AS (SELECT a.i, b.i AS j, corr(a.v, b.v) AS s
      FROM e a JOIN e b ON a.vec_id = b.vec_id AND a.i <> b.i GROUP BY a.i, b.i),
top AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY s DESC, j) AS r FROM c)
SELECT CAST(least(i, j) AS INTEGER) AS a, CAST(greatest(i, j) AS INTEGER) AS b, round(min(s), 6) AS weight
FROM top WHERE r <= 5 GROUP BY 1, 2
""")
def knn_graph(spark, folder):
    wide = explode_vector(table(spark, folder, "embeddings").select("embedding"), "embedding", 64)
    pairs = S.correlation_pairs(cross_products(wide, DIMS))
    return G.nearest_neighbours(pairs).select("a", "b", r6("weight").alias("weight"))


@query()
def leiden_knn(spark, folder):
    """Communities of the columns' nearest-neighbour graph; a test holds them to brute force."""
    edges = cut_lineage(knn_graph(spark, folder))
    nodes = spark.range(len(DIMS)).select(F.col("id").alias("node"))
    return C.leiden(nodes, edges, resolution=0.001)


# -- communities, components and lineage over data-sized graphs ----------------------------------------------

@query("""
WITH RECURSIVE e AS (SELECT o_custkey AS c, o_orderkey AS o FROM orders),
edges AS (SELECT DISTINCT c AS a, o % 997 + 1000000 AS b FROM e),
both_ways AS (SELECT a, b FROM edges UNION ALL SELECT b, a FROM edges),
nodes AS (SELECT DISTINCT a AS n FROM both_ways),
reach AS (SELECT n, n AS label FROM nodes UNION
          SELECT b.b, r.label FROM reach r JOIN both_ways b ON r.n = b.a WHERE r.label < b.b)
SELECT n AS node, min(label) AS component FROM reach GROUP BY n
""")
def order_components(spark, folder):
    """Components of a graph that grows with the orders."""
    edges = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("i"), (F.col("o_orderkey") % 997 + 1000000).alias("j")
    ).distinct()
    nodes = edges.select("i").unionByName(edges.select(F.col("j").alias("i"))).distinct()
    return G.components(nodes, edges).select(F.col("i").alias("node"), "component")


@query("""
SELECT o_orderkey AS node, min(o_orderkey) OVER (PARTITION BY o_custkey, year(o_orderdate)) AS community FROM orders
""")
def leiden_orders(spark, folder):
    """Orders linked to the customer's next one, weakly across years: a year's orders are a community."""
    orders = table(spark, folder, "orders")
    order = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    chain = orders.select(
        F.col("o_orderkey").alias("a"), F.lead("o_orderkey").over(order).alias("b"),
        F.when(F.year("o_orderdate") == F.year(F.lead("o_orderdate").over(order)), 1.0).otherwise(1e-6).alias("weight"))
    nodes = orders.select(F.col("o_orderkey").alias("node"))
    return C.leiden(nodes, chain, resolution=1e-5)


# Every order absorbed by another: survivors in three steps, kept ones are multiples of 50.
LINKS_SQL = """
links AS (SELECT o_orderkey AS removed, o_orderkey // 3 AS survivor, 2 + o_orderkey % 3 AS step
          FROM orders WHERE o_orderkey % 50 <> 0),
kept AS (SELECT o_orderkey AS col FROM orders WHERE o_orderkey % 50 = 0),
walk AS (SELECT removed, survivor AS owner FROM links UNION ALL
         SELECT w.removed, l.survivor FROM walk w JOIN links l ON w.owner = l.removed),
owned AS (SELECT w.removed, w.owner FROM walk w WHERE w.owner NOT IN (SELECT removed FROM links)),
sizes AS (SELECT k.col, count(o.removed) + 1 AS cluster_size
          FROM kept k LEFT JOIN owned o ON o.owner = k.col GROUP BY k.col)
"""


def _links(spark, folder):
    orders = table(spark, folder, "orders")
    links = orders.filter("o_orderkey % 50 <> 0").select(
        F.col("o_orderkey").alias("removed"), F.expr("o_orderkey div 3").alias("survivor"),
        (2 + F.col("o_orderkey") % 3).alias("step"),
    )
    kept = orders.filter("o_orderkey % 50 = 0").select(F.col("o_orderkey").alias("col"))
    return links, kept


def _sizes(spark, folder):
    links, kept = _links(spark, folder)
    return L.cluster_sizes(L.resolve(L.merge_steps(links)), kept)


@query("WITH RECURSIVE " + LINKS_SQL + "SELECT removed, owner FROM owned")
def lineage_closure(spark, folder):
    links, _ = _links(spark, folder)
    return L.resolve(L.merge_steps(links))


@query("""
WITH RECURSIVE links AS (
  SELECT o_orderkey AS removed, CASE WHEN o_orderkey % 7 <> 3 THEN o_orderkey // 3 END AS survivor,
    2 + o_orderkey % 3 AS step FROM orders WHERE o_orderkey % 50 <> 0),
walk AS (SELECT removed, survivor AS owner FROM links WHERE survivor IS NOT NULL UNION ALL
         SELECT w.removed, l.survivor FROM walk w JOIN links l ON w.owner = l.removed WHERE l.survivor IS NOT NULL)
SELECT removed, step FROM links WHERE removed NOT IN (
  SELECT w.removed FROM walk w JOIN orders k ON w.owner = k.o_orderkey WHERE k.o_orderkey % 50 = 0)
""")
def ownerless_columns(spark, folder):
    """Every seventh order went without a survivor; it and what it stood for have no owner."""
    links, kept = _links(spark, folder)
    alone = F.when(F.col("removed") % 7 != 3, F.col("survivor"))
    return L.ownerless(kept, links.withColumn("survivor", alone))


@query("WITH RECURSIVE " + LINKS_SQL + "SELECT cluster_size, count(*) AS n_clusters FROM sizes GROUP BY 1")
def size_distribution(spark, folder):
    return L.size_distribution(_sizes(spark, folder))


@query("WITH RECURSIVE " + LINKS_SQL + "SELECT col, cluster_size FROM sizes ORDER BY cluster_size DESC, col LIMIT 20")
def top_clusters(spark, folder):
    return L.largest_clusters(_sizes(spark, folder))


@query("WITH RECURSIVE " + LINKS_SQL + """
SELECT round(avg(cluster_size), 6) AS mean, quantile_cont(cluster_size, 0.5) AS median,
  min(cluster_size) AS min, max(cluster_size) AS max, round(stddev_pop(cluster_size), 6) AS std FROM sizes
""")
def cluster_statistics(spark, folder):
    return L.size_statistics(_sizes(spark, folder)).select(
        r6("mean").alias("mean"), "median", "min", "max", r6("std").alias("std")
    )


@query("WITH RECURSIVE " + LINKS_SQL + """,
flags AS (SELECT owner, bool_or(step = 2) AS p2, bool_or(step = 3) AS p3
          FROM owned JOIN links USING (removed) GROUP BY owner)
SELECT count(*) FILTER (p2 AND NOT p3) AS pass2_only, count(*) FILTER (p3 AND NOT p2) AS pass3_only,
  count(*) FILTER (p2 AND p3) AS both_passes FROM flags
""")
def removal_distribution(spark, folder):
    links, _ = _links(spark, folder)
    return L.removal_distribution(L.resolve(L.merge_steps(links)), links)


@query("""
WITH l AS (SELECT p_partkey, p_brand, p_size % 3 + 2 AS step FROM part),
m AS (SELECT p_brand AS removed, max(step) AS step FROM l GROUP BY 1)
SELECT m.removed, m.step, max(p.p_type) AS survivor
FROM m JOIN part p ON p.p_brand = m.removed AND p.p_size % 3 + 2 = m.step GROUP BY 1, 2
""")
def merged_steps(spark, folder):
    """The last step's survivor wins."""
    links = table(spark, folder, "part").select(
        F.col("p_brand").alias("removed"), F.col("p_type").alias("survivor"),
        (F.col("p_size") % 3 + 2).alias("step"),
    )
    return L.merge_steps(links).select("removed", "step", "survivor")


@query("""
WITH p3 AS (SELECT o_orderkey AS removed, [o_orderkey + 1, o_orderkey + 3, o_orderkey + 5] AS correlated
            FROM orders WHERE o_orderkey % 4 = 0),
alive AS (SELECT o_orderkey AS col FROM orders WHERE o_orderkey % 4 = 1 OR o_orderkey % 4 = 3),
c AS (SELECT removed, unnest(correlated) AS col, unnest(range(3)) AS k FROM p3),
f AS (SELECT removed, arg_min(col, k) AS owner FROM c WHERE col IN (SELECT col FROM alive) GROUP BY 1),
p2 AS (SELECT o_orderkey AS removed, o_orderkey - 2 AS head FROM orders WHERE o_orderkey % 4 = 2)
SELECT owner, removed, 3 AS step FROM f UNION ALL
SELECT f.owner, p2.removed, 2 FROM p2 JOIN f ON p2.head = f.removed
""")
def lineage_rebuild(spark, folder):
    orders = table(spark, folder, "orders")
    key = F.col("o_orderkey")
    pass3 = orders.filter("o_orderkey % 4 = 0").select(
        key.alias("removed"), F.array(key + 1, key + 3, key + 5).alias("correlated")
    )
    pass2 = orders.filter("o_orderkey % 4 = 2").select(
        key.alias("removed"), (key - 2).alias("representative")
    )
    alive = orders.filter("o_orderkey % 4 IN (1, 3)").select(key.alias("col"))
    return L.rebuild_from_steps(pass2, pass3, alive)
