"""Scans, schemas, sampling and sketches."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from colsieve.functions.hashing import sketch_bucket, sketch_parameters, sketch_sign
from colsieve.functions.ranking import with_group_rank
from colsieve.operators.quality import missing_chunks
from colsieve.operators.sampling import sample_addresses, sample_per_group
from colsieve.plans.catalog.common import query, r6, table
from colsieve.sources.tables import as_features, enforce_schema, feature_columns, row_total, rows_at

ROW_KEY = "concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(round(l_extendedprice * 100) AS BIGINT), '42')"


@query("""
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_discount > 0.08 AND l_shipdate >= TIMESTAMP '1998-01-01'
""")
def projected_scan(spark, folder):
    li = table(spark, folder, "lineitem")
    return li.filter("l_discount > 0.08D AND l_shipdate >= TIMESTAMP '1998-01-01'").select(
        "l_orderkey", "l_linenumber", "l_quantity"
    )


@query("""
SELECT c_custkey AS id, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
       c_mktsegment AS segment FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier
""")
def schema_union(spark, folder):
    customer = table(spark, folder, "customer").toDF("id", "name", "nationkey", "acctbal", "segment")
    supplier = table(spark, folder, "supplier").toDF("id", "name", "nationkey", "acctbal")
    return customer.unionByName(supplier, allowMissingColumns=True)


@query("""
SELECT c_name, CAST(NULL AS DOUBLE) AS c_missing, c_acctbal, CAST(c_nationkey AS DOUBLE) AS c_nationkey
FROM customer
""")
def schema_enforce(spark, folder):
    master = T.StructType([
        T.StructField("c_name", T.StringType()), T.StructField("c_missing", T.DoubleType()),
        T.StructField("c_acctbal", T.DoubleType()), T.StructField("c_nationkey", T.DoubleType()),
    ])
    return enforce_schema(table(spark, folder, "customer"), master)


@query("""
SELECT count(*) AS n_rows, count(l_orderkey) AS l_orderkey, count(l_partkey) AS l_partkey,
       count(l_suppkey) AS l_suppkey, count(l_linenumber) AS l_linenumber,
       count(l_quantity) AS l_quantity, count(l_discount) AS l_discount, count(l_tax) AS l_tax
FROM lineitem
""")
def numeric_columns(spark, folder):
    li = table(spark, folder, "lineitem")
    columns = feature_columns(li, exclude=["L_EXTENDEDPRICE"])  # the target, in any case
    return as_features(li, columns).agg(
        F.count("*").alias("n_rows"), *[F.count(c).alias(c) for c in columns]
    )


@query("""
SELECT CAST(sum(least(n, 500)) AS BIGINT) AS n_rows
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_suppkey)
""")
def capped_count(spark, folder):
    return row_total(table(spark, folder, "lineitem"), "l_suppkey", 500)


@query(f"""
SELECT l_returnflag, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_returnflag
    ORDER BY md5({ROW_KEY}), l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice) AS r
  FROM lineitem) WHERE r <= 100
""")
def per_group_sample(spark, folder):
    li = table(spark, folder, "lineitem").withColumn(
        "cents", F.round(F.col("l_extendedprice") * 100).cast("long")
    )
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "cents"]
    return sample_per_group(li, "l_returnflag", keys, 100, 42).select(
        "l_returnflag", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"
    )


@query("""
SELECT o_orderpriority, o_orderkey FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderpriority
    ORDER BY md5(concat_ws('|', o_orderkey, '7')), o_orderkey) AS r
  FROM orders) WHERE r <= 1500
""")
def per_group_sample_large(spark, folder):
    orders = table(spark, folder, "orders")
    return sample_per_group(orders, "o_orderpriority", ["o_orderkey"], 1500, 7).select(
        "o_orderpriority", "o_orderkey"
    )


@query("""
SELECT event_id, user_id, event_type, value FROM events WHERE event_id IN (
  SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY event_type
    ORDER BY md5(concat_ws('|', event_id, '42')), event_id) AS r FROM events) WHERE r <= 50)
""")
def saved_index_scan(spark, folder):
    events = table(spark, folder, "events")
    saved = sample_addresses(events, "event_type", ["event_id"], 50)
    return rows_at(events, saved, ["event_id"]).select("event_id", "user_id", "event_type", "value")


@query("""
SELECT p_partkey, CASE WHEN r = 1 THEN p_name ELSE p_name || '_' || (r - 1) END AS name FROM (
  SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS r FROM part)
""")
def dedup_names(spark, folder):
    ranked = with_group_rank(table(spark, folder, "part"), ["p_name"], "p_partkey", "r")
    suffix = F.concat("p_name", F.lit("_"), (F.col("r") - 1).cast("string"))
    return ranked.select("p_partkey", F.when(F.col("r") == 1, F.col("p_name")).otherwise(suffix).alias("name"))


@query("""
WITH a AS (SELECT DISTINCT p_name || ' ' || p_type AS name FROM part WHERE p_size <= 40),
     b AS (SELECT DISTINCT upper(p_name || ' ' || p_type) AS name FROM part WHERE p_size > 5)
SELECT name FROM b WHERE lower(name) NOT IN (SELECT lower(name) FROM a)
""")
def overlap_anti(spark, folder):
    part = table(spark, folder, "part").select(
        "p_size", F.concat_ws(" ", "p_name", "p_type").alias("name")
    )
    first = part.filter("p_size <= 40").select(F.lower("name").alias("key")).distinct()
    second = part.filter("p_size > 5").select(F.upper("name").alias("name")).distinct()
    return second.join(first, F.lower("name") == F.col("key"), "left_anti")


@query("""
WITH c AS (SELECT event_id // 250 AS chunk, count(*) AS n_rows FROM events GROUP BY 1)
SELECT chunk, n_rows FROM c
WHERE chunk NOT IN (SELECT event_id // 250 FROM events WHERE event_type = 'error' AND value > 250)
""")
def resume_chunks(spark, folder):
    events = table(spark, folder, "events").withColumn("chunk", F.expr("event_id div 250"))
    chunks = events.groupBy("chunk").agg(F.count("*").alias("n_rows"))
    done = events.filter("event_type = 'error' AND value > 250")
    return missing_chunks(chunks, done, "chunk")


def _sketch_sql(m: int, seed: int) -> str:
    size, (a1, b1, c1, a2, b2, c2) = sketch_parameters(m, seed)
    word = 1 << 64
    mask = (1 << 61) - 1

    def hashed(a, b, c):
        product = f"({a}::HUGEINT * xor(o_orderkey, {b}::BIGINT)::HUGEINT + {c}::HUGEINT)"
        return f"(({product} % {word}::HUGEINT) & {mask}::HUGEINT)"

    return f"""
SELECT o_orderkey, CAST({hashed(a1, b1, c1)} % {size} AS BIGINT) AS bucket,
       CASE WHEN {hashed(a2, b2, c2)} % 2 = 0 THEN 1.0 ELSE -1.0 END::DOUBLE AS sign
FROM orders"""


@query(_sketch_sql(1000, 42))
def countsketch_buckets(spark, folder):
    key = F.col("o_orderkey")
    return table(spark, folder, "orders").select(
        "o_orderkey", sketch_bucket(key, 1000, 42).alias("bucket"), sketch_sign(key, 1000, 42).alias("sign")
    )


@query(f"""
SELECT bucket, round(sum(sign * o_totalprice), 4) AS s
FROM ({_sketch_sql(64, 7).replace("SELECT o_orderkey,", "SELECT o_totalprice,")}) GROUP BY bucket
""")
def countsketch_vector(spark, folder):
    key = F.col("o_orderkey")
    signed = sketch_sign(key, 64, 7) * F.col("o_totalprice")
    return table(spark, folder, "orders").groupBy(sketch_bucket(key, 64, 7).alias("bucket")).agg(
        F.round(F.sum(signed), 4).alias("s")
    )


@query("""
SELECT p_partkey, md5(concat_ws('|', p_name, p_brand, p_type, p_size)) AS fingerprint FROM part
""")
def row_fingerprint(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey",
        F.md5(F.concat_ws("|", "p_name", "p_brand", "p_type", F.col("p_size").cast("string"))).alias(
            "fingerprint"
        ),
    )


@query("""
SELECT l_returnflag, round(avg(-log10(l_extendedprice)), 6) AS mean_neg_log10,
       round(min(-log10(l_extendedprice)), 6) AS min_neg_log10
FROM lineitem GROUP BY 1
""")
def negative_log(spark, folder):
    from colsieve.functions.text import neg_log10

    li = table(spark, folder, "lineitem").withColumn("y", neg_log10(F.col("l_extendedprice")))
    return li.groupBy("l_returnflag").agg(
        r6(F.avg("y")).alias("mean_neg_log10"), r6(F.min("y")).alias("min_neg_log10")
    )
