"""Records: XML, named properties, statuses, features and quality counters."""

from __future__ import annotations

from pyspark.sql import functions as F

from colsieve.functions.text import final_status, norm_label, part_number, to_number, with_inchi_prefix
from colsieve.operators.featurize import TEXT_FEATURES, apply_guarded, with_features
from colsieve.operators.properties import filter_by_range, matches, matching_value, range_counts
from colsieve.operators.quality import combine_summaries, error_summary, outcome_metrics
from colsieve.plans.catalog.common import query, r6, table
from colsieve.sources.records import as_rows, count_elements, parse_xml, rejected


@query("""
SELECT trim(regexp_replace(translate(lower(o_orderpriority), '-_', '  '), '\\s+', ' ', 'g')) AS label,
       count(*) AS n FROM orders GROUP BY 1
""")
def label_norm(spark, folder):
    return table(spark, folder, "orders").groupBy(norm_label(F.col("o_orderpriority")).alias("label")).agg(
        F.count("*").alias("n")
    )


@query("""
SELECT CASE WHEN event_type IN ('click', 'view') THEN 'Page-Use'
            WHEN event_type = 'purchase' OR (event_type = 'signup' AND user_id % 2 = 0) THEN 'Sale' END AS target,
       count(*) AS n FROM events GROUP BY 1
""")
def alias_resolve(spark, folder):
    """Keys such as ``signup::even`` mapped to targets by full key or label aliases."""
    parity = F.when(F.col("user_id") % 2 == 0, "Even").otherwise("Odd")
    key = F.concat_ws("::", F.upper("event_type"), parity)
    target = F.when(matches(key, "Page-Use", ["click", "VIEW"]), "Page-Use").when(
        matches(key, "Sale", ["Purchase", "Signup::even"]), "Sale"
    )
    return table(spark, folder, "events").groupBy(target.alias("target")).agg(F.count("*").alias("n"))


def _k(df):
    return F.get_json_object("props", "$.k")


@query("""
SELECT event_id, event_type FROM events
WHERE TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) BETWEEN 20 AND 60
""")
def property_filter(spark, folder):
    events = table(spark, folder, "events")
    return filter_by_range(events, _k(events), 20, 60).select("event_id", "event_type")


@query("""
WITH k AS (SELECT CASE WHEN event_type = 'view' THEN NULL WHEN event_type = 'click' THEN 'n/a'
             ELSE json_extract_string(props, '$.k') END AS v FROM events),
n AS (SELECT TRY_CAST(v AS DOUBLE) AS x FROM k)
SELECT count(*) AS checked, count(*) FILTER (x BETWEEN 20 AND 60) AS passed,
  count(*) FILTER (x < 20 OR x > 60) AS filtered, count(*) FILTER (x IS NULL) AS missing FROM n
""")
def property_filter_stats(spark, folder):
    events = table(spark, folder, "events")
    value = F.when(F.col("event_type") == "view", F.lit(None)).when(
        F.col("event_type") == "click", "n/a").otherwise(_k(events))
    return range_counts(events, value, 20, 60)


# Parts written as compound records: a repeated key, a nameless key, an alias, and ids that lack.
RECORD_TEXT = """
concat('<PC-Compound>',
  CASE WHEN p_partkey % 10 = 3 THEN '' ELSE concat(
    '<PC-Compound_id><PC-CompoundType><PC-CompoundType_id><PC-CompoundType_id_cid>', p_partkey,
    '</PC-CompoundType_id_cid></PC-CompoundType_id></PC-CompoundType></PC-Compound_id>') END,
  '<PC-Compound_props>',
  info('Count', 'Hydrogen Bond Donor', 'ival', p_size),
  info('Molecular Formula', '', 'sval', p_brand),
  CASE WHEN p_size > 25 THEN info('Molecular Formula', '', 'sval', p_type) ELSE '' END,
  info('Log P', 'XLogP3-AA', 'fval', p_retailprice),
  info('SMILES', 'Other', 'sval', p_name),
  '</PC-Compound_props></PC-Compound>')
"""


def _info(label: str, name: str, tag: str, value: str) -> str:
    named = f"<PC-Urn_name>{name}</PC-Urn_name>" if name else ""
    return (
        f"concat('<PC-InfoData><PC-InfoData_urn><PC-Urn><PC-Urn_label>{label}</PC-Urn_label>{named}"
        f"</PC-Urn></PC-InfoData_urn><PC-InfoData_value><PC-InfoData_value_{tag}>', {value}, "
        f"'</PC-InfoData_value_{tag}></PC-InfoData_value></PC-InfoData>')"
    )


def _record_text() -> str:
    import re

    return re.sub(
        r"info\('([^']*)', '([^']*)', '([^']*)', (\w+)\)", lambda m: _info(*m.groups()), RECORD_TEXT
    )


def _records(spark, folder):
    part = table(spark, folder, "part")
    return parse_xml(part.select("p_partkey", F.expr(_record_text()).alias("xml")), "xml")


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS "CID", CAST(p_size AS VARCHAR) AS donors,
  CASE WHEN p_size > 25 THEN p_type ELSE p_brand END AS formula,
  round(p_retailprice, 2) AS logp, p_name AS smiles, '' AS charge
FROM part WHERE p_partkey % 10 <> 3
""")
def xml_extract(spark, folder):
    wanted = ["CID", "H-Bond Donor Count", "Molecular Formula", "Log P::XLogP3-AA", "SMILES::Absolute", "Charge"]
    rows = as_rows(_records(spark, folder), wanted).toDF("CID", "donors", "formula", "logp", "smiles", "charge")
    return rows.withColumn("logp", F.round(F.col("logp").try_cast("double"), 2))


@query("""
SELECT p_partkey, 'UNKNOWN' AS cid, 'No CID found' AS error, false AS recoverable
FROM part WHERE p_partkey % 10 = 3
""")
def xml_rejects(spark, folder):
    return rejected(_records(spark, folder)).select("p_partkey", "cid", "error", "recoverable")


@query("SELECT p_partkey FROM part WHERE p_size BETWEEN 10 AND 30")
def xml_property_filter(spark, folder):
    records = _records(spark, folder)
    value = matching_value(F.col("props"), "H-Bond Donor Count", ["Count::Hydrogen Bond Donor"])
    return filter_by_range(records, value, 10, 30).select("p_partkey")


@query("""
SELECT page_id, CAST(len(html) - len(replace(html, '<p>', 'p>')) AS BIGINT) AS n_elements FROM pages
""")
def element_count(spark, folder):
    return table(spark, folder, "pages").select(
        "page_id", count_elements(F.col("html"), "p").cast("long").alias("n_elements")
    )


@query(r"""
WITH t AS (SELECT l_linenumber, l_quantity,
  CASE l_linenumber WHEN 1 THEN '[' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ']'
    WHEN 2 THEN '  [ ' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '.5e1 ] '
    WHEN 3 THEN 'abc' WHEN 4 THEN '[1, 2]' WHEN 5 THEN 'inf'
    ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS s FROM lineitem)
SELECT l_linenumber, count(*) AS n, sum(CASE l_linenumber WHEN 1 THEN l_quantity
  WHEN 2 THEN (l_quantity + 0.5) * 10 WHEN 3 THEN NULL WHEN 4 THEN NULL WHEN 5 THEN NULL
  ELSE l_quantity END) AS total
FROM t GROUP BY 1
""")
def vector_text(spark, folder):
    """Numbers, one-element vectors and junk in one text column."""
    q = F.col("l_quantity").cast("long").cast("string")
    n = F.col("l_linenumber")
    text = (
        F.when(n == 1, F.concat(F.lit("["), q, F.lit("]")))
        .when(n == 2, F.concat(F.lit("  [ "), q, F.lit(".5e1 ] ")))
        .when(n == 3, "abc").when(n == 4, "[1, 2]").when(n == 5, "inf").otherwise(q)
    )
    li = table(spark, folder, "lineitem").withColumn("x", to_number(text))
    return li.groupBy("l_linenumber").agg(F.count("*").alias("n"), F.sum("x").alias("total"))


STATUS_SQL = """CASE o_orderkey % 6 WHEN 0 THEN 'success' WHEN 1 THEN 'partial_success(Cleanup)'
  WHEN 2 THEN 'recovered_via_inchi(success)' WHEN 3 THEN 'recovered_via_inchi(partial_success(Normalizer))'
  WHEN 4 THEN 'failed(parsing)' ELSE NULL END"""
SOURCE_SQL = """CASE WHEN o_orderkey % 6 IN (2, 3) THEN 'inchi_fallback_after_std'
  WHEN o_orderstatus = 'F' THEN 'inchi_fallback' ELSE 'smiles' END"""


@query(f"""
WITH t AS (SELECT {STATUS_SQL} AS st, {SOURCE_SQL} AS src, o_orderkey % 6 < 4 AS ok FROM orders)
SELECT CASE WHEN NOT ok THEN CASE WHEN st LIKE 'failed(%' THEN st ELSE 'failed(unknown)' END
  WHEN src LIKE 'inchi_fallback%' THEN CASE
    WHEN st = 'partial_success(Cleanup)' THEN 'partial_success_via_inchi(Cleanup)'
    WHEN st LIKE 'recovered_via_inchi(partial%' THEN 'partial_success_via_inchi(Normalizer)'
    ELSE 'success_via_inchi' END
  WHEN st LIKE 'partial_success(%' THEN st ELSE 'success' END AS status, count(*) AS n
FROM t GROUP BY 1
""")
def final_statuses(spark, folder):
    t = table(spark, folder, "orders").select(
        F.expr(STATUS_SQL).alias("st"), F.expr(SOURCE_SQL).alias("src"),
        (F.col("o_orderkey") % 6 < 4).alias("ok"),
    )
    status = final_status(F.col("st"), F.col("src"), F.col("ok"))
    return t.groupBy(status.alias("status")).agg(F.count("*").alias("n"))


@query("""
SELECT CAST(o_orderkey % 100 AS INTEGER) AS chunk, count(*) AS n,
  count(DISTINCT CASE WHEN o_orderkey % 2 = 0 THEN 'InChI=' || o_orderkey ELSE 'InChI=1S/' || o_orderkey END) AS keys
FROM orders GROUP BY 1
""")
def part_names(spark, folder):
    """Chunk numbers out of part file names, and identifiers with their prefix made uniform."""
    orders = table(spark, folder, "orders")
    file_name = F.format_string("part-%06d.parquet", (F.col("o_orderkey") % 100).cast("int"))
    raw = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey").cast("string")).otherwise(
        F.concat(F.lit(" InChI=1S/"), F.col("o_orderkey").cast("string"))
    )
    return orders.groupBy(part_number(file_name).alias("chunk")).agg(
        F.count("*").alias("n"), F.count_distinct(with_inchi_prefix(raw)).alias("keys")
    )


@query("""
SELECT doc_id, CAST(length(text) AS DOUBLE) AS n_chars,
  CAST(len(regexp_extract_all(text, '[^ \\t\\r\\n]+')) AS DOUBLE) AS n_words,
  CAST(len(regexp_extract_all(text, '[0-9]')) AS DOUBLE) AS n_digits,
  CAST(len(regexp_extract_all(text, '[A-Z]')) AS DOUBLE) AS n_upper,
  CAST(len(regexp_extract_all(text, '\\n')) + 1 AS DOUBLE) AS n_lines,
  round(len(regexp_extract_all(text, '[A-Z]')) / length(text), 6) AS upper_ratio
FROM documents
""")
def text_features(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return with_features(docs, "text", TEXT_FEATURES).drop("text").withColumn(
        "upper_ratio", r6("upper_ratio")
    )


def _shape():
    def one(text: str) -> dict[str, float]:
        words = text.split(" ")
        return {"longest_word": float(max(map(len, words))), "blanks": float(len(words) - 1)}

    return one


@query("""
SELECT doc_id, 'success' AS descriptor_status,
  CAST(list_max(list_transform(string_split(text, ' '), lambda x: length(x))) AS DOUBLE) AS longest_word,
  CAST(len(string_split(text, ' ')) - 1 AS DOUBLE) AS blanks
FROM documents
""")
def guarded_features(spark, folder):
    """A Python descriptor function per record, each call under a time limit."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return apply_guarded(docs, "text", ["longest_word", "blanks"], _shape, 30.0).drop("text")


@query("""
WITH f AS (SELECT *, row_number() OVER (PARTITION BY user_id % 7 ORDER BY event_id) AS r
           FROM events WHERE event_type = 'error')
SELECT CAST(user_id % 7 AS BIGINT) AS kind, count(*) AS n_errors,
  string_agg(CASE WHEN r <= 3 THEN CAST(event_id AS VARCHAR) END, ',' ORDER BY event_id) AS examples
FROM f GROUP BY 1
""")
def error_summaries(spark, folder):
    errors = table(spark, folder, "events").filter("event_type = 'error'").withColumn(
        "kind", F.col("user_id") % 7
    )
    return error_summary(errors, "kind", "event_id").withColumn(
        "examples", F.array_join(F.col("examples").cast("array<string>"), ",")
    )


METRIC_STATUS = """CASE WHEN event_type = 'error' THEN CASE WHEN value > 50 THEN 'failed(skip)'
  ELSE 'failed(descriptor)' END ELSE 'success' END"""
METRICS_SQL = f"""
m AS (SELECT chunk, count(*) AS n_total, count(*) FILTER (st = 'success') AS n_success,
  count(*) FILTER (st <> 'success') AS n_failed, count(*) FILTER (st = 'failed(skip)') AS n_timeout
  FROM (SELECT event_id // 1000 AS chunk, {METRIC_STATUS} AS st FROM events) GROUP BY chunk)
"""


def _metrics(spark, folder):
    events = table(spark, folder, "events").withColumn("chunk", F.expr("event_id div 1000"))
    return outcome_metrics(events, ["chunk"], F.expr(METRIC_STATUS))


@query("WITH " + METRICS_SQL + "SELECT *, round(100.0 * n_success / n_total, 6) AS success_rate FROM m")
def chunk_metrics(spark, folder):
    return _metrics(spark, folder).withColumn("success_rate", r6("success_rate"))


@query("WITH " + METRICS_SQL + """
SELECT count(*) AS n_files, CAST(sum(n_total) AS BIGINT) AS n_total, CAST(sum(n_success) AS BIGINT) AS n_success,
  CAST(sum(n_failed) AS BIGINT) AS n_failed, CAST(sum(n_timeout) AS BIGINT) AS n_timeout FROM m
""")
def batch_summary(spark, folder):
    return combine_summaries(_metrics(spark, folder), ["n_total", "n_success", "n_failed", "n_timeout"])
