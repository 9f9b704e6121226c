"""Joins, aggregations and numbering over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sheaf import dims
from sheaf.functions import arrays
from sheaf.operators.children import (
    distinct_in_order, explode_list, first_by_priority, last_wins, link_references, regroup,
)
from sheaf.operators.lookups import translate_codes
from sheaf.operators.ranges import adjacent_ranges, integer_ranges, range_as_string, range_text
from sheaf.workloads import query
from sheaf.workloads.feeds import spread_table, table


@query("""
WITH y AS (SELECT DISTINCT o_custkey, year(o_orderdate) AS y FROM orders),
g AS (SELECT o_custkey, y, y - row_number() OVER (PARTITION BY o_custkey ORDER BY y) AS run FROM y),
r AS (SELECT o_custkey, min(y) AS lo, max(y) AS hi FROM g GROUP BY o_custkey, run)
SELECT o_custkey AS custkey, lo::BIGINT AS lo, hi::BIGINT AS hi,
       CASE WHEN lo = hi THEN lo::VARCHAR ELSE lo || '-' || hi END AS label FROM r
""")
def year_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("custkey"), F.year("o_orderdate").alias("year")
    )
    runs = integer_ranges(years, ["custkey"], "year")
    return runs.withColumn("label", range_text(F.col("lo"), F.col("hi")))


@query("""
WITH g AS (SELECT DISTINCT l_suppkey, l_orderkey AS v FROM lineitem),
n AS (SELECT l_suppkey, v, v - row_number() OVER (PARTITION BY l_suppkey ORDER BY v) AS run FROM g)
SELECT l_suppkey AS suppkey, min(v)::BIGINT AS lo, max(v)::BIGINT AS hi FROM n GROUP BY l_suppkey, run
""")
def order_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of consecutive orders of each supplier, over several buckets."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("suppkey"), "l_orderkey")
    return integer_ranges(lines, ["suppkey"], "l_orderkey", width=64)


@query("""
WITH g AS (SELECT o_orderkey, o_custkey, o_custkey - o_orderkey AS shift FROM orders),
n AS (SELECT *, o_orderkey - row_number() OVER (PARTITION BY shift ORDER BY o_orderkey) AS run FROM g)
SELECT min(o_orderkey)::BIGINT AS first_position, min(o_custkey)::BIGINT AS lo, max(o_custkey)::BIGINT AS hi
FROM n GROUP BY shift, run
""")
def adjacent_customer_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of customers that follow each other from order to order."""
    return adjacent_ranges(table(spark, sf_dir, "orders"), [], "o_orderkey", "o_custkey")


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_size || '-' || (p_size + 2) || ', ' || (p_size + 9)
                       WHEN p_partkey % 3 = 1 THEN p_size::VARCHAR
                       ELSE (p_size + 5) || ', ' || p_size || '-' || (p_size + 1) || ', ' || p_size END AS label
FROM part
""")
def range_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, case = F.col("p_size"), F.col("p_partkey") % 3
    values = (
        F.when(case == 0, F.array(size, size + 1, size + 2, size + 9))
        .when(case == 1, F.array(size))
        .otherwise(F.array(size + 5, size, size + 1, size))
    )
    return table(spark, sf_dir, "part").select("p_partkey", range_as_string(values).alias("label"))


@query("""
SELECT l_orderkey AS orderkey, l_suppkey AS suppkey, min(l_linenumber) AS first_seen FROM lineitem GROUP BY 1, 2
""")
def affiliation_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), F.col("l_suppkey").alias("suppkey"), "l_linenumber"
    )
    return distinct_in_order(lines, ["orderkey"], "suppkey", "l_linenumber")


@query("""
SELECT orderkey, partkey, suppkey, quantity FROM (
  SELECT l_orderkey AS orderkey, l_partkey AS partkey, l_suppkey AS suppkey, l_quantity AS quantity,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_suppkey DESC, l_partkey DESC, l_quantity DESC) AS rn
  FROM lineitem) WHERE rn = 1
""")
def id_map_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), F.col("l_partkey").alias("partkey"),
        F.col("l_suppkey").alias("suppkey"), F.col("l_quantity").alias("quantity"),
        F.struct("l_linenumber", "l_suppkey", "l_partkey", "l_quantity").alias("_pos"),
    )
    return last_wins(lines, ["orderkey"], "_pos").drop("_pos")


@query("""
SELECT custkey, orderkey, status FROM (
  SELECT o_custkey AS custkey, o_orderkey AS orderkey, o_orderstatus AS status,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderkey) AS rn FROM orders) WHERE rn = 1
""")
def first_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("custkey"), F.col("o_orderkey").alias("orderkey"),
        F.col("o_orderstatus").alias("status"), F.struct("o_orderpriority", "o_orderkey").alias("_rank"),
    )
    return first_by_priority(orders, ["custkey"], "_rank").drop("_rank")


@query("""
WITH t AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY l_linenumber DESC, l_partkey DESC, l_shipdate DESC) AS rn FROM lineitem)
SELECT r.l_orderkey AS orderkey, r.l_partkey AS partkey, r.l_suppkey AS suppkey, r.l_linenumber AS linenumber, t.l_shipdate::DATE::VARCHAR AS target
FROM lineitem r JOIN t ON r.l_orderkey = t.l_orderkey AND r.l_suppkey = t.l_suppkey AND t.rn = 1
""")
def linked_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items linked to the last line of the same supplier in the order."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), F.col("l_partkey").alias("partkey"),
        F.col("l_suppkey").alias("suppkey"), F.col("l_linenumber").alias("linenumber"), "l_shipdate",
    )
    targets = lines.select(
        "orderkey", "suppkey", F.struct("linenumber", "partkey", "l_shipdate").alias("_pos"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("target"),
    )
    return link_references(lines.drop("l_shipdate"), targets, ["orderkey"], "suppkey", "_pos")


@query("""
SELECT o_orderkey AS orderkey, c AS chunk_no, CASE WHEN c = 0 THEN least(n, 3) ELSE n - 3 END AS n_children,
       CASE WHEN c = 0 THEN CASE WHEN n >= 3 THEN 'a0,a1,a2' WHEN n = 2 THEN 'a0,a1' ELSE 'a0' END
            ELSE CASE WHEN n = 5 THEN 'a3,a4' ELSE 'a3' END END AS children
FROM (SELECT o_orderkey, (o_orderkey % 5 + 1)::INT AS n FROM orders), (VALUES (0::BIGINT), (1::BIGINT)) v(c) WHERE c = 0 OR n > 3
""")
def author_regroup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Author lists exploded to rows and regrouped, three to a chunk."""
    records = spread_table(spark, sf_dir, "orders", "o_orderkey").select(
        F.col("o_orderkey").alias("orderkey"),
        F.transform(F.sequence(F.lit(0), (F.col("o_orderkey") % 5).cast("int")),
                    lambda i: F.concat(F.lit("a"), i.cast("string"))).alias("authors"),
    )
    children = explode_list(records, "authors", "seq", "name")
    grouped = regroup(children, ["orderkey"], "seq", ["name"], chunk=3)
    return grouped.select(
        "orderkey",
        "chunk_no",
        F.size("children").alias("n_children"),
        F.array_join(F.transform("children", lambda c: c["name"]), ",").alias("children"),
    )


_PAIRS = ", ".join(f"('{k}', '{v}')" for k, v in dims.LANGUAGES.items())


@query(f"""
SELECT doc_id, lang, coalesce(v, lang) AS language FROM documents LEFT JOIN (VALUES {_PAIRS}) d(k, v) ON lang = k
""")
def code_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return translate_codes(docs, dims.as_table(spark, dims.LANGUAGES), "lang", "language")


@query("""
SELECT event_id, CASE WHEN json_extract_string(props, '$.k')::INT IS NULL THEN '' ELSE json_extract_string(props, '$.k') END AS k,
       '' AS missing, CASE WHEN event_type = 'click' THEN 'click' ELSE 'none' END AS first_kind
FROM events
""")
def nested_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    root = F.try_parse_json("props")
    kinds = F.array(F.lit(""), F.lit(None).cast("string"), F.when(F.col("event_type") == "click", "click"))
    return events.select(
        "event_id",
        arrays.variant_nested(root, "k").alias("k"),
        arrays.variant_nested(root, "k", "deeper").alias("missing"),
        arrays.first_nonempty(kinds, "none").alias("first_kind"),
    )
