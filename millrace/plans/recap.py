"""Static projections, filters, joins and aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import dates
from millrace.functions.text import explode_columns
from millrace.operators.aggregates import average, count_by
from millrace.plans.registry import query
from millrace.sources.tables import table


@query("SELECT l_orderkey, l_linenumber, l_quantity / 2.2e0 AS kilograms FROM lineitem")
def project_arith(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_linenumber"), F.expr("l_quantity / 2.2D").alias("kilograms")
    )


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'")
def filter_ne(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return orders.filter(F.col("o_orderstatus") != "F")


@query("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'")
def sql_filter(spark, sf_dir):
    table(spark, sf_dir, "customer").createOrReplaceTempView("millrace_customer")
    return spark.sql(
        "SELECT c_custkey, c_name FROM millrace_customer WHERE c_mktsegment = 'BUILDING'"
    )


@query("SELECT o_orderkey AS number, o_orderkey * 2 AS doubled FROM orders")
def range_double(spark, sf_dir):
    numbers = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("number"))
    return numbers.select("number", (F.col("number") * 2).alias("doubled"))


@query(
    """SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    WHERE coalesce(l.quality, 0) < 1"""
)
def filter_null_default(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    labelled = documents.join(labels, "doc_id", "left")
    return labelled.filter(F.coalesce("quality", F.lit(0)) < 1).select("doc_id")


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 8000")
def filter_gt(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return customers.filter(F.col("c_acctbal") > 8000)


@query(
    """SELECT o_orderkey, o_orderpriority || ' ' || o_orderstatus AS label,
        CAST(year(DATE '2024-02-28') - year(o_orderdate)
          - CASE WHEN strftime(o_orderdate, '%m%d') > '0228' THEN 1 ELSE 0 END AS INTEGER) AS age
    FROM orders"""
)
def age_years(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        dates.full_name("o_orderpriority", "o_orderstatus").alias("label"),
        dates.age_years(F.col("o_orderdate"), F.lit("2024-02-28").cast("date")).alias("age"),
    )


@query(
    """SELECT p_brand AS name FROM part UNION ALL SELECT p_type AS name FROM part"""
)
def explode_names(spark, sf_dir):
    return explode_columns(table(spark, sf_dir, "part"), ["p_brand", "p_type"], "name")


@query(
    """SELECT o.o_orderkey, c.c_custkey, c.c_name
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"""
)
def join_inner(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "inner")
    return joined.select("o_orderkey", "c_custkey", "c_name")


@query("SELECT round(avg(l_quantity), 4) AS mean_quantity FROM lineitem")
def agg_avg(spark, sf_dir):
    mean = average(table(spark, sf_dir, "lineitem"), "l_quantity", "mean_quantity")
    return mean.select(F.round("mean_quantity", 4).alias("mean_quantity"))


@query("SELECT c_mktsegment, count(*) AS count FROM customer GROUP BY c_mktsegment")
def group_count(spark, sf_dir):
    return count_by(table(spark, sf_dir, "customer"), "c_mktsegment")
