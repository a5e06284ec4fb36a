"""TPC-H style relational jobs (G13: Q3 variant, G14: Q10 variant).

Written as plain filter -> join -> aggregate plans.  Catalyst pushes the
segment / date / flag predicates into the parquet scans (``PushedFilters``)
and reads only the referenced columns.  The final aggregate groups on the
join key of the last join, so it reuses that join's hash partitioning and
adds no shuffle of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import exact_sum, revenue
from ..operators.joins import join_with_tiny
from ..operators.relational import filter_year
from ..sources.tables import load


def q3_shipping_priority(customer: DataFrame, orders: DataFrame, lineitem: DataFrame,
                         segment: str = "AUTOMOBILE", date: str = "1995-03-12",
                         sort: bool = False) -> DataFrame:
    """Revenue of orders placed before ``date`` by ``segment`` customers,
    counting line items shipped after ``date``.

    Groups by (l_orderkey, o_orderdate, o_orderpriority) -- the test tables
    carry ``o_orderpriority`` in place of ``o_shippriority``.
    """
    cust = customer.filter(F.col("c_mktsegment") == segment).select("c_custkey")
    ords = orders.filter(F.col("o_orderdate") < F.lit(date).cast("timestamp_ntz")) \
                 .select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    items = lineitem.filter(F.col("l_shipdate") > F.lit(date).cast("timestamp_ntz")) \
                    .select("l_orderkey", revenue().alias("rev"))
    co = cust.join(ords, cust.c_custkey == ords.o_custkey)
    joined = co.join(items, co.o_orderkey == items.l_orderkey)
    out = joined.groupBy("l_orderkey", "o_orderdate", "o_orderpriority") \
                .agg(exact_sum("rev").alias("revenue"))
    if sort:   # W08: the Table-API form orders by revenue desc, date asc
        out = out.orderBy(F.col("revenue").desc(), F.col("o_orderdate").asc())
    return out


def q10_returned_items(customer: DataFrame, orders: DataFrame, lineitem: DataFrame,
                       nation: DataFrame, min_year: int = 1990) -> DataFrame:
    """Per customer, revenue lost to returned items (flag 'R') on orders
    from years after ``min_year``, with the customer's nation name.

    The nation side is joined with a size-checked broadcast (J04); the
    lineitem side is the huge one (J05) and is pre-aggregated per order
    customer before meeting the customer table.
    """
    ords = filter_year(orders, "o_orderdate", ">", min_year).select("o_orderkey", "o_custkey")
    items = lineitem.filter(F.col("l_returnflag") == "R") \
                    .select("l_orderkey", revenue().alias("rev"))
    rev = ords.join(items, ords.o_orderkey == items.l_orderkey) \
              .groupBy(F.col("o_custkey").alias("c_custkey")) \
              .agg(exact_sum("rev").alias("revenue"))
    cust = join_with_tiny(
        customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal"),
        nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name"),
        "c_nationkey")
    return cust.join(rev, "c_custkey") \
               .select("c_custkey", "c_name", "n_name", "c_acctbal", "revenue")


def _orders_items(spark: SparkSession, sf_dir: str):
    return load(spark, sf_dir, "orders"), load(spark, sf_dir, "lineitem")


def g13(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, li = _orders_items(spark, sf_dir)
    return q3_shipping_priority(load(spark, sf_dir, "customer"), o, li)


def g13_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, li = _orders_items(spark, sf_dir)
    return q3_shipping_priority(load(spark, sf_dir, "customer"), o, li, sort=True)


def g14(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, li = _orders_items(spark, sf_dir)
    return q10_returned_items(load(spark, sf_dir, "customer"), o, li, load(spark, sf_dir, "nation"))


G13_SQL = """
SELECT l_orderkey, o_orderdate, o_orderpriority,
       CAST(SUM(CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(15,2))) AS DECIMAL(18,4))) AS DOUBLE) AS revenue
FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
WHERE c_mktsegment = 'AUTOMOBILE' AND o_orderdate < TIMESTAMP '1995-03-12'
  AND l_shipdate > TIMESTAMP '1995-03-12'
GROUP BY l_orderkey, o_orderdate, o_orderpriority
"""

G14_SQL = """
SELECT c_custkey, c_name, n_name, c_acctbal, r.revenue
FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN (SELECT o_custkey,
             CAST(SUM(CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(15,2))) AS DECIMAL(18,4))) AS DOUBLE) AS revenue
      FROM orders JOIN lineitem ON o_orderkey = l_orderkey
      WHERE CAST(substr(CAST(o_orderdate AS VARCHAR), 1, 4) AS INTEGER) > 1990 AND l_returnflag = 'R'
      GROUP BY o_custkey) r ON r.o_custkey = c_custkey
"""
