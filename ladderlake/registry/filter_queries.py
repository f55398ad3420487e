"""Filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ladderlake.operators.filters import in_run_window, outside, resolved_date, selected
from ladderlake.registry import register
from ladderlake.registry.stand_ins import table


@register(
    "filter_run_window",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS file_date FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-03-03' AND DATE '1999-10-30'""",
)
def filter_run_window(spark, sf):
    """Both ends of the window belong to it."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("file_date")
    )
    return orders.filter(in_run_window("file_date", "1996-03-03", "1999-10-30"))


@register(
    "resolve_run_window",
    """SELECT o_orderkey,
 CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE)
  ELSE DATE '2002-01-21' - 20 END AS run_date,
 CASE WHEN o_orderstatus = 'P' THEN CAST(o_orderdate AS DATE)
  ELSE DATE '2002-01-21' - 5 END AS run_end_date
FROM orders""",
)
def resolve_run_window(spark, sf):
    """An explicit date wins over one counted back from the day of the run."""
    today = F.lit("2002-01-21").cast("date")
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    status = F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        resolved_date(F.when(status == "F", text), today, 20).alias("run_date"),
        resolved_date(F.when(status == "P", text), today, 5).alias("run_end_date"),
    )


@register(
    "filter_equality",
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'",
)
def filter_equality(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return orders.filter(F.col("o_orderstatus") == "F")


_SOMETIMES = "CASE WHEN l_linenumber <> 7 THEN l_suppkey END"


def _profiles(spark, sf):
    """Line items whose seventh lines have no profile."""
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_linenumber") != 7, F.col("l_suppkey")).alias("profile_id"),
    )


@register(
    "filter_not_null",
    f"""SELECT * FROM (SELECT l_orderkey, l_linenumber, {_SOMETIMES} AS profile_id FROM lineitem)
WHERE profile_id IS NOT NULL""",
)
def filter_not_null(spark, sf):
    return _profiles(spark, sf).filter(F.col("profile_id").isNotNull())


@register(
    "filter_is_null",
    f"""SELECT l_orderkey, l_linenumber FROM (
 SELECT l_orderkey, l_linenumber, {_SOMETIMES} AS profile_id FROM lineitem)
WHERE profile_id IS NULL""",
)
def filter_is_null(spark, sf):
    return _profiles(spark, sf).filter("profile_id IS NULL").drop("profile_id")


@register(
    "filter_outside_range",
    f"""SELECT * FROM (SELECT l_orderkey, l_linenumber, {_SOMETIMES} AS profile_id FROM lineitem)
WHERE profile_id < 10 OR profile_id > 80""",
)
def filter_outside_range(spark, sf):
    return _profiles(spark, sf).filter(outside("profile_id", 10, 80))


@register(
    "filter_not_equal_cols",
    """SELECT l_orderkey, l_linenumber, c_nationkey, s_nationkey FROM lineitem
 JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
 JOIN supplier ON l_suppkey = s_suppkey WHERE c_nationkey <> s_nationkey""",
)
def filter_not_equal_cols(spark, sf):
    """A comparison across the two sides of a join."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    buyers = orders.join(customers, orders.o_custkey == customers.c_custkey)
    return (
        lines.join(buyers, lines.l_orderkey == buyers.o_orderkey)
        .join(suppliers, lines.l_suppkey == suppliers.s_suppkey)
        .filter(F.col("c_nationkey") != F.col("s_nationkey"))
        .select("l_orderkey", "l_linenumber", "c_nationkey", "s_nationkey")
    )


@register(
    "filter_multi_isin",
    """SELECT p_partkey, p_brand, p_type FROM part
WHERE p_brand IN ('Brand#2', 'Brand#17', 'Brand#4') AND p_type IN ('ECONOMY', 'SMALL')""",
)
def filter_multi_isin(spark, sf):
    """Choices of several columns together; no choice of sizes keeps every size."""
    parts = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    wanted = {
        "p_brand": ["Brand#2", "Brand#17", "Brand#4"],
        "p_type": ["ECONOMY", "SMALL"],
        "p_size": [],
    }
    return selected(parts, wanted).drop("p_size")
