"""Set operations."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.operators.quality import violations
from lakeops.plans import domain as d
from lakeops.plans.domain import check
from lakeops.plans.registry import query

_OLD = "SELECT customer_id, priority FROM sales WHERE status IN ('F', 'O')"
_NEW = "SELECT customer_id, priority FROM sales WHERE status IN ('O', 'P')"


def _two_batches(spark, sf):
    rows = d.orders(spark, sf)
    pick = ["customer_id", "priority"]
    return (rows.where(F.col("status").isin("F", "O")).select(*pick),
            rows.where(F.col("status").isin("O", "P")).select(*pick))


@query("union_distinct", "O1", sql=check(f"{_OLD} UNION {_NEW}", "sales"))
def _(spark, sf):
    old, new = _two_batches(spark, sf)
    return old.union(new).distinct()


@query("union_all", "O2", sql=check(
    f"SELECT customer_id, priority, count(*) AS n FROM ({_OLD} UNION ALL {_NEW}) GROUP BY ALL",
    "sales"))
def _(spark, sf):
    old, new = _two_batches(spark, sf)
    return old.union(new).groupBy("customer_id", "priority").agg(F.count(F.lit(1)).alias("n"))


@query("intersect", "O3", sql=check(f"{_OLD} INTERSECT {_NEW}", "sales"))
def _(spark, sf):
    old, new = _two_batches(spark, sf)
    return old.intersect(new)


@query("except_minus", "O4", sql=check(f"{_OLD} EXCEPT {_NEW}", "sales"))
def _(spark, sf):
    old, new = _two_batches(spark, sf)
    return spark.sql("SELECT * FROM {a} MINUS SELECT * FROM {b}", a=old, b=new)


@query("set_operation_on_arrays", "O1", "O4", sql=check("""
    SELECT list_count AS items, count(*) AS n FROM (
        SELECT order_id, order_id % 4 AS list_count FROM sales WHERE status = 'F') GROUP BY ALL""",
    "sales"))
def _(spark, sf):
    rows = d.nested_orders(spark, sf).select("order_id", "status", "items")
    left = rows.where("status <> 'O'").select("order_id", "items")
    right = rows.where("status <> 'F'").select("order_id", "items")
    return left.subtract(right).groupBy(F.size("items").alias("items")).agg(
        F.count(F.lit(1)).alias("n"))


@query("stacked_checks", "O5", sql=check("""
    SELECT 'orders: large' AS check, count(*) AS n FROM sales WHERE amount > 400000
    UNION ALL SELECT 'customers: in debt', count(*) FROM customers WHERE balance < 0
    UNION ALL SELECT 'items: no price', count(*) FROM items WHERE price IS NULL""",
    "sales", "customers", "items"))
def _(spark, sf):
    return reduce(DataFrame.unionByName, [
        violations(d.orders(spark, sf), "orders: large", "amount > 400000"),
        violations(d.customers(spark, sf), "customers: in debt", "balance < 0"),
        violations(d.items(spark, sf), "items: no price", "price IS NULL")])
