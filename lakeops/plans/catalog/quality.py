"""Expectations and audits."""

from pyspark.sql import functions as F

from lakeops.operators.quality import audit, expect, is_empty, violations
from lakeops.plans import domain as d
from lakeops.plans.domain import check
from lakeops.plans.registry import query

RULES = {
    "big_enough": ("quantity > 5", "drop"),
    "has_price": ("line_total > 1000", "drop"),
    "not_returned": ("nullif(flag, 'N') <> 'R'", "warn"),
    "has_item": ("item_id IS NOT NULL", "fail"),
}


@query("expectations_kept_rows", "Q1", sql=check("""
    SELECT flag, line_status, count(*) AS n, CAST(sum(line_total) AS DOUBLE) AS total FROM lines
    WHERE quantity > 5 AND line_total > 1000 GROUP BY ALL""", "lines"))
def _(spark, sf):
    kept, _metrics = expect(d.lines(spark, sf), RULES, "lines")
    return kept.groupBy("flag", "line_status").agg(
        F.count(F.lit(1)).alias("n"), F.sum("line_total").alias("total"))


@query("expectation_metrics", "Q1", "Q2", sql=check("""
    SELECT 'lines' AS dataset, 'big_enough' AS constraint, 'drop' AS action,
           count(*) FILTER (quantity > 5) AS passed, count(*) - count(*) FILTER (quantity > 5) AS failed FROM lines
    UNION ALL SELECT 'lines', 'has_price', 'drop', count(*) FILTER (line_total > 1000),
           count(*) - count(*) FILTER (line_total > 1000) FROM lines
    UNION ALL SELECT 'lines', 'not_returned', 'warn', count(*) FILTER (flag = 'A'),
           count(*) - count(*) FILTER (flag = 'A') FROM lines
    UNION ALL SELECT 'lines', 'has_item', 'fail', count(*), 0 FROM lines""", "lines"))
def _(spark, sf):
    return expect(d.lines(spark, sf), RULES, "lines")[1]


@query("audit_rows", "Q3", "Q5", sql=check("""
    SELECT * FROM (
        SELECT 'orders: future date' AS check, count(*) AS violation_count FROM sales WHERE order_date > DATE '2001-06-01'
        UNION ALL SELECT 'orders: no amount', count(*) FROM sales WHERE amount IS NULL OR amount <= 0
        UNION ALL SELECT 'orders: empty', CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM sales
        UNION ALL SELECT 'giants: empty', CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM sales WHERE amount > 10000000)
    WHERE violation_count > 0""", "sales"))
def _(spark, sf):
    orders = d.orders(spark, sf)
    return audit([
        violations(orders, "orders: future date", "order_date > DATE'2001-06-01'"),
        violations(orders, "orders: no amount", "amount IS NULL OR amount <= 0"),
        is_empty(orders, "orders: empty"),
        is_empty(orders.where("amount > 10000000"), "giants: empty")])
