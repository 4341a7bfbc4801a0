"""Window functions, sorting and top-k."""

from pyspark.sql import functions as F

from lakeops.operators.ordering import top_k
from lakeops.operators.windows import ordered_features, rank_within, top_k_any
from lakeops.plans import domain as d
from lakeops.plans.domain import check
from lakeops.plans.registry import query


def spend_timeline(orders):
    """Every order of a customer with its number, running and total spend, and the one before."""
    rows = orders.select("customer_id", "order_id", "order_ts", "amount").distinct()
    return ordered_features(rows, ["customer_id"], ["order_ts", "order_id"], {
        "running_spend": ("running_sum", "amount"), "total_spend": ("total", "amount"),
        "order_seq": ("row_number",), "prev_amount": ("lag", "amount")})


@query("spend_timeline", "W1", "W2", "W3", "W4", "W6", "W7", sql=check("""
    SELECT customer_id, order_id, strftime(order_ts, '%Y-%m-%d %H:%M:%S.%f') AS order_ts,
           CAST(amount AS DOUBLE) AS amount, CAST(sum(amount) OVER w AS DOUBLE) AS running_spend,
           CAST(sum(amount) OVER g AS DOUBLE) AS total_spend, row_number() OVER s AS order_seq,
           CAST(lag(amount) OVER s AS DOUBLE) AS prev_amount
    FROM (SELECT DISTINCT customer_id, order_id, order_ts, amount FROM sales)
    WINDOW w AS (PARTITION BY customer_id ORDER BY order_ts),
           s AS (PARTITION BY customer_id ORDER BY order_ts, order_id),
           g AS (PARTITION BY customer_id)""", "sales"))
def _(spark, sf):
    return spend_timeline(d.orders(spark, sf))


@query("event_timeline_split", "W1", "W2", "W3", "W4", sql="""
    SELECT event_id, event_type, row_number() OVER s AS seq, CAST(sum(v) OVER w AS DOUBLE) AS running,
           CAST(sum(v) OVER g AS DOUBLE) AS total, CAST(lag(v) OVER s AS DOUBLE) AS prev
    FROM (SELECT event_id, event_type, ts, CAST(value AS DECIMAL(18,2)) AS v FROM events)
    WINDOW w AS (PARTITION BY event_type ORDER BY ts), g AS (PARTITION BY event_type),
           s AS (PARTITION BY event_type ORDER BY ts, event_id)""")
def _(spark, sf):
    rows = d.events(spark, sf).select(
        "event_id", "event_type", "ts", F.col("value").cast("decimal(18,2)").alias("v"))
    return ordered_features(rows, ["event_type"], ["ts", "event_id"], {
        "seq": ("row_number",), "running": ("running_sum", "v"), "total": ("total", "v"),
        "prev": ("lag", "v")}, 40).drop("ts", "v")


@query("rank_orders_in_region", "W5", sql=check("""
    SELECT customer_id, region, order_id, CAST(amount AS DOUBLE) AS amount,
           rank() OVER w AS rnk, dense_rank() OVER w AS dense_rnk, percent_rank() OVER w AS pct
    FROM sales JOIN customers USING (customer_id)
    WINDOW w AS (PARTITION BY region ORDER BY amount DESC)""", "sales", "customers"))
def _(spark, sf):
    rows = d.orders(spark, sf).select("customer_id", "order_id", "amount").join(
        d.customers(spark, sf).select("customer_id", "region"), "customer_id")
    return rank_within(rows, ["region"], "-amount")


@query("window_over_aggregate", "W8", "W6", sql=check("""
    SELECT status, priority, n, CAST(total AS DOUBLE) AS total,
           row_number() OVER (PARTITION BY status ORDER BY total DESC, priority) AS rank_total,
           row_number() OVER (PARTITION BY status ORDER BY n DESC, priority) AS rank_n
    FROM (SELECT status, priority, count(*) AS n, sum(amount) AS total FROM sales GROUP BY ALL)""",
    "sales"))
def _(spark, sf):
    # The window runs over one row per (status, priority): fifteen rows at any scale.
    return spark.sql("""
        SELECT status, priority, n, total, row_number() OVER by_total AS rank_total,
               row_number() OVER by_n AS rank_n
        FROM (SELECT status, priority, count(*) AS n, sum(amount) AS total
              FROM {orders} GROUP BY status, priority)
        WINDOW by_total AS (PARTITION BY status ORDER BY total DESC, priority),
               by_n AS (PARTITION BY status ORDER BY n DESC, priority)""",
                     orders=d.orders(spark, sf))


@query("order_by_several_keys", "L1", sql=check("""
    SELECT region, country, count(*) AS n FROM customers GROUP BY ALL
    ORDER BY region, n DESC, country""", "customers"))
def _(spark, sf):
    return d.customers(spark, sf).groupBy("region", "country").agg(
        F.count(F.lit(1)).alias("n")).orderBy("region", F.desc("n"), "country")


@query("top_items", "L2", sql=check("""
    SELECT item_id, name, category, sum(quantity)::BIGINT AS units_sold, CAST(sum(line_total) AS DOUBLE) AS revenue
    FROM lines JOIN items USING (item_id) GROUP BY ALL
    ORDER BY sum(line_total) DESC, item_id LIMIT 10""", "lines", "items"))
def _(spark, sf):
    sold = d.lines(spark, sf).groupBy("item_id").agg(
        F.sum("quantity").alias("units_sold"), F.sum("line_total").alias("revenue"))
    # The ten rows are chosen before the names are looked up.
    best = sold.orderBy(F.desc("revenue"), "item_id").limit(10)
    return best.join(d.items(spark, sf).select("item_id", "name", "category"), "item_id")


@query("top_orders_per_customer", "L3", sql=check("""
    SELECT customer_id, order_id, CAST(amount AS DOUBLE) AS amount, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY amount DESC, order_id) AS rank
        FROM sales) WHERE rank <= 3""", "sales"))
def _(spark, sf):
    rows = d.orders(spark, sf).select("customer_id", "order_id", "amount")
    return top_k(rows, ["customer_id"], ["-amount", "order_id"], 3)


@query("top_by_either_ranking", "L4", sql=check("""
    SELECT * EXCLUDE (amount), CAST(amount AS DOUBLE) AS amount FROM (
        SELECT order_id, status, amount,
            row_number() OVER (PARTITION BY status ORDER BY amount DESC, order_id) AS rank_amount,
            row_number() OVER (PARTITION BY status ORDER BY customer_id, order_id) AS rank_customer
        FROM sales) WHERE rank_amount <= 10 OR rank_customer <= 10""", "sales"))
def _(spark, sf):
    rows = d.orders(spark, sf).select("order_id", "customer_id", "status", "amount")
    return top_k_any(rows, ["status"], {
        "rank_amount": ["-amount", "order_id"], "rank_customer": ["customer_id", "order_id"]},
        10).drop("customer_id")
