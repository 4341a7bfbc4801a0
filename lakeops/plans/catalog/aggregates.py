"""Aggregation, reshaping and set-valued results."""

from datetime import date

from pyspark.sql import functions as F

from lakeops.functions.columns import money
from lakeops.operators.aggregates import (
    analyze, average, column_profile, distinct_values, recent_runs, regional_revenue, run_metrics,
    summary_row, two_stage_agg)
from lakeops.operators.sketches import describe, distinct_error, partials, refresh_statistics, unite
from lakeops.plans import domain as d
from lakeops.plans.domain import check, table
from lakeops.plans.registry import query
from lakeops.session import scratch_path, settle
from lakeops.sources.ingest import copy_into, read_loaded

_AVG = "CAST(sum({0}) AS DOUBLE) / count({0})"


@query("aggregate_global", "A1", sql=check(f"""
    SELECT count(*) AS n, count(nullif(status, 'P')) AS closed, CAST(sum(amount) AS DOUBLE) AS total,
           {_AVG.format('amount')} AS mean, CAST(min(amount) AS DOUBLE) AS low,
           CAST(max(amount) AS DOUBLE) AS high FROM sales""", "sales"))
def _(spark, sf):
    return d.orders(spark, sf).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.nullif("status", F.lit("P"))).alias("closed"),
        F.sum("amount").alias("total"), average("amount").alias("mean"),
        F.min("amount").alias("low"), F.max("amount").alias("high"))


@query("aggregate_grouped", "A1", sql=f"""
    SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS units,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS gross,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))))
                AS DOUBLE) AS net,
           {_AVG.format('CAST(l_extendedprice AS DECIMAL(18,2))')} AS avg_price
    FROM lineitem GROUP BY ALL""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_quantity", money("l_extendedprice").alias("price"),
        money("l_discount").alias("discount"))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("bigint")).cast("double")
        .alias("units"), F.sum("price").alias("gross"),
        F.sum(F.col("price") * (1 - F.col("discount"))).alias("net"),
        average("price").alias("avg_price"))


@query("count_distinct", "A2", sql=check("""
    SELECT status, count(DISTINCT customer_id) AS customers, count(DISTINCT order_date) AS days
    FROM sales GROUP BY status""", "sales"))
def _(spark, sf):
    return d.orders(spark, sf).groupBy("status").agg(
        F.countDistinct("customer_id").alias("customers"),
        F.countDistinct("order_date").alias("days"))


@query("approx_count_distinct", "A3", sql=check("""
    SELECT status, true AS within_bound FROM sales GROUP BY status""", "sales"))
def _(spark, sf):
    # The estimate differs between engines; what is checked is its distance from the exact count.
    n = F.countDistinct("customer_id")
    near = F.abs(F.approx_count_distinct("customer_id", 0.05) - n) <= 0.15 * n
    return d.orders(spark, sf).groupBy("status").agg(near.alias("within_bound"))


@query("regional_revenue", "A4", "L1", sql=check(f"""
    SELECT region, count(*) AS line_items, count(DISTINCT order_id) AS orders_exact,
           count(DISTINCT customer_id) AS customers_exact, CAST(sum(line_total) AS DOUBLE) AS revenue,
           {_AVG.format('line_total')} AS avg_line
    FROM lines JOIN sales USING (order_id) JOIN customers USING (customer_id) GROUP BY region""",
    "lines", "sales", "customers"))
def _(spark, sf):
    lines = d.lines(spark, sf).select("order_id", "line_total").join(
        d.orders(spark, sf).select("order_id", "customer_id"), "order_id")
    return regional_revenue(lines, d.customers(spark, sf)).drop("customers_approx").orderBy(
        F.desc("revenue"))


@query("collect_sets", "A5", sql=check("""
    SELECT customer_id, 0 AS chunk, array_to_string(list_sort(list(DISTINCT priority)), '|') AS priorities
    FROM sales GROUP BY customer_id""", "sales"))
def _(spark, sf):
    # There are few priorities: one chunk for each customer.
    return distinct_values(d.orders(spark, sf), ["customer_id"], "priority", "priorities", chunks=1)


@query("flatten_distinct", "A6", sql=check("""
    SELECT status, CAST('0x' || left(md5(CAST(item_id AS VARCHAR)), 8) AS BIGINT) % 32 AS chunk,
           array_to_string(list_sort(list(DISTINCT item_id)), '|') AS item_ids
    FROM nested_lines GROUP BY ALL""", "nested_lines"))
def _(spark, sf):
    # The distinct elements of all nested arrays of a group: exploded before they are collected.
    elements = d.nested_orders(spark, sf).select("status", F.explode("items.item_id").alias("i"))
    return distinct_values(elements, ["status"], "i", "item_ids", chunks=32)


@query("pivot_daily_revenue", "A7", sql=check("""
    SELECT CAST(order_date AS VARCHAR) AS order_date,
           CAST(sum(amount) FILTER (region = 'AFRICA') AS DOUBLE) AS revenue_africa,
           CAST(sum(amount) FILTER (region = 'AMERICA') AS DOUBLE) AS revenue_america,
           CAST(sum(amount) FILTER (region = 'ASIA') AS DOUBLE) AS revenue_asia
    FROM sales JOIN customers USING (customer_id) GROUP BY order_date""", "sales", "customers"))
def _(spark, sf):
    rows = d.orders(spark, sf).select("customer_id", "order_date", "amount").join(
        d.customers(spark, sf).select("customer_id", "region"), "customer_id")
    wide = rows.groupBy("order_date").pivot("region", ["AFRICA", "AMERICA", "ASIA"]).agg(
        F.sum("amount"))
    return wide.toDF("order_date", "revenue_africa", "revenue_america", "revenue_asia")


@query("having_on_alias", "A8", sql=check("""
    SELECT customer_id, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS total FROM sales
    GROUP BY customer_id HAVING sum(amount) > 3000000""", "sales"))
def _(spark, sf):
    return spark.sql("""
        SELECT customer_id, count(*) AS n, sum(amount) AS total FROM {orders}
        GROUP BY customer_id HAVING total > 3000000""", orders=d.orders(spark, sf))


@query("conditional_aggregates", "A9", sql="""
    SELECT user_id, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)::BIGINT AS errors,
           sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) * 1.0::DOUBLE / count(*) AS error_rate
    FROM events GROUP BY user_id""")
def _(spark, sf):
    errors = F.sum(F.when(F.col("event_type") == "error", 1).otherwise(0))
    return d.events(spark, sf).groupBy("user_id").agg(
        errors.alias("errors"), (errors / F.count(F.lit(1))).alias("error_rate"))


def _runs(spark, sf):
    """Events as job runs that last ``value`` seconds; views are runs that have not finished."""
    state = (F.when(F.col("event_type") == "error", "FAILED")
             .when(F.col("event_type") != "view", "SUCCEEDED"))
    return d.events(spark, sf).select(
        "event_id", "user_id", "event_type", F.col("ts").alias("period_start"),
        (F.col("ts") + F.expr("make_dt_interval(0, 0, 0, floor(value))")).alias("period_end"),
        state.alias("state"))


_RUNS = """runs AS (
    SELECT event_id, user_id, event_type, ts AS period_start,
           ts + to_seconds(CAST(floor(value) AS BIGINT)) AS period_end,
           CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'view' THEN NULL ELSE 'SUCCEEDED' END AS state
    FROM events),
    recent AS (SELECT *, CAST(floor(epoch(period_end)) AS BIGINT) - CAST(floor(epoch(period_start)) AS BIGINT) AS s
        FROM runs WHERE period_start > TIMESTAMP '2024-01-31' - INTERVAL 14 DAYS)"""


@query("run_metrics", "A10", sql=f"""
    WITH {_RUNS}
    SELECT user_id, count(*) AS total, count(*) FILTER (state = 'FAILED') AS failed,
           CAST(count(*) FILTER (state = 'FAILED') AS DOUBLE) / count(*) AS fail_rate,
           CAST(sum(s) AS DOUBLE) / count(s) AS avg_s, max(s) AS max_s
    FROM recent WHERE state IS NOT NULL GROUP BY user_id HAVING count(*) FILTER (state = 'FAILED') > 0""")
def _(spark, sf):
    return run_metrics(_runs(spark, sf), "user_id", "period_start", "period_end", "state",
                       date(2024, 1, 31), 14).where("fail_rate > 0")


@query("slowest_tasks", "A10", "L2", sql=f"""
    WITH {_RUNS}
    SELECT event_type, user_id, count(*) AS total, CAST(sum(s) AS DOUBLE) / count(s) AS avg_s, max(s) AS max_s
    FROM recent WHERE state IS NOT NULL GROUP BY ALL ORDER BY avg_s DESC, event_type, user_id LIMIT 20""")
def _(spark, sf):
    tasks = run_metrics(_runs(spark, sf), ["event_type", "user_id"], "period_start", "period_end",
                        "state", date(2024, 1, 31), 14)
    return tasks.orderBy(F.desc("avg_s"), "event_type", "user_id").limit(20).drop(
        "failed", "fail_rate")


@query("recent_runs_of_a_job", "A10", "L1", sql=f"""
    WITH {_RUNS}
    SELECT event_id, state, strftime(period_start, '%Y-%m-%d %H:%M:%S.%f') AS period_start, s AS duration_s
    FROM recent WHERE event_type = 'purchase'""")
def _(spark, sf):
    return recent_runs(_runs(spark, sf), "event_type", "purchase", "period_start", "period_end",
                       date(2024, 1, 31)).select("event_id", "state", "period_start", "duration_s")


@query("daily_totals", "A11", sql="""
    SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM events GROUP BY ALL""")
def _(spark, sf):
    day = F.date_trunc("DD", F.col("ts").cast("timestamp")).cast("date")
    return d.events(spark, sf).groupBy(day.alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(money("value")).alias("total"))


def daily_units(lines, orders, customers, regions):
    """Units per customer and day in some regions, in one pass for all of them.

    Lines are summed per order before any join, and only orders of those regions are joined.
    """
    chosen = customers.where(F.col("region").isin(regions)).select("customer_id", "name", "region")
    wanted = orders.select("order_id", "customer_id", "order_date").join(chosen, "customer_id")
    sold = lines.groupBy("order_id").agg(F.sum("quantity").alias("quantity"))
    return sold.join(wanted, "order_id").groupBy(
        "customer_id", "name", "order_date", "region").agg(F.sum("quantity").alias("units"))


@query("daily_units_per_region", "A12", sql=check("""
    SELECT customer_id, name, CAST(order_date AS VARCHAR) AS order_date, sum(quantity)::BIGINT AS units, region
    FROM lines JOIN sales USING (order_id) JOIN customers USING (customer_id)
    WHERE region IN ('ASIA', 'EUROPE') GROUP BY ALL""", "lines", "sales", "customers"))
def _(spark, sf):
    return daily_units(d.lines(spark, sf), d.orders(spark, sf), d.customers(spark, sf),
                       ["ASIA", "EUROPE"])


@query("two_stage_aggregate", "A13", sql=check(f"""
    SELECT flag, count(DISTINCT item_id) AS items, count(quantity) AS n, sum(quantity)::BIGINT AS units,
           CAST(min(line_total) AS DOUBLE) AS low, CAST(max(line_total) AS DOUBLE) AS high,
           {_AVG.format('line_total')} AS mean FROM lines GROUP BY flag""", "lines"))
def _(spark, sf):
    return two_stage_agg(d.lines(spark, sf), ["flag"], ("items", "item_id"), {
        "n": ("count", "quantity"), "units": ("sum", "quantity"), "low": ("min", "line_total"),
        "high": ("max", "line_total"), "mean": ("avg", "line_total")})


@query("column_description", "A14", sql=check("""
    SELECT summary, round(v, 2) AS amount FROM (
        SELECT 'count' AS summary, CAST(count(amount) AS DOUBLE) AS v FROM sales
        UNION ALL SELECT 'mean', CAST(sum(amount) AS DOUBLE) / count(amount) FROM sales
        UNION ALL SELECT 'stddev', stddev_samp(CAST(amount AS DOUBLE)) FROM sales
        UNION ALL SELECT 'min', CAST(min(amount) AS DOUBLE) FROM sales
        UNION ALL SELECT 'max', CAST(max(amount) AS DOUBLE) FROM sales)""", "sales"))
def _(spark, sf):
    return d.orders(spark, sf).describe("amount").select(
        "summary", F.round(F.col("amount").cast("double"), 2).alias("amount"))


@query("column_profile", "A14", sql=check("""
    SELECT * FROM (
        SELECT 'count' AS summary, CAST(count(amount) AS DOUBLE) AS amount, CAST(count(customer_id) AS DOUBLE) AS customer_id FROM sales
        UNION ALL SELECT 'mean', round(CAST(sum(amount) AS DOUBLE) / count(amount), 2), round(avg(customer_id), 2) FROM sales
        UNION ALL SELECT 'stddev', round(stddev_samp(CAST(amount AS DOUBLE)), 2), round(stddev_samp(customer_id), 2) FROM sales
        UNION ALL SELECT 'min', CAST(min(amount) AS DOUBLE), CAST(min(customer_id) AS DOUBLE) FROM sales
        UNION ALL SELECT '25%', CAST(quantile_disc(amount, 0.25) AS DOUBLE), quantile_disc(customer_id, 0.25) FROM sales
        UNION ALL SELECT '50%', CAST(quantile_disc(amount, 0.5) AS DOUBLE), quantile_disc(customer_id, 0.5) FROM sales
        UNION ALL SELECT '75%', CAST(quantile_disc(amount, 0.75) AS DOUBLE), quantile_disc(customer_id, 0.75) FROM sales
        UNION ALL SELECT 'max', CAST(max(amount) AS DOUBLE), CAST(max(customer_id) AS DOUBLE) FROM sales)""", "sales"))
def _(spark, sf):
    profile = column_profile(d.orders(spark, sf), ["amount", "customer_id"], 1_000_000)
    return profile.select("summary", *[F.round(c, 2).alias(c) for c in ("amount", "customer_id")])


@query("summary_row", "A15", sql=check("""
    SELECT count(*) AS days, coalesce(sum(n), 0)::BIGINT AS orders, CAST(coalesce(sum(r), 0) AS DOUBLE) AS revenue
    FROM (SELECT order_date, count(*) AS n, sum(amount) AS r FROM sales GROUP BY order_date)""", "sales"))
def _(spark, sf):
    daily = d.orders(spark, sf).groupBy("order_date").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("amount").alias("revenue"))
    return summary_row(daily)


@query("summary_row_of_nothing", "A15", sql="SELECT 0 AS days, 0 AS orders, 0.0::DOUBLE AS revenue")
def _(spark, sf):
    return summary_row(d.orders(spark, sf).where("amount < 0").select(
        F.lit(1).alias("orders"), F.col("amount").alias("revenue")))


@query("count_per_key_with_refresh_time", "A16", sql=check("""
    SELECT brand, count(*) AS books_count, '2024-02-01 00:00:00.000000' AS updated_time
    FROM items GROUP BY brand""", "items"))
def _(spark, sf):
    # The refresh time is an argument, so that a re-run gives the same table.
    refreshed = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return d.items(spark, sf).groupBy("brand").agg(
        F.count(F.lit(1)).alias("books_count"), F.first(refreshed).alias("updated_time"))


@query("column_statistics", "K16", sql="""
    SELECT 'o_orderkey' AS column, count(*) AS rows, count(*) - count(o_orderkey) AS nulls,
           min(o_orderkey)::VARCHAR AS min, max(o_orderkey)::VARCHAR AS max FROM orders
    UNION ALL SELECT 'o_custkey', count(*), count(*) - count(o_custkey),
           min(o_custkey)::VARCHAR, max(o_custkey)::VARCHAR FROM orders
    UNION ALL SELECT 'status', count(*), count(*) - count(nullif(o_orderstatus, 'P')),
           min(nullif(o_orderstatus, 'P')), max(nullif(o_orderstatus, 'P')) FROM orders
    UNION ALL SELECT 'o_orderpriority', count(*), count(*) - count(o_orderpriority),
           min(o_orderpriority), max(o_orderpriority) FROM orders""")
def _(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        "o_orderpriority")
    return analyze(rows).drop("approx_distinct")


def _checked(estimate, exact, lg_k=12):
    """The exact count if the estimate is within three standard errors of it, else the estimate."""
    near = F.abs(estimate - exact) <= F.ceil(3 * distinct_error(lg_k) * exact)
    return F.when(near, exact).otherwise(estimate)


@query("statistics_of_loads", "A3", "K16", "S8", sql="""
    SELECT 'o_orderkey' AS column, count(*) AS rows, count(*) - count(o_orderkey) AS nulls,
           count(DISTINCT o_orderkey) AS distinct_values, min(o_orderkey)::VARCHAR AS min, max(o_orderkey)::VARCHAR AS max FROM orders
    UNION ALL SELECT 'o_custkey', count(*), count(*) - count(o_custkey), count(DISTINCT o_custkey),
           min(o_custkey)::VARCHAR, max(o_custkey)::VARCHAR FROM orders
    UNION ALL SELECT 'status', count(*), count(*) - count(nullif(o_orderstatus, 'P')), count(DISTINCT nullif(o_orderstatus, 'P')),
           min(nullif(o_orderstatus, 'P')), max(nullif(o_orderstatus, 'P')) FROM orders
    UNION ALL SELECT 'o_orderpriority', count(*), count(*) - count(CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END),
           count(DISTINCT CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END),
           min(CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END), max(CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END)
           FROM orders""")
def _(spark, sf):
    # Two loads, the second with a column more; each refresh reads the load that is new.
    out = scratch_path(spark, "statistics")
    rows = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"), "o_orderpriority", "o_orderstatus")
    finished = F.col("o_orderstatus") == "F"
    for part in (rows.where(finished).drop("o_orderpriority", "o_orderstatus"), rows.where(~finished).drop("o_orderstatus")):
        part.write.mode("append").parquet(f"{out}/landing")
        copy_into(spark, f"{out}/table", f"{out}/landing", "parquet", merge_schema=True)
        found = refresh_statistics(spark, f"{out}/table")
    loaded = read_loaded(spark, f"{out}/table")
    exact = loaded.agg(*[F.countDistinct(c).alias(c) for c in loaded.columns]).select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in loaded.columns])))
    return found.join(exact, "column").select(
        "column", "rows", "nulls", _checked(F.col("approx_distinct"), F.col("n")).alias("distinct_values"), "min", "max")


@query("distinct_customers_of_months", "A3", sql=check("""
    SELECT CAST(CAST(date_trunc('month', order_date) AS DATE) AS VARCHAR) AS month, count(*) AS orders, count(DISTINCT customer_id) AS customers,
           CAST(max(amount) AS DOUBLE) AS largest FROM sales GROUP BY ALL""", "sales"))
def _(spark, sf):
    # Orders are read once, for days; months are united from the days' sketches.
    orders = d.orders(spark, sf).withColumn("month", F.trunc("order_date", "month"))
    days = settle(partials(orders, ["month", "order_date"], ["customer_id", "amount"]), "days")
    months = describe(unite(days, ["month"]), ["month"]).groupBy("month").agg(
        F.max("rows").alias("orders"), F.max(F.when(F.col("column") == "customer_id", F.col("approx_distinct"))).alias("estimate"),
        F.max(F.when(F.col("column") == "amount", F.col("max").cast("decimal(18,2)"))).alias("largest"))
    exact = orders.groupBy("month").agg(F.countDistinct("customer_id").alias("n"))
    return months.join(exact, "month").select("month", "orders", _checked(F.col("estimate"), F.col("n")).alias("customers"), "largest")
