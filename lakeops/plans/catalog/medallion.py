"""The medallion datasets over the given tables."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions.columns import money
from lakeops.operators.cdc import apply_scd1, scd1_rows
from lakeops.plans import domain as d
from lakeops.plans import medallion as m
from lakeops.plans.catalog.cleaning import _CODE_SQL, _REGION_SQL, _coded_customers
from lakeops.plans.domain import check, table
from lakeops.plans.registry import query
from lakeops.session import scratch_path

_AVG = "CAST(sum(amount) AS DOUBLE) / count(amount)"


def bronze_customers(spark, sf):
    """Raw customers: padded names, mixed-case emails (some broken), raw country codes."""
    broken = F.col("c_mktsegment") == "MACHINERY"
    raw = _coded_customers(spark, sf)
    return raw.select(
        F.col("c_custkey").alias("customer_id"), F.concat(F.lit(" "), "c_name").alias("name"),
        F.when(broken, F.lit("no-address")).otherwise(
            F.concat(F.lit("User"), F.col("c_custkey").cast("string"), F.lit("@Example.COM ")))
        .alias("email"),
        "country", F.lit("2025-01-15").alias("signup_date"), F.col("c_mktsegment").alias("tier"))


_CUSTOMERS = f"""silver_customers AS (
    SELECT customer_id, name, email, code AS country, {_REGION_SQL} AS region, '2025-01-15' AS signup_date, tier
    FROM (SELECT c_custkey AS customer_id, upper(left(c_name, 1)) || lower(substr(c_name, 2)) AS name,
                 'user' || c_custkey || '@example.com' AS email, upper(trim({_CODE_SQL})) AS code,
                 c_mktsegment AS tier, c_mktsegment <> 'MACHINERY' AS ok FROM customer) WHERE ok)"""


def bronze_orders(spark, sf):
    """Raw orders with nested items; large amounts are entered as negative corrections."""
    status = (F.when(F.col("status") == "F", "Delivered").when(F.col("status") == "O", "PLACED")
              .otherwise("unknown"))
    return d.nested_orders(spark, sf).select(
        "order_id", "customer_id", "order_ts", status.alias("status"), F.lit("eur").alias("currency"),
        F.when(F.col("amount") > 450000, -F.col("amount")).otherwise(F.col("amount")).alias("amount"),
        "items")


_ORDERS = """silver_orders AS (
    SELECT order_id, customer_id, order_ts, order_date,
           CASE status WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'placed' ELSE 'unknown' END AS status,
           'EUR' AS currency, amount FROM sales WHERE amount <= 450000 AND amount > 0)"""


@query("silver_customers", "D1", sql=f"WITH {_CUSTOMERS} SELECT * FROM silver_customers")
def _(spark, sf):
    return m.silver_customers(bronze_customers(spark, sf))


@query("silver_orders", "D2", sql=check(f"""
    WITH {_ORDERS} SELECT order_id, customer_id, CAST(order_date AS VARCHAR) AS order_date, status, currency,
        CAST(amount AS DOUBLE) AS amount, 0.0::DOUBLE AS discount_amount FROM silver_orders""", "sales"))
def _(spark, sf):
    return m.silver_orders(bronze_orders(spark, sf)).drop("order_ts")


@query("silver_order_items", "D3", sql=check("""
    SELECT order_id, customer_id, CAST(order_date AS VARCHAR) AS order_date, item_id, quantity,
           CAST(unit_price AS DOUBLE) AS unit_price, CAST(quantity * unit_price AS DOUBLE) AS line_total,
           'eur' AS currency FROM nested_lines WHERE quantity > 0""", "nested_lines"))
def _(spark, sf):
    return m.silver_order_items(bronze_orders(spark, sf)).drop("order_ts")


@query("silver_items", "D4", sql="""
    SELECT p_partkey AS item_id, array_to_string(list_transform(string_split(p_name, ' '),
               lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ') AS name,
           lower(p_type) AS category, CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS price,
           p_size > 10 AS in_stock FROM part""")
def _(spark, sf):
    return m.silver_items(table(spark, sf, "part").select(
        F.col("p_partkey").alias("item_id"), F.upper("p_name").alias("name"),
        F.col("p_type").alias("category"), money("p_retailprice").alias("price"),
        (F.col("p_size") > 10).alias("in_stock")))


@query("gold_daily_revenue", "D5", sql=check(f"""
    WITH {_CUSTOMERS}, {_ORDERS}
    SELECT CAST(order_date AS VARCHAR) AS order_date, region, count(DISTINCT order_id) AS orders,
           CAST(sum(amount) AS DOUBLE) AS revenue, {_AVG} AS avg_order_amount
    FROM silver_orders JOIN silver_customers USING (customer_id) GROUP BY ALL""", "sales"))
def gold_daily_revenue(spark, sf):
    return m.gold_daily_revenue(m.silver_orders(bronze_orders(spark, sf)),
                                m.silver_customers(bronze_customers(spark, sf)))


@query("gold_daily_revenue_by_geography", "D5", "J16", sql=check(f"""
    SELECT CAST(order_date AS VARCHAR) AS order_date, region, count(DISTINCT order_id) AS orders,
           CAST(sum(amount) AS DOUBLE) AS revenue, {_AVG} AS avg_order_amount
    FROM sales JOIN customers USING (customer_id) GROUP BY ALL""", "sales", "customers"))
def gold_daily_revenue_by_geography(spark, sf):
    return m.gold_daily_revenue(d.orders(spark, sf), d.customers(spark, sf))


@query("gold_top_10_customers", "D6", sql=check(f"""
    WITH {_CUSTOMERS}, {_ORDERS}, spend AS (
        SELECT customer_id, name, region, count(DISTINCT order_id) AS lifetime_orders, sum(amount) AS s
        FROM silver_orders JOIN silver_customers USING (customer_id) GROUP BY ALL)
    SELECT customer_id, name, region, lifetime_orders, CAST(s AS DOUBLE) AS lifetime_spend, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY region ORDER BY s DESC, customer_id) AS rank FROM spend)
    WHERE rank <= 10""", "sales"))
def _(spark, sf):
    return m.gold_top_10_customers(m.silver_orders(bronze_orders(spark, sf)),
                                   m.silver_customers(bronze_customers(spark, sf)))


_TOP_ITEMS = """sold AS (
        SELECT item_id, name, category, sum(quantity)::BIGINT AS units_sold, sum(line_total) AS r
        FROM lines JOIN items USING (item_id) GROUP BY ALL),
    top_items AS (SELECT * FROM (SELECT *,
        row_number() OVER (PARTITION BY category ORDER BY r DESC, item_id) AS rank_revenue,
        row_number() OVER (PARTITION BY category ORDER BY units_sold DESC, item_id) AS rank_units FROM sold)
        WHERE rank_revenue <= 10 OR rank_units <= 10)"""


@query("gold_top_10_items", "D7", sql=check(f"""
    WITH {_TOP_ITEMS}
    SELECT item_id, name, category, units_sold, CAST(r AS DOUBLE) AS revenue, rank_revenue, rank_units
    FROM top_items""", "lines", "items"))
def _(spark, sf):
    return m.gold_top_10_items(d.lines(spark, sf), d.items(spark, sf))


@query("region_report_daily", "D8", "G5", sql=check(f"""
    SELECT CAST(order_date AS VARCHAR) AS order_date, count(DISTINCT order_id) AS orders,
           CAST(sum(amount) AS DOUBLE) AS revenue, {_AVG} AS avg_order_amount
    FROM sales JOIN customers USING (customer_id) WHERE region = 'ASIA' GROUP BY order_date""",
    "sales", "customers"))
def _(spark, sf):
    daily = gold_daily_revenue_by_geography(spark, sf)
    top = m.gold_top_10_customers(d.orders(spark, sf), d.customers(spark, sf))
    return m.region_report(daily, top, "ASIA")["daily"]


@query("region_summaries", "D8", sql=check("""
    WITH daily AS (SELECT order_date, region, count(DISTINCT order_id) AS o, sum(amount) AS r
                   FROM sales JOIN customers USING (customer_id) GROUP BY ALL)
    SELECT region, count(*) AS days, sum(o)::BIGINT AS orders, CAST(sum(r) AS DOUBLE) AS revenue,
           region || ': revenue of ' || sum(r)::DECIMAL(38,2)::VARCHAR || ' from ' || sum(o)::BIGINT || ' orders on '
               || count(*) || ' days' AS summary
    FROM daily GROUP BY region""", "sales", "customers"))
def _(spark, sf):
    return m.region_summaries(gold_daily_revenue_by_geography(spark, sf))


def _items_bronze(parts):
    return parts.select(
        F.concat(F.lit("I"), F.col("p_partkey").cast("string")).alias("item_id"),
        F.col("p_name").alias("name"), F.col("p_type").alias("category"),
        money("p_retailprice").alias("price"), F.lit(True).alias("in_stock"))


def _dataset_sizes(datasets):
    names = ["silver_customers", "silver_orders", "silver_order_items", "silver_items",
             "gold_daily_revenue"]
    return reduce(DataFrame.union, [
        datasets[n].agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("dataset"), "n")
        for n in names])


_SIZES = check(f"""
    WITH {_CUSTOMERS}, {_ORDERS}
    SELECT 'silver_customers' AS dataset, count(*) AS n FROM silver_customers
    UNION ALL SELECT 'silver_orders', count(*) FROM silver_orders
    UNION ALL SELECT 'silver_order_items', count(*) FROM nested_lines WHERE quantity > 0
    UNION ALL SELECT 'silver_items', count(*) FROM part
    UNION ALL SELECT 'gold_daily_revenue', count(*) FROM (
        SELECT DISTINCT order_date, region FROM silver_orders JOIN silver_customers USING (customer_id))""",
    "nested_lines")


@query("medallion_refresh", "D9", "Q3", sql=_SIZES)
def _(spark, sf):
    return _dataset_sizes(m.run_medallion({
        "customers": bronze_customers(spark, sf), "orders": bronze_orders(spark, sf),
        "items": _items_bronze(table(spark, sf, "part"))},
        scratch_path(spark, "medallion"), "2030-01-01"))


@query("medallion_incremental", "D9", "T3", "S10", sql=_SIZES)
def _(spark, sf):
    # Bronze feeds land as files; two refreshes, the second of which finds nothing new.
    land, out = scratch_path(spark, "landing"), scratch_path(spark, "medallion")
    feeds = {"customers": bronze_customers(spark, sf), "orders": bronze_orders(spark, sf),
             "items": _items_bronze(table(spark, sf, "part"))}
    places = {}
    for name, feed in feeds.items():
        feed.write.parquet(f"{land}/{name}")
        places[name] = m.Landing(f"{land}/{name}", "parquet", feed.schema)
    m.refresh_medallion(spark, places, out, "2030-01-01")
    return _dataset_sizes(m.refresh_medallion(spark, places, out, "2030-01-01"))


def _fed_in_two_parts(spark, sf):
    """Most customers and orders, a refresh, then the others, and a refresh that follows them."""
    land, out = scratch_path(spark, "landing"), scratch_path(spark, "medallion")
    items = _items_bronze(table(spark, sf, "part"))
    items.write.parquet(f"{land}/items")
    feeds = {"customers": (bronze_customers(spark, sf), "customer_id % 10 = 3"),
             "orders": (bronze_orders(spark, sf), "order_id % 50 = 7")}
    places = {n: m.Landing(f"{land}/{n}", "parquet", feed.schema) for n, (feed, _) in feeds.items()}
    places["items"] = m.Landing(f"{land}/items", "parquet", items.schema)
    for part in ("NOT ({})", "{}"):
        for name, (feed, late) in feeds.items():
            feed.where(part.format(late)).write.mode("append").parquet(f"{land}/{name}")
        datasets = m.refresh_medallion(spark, places, out, "2030-01-01")
    return datasets


@query("gold_daily_revenue_followed", "D5", "D9", sql=check(f"""
    WITH {_CUSTOMERS}, {_ORDERS}
    SELECT CAST(order_date AS VARCHAR) AS order_date, region, count(DISTINCT order_id) AS orders,
           CAST(sum(amount) AS DOUBLE) AS revenue, {_AVG} AS avg_order_amount
    FROM silver_orders JOIN silver_customers USING (customer_id) GROUP BY ALL""", "sales"))
def _(spark, sf):
    return _fed_in_two_parts(spark, sf)["gold_daily_revenue"]


@query("gold_rankings_followed", "D6", "D7", "D9", sql=check(f"""
    WITH {_CUSTOMERS}, {_ORDERS}, spend AS (
        SELECT customer_id, region, count(DISTINCT order_id) AS n, sum(amount) AS s
        FROM silver_orders JOIN silver_customers USING (customer_id) GROUP BY ALL),
    best AS (SELECT *, row_number() OVER (PARTITION BY region ORDER BY s DESC, customer_id) AS rank FROM spend),
    sold AS (SELECT l.item_id, p_type AS category, sum(quantity)::BIGINT AS u,
                    sum(quantity * unit_price) AS r FROM nested_lines l JOIN part ON l.item_id = 'I' || p_partkey
             WHERE quantity > 0 GROUP BY ALL),
    top_items AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY r DESC, item_id) AS rr,
                         row_number() OVER (PARTITION BY category ORDER BY u DESC, item_id) AS ru FROM sold)
    SELECT 'customer' AS kind, CAST(customer_id AS VARCHAR) AS id, n, CAST(s AS DOUBLE) AS total, rank AS place, rank AS other
    FROM best WHERE rank <= 10
    UNION ALL SELECT 'item', item_id, u, CAST(r AS DOUBLE), rr, ru FROM top_items WHERE rr <= 10 OR ru <= 10""", "sales", "nested_lines"))
def _(spark, sf):
    gold = _fed_in_two_parts(spark, sf)
    return gold["gold_top_10_customers"].select(
        F.lit("customer").alias("kind"), F.col("customer_id").cast("string").alias("id"), F.col("lifetime_orders").alias("n"),
        F.col("lifetime_spend").cast("double").alias("total"), F.col("rank").alias("place"), F.col("rank").alias("other")).union(
        gold["gold_top_10_items"].select(
            F.lit("item"), "item_id", "units_sold", F.col("revenue").cast("double"), "rank_revenue", "rank_units"))


@query("units_per_title", "D10", sql=check("""
    SELECT i.name AS title, count(*) AS n, sum(n.quantity)::BIGINT AS quantity
    FROM nested_lines n JOIN items i ON n.item_id = 'I' || i.item_id GROUP BY ALL""",
    "nested_lines", "items"))
def _(spark, sf):
    # Units are summed per item before the titles are joined.
    units = (d.nested_orders(spark, sf).select(F.inline("items")).groupBy("item_id")
             .agg(F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("quantity")))
    titles = d.items(spark, sf).select(
        F.concat(F.lit("I"), F.col("item_id").cast("string")).alias("item_id"),
        F.col("name").alias("title"))
    return units.join(titles, "item_id").groupBy("title").agg(
        F.sum("n").alias("n"), F.sum("quantity").alias("quantity"))


@query("cdc_to_aggregate", "M9", "A16", sql="""
    SELECT event_type, count(*) AS n FROM (
        SELECT event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events)
    WHERE rn = 1 AND event_type <> 'error' GROUP BY event_type""")
def _(spark, sf):
    events = d.events(spark, sf).select("user_id", "event_type", "ts")
    state = apply_scd1(events, ["user_id"], "ts", "event_type = 'error'", ["ts"])
    return scd1_rows(state).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
