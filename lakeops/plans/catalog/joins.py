"""Joins."""

from pyspark.sql import functions as F

from lakeops.operators.cdc import changed_rows
from lakeops.operators.joins import broadcast_join, full_outer, salted_join
from lakeops.plans import domain as d
from lakeops.plans.domain import check
from lakeops.plans.registry import query


def _listed(spark, sf):
    """The whole catalogue under other numbers for small items, so that every outer and anti join
    has unmatched rows on both sides."""
    renumbered = F.when(F.col("size") > 25, F.col("item_id")).otherwise(-F.col("item_id"))
    return d.items(spark, sf).withColumn("item_id", renumbered)


_LISTED = """listed AS (SELECT * REPLACE (CASE WHEN size > 25 THEN item_id ELSE -item_id END AS item_id)
    FROM items)"""


@query("join_inner", "J1", sql=check(f"""
    WITH {_LISTED} SELECT order_id, item_id, supplier_id, name, category, CAST(line_total AS DOUBLE) AS line_total
    FROM lines JOIN listed USING (item_id)""", "lines", "items"))
def _(spark, sf):
    return d.lines(spark, sf).join(_listed(spark, sf), "item_id").select(
        "order_id", "item_id", "supplier_id", "name", "category", "line_total")


@query("join_left", "J2", sql=check(f"""
    WITH {_LISTED} SELECT name, count(*) AS n, count(category) AS found,
        CAST(sum(line_total) AS DOUBLE) AS revenue
    FROM lines LEFT JOIN listed USING (item_id) GROUP BY name""", "lines", "items"))
def _(spark, sf):
    rows = d.lines(spark, sf).join(_listed(spark, sf), "item_id", "left")
    return rows.groupBy("name").agg(
        F.count(F.lit(1)).alias("n"), F.count("category").alias("found"),
        F.sum("line_total").alias("revenue"))


@query("join_right", "J3", sql=check("""
    SELECT c.customer_id, c.name, count(o.order_id) AS n, count(DISTINCT o.order_id) AS orders
    FROM (SELECT order_id, CASE WHEN amount > 400000 THEN customer_id ELSE -customer_id END AS customer_id
          FROM sales) o RIGHT JOIN customers c USING (customer_id)
    GROUP BY ALL""", "sales", "customers"))
def _(spark, sf):
    # Orders of small amounts are booked on other numbers: rows without a match on both sides.
    booked = F.when(F.col("amount") > 400000, F.col("customer_id")).otherwise(-F.col("customer_id"))
    orders = d.orders(spark, sf).select("order_id", booked.alias("customer_id"))
    rows = orders.join(d.customers(spark, sf).select("customer_id", "name"), "customer_id", "right")
    return rows.groupBy("customer_id", "name").agg(
        F.count("order_id").alias("n"), F.countDistinct("order_id").alias("orders"))


@query("join_full_outer", "J4", sql=check(f"""
    WITH {_LISTED} SELECT i.item_id AS catalog_sku, o.item_id AS order_sku, i.name, o.order_id, o.supplier_id
    FROM listed i FULL OUTER JOIN lines o ON i.item_id = o.item_id""", "lines", "items"))
def _(spark, sf):
    sold = d.lines(spark, sf).select(F.col("item_id").alias("order_sku"), "order_id", "supplier_id")
    listed = _listed(spark, sf).select(F.col("item_id").alias("catalog_sku"), "name")
    return full_outer(sold, listed, "order_sku", "catalog_sku")


@query("join_left_semi", "J5", sql=check(f"""
    WITH {_LISTED} SELECT DISTINCT order_id FROM lines
    WHERE item_id IN (SELECT item_id FROM listed)""", "lines", "items"))
def _(spark, sf):
    return (d.lines(spark, sf).select("order_id", "item_id")
            .join(_listed(spark, sf), "item_id", "left_semi").select("order_id").distinct())


@query("join_left_anti", "J6", sql=check(f"""
    WITH {_LISTED} SELECT order_id, item_id, supplier_id, quantity FROM lines
    WHERE item_id NOT IN (SELECT item_id FROM listed)""", "lines", "items"))
def _(spark, sf):
    return (d.lines(spark, sf).select("order_id", "item_id", "supplier_id", "quantity")
            .join(_listed(spark, sf), "item_id", "left_anti"))


@query("dense_grid", "J7", sql=check("""
    WITH grid AS (SELECT r_name AS region, status FROM region,
                  (VALUES ('F'), ('O'), ('P'), ('X')) AS s(status)),
    facts AS (SELECT region, status, count(*) AS n FROM sales JOIN customers USING (customer_id)
              GROUP BY ALL)
    SELECT region, status, coalesce(n, 0) AS n FROM grid LEFT JOIN facts USING (region, status)""",
    "sales", "customers"))
def _(spark, sf):
    # Every region with every status of a declared list: the list is exploded per region, so
    # the combinations of two bounded sets need no cartesian product.
    statuses = F.array(*[F.lit(s) for s in ("F", "O", "P", "X")])
    grid = d.table(spark, sf, "region").select(
        F.col("r_name").alias("region"), F.explode(statuses).alias("status"))
    facts = (d.orders(spark, sf).select("customer_id", "status")
             .join(d.customers(spark, sf).select("customer_id", "region"), "customer_id")
             .groupBy("region", "status").agg(F.count(F.lit(1)).alias("n")))
    return grid.join(facts, ["region", "status"], "left").fillna(0, ["n"])


@query("join_broadcast", "J8", sql="""
    SELECT n_name, count(*) AS suppliers, CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
    FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name""")
def _(spark, sf):
    nation = d.table(spark, sf, "nation").select("n_nationkey", "n_name")
    rows = broadcast_join(d.table(spark, sf, "supplier"), nation,
                          F.col("s_nationkey") == F.col("n_nationkey"))
    return rows.groupBy("n_name").agg(
        F.count(F.lit(1)).alias("suppliers"),
        F.sum(F.col("s_acctbal").cast("decimal(18,2)")).alias("balance"))


@query("join_two_keys", "J9", sql=check("""
    SELECT l.order_id, l.item_id, l.supplier_id, l.quantity, x.flag, x.line_status
    FROM lines l JOIN (SELECT DISTINCT order_id, item_id, supplier_id, flag, line_status FROM lines) x
      ON l.order_id = x.order_id AND l.item_id = x.item_id AND l.supplier_id = x.supplier_id""",
    "lines"))
def _(spark, sf):
    rows = d.lines(spark, sf)
    context = rows.select(F.col("order_id").alias("in_order"), F.col("item_id").alias("of_item"),
                          F.col("supplier_id").alias("by_supplier"), "flag",
                          "line_status").distinct()
    left = rows.select("order_id", "item_id", "supplier_id", "quantity")
    same = ((F.col("order_id") == F.col("in_order")) & (F.col("item_id") == F.col("of_item"))
            & (F.col("supplier_id") == F.col("by_supplier")))
    return left.join(context, same).drop("in_order", "of_item", "by_supplier")


@query("join_null_safe", "J10", sql="""
    WITH o AS (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS p FROM orders),
    k AS (SELECT p, count(*) AS n FROM o GROUP BY p)
    SELECT k.p AS priority, k.n, count(*) AS matched FROM o JOIN k ON o.p IS NOT DISTINCT FROM k.p
    GROUP BY ALL""")
def _(spark, sf):
    low = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    o = d.table(spark, sf, "orders").select(low.alias("p"))
    k = o.groupBy(F.col("p").alias("priority")).agg(F.count(F.lit(1)).alias("n"))
    return (o.join(k, F.col("p").eqNullSafe(F.col("priority")))
            .groupBy("priority", "n").agg(F.count(F.lit(1)).alias("matched")))


@query("join_with_inequality", "J11", sql=check("""
    SELECT i.category, count(*) AS n FROM lines l JOIN items i
        ON l.item_id = i.item_id AND l.line_total <> l.quantity * i.price
    GROUP BY i.category""", "lines", "items"))
def _(spark, sf):
    # The inequality filters the pairs of an equi-join (one item per line), so it stays hashable.
    lines = d.lines(spark, sf).select(F.col("item_id").alias("sku"), "quantity", "line_total")
    items = d.items(spark, sf).select("item_id", "category", "price")
    off = ((F.col("sku") == F.col("item_id"))
           & (F.col("line_total") != F.col("quantity") * F.col("price")))
    return lines.join(items, off).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


def _snapshots(spark, sf):
    """Customers before and after: some left, some joined, some moved, some lost their tier."""
    now = d.customers(spark, sf).select("customer_id", "country", "tier", "balance")
    old = now.where("tier <> 'MACHINERY'")
    new = (now.where("balance > 0").withColumn(
        "tier", F.when(F.col("tier") != "HOUSEHOLD", F.col("tier")))
        .withColumn("country", F.when(F.col("balance") > 9000, "MOVED").otherwise(F.col("country"))))
    return old, new


_SNAPSHOTS = """
    old AS (SELECT customer_id, country, tier, balance FROM customers WHERE tier <> 'MACHINERY'),
    new AS (SELECT customer_id, CASE WHEN balance > 9000 THEN 'MOVED' ELSE country END AS country,
                   nullif(tier, 'HOUSEHOLD') AS tier, balance FROM customers WHERE balance > 0)"""


@query("changed_rows", "J12", sql=check(f"""
    WITH {_SNAPSHOTS}
    SELECT coalesce(o.customer_id, n.customer_id) AS customer_id,
           CASE WHEN o.customer_id IS NULL THEN 'added' WHEN n.customer_id IS NULL THEN 'removed'
                ELSE 'changed' END AS status,
           CASE WHEN o.customer_id IS NOT NULL AND n.customer_id IS NOT NULL THEN concat_ws('|',
               CASE WHEN o.country IS DISTINCT FROM n.country THEN 'country' END,
               CASE WHEN o.tier IS DISTINCT FROM n.tier THEN 'tier' END) END AS changed_columns
    FROM old o FULL OUTER JOIN new n ON o.customer_id = n.customer_id
    WHERE o.customer_id IS NULL OR n.customer_id IS NULL
       OR o.country IS DISTINCT FROM n.country OR o.tier IS DISTINCT FROM n.tier""", "customers"))
def _(spark, sf):
    return changed_rows(*_snapshots(spark, sf), ["customer_id"])


@query("salted_join", "J13", sql=check("""
    SELECT country, region, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS total
    FROM sales JOIN customers USING (customer_id) GROUP BY ALL""", "sales", "customers"))
def _(spark, sf):
    orders = d.orders(spark, sf).select("order_id", "customer_id", "amount")
    people = d.customers(spark, sf).select("customer_id", "country", "region")
    return salted_join(orders, people, ["customer_id"], 8, ["order_id"]).groupBy(
        "country", "region").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total"))


@query("star_join", "J16", sql=check("""
    SELECT c.region, i.category, count(*) AS n, CAST(sum(l.line_total * (1 - l.discount)) AS DOUBLE) AS revenue
    FROM lines l JOIN sales o USING (order_id) JOIN customers c USING (customer_id)
         JOIN items i ON l.item_id = i.item_id GROUP BY ALL""",
    "lines", "sales", "customers", "items"))
def _(spark, sf):
    return (d.lines(spark, sf).select("order_id", "item_id", "line_total", "discount")
            .join(d.orders(spark, sf).select("order_id", "customer_id"), "order_id")
            .join(d.customers(spark, sf).select("customer_id", "region"), "customer_id")
            .join(d.items(spark, sf).select("item_id", "category"), "item_id")
            .groupBy("region", "category").agg(
                F.count(F.lit(1)).alias("n"),
                F.sum(F.col("line_total") * (1 - F.col("discount"))).alias("revenue")))
