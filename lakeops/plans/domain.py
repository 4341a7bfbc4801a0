"""The customers / orders / items domain on the given tables, for Spark and for the check SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.columns import money


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with country, region and a derived email address."""
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = table(spark, sf_dir, "customer").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey"))
    domain = (F.when(F.col("c_mktsegment") == "BUILDING", ".com")
              .when(F.col("c_mktsegment") == "MACHINERY", ".org")
              .when(F.col("c_mktsegment") == "FURNITURE", ".edu").otherwise(".net"))
    return rows.select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"),
        F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@shop"), domain)
        .alias("email"),
        F.col("n_name").alias("country"), F.col("r_name").alias("region"),
        F.col("c_mktsegment").alias("tier"), money("c_acctbal").alias("balance"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_ts"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"),
        money("o_totalprice").alias("amount"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"), F.col("p_name").alias("name"),
        F.lower("p_type").alias("category"), F.col("p_brand").alias("brand"),
        F.col("p_size").alias("size"), money("p_retailprice").alias("price"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items, one row each."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("item_id"),
        F.col("l_suppkey").alias("supplier_id"), F.col("l_quantity").cast("bigint").alias("quantity"),
        money("l_extendedprice").alias("line_total"), money("l_discount").alias("discount"),
        F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("line_status"),
        F.col("l_shipdate").alias("ship_ts"))


def nested_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a nested array of zero to three items, derived from the order row itself."""
    number = F.expr("""
        transform(filter(array(1, 2, 3), i -> i <= pmod(order_id, 4)), i -> named_struct(
            'item_id', concat('I', CAST(pmod(order_id + i * 17, 40) AS STRING)),
            'quantity', CAST(pmod(order_id * i, 9) AS INT),
            'unit_price', CAST(pmod(customer_id * 31 + i * 7, 5000) / 100 AS DECIMAL(10,2))))""")
    return orders(spark, sf_dir).withColumn("items", number)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


# The same views for the check SQL.
VIEWS = {
    "customers": """
        SELECT c_custkey AS customer_id, c_name AS name,
               lower(replace(c_name, '#', '.')) || '@shop' || CASE c_mktsegment
                   WHEN 'BUILDING' THEN '.com' WHEN 'MACHINERY' THEN '.org'
                   WHEN 'FURNITURE' THEN '.edu' ELSE '.net' END AS email,
               n_name AS country, r_name AS region, c_mktsegment AS tier,
               CAST(c_acctbal AS DECIMAL(18,2)) AS balance
        FROM customer JOIN nation ON c_nationkey = n_nationkey
             JOIN region ON n_regionkey = r_regionkey""",
    "sales": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_ts,
               CAST(o_orderdate AS DATE) AS order_date, o_orderstatus AS status,
               o_orderpriority AS priority, CAST(o_totalprice AS DECIMAL(18,2)) AS amount
        FROM orders""",
    "items": """
        SELECT p_partkey AS item_id, p_name AS name, lower(p_type) AS category, p_brand AS brand,
               p_size AS size, CAST(p_retailprice AS DECIMAL(18,2)) AS price FROM part""",
    "lines": """
        SELECT l_orderkey AS order_id, l_partkey AS item_id, l_suppkey AS supplier_id,
               CAST(l_quantity AS BIGINT) AS quantity,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS line_total,
               CAST(l_discount AS DECIMAL(18,2)) AS discount, l_returnflag AS flag,
               l_linestatus AS line_status, l_shipdate AS ship_ts
        FROM lineitem""",
    "nested_lines": """
        SELECT s.*, i AS pos, 'I' || CAST((order_id + i * 17) % 40 AS VARCHAR) AS item_id,
               CAST((order_id * i) % 9 AS BIGINT) AS quantity,
               CAST(((customer_id * 31 + i * 7) % 5000) / 100.0 AS DECIMAL(10,2)) AS unit_price
        FROM (SELECT * FROM sales) s, (VALUES (1), (2), (3)) AS n(i) WHERE i <= order_id % 4""",
}
_NEEDS = {"nested_lines": ("sales",)}


def check(sql: str, *views: str) -> str:
    """Check SQL with the named views in front."""
    wanted: list[str] = []
    for v in views:
        wanted += [n for n in (*_NEEDS.get(v, ()), v) if n not in wanted]
    ctes = ", ".join(f"{v} AS ({VIEWS[v]})" for v in wanted)
    if not ctes:
        return sql
    if sql.lstrip().upper().startswith("WITH "):
        return f"WITH {ctes}, {sql.lstrip()[5:]}"
    return f"WITH {ctes} {sql}"
