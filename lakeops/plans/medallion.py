"""The bronze, silver and gold datasets over customers, orders and items.

Every dataset is a function from DataFrames to a DataFrame and works on batch and streaming
input up to silver. Revenue sums order amounts as they are: currencies are mixed, cancelled
orders count and discounts are not subtracted.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.columns import derive_region
from lakeops.operators.aggregates import average, summary_row
from lakeops.operators.clean import order_lines
from lakeops.operators.ordering import top_k
from lakeops.operators.quality import Rules, audit, enforce, is_empty, violations
from lakeops.operators.windows import top_k_any
from lakeops.plans.refresh import note_touched, refresh_keys
from lakeops.session import settle
from lakeops.sources.files import SchemaLike, read_files
from lakeops.sources.ingest import save_schema
from lakeops.streaming.flows import append_stream, follow_sink, ingest_stream, read_sink

Save = Callable[[DataFrame, str], DataFrame]

# Expectations of the silver datasets.
CUSTOMER_RULES: Rules = {
    "valid_id": ("customer_id IS NOT NULL", "drop"),
    "valid_email": (r"email RLIKE '.+@.+\\..+'", "drop"),
}
ORDER_RULES: Rules = {
    "positive_amount": ("amount > 0", "drop"),
    "valid_status": ("status IN ('placed', 'shipped', 'delivered', 'cancelled')", "warn"),
    "valid_currency": ("length(currency) = 3", "warn"),
}
LINE_RULES: Rules = {
    "valid_qty": ("quantity > 0", "drop"),
    "valid_price": ("unit_price >= 0", "warn"),
}


def typed_customers(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "customer_id", F.initcap(F.trim("name")).alias("name"),
        F.lower(F.trim("email")).alias("email"), F.upper(F.trim("country")).alias("country"),
        derive_region("country").alias("region"),
        F.col("signup_date").cast("date").alias("signup_date"), "tier")


def silver_customers(bronze: DataFrame) -> DataFrame:
    return enforce(typed_customers(bronze), CUSTOMER_RULES)


def typed_orders(bronze: DataFrame) -> DataFrame:
    """Orders without their lines; a feed that has no discounts yet gets zeros."""
    discount = (F.coalesce(F.col("discount_amount").cast("double"), F.lit(0.0)) if "discount_amount" in bronze.columns
                else F.lit(0.0))
    return bronze.select(
        "order_id", "customer_id", "order_ts", F.col("order_ts").cast("date").alias("order_date"),
        F.lower("status").alias("status"), F.upper("currency").alias("currency"), "amount",
        discount.alias("discount_amount"))


def silver_orders(bronze: DataFrame) -> DataFrame:
    return enforce(typed_orders(bronze), ORDER_RULES)


def typed_order_items(bronze: DataFrame) -> DataFrame:
    lines = order_lines(bronze, carry=["currency"])
    return lines.select("order_id", "customer_id", "order_ts", "order_date", "item_id",
                        "quantity", "unit_price", "line_total", "currency")


def silver_order_items(bronze: DataFrame) -> DataFrame:
    return enforce(typed_order_items(bronze), LINE_RULES)


def silver_items(bronze: DataFrame) -> DataFrame:
    return bronze.select("item_id", F.initcap(F.trim("name")).alias("name"),
                         F.lower("category").alias("category"), "price", "in_stock")


def gold_daily_revenue(orders: DataFrame, customers: DataFrame) -> DataFrame:
    joined = orders.join(customers.select("customer_id", "region"), "customer_id")
    return joined.groupBy("order_date", "region").agg(
        F.countDistinct("order_id").alias("orders"), F.sum("amount").alias("revenue"),
        average("amount").alias("avg_order_amount"))


def gold_top_10_customers(orders: DataFrame, customers: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` customers of each region with the highest spend; the id breaks ties.

    Spend is summed per customer id before the names are joined, so the join moves one row per
    customer instead of every order.
    """
    return top_customers(customer_spend(orders), customers, k)


def customer_spend(orders: DataFrame) -> DataFrame:
    # ``orders`` has one row per order_id and event; count(DISTINCT) keeps re-deliveries out.
    return orders.groupBy("customer_id").agg(
        F.countDistinct("order_id").alias("lifetime_orders"),
        F.sum("amount").alias("lifetime_spend"))


def top_customers(spend: DataFrame, customers: DataFrame, k: int = 10) -> DataFrame:
    rows = spend.join(customers.select("customer_id", "name", "region"), "customer_id")
    ranked = top_k(rows, ["region"], ["-lifetime_spend", "customer_id"], k)
    return ranked.select("customer_id", "name", "region", "lifetime_orders", "lifetime_spend",
                         "rank")


def item_totals(lines: DataFrame) -> DataFrame:
    return lines.groupBy("item_id").agg(F.sum("quantity").alias("units_sold"),
                                        F.sum("line_total").alias("revenue"))


def gold_top_10_items(lines: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """Items among the first ``k`` of their category by revenue or by units; summed before the join
    to the catalogue."""
    return top_items(item_totals(lines), items, k)


def top_items(sold: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    sales = settle(sold.join(items.select("item_id", "name", "category"), "item_id"), "item-sales")
    ranked = top_k_any(sales, ["category"], {
        "rank_revenue": ["-revenue", "item_id"], "rank_units": ["-units_sold", "item_id"],
    }, k)
    return ranked.select("item_id", "name", "category", "units_sold", "revenue", "rank_revenue",
                         "rank_units")


def _summary(region: Column) -> Column:
    """One line of text over the columns days, orders and revenue."""
    money = F.col("revenue").cast("decimal(38,2)").cast("string")
    return F.format_string("%s: revenue of %s from %d orders on %d days", region, money, "orders", "days")


def region_report(daily: DataFrame, top: DataFrame, region: str) -> dict[str, DataFrame]:
    """Daily revenue, best customers and a summary line of one region."""
    days = daily.where(F.col("region") == region)
    line = summary_row(days).select(
        F.lit(region).alias("region"), "days", "orders", "revenue",
        _summary(F.lit(region)).alias("summary"))
    return {
        "daily": days.select("order_date", "orders", "revenue", "avg_order_amount"),
        "top_customers": top.where(F.col("region") == region).select(
            "rank", "name", "lifetime_orders", "lifetime_spend"),
        "summary": line,
    }


def region_summaries(daily: DataFrame) -> DataFrame:
    """The summary lines of all regions in one pass instead of one job per region."""
    sums = daily.groupBy("region").agg(
        F.count(F.lit(1)).alias("days"), F.sum("orders").alias("orders"),
        F.sum("revenue").alias("revenue"))
    return sums.select("*", _summary(F.col("region")).alias("summary"))


def gold_audit(daily: DataFrame, customers: DataFrame, items: DataFrame, as_of: str,
               k: int = 10, on_violation: str = "rows") -> DataFrame:
    """Violations over the gold datasets; an item is fine when either of its ranks is."""
    return audit([
        violations(daily, "daily revenue without a value, below zero or undated",
                   "revenue IS NULL OR revenue < 0 OR order_date IS NULL "
                   f"OR order_date > DATE'{as_of}'"),
        is_empty(daily, "no daily revenue at all"),
        violations(customers, "best customers out of rank, without an id or without spend",
                   f"rank > {k} OR customer_id IS NULL OR lifetime_spend <= 0"),
        violations(items, "best items out of both ranks or without sales",
                   f"(rank_revenue > {k} AND rank_units > {k}) OR units_sold <= 0 "
                   "OR revenue <= 0"),
    ], on_violation)


def refresh_gold(silver: dict[str, DataFrame], save: Save, as_of: str) -> dict[str, DataFrame]:
    """Recompute the gold datasets; fails when the audit finds a violation."""
    orders, customers = silver["silver_orders"], silver["silver_customers"]
    gold = {
        "gold_daily_revenue": save(gold_daily_revenue(orders, customers), "gold_daily_revenue"),
        "gold_top_10_customers": save(gold_top_10_customers(orders, customers),
                                      "gold_top_10_customers"),
        "gold_top_10_items": save(
            gold_top_10_items(silver["silver_order_items"], silver["silver_items"]),
            "gold_top_10_items"),
    }
    gold_audit(*gold.values(), as_of, on_violation="raise").count()
    return gold


def follow_gold(spark: SparkSession, out: str, silver: dict[str, DataFrame], save: Save,
                as_of: str) -> dict[str, DataFrame]:
    """The gold datasets after a run, computed again only where silver's new rows touch them: days of
    new orders and of orders of new customers, customers with new orders, items with new lines. The
    rankings are made from the totals of customers and items. Fails when the audit finds a violation."""
    orders, customers = silver["silver_orders"], silver["silver_customers"]

    def days_of_customers(batch: DataFrame) -> DataFrame:
        return orders.join(batch.select("customer_id").distinct(), "customer_id", "left_semi").select("order_date")

    note_touched(spark, out, "silver_orders", {
        "gold_daily_revenue": lambda b: b.select("order_date"), "customer_spend": lambda b: b.select("customer_id")})
    note_touched(spark, out, "silver_customers", {"gold_daily_revenue": days_of_customers})
    note_touched(spark, out, "silver_order_items", {"item_totals": lambda b: b.select("item_id")})

    def key(rows: DataFrame, name: str) -> T.StructType:
        return T.StructType([rows.schema[name]])

    lines = silver["silver_order_items"]
    daily = refresh_keys(spark, out, "gold_daily_revenue", key(orders, "order_date"), orders,
                         lambda rows: gold_daily_revenue(rows, customers))
    spend = refresh_keys(spark, out, "customer_spend", key(orders, "customer_id"), orders, customer_spend)
    sold = refresh_keys(spark, out, "item_totals", key(lines, "item_id"), lines, item_totals)
    gold = {
        "gold_daily_revenue": daily,
        "gold_top_10_customers": save(top_customers(spend, customers), "gold_top_10_customers"),
        "gold_top_10_items": save(top_items(sold, silver["silver_items"]), "gold_top_10_items"),
    }
    gold_audit(*gold.values(), as_of, on_violation="raise").count()
    return gold


def _save_below(out: str) -> Save:
    def save(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{out}/{name}")
        return df.sparkSession.read.parquet(f"{out}/{name}")
    return save


def run_medallion(bronze: dict[str, DataFrame], out: str, as_of: str) -> dict[str, DataFrame]:
    """Refresh silver and gold from ``bronze`` (customers, orders, items) in dependency order.

    Every dataset is written below ``out`` and later ones read the files, so each is computed
    once.
    """
    save = _save_below(out)
    silver = {
        "silver_customers": save(silver_customers(bronze["customers"]), "silver_customers"),
        "silver_orders": save(silver_orders(bronze["orders"]), "silver_orders"),
        "silver_order_items": save(silver_order_items(bronze["orders"]), "silver_order_items"),
        "silver_items": save(silver_items(bronze["items"]), "silver_items"),
    }
    return {**silver, **refresh_gold(silver, save, as_of)}


@dataclass(frozen=True)
class Landing:
    """A folder of arriving files and how to read it."""

    path: str
    fmt: str
    schema: SchemaLike | None
    options: Mapping[str, str] = field(default_factory=dict)
    prepare: Callable[[DataFrame], DataFrame] | None = None


def refresh_medallion(spark: SparkSession, landing: Mapping[str, Landing], out: str,
                      as_of: str) -> dict[str, DataFrame]:
    """Incremental refresh: customers and orders flow through checkpointed append streams to
    silver, each row once; the item catalogue is read again, and gold is computed again where new rows of
    silver touch it (:func:`follow_gold`).

    Run it again after new files arrived; a run without new files changes nothing.
    """
    def table(name: str) -> DataFrame:
        return read_sink(spark, f"{out}/{name}")

    def hop(source: str, target: str, step: Callable[[DataFrame], DataFrame]) -> None:
        rows = step(follow_sink(spark, f"{out}/{source}"))
        save_schema(spark, f"{out}/{target}/_schema", rows.schema)
        append_stream(rows, f"{out}/{target}", f"{out}/_checkpoints/{target}")

    for name in ("customers", "orders"):
        src = landing[name]
        ingest_stream(spark, src.path, src.fmt, f"{out}/bronze_{name}",
                      f"{out}/_checkpoints/bronze_{name}", src.schema, prepare=src.prepare,
                      **src.options)
    hop("bronze_customers", "silver_customers", silver_customers)
    hop("bronze_orders", "silver_orders", silver_orders)
    hop("bronze_orders", "silver_order_items", silver_order_items)
    save, items = _save_below(out), landing["items"]
    catalogue = read_files(spark, items.path, items.fmt, items.schema, **items.options)
    if items.prepare:
        catalogue = items.prepare(catalogue)
    silver = {n: table(n) for n in ("silver_customers", "silver_orders", "silver_order_items")}
    silver["silver_items"] = save(silver_items(catalogue), "silver_items")
    return {**silver, **follow_gold(spark, out, silver, save, as_of)}
