"""Aggregates of the gold layer and skew-tolerant grouping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T



def average(col: str) -> Column:
    """Exact decimal sum over the count of non-NULL values, as a double."""
    return F.sum(col).cast("double") / F.when(F.count(col) > 0, F.count(col))


def regional_revenue(lines: DataFrame, customers: DataFrame, rsd: float = 0.05) -> DataFrame:
    """Line items, orders, customers (exact and approximate) and revenue per region.

    Rows are summed per order and per customer before the join, and each distinct count is a plain
    count of groups, so nothing is expanded.
    """
    per_order = lines.groupBy("customer_id", "order_id").agg(
        F.count(F.lit(1)).alias("n"), F.count("line_total").alias("priced"),
        F.sum("line_total").alias("total"))
    joined = per_order.join(customers.select("customer_id", "region"), "customer_id")
    orders = (joined.groupBy("region", "order_id").agg(F.lit(1).alias("one")).groupBy("region")
              .agg(F.count("order_id").alias("orders_exact")))
    per_customer = joined.groupBy("region", "customer_id").agg(
        F.sum("n").alias("n"), F.sum("priced").alias("priced"), F.sum("total").alias("total"))
    revenue, priced = F.sum("total"), F.sum("priced")
    totals = per_customer.groupBy("region").agg(
        F.sum("n").alias("line_items"), F.count("customer_id").alias("customers_exact"),
        F.approx_count_distinct("customer_id", rsd).alias("customers_approx"),
        revenue.alias("revenue"), (revenue.cast("double") / F.when(priced > 0, priced)).alias("avg_line"))
    return (totals.alias("a").join(orders.alias("b"), F.col("a.region").eqNullSafe(F.col("b.region")))
            .select("a.region", "line_items", "orders_exact", "customers_exact", "customers_approx", "revenue", "avg_line"))


def distinct_values(df: DataFrame, keys: Sequence[str], col: str | Column, name: str,
                    chunks: int) -> DataFrame:
    """``collect_set`` per key as sorted arrays, one for each ``chunk`` below ``chunks`` that has values.

    A value's chunk is the first eight hexadecimal digits of the MD5 of its text, modulo
    ``chunks``: declare as many as the largest set needs for its arrays to stay small. Values are made
    distinct before they are collected (combined in the map tasks).
    """
    value = F.col(col) if isinstance(col, str) else col
    number = F.conv(F.left(F.md5(F.col("__v").cast("string").cast("binary")), F.lit(8)), 16, 10).cast("bigint")
    pairs = df.select(*keys, value.alias("__v")).where("__v IS NOT NULL").distinct()
    return (pairs.withColumn("chunk", (number % chunks).cast("int")).groupBy(*keys, "chunk")
            .agg(F.array_sort(F.collect_list("__v")).alias(name)))


def two_stage_agg(df: DataFrame, keys: Sequence[str], distinct: tuple[str, str],
                  aggs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Exact count of distinct values (``(name, column)``) next to plain aggregates, hot keys split.

    Grouping on (key, value) first spreads a hot key over its values and combines in the map tasks,
    and the second stage only adds one row per value. Plain aggregates alone need no second
    stage: Spark already combines them before the shuffle. ``aggs`` maps a result column
    to (sum, count, min, max or avg, column).
    """
    partial, final = [], [F.count("__v").alias(distinct[0])]
    for name, (kind, col) in aggs.items():
        if kind == "avg":
            partial += [F.sum(col).alias(f"__s_{name}"), F.count(col).alias(f"__c_{name}")]
            n = F.sum(f"__c_{name}")
            final.append((F.sum(f"__s_{name}").cast("double") / F.when(n > 0, n)).alias(name))
        else:
            partial.append(getattr(F, kind)(col).alias(f"__p_{name}"))
            merge = F.sum if kind in ("sum", "count") else getattr(F, kind)
            final.append(merge(f"__p_{name}").alias(name))
    return (df.groupBy(*keys, F.col(distinct[1]).alias("__v")).agg(*partial)
            .groupBy(*keys).agg(*final))


def lookback(df: DataFrame, ts: str, as_of: date, days: int) -> DataFrame:
    """Rows younger than ``days`` before ``as_of``; the bound is a literal, so it is pushed down."""
    start = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(days)} DAYS")
    return df.where(F.col(ts).cast("timestamp_ntz") > start)


def _seconds(start: str, end: str) -> Column:
    return (F.unix_timestamp(F.col(end).cast("timestamp"))
            - F.unix_timestamp(F.col(start).cast("timestamp")))


def recent_runs(runs: DataFrame, job: str, job_id, start: str, end: str, as_of: date,
                days: int = 14) -> DataFrame:
    """Runs of one job in the last ``days`` with their duration in seconds, newest first."""
    recent = lookback(runs, start, as_of, days).where(F.col(job) == F.lit(job_id))
    return recent.withColumn("duration_s", _seconds(start, end)).orderBy(F.desc(start))


def run_metrics(runs: DataFrame, job: str | Sequence[str], start: str, end: str, state: str, as_of: date,
                days: int = 30, failed: str = "FAILED") -> DataFrame:
    """Per job (or job and task): finished runs, failures, failure rate, mean and longest
    duration in seconds."""
    recent = lookback(runs, start, as_of, days).where(F.col(state).isNotNull())
    bad = F.sum(F.when(F.col(state) == failed, 1).otherwise(0))
    keys = [job] if isinstance(job, str) else list(job)
    return recent.withColumn("__s", _seconds(start, end)).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"), bad.alias("failed"),
        (bad / F.count(F.lit(1))).alias("fail_rate"),
        average("__s").alias("avg_s"), F.max("__s").alias("max_s"))


def summary_row(df: DataFrame, orders: str = "orders", revenue: str = "revenue") -> DataFrame:
    """Days, orders and revenue; zeros when there are no rows."""
    return df.agg(F.count(F.lit(1)).alias("days"),
                  F.coalesce(F.sum(orders), F.lit(0)).alias("orders"),
                  F.coalesce(F.sum(revenue), F.lit(0)).alias("revenue"))


def column_profile(df: DataFrame, cols: Sequence[str], accuracy: int = 10_000) -> DataFrame:
    """count, mean, stddev, min, quartiles and max of numeric columns, in one pass.

    A quartile's rank is off by a share of 1 / ``accuracy`` of the rows at most.
    """
    names = ("count", "mean", "stddev", "min", "25%", "50%", "75%", "max")
    aggs = []
    for c in cols:
        q = F.percentile_approx(c, [0.25, 0.5, 0.75], accuracy)
        values = [F.count(c), average(c), F.stddev_samp(c), F.min(c), q[0], q[1], q[2], F.max(c)]
        aggs.append(F.array(*[v.cast("double") for v in values]).alias(c))
    zipped = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("summary"), *[F.col(c) for c in cols])
    return df.agg(*aggs).select(F.inline(zipped))


def analyze(df: DataFrame) -> DataFrame:
    """One row per atomic column: rows, NULLs, distinct values, min and max as text; one pass."""
    cols = [f.name for f in df.schema.fields
            if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))]
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for c in cols:
        aggs += [F.count(c).alias(f"n_{c}"), F.approx_count_distinct(c, 0.02).alias(f"d_{c}"),
                 F.min(c).cast("string").alias(f"lo_{c}"), F.max(c).cast("string").alias(f"hi_{c}")]
    stats = [F.struct(F.lit(c).alias("column"), F.col("__rows").alias("rows"),
                      (F.col("__rows") - F.col(f"n_{c}")).alias("nulls"),
                      F.col(f"d_{c}").alias("approx_distinct"),
                      F.col(f"lo_{c}").alias("min"), F.col(f"hi_{c}").alias("max"))
             for c in cols]
    return df.agg(*aggs).select(F.inline(F.array(*stats)))
