"""Compaction and clustering: same rows, better files."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeops.functions.columns import money
from lakeops.operators.layout import cluster_by, compact, file_ranges, unsorted_writes
from lakeops.plans.domain import table
from lakeops.plans.registry import query
from lakeops.session import scratch_path

_SAME_ROWS = """
    SELECT l_returnflag, count(*) AS n, count(DISTINCT l_orderkey) AS orders,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM lineitem GROUP BY ALL"""


def _content(rows):
    return rows.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("l_orderkey").alias("orders"),
        F.sum(money("l_extendedprice")).alias("total"))


@query("compacted_table", "K14", sql=_SAME_ROWS.replace("SELECT l_returnflag", "SELECT 1 AS files, l_returnflag"))
def _(spark, sf):
    path = scratch_path(spark, "packed")
    table(spark, sf, "lineitem").repartition(24).write.parquet(path)
    compact(spark, path, 1 << 30)
    files = file_ranges(spark.read.parquet(path), ["l_orderkey"]).count()
    return _content(spark.read.parquet(path)).withColumn("files", F.lit(files))


@query("compacted_partition", "K14", sql=_SAME_ROWS.replace(
    "SELECT l_returnflag", "SELECT CASE WHEN l_returnflag = 'A' THEN 1 ELSE 6 END AS files, l_returnflag"))
def _(spark, sf):
    # Only the files of one partition are rewritten; the rows of all are still there.
    path = scratch_path(spark, "partitions")
    rows = table(unsorted_writes(spark), sf, "lineitem")
    rows.repartition(6).write.partitionBy("l_returnflag").parquet(path)
    compact(spark, path, 1 << 30, "l_returnflag = 'A'", ["l_returnflag"])
    packed = spark.read.parquet(path)
    files = packed.groupBy("l_returnflag").agg(F.countDistinct("_metadata.file_path").alias("files"))
    return _content(packed).join(files, "l_returnflag")


@query("clustered_table", "K15", sql=_SAME_ROWS)
def _(spark, sf):
    path = scratch_path(spark, "clustered")
    rows = table(spark, sf, "lineitem")
    cluster_by(rows, ["l_orderkey", "l_shipdate"], 16).write.parquet(path)
    return _content(spark.read.parquet(path))


@query("clustered_files_are_narrow", "K15", sql="""
    SELECT 16 AS files, true AS narrow_orders, true AS narrow_dates, count(*) AS n FROM lineitem""")
def _(spark, sf):
    path = scratch_path(spark, "narrow")
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_shipdate")
    cluster_by(rows, ["l_orderkey", "l_shipdate"], 16).write.parquet(path)
    files = file_ranges(spark.read.parquet(path), ["l_orderkey", "l_shipdate"])
    width = F.avg(F.col("max_l_orderkey") - F.col("min_l_orderkey"))
    days = F.avg(F.date_diff("max_l_shipdate", "min_l_shipdate"))
    whole = F.max("max_l_orderkey") - F.min("min_l_orderkey")
    all_days = F.date_diff(F.max("max_l_shipdate"), F.min("min_l_shipdate"))
    # Four ranges on each axis would be ideal; borders that cut through them cost some of it.
    return files.agg(F.count(F.lit(1)).alias("files"), (width < 0.5 * whole).alias("narrow_orders"),
                     (days < 0.5 * all_days).alias("narrow_dates"), F.sum("rows").alias("n"))


@query("clustered_by_name", "K15", sql="""
    SELECT 8 AS files, true AS apart, count(*) AS n FROM customer""")
def _(spark, sf):
    # Names share a long prefix; still, no two files may share a range of names.
    path = scratch_path(spark, "names")
    cluster_by(table(spark, sf, "customer").select("c_name", "c_custkey"), ["c_name"], 8).write.parquet(path)
    files = file_ranges(spark.read.parquet(path), ["c_name"])
    by_name = Window.orderBy("min_c_name")  # one row per file
    return (files.withColumn("apart", F.coalesce(F.col("min_c_name") > F.lag("max_c_name").over(by_name), F.lit(True)))
            .agg(F.count(F.lit(1)).alias("files"), F.bool_and("apart").alias("apart"), F.sum("rows").alias("n")))
