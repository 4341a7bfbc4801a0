"""Windows in ranges must equal plain windows, also when one key holds a third of all rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeops.operators.ordering import order_columns
from lakeops.operators.windows import in_ranges, ordered_features, rank_within, top_k_any

FEATURES = {"seq": ("row_number",), "run": ("running_sum", "amount"), "all": ("total", "amount"),
            "prev": ("lag", "amount"), "next": ("lead", "amount"), "r": ("rank",), "dr": ("dense_rank",),
            "n": ("count",)}


@pytest.fixture(scope="module")
def skewed(spark):
    """6,000 rows; key 1 holds a third, key NULL a sixth; half of key 1 shares one timestamp."""
    h = F.pmod(F.xxhash64("id"), F.lit(1000))
    return spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 6 == 1, F.lit(None).cast("int"))
        .otherwise((h % 50 + 2).cast("int")).alias("k"),
        F.when(F.col("id") % 6 == 0, F.lit(500)).otherwise(h).alias("ts"),
        F.col("id"), F.when(h % 7 > 0, (h % 90).cast("decimal(18,2)")).alias("amount"),
    ).repartition(5, "id")


def plain(df, keys, order_by):
    order = order_columns(order_by)
    w, t, g = (Window.partitionBy(*keys).orderBy(*order), Window.partitionBy(*keys).orderBy(order[0]),
               Window.partitionBy(*keys))
    return df.select("*", F.row_number().over(w).alias("seq"), F.sum("amount").over(t).alias("run"),
                     F.sum("amount").over(g).alias("all"), F.lag("amount").over(w).alias("prev"),
                     F.lead("amount").over(w).alias("next"), F.rank().over(t).alias("r"),
                     F.dense_rank().over(t).alias("dr"), F.count(F.lit(1)).over(g).alias("n"))


@pytest.mark.parametrize("ranges", [1, 3, 40])
@pytest.mark.parametrize("order_by", [["ts", "id"], ["-ts", "-id"], ["ts", "-id"], ["-ts", "id"]])
def test_equals_the_plain_window(skewed, rows, ranges, order_by):
    got = ordered_features(skewed, ["k"], order_by, FEATURES, ranges)
    assert rows(got) == rows(plain(skewed, ["k"], order_by))


def test_null_order_values(skewed, rows):
    df = skewed.withColumn("ts", F.when(F.col("ts") > 400, F.col("ts")))
    assert rows(ordered_features(df, ["k"], ["ts", "id"], FEATURES, 30)) == rows(plain(df, ["k"], ["ts", "id"]))


@pytest.mark.parametrize("image", ["id + 1152921504606846976", "concat('item-', id % 700)",
                                   "cast(id % 400 as decimal(38,0)) + 90071992547409930000"])
def test_large_numbers_and_strings(skewed, rows, image):
    df = skewed.withColumn("ts", F.expr(image))
    for order_by in (["ts", "id"], ["-ts", "id"]):
        got = ordered_features(df, ["k"], order_by, FEATURES, 30)
        assert rows(got) == rows(plain(df, ["k"], order_by))


def test_large_groups_lie_in_many_ranges(skewed):
    sizes = in_ranges(skewed, ["k"], ["ts", "id"], 40).groupBy("__p", "k").count()
    assert sizes.agg(F.max("count")).first()[0] <= 400


@pytest.mark.parametrize("ranges", [2, 50])
def test_rank_within(skewed, rows, ranges):
    w = Window.partitionBy("k").orderBy(F.desc("amount"))
    want = skewed.select("*", F.rank().over(w).alias("rnk"), F.dense_rank().over(w).alias("dense_rnk"),
                         F.percent_rank().over(w).alias("pct"))
    assert rows(rank_within(skewed, ["k"], "-amount", ranges=ranges)) == rows(want)


@pytest.mark.parametrize("tie", ["id", "concat('i', id)"])
def test_top_k_any(skewed, rows, tie):
    df = skewed.withColumn("id", F.expr(tie))
    a = Window.partitionBy("k").orderBy(F.desc("amount"), "id")
    b = Window.partitionBy("k").orderBy("ts", F.desc("id"))
    want = (df.withColumn("a", F.row_number().over(a)).withColumn("b", F.row_number().over(b))
            .where("a <= 5 OR b <= 5"))
    got = top_k_any(df, ["k"], {"a": ["-amount", "id"], "b": ["ts", "-id"]}, 5)
    assert rows(got) == rows(want)


def test_only_border_groups_are_broadcast(skewed):
    plan = ordered_features(skewed, ["k"], ["ts", "id"], FEATURES, 8)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Expand" not in plan
