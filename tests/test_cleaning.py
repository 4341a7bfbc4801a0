import pytest
from pyspark.sql import functions as F
from pyspark.testing.utils import assertDataFrameEqual

from lakeops.functions.columns import derive_region, first_letter_mask, mask_email
from lakeops.functions.sqlfuncs import register_sql_functions
from lakeops.operators.aggregates import column_profile, distinct_values, run_metrics, two_stage_agg
from lakeops.operators.clean import CUSTOMER_FEED, load_typed, order_lines, tidy, uncastable_rows
from lakeops.operators.joins import full_outer, salted_join
from lakeops.operators.ordering import latest_per_key

SCHEMA = "customer_id BIGINT, name STRING, email STRING, country STRING, signup_date STRING"


def people(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_normalise(spark):
    got = tidy(people(
        spark, (11, "  joão da silva ", "João.Silva@MAIL.example", " br ", "2021-12-31"),
        (12, "O'NEIL-smith", " x@Y.example ", "Jp", "1999-02-28")), CUSTOMER_FEED)
    assert [(r.customer_id, r.email, r.country, str(r.signup_date)) for r in got.orderBy("customer_id").collect()] == [
        (11, "joão.silva@mail.example", "BR", "2021-12-31"), (12, "x@y.example", "JP", "1999-02-28")]
    assert all(r.name == r.name.strip() and r.name[:1].isupper() for r in got.collect())


def test_rows_without_key_or_address_go_and_the_newest_stays(spark):
    got = tidy(people(
        spark, (7, "first entry", "f@y.example", "FR", "2020-03-01"), (7, "second entry", "f@y.example", "FR", "2022-03-01"),
        (8, "nobody", None, "FR", "2020-01-01"), (None, "no key", "k@y.example", "FR", "2020-01-01")), CUSTOMER_FEED).collect()
    assert [(r.customer_id, str(r.signup_date)) for r in got] == [(7, "2022-03-01")]


def test_latest_per_key_limits_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id").repartition(4)
    plan = latest_per_key(df, ["k"], ["-id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_regions_masks_and_functions(spark):
    df = spark.createDataFrame([("de",), (" ca ",), ("JP",), ("mx",), ("za",), ("xx",), (None,)], "c STRING")
    assert [r[0] for r in df.select(derive_region("c")).collect()] == [
        "EU", "NA", "APAC", "LATAM", "EMEA", "OTHER", "OTHER"]
    row = spark.sql("SELECT 'anna@x.com' AS e, 'Anna' AS n").select(mask_email("e"), first_letter_mask("n")).first()
    assert tuple(row) == ("a***@x.com", "A***")
    register_sql_functions(spark)
    got = spark.sql("""SELECT get_url('a@b.org'), site_type('a@b.org'), site_type('a@b.de'),
        get_letter_grade(3.5), get_letter_grade(2.75), get_letter_grade(2.0), get_letter_grade(1.9),
        get_letter_grade(NULL)""").first()
    assert tuple(got) == ("https://www.b.org", "Non-profits organization",
                          "Unknow extenstion for domain: b.de", "A", "B", "C", "F", "F")


def test_casts(spark):
    raw = spark.createDataFrame([("100",), ("100$",), (None,)], "v STRING")
    assert [r[0] for r in uncastable_rows(raw, "v", "int").collect()] == ["100$"]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        load_typed(raw, {"v": "int"}).collect()


def test_order_lines(spark):
    orders = spark.sql("""SELECT 1 AS order_id, 7 AS customer_id, TIMESTAMP'2026-06-01 09:30:00' AS order_ts,
        array(named_struct('item_id', 'A', 'quantity', 2, 'unit_price', 1.5D),
              named_struct('item_id', 'B', 'quantity', -1, 'unit_price', 4.0D)) AS items
        UNION ALL SELECT 2, 8, TIMESTAMP'2026-06-01 09:30:00', array()""")
    got = sorted((r["item_id"], r["line_total"], str(r["order_date"])) for r in order_lines(orders).collect())
    assert got == [("A", 3.0, "2026-06-01"), ("B", -4.0, "2026-06-01")]


@pytest.fixture
def hot(spark):
    return spark.range(4000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 1 WHEN id % 50 = 1 THEN NULL ELSE id % 40 END AS k",
        "CAST(id % 97 AS DECIMAL(18,2)) AS v")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_join(spark, hot, rows, how):
    small = spark.range(0, 30).selectExpr("id AS k", "id * 2 AS w")
    assert rows(salted_join(hot, small, ["k"], 8, how=how)) == rows(hot.join(small, "k", how))
    with pytest.raises(ValueError):
        salted_join(hot, small, ["k"], how="full")


def test_full_outer_equals_join(spark, hot, rows):
    dim = spark.range(20, 60).selectExpr("id AS dk", "id * 2 AS w")
    want = hot.join(dim, hot.k == dim.dk, "full")
    assert rows(full_outer(hot, dim, "k", "dk")) == rows(want)


def test_two_stage_aggregate(hot, rows):
    got = two_stage_agg(hot, ["k"], ("d", "v"), {
        "n": ("count", "v"), "s": ("sum", "v"), "lo": ("min", "v"), "hi": ("max", "v"), "m": ("avg", "v")})
    want = hot.groupBy("k").agg(F.countDistinct("v"), F.count("v"), F.sum("v"), F.min("v"), F.max("v"),
                                F.sum("v").cast("double") / F.count("v"))
    assert [tuple(map(str, r)) for r in rows(got)] == [tuple(map(str, r)) for r in rows(want)]
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()


def test_distinct_values_have_one_shape(hot, rows):
    parts = distinct_values(hot, ["k"], "v", "vs", chunks=8)
    assert parts.agg(F.max("chunk")).first()[0] < 8 and parts.where("chunk > 0").count() > 0
    assert parts.columns == distinct_values(hot.limit(1), ["k"], "v", "vs", chunks=8).columns
    flat = lambda df: sorted(map(str, df.select("k", F.explode("vs").alias("v")).collect()))
    assert flat(parts) == sorted(map(str, hot.select("k", "v").distinct().collect()))


def test_run_metrics_ignores_unfinished_runs(spark):
    from datetime import date
    runs = spark.sql("""SELECT * FROM VALUES
        (1, TIMESTAMP'2026-06-10 10:00:00', TIMESTAMP'2026-06-10 10:01:00', 'FAILED'),
        (1, TIMESTAMP'2026-06-10 11:00:00', TIMESTAMP'2026-06-10 11:00:20', 'SUCCEEDED'),
        (1, TIMESTAMP'2026-06-10 12:00:00', NULL, NULL),
        (1, TIMESTAMP'2026-01-01 12:00:00', TIMESTAMP'2026-01-01 13:00:00', 'FAILED')
        AS t(job, s, e, state)""")
    row = run_metrics(runs, "job", "s", "e", "state", date(2026, 6, 15)).first()
    assert tuple(row) == (1, 2, 1, 0.5, 40.0, 60)


def test_column_profile(hot):
    got = {r["summary"]: r["v"] for r in column_profile(hot, ["v"]).collect()}
    assert set(got) == {"count", "mean", "stddev", "min", "25%", "50%", "75%", "max"}
    assert got["count"] == 4000 and got["min"] <= got["75%"] <= got["max"] == 96


def test_broadcast_only_below_the_size_limit(spark, hot, tmp_path):
    from lakeops.operators.joins import broadcast_join
    small = spark.range(0, 30).selectExpr("id AS k", "id * 2 AS w")
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan(broadcast_join(hot, small, ["k"]))
    assert "strategy=broadcast" not in plan(broadcast_join(hot, small, ["k"], max_bytes=1))
