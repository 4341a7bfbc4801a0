import pytest
from pyspark.sql import functions as F

from lakeops.operators.layout import cluster_by, compact, file_ranges
from lakeops.operators.policies import apply_mask, apply_policies, apply_row_filter
from lakeops.operators.quality import audit, expect, expect_observed, is_empty, violations
from lakeops.operators.tables import SchemaMismatch, copy_table, copy_version, empty_like, write_table
from lakeops.plans import medallion as m
from lakeops.sources.files import synthetic_orders


@pytest.fixture
def df(spark):
    return spark.createDataFrame([(1, "EU", "anna@x.com"), (-2, "NA", "bob@x.com"), (None, "OTHER", None)],
                                 "v INT, region STRING, email STRING")


def test_expectations(df):
    kept, metrics = expect(df, {"positive": ("v > 0", "drop"), "mail": ("email LIKE '%@%'", "warn")}, "d")
    assert kept.count() == 1
    assert sorted(map(tuple, metrics.collect())) == [("d", "mail", "warn", 2, 1), ("d", "positive", "drop", 1, 2)]
    with pytest.raises(Exception, match="expectation positive violated"):
        expect(df, {"positive": ("v > 0", "fail")})[0].count()
    with pytest.raises(ValueError):
        expect(df, {"x": ("true", "explode")})


def test_observed_expectations(df, tmp_path):
    kept, seen = expect_observed(df, {"positive": ("v > 0", "drop")})
    kept.write.parquet(str(tmp_path / "o"))
    assert seen.get == {"__rows": 3, "positive": 1}


def test_audit(df):
    checks = [violations(df, "negative", "v < 0"), violations(df, "none", "v > 100"), is_empty(df, "empty"),
              is_empty(df.where("v > 100"), "hollow")]
    assert sorted(map(tuple, audit(checks).collect())) == [("hollow", 1), ("negative", 1)]
    with pytest.raises(Exception, match="audit failed"):
        audit(checks, "raise").count()
    assert audit(checks[1:3], "raise").count() == 0


def test_row_filter_and_mask(df):
    regions = lambda groups: sorted(r["region"] for r in apply_row_filter(df, groups).collect())
    assert regions(["admins"]) == ["EU", "NA", "OTHER"]
    assert regions(["eu_team", "na_team"]) == ["EU", "NA"] and regions([]) == []
    assert apply_mask(df, "email", []).first()["email"] == "a***@x.com"
    assert apply_mask(df, "email", ["pii_readers"]).first()["email"] == "anna@x.com"


def test_tag_policies(df):
    tags = {"email": {"pii": "true", "pii_class": "email"}, "region": {"region_col": "true"}}
    table = {"domain": "customers"}
    assert [tuple(r) for r in apply_policies(df, tags, table, ["eu_team"]).collect()] == [(1, "EU", "a***@x.com")]
    assert apply_policies(df, tags, table, ["admins", "pii_readers"]).count() == 3
    assert apply_policies(df, tags, {}, ["pii_readers"]).count() == 3
    assert apply_policies(df, {}, table, ["eu_team"]).first()["email"] == "anna@x.com"


def test_write_modes(spark, df, tmp_path):
    path = str(tmp_path / "t")
    write_table(df, path)
    write_table(df, path, "append")
    assert spark.read.parquet(path).count() == 6
    write_table(df, path, "overwrite_strict")
    assert spark.read.parquet(path).count() == 3
    wider = df.withColumn("at", F.current_timestamp())
    for mode in ("append", "overwrite_strict"):
        with pytest.raises(SchemaMismatch):
            write_table(wider, path, mode)
    write_table(wider, path, "overwrite_strict", overwrite_schema=True)
    assert "at" in spark.read.parquet(path).columns
    assert empty_like(df).count() == 0 and empty_like(df).schema == df.schema


def test_constraint_leaves_the_table_alone(spark, df, tmp_path):
    path = str(tmp_path / "t")
    write_table(df.where("v > 0"), path)
    with pytest.raises(Exception, match="CHECK constraint violated"):
        write_table(df, path, constraints=["v > 0"])
    assert spark.read.parquet(path).count() == 1
    write_table(df.where("v IS NULL OR v > 0"), path, constraints=["v > 0"])
    assert spark.read.parquet(path).count() == 2


def test_partition_pruning_and_copies(spark, df, tmp_path, rows):
    path, copy = str(tmp_path / "t"), str(tmp_path / "c")
    write_table(df, path, partition_by=["region"])
    read = spark.read.parquet(path).where("region = 'EU'")
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(region" in plan
    assert rows(copy_table(spark, path, copy)) == rows(spark.read.parquet(path))
    feed = df.selectExpr("*", "'insert' AS _change_type", "1L AS _commit_version")
    assert rows(copy_version(feed, ["region"], 1, str(tmp_path / "v"))) == rows(df)


def test_compaction(spark, tmp_path):
    path = str(tmp_path / "flat")
    spark.range(4000).selectExpr("id", "id % 7 AS v").repartition(9).write.parquet(path)
    assert compact(spark, path, 1 << 30) == 1
    got = spark.read.parquet(path)
    assert got.select("_metadata.file_path").distinct().count() == 1
    assert sorted(map(tuple, got.collect())) == [(i, i % 7) for i in range(4000)]


def test_compaction_of_one_partition(spark, tmp_path):
    path = str(tmp_path / "parts")
    spark.range(1000).selectExpr("id", "CAST(id % 4 AS INT) AS p").repartition(5).write.partitionBy("p").parquet(path)
    others = {r[0] for r in spark.read.parquet(path).where("p <> 1").select("_metadata.file_path").collect()}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    compact(spark, path, 1 << 30, "p = 1", ["p"])
    got = spark.read.parquet(path)
    assert sorted(map(tuple, got.select("id", "p").collect())) == [(i, i % 4) for i in range(1000)]
    assert {r[0] for r in got.where("p <> 1").select("_metadata.file_path").collect()} == others
    assert got.where("p = 1").select("_metadata.file_path").distinct().count() == 1
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    with pytest.raises(ValueError):
        compact(spark, path, 1 << 30, "id < 5")


def test_string_keys_cluster_by_their_whole_value(spark, tmp_path):
    names = spark.range(20_000).selectExpr("format_string('Customer#%09d', id) AS name", "id % 97 AS b")
    for keys, most in ((["name"], 0.08), (["name", "b"], 0.5)):
        path = str(tmp_path / "-".join(keys))
        cluster_by(names, keys, 16).write.parquet(path)
        files = file_ranges(spark.read.parquet(path), ["name"]).collect()
        width = [int(r.max_name[-9:]) - int(r.min_name[-9:]) for r in files]
        assert len(files) == 16 and sum(width) / 16 < most * 20_000


def test_clustering_narrows_files(spark, tmp_path):
    rows = synthetic_orders(spark, 40_000, customers=1000)
    spans = {}
    for name, laid in (("plain", rows.repartition(16)), ("z", cluster_by(rows, ["customer_id", "order_date", "status"], 16))):
        laid.write.parquet(str(tmp_path / name))
        stats = file_ranges(spark.read.parquet(str(tmp_path / name)), ["customer_id", "order_date"])
        spans[name] = stats.agg(F.avg(F.expr("max_customer_id - min_customer_id")), F.sum("rows")).first()
    assert spans["z"][1] == spans["plain"][1] == 40_000
    assert spans["z"][0] < 0.6 * spans["plain"][0]
    with pytest.raises(ValueError):
        cluster_by(rows, rows.columns[:5], 4)


ORDERS = """SELECT 1 AS order_id, 1 AS customer_id, TIMESTAMP'2026-06-01 09:00:00' AS order_ts, 'Placed' AS status,
    'eur' AS currency, 30.0D AS amount, array(named_struct('item_id','A','quantity',2,'unit_price',10.0D),
    named_struct('item_id','B','quantity',-1,'unit_price',5.0D)) AS items
    UNION ALL SELECT 2, 1, TIMESTAMP'2026-06-01 10:00:00', 'shipped', 'euro', 50.0D, array(named_struct('item_id','B','quantity',1,'unit_price',50.0D))
    UNION ALL SELECT 3, 2, TIMESTAMP'2026-06-02 10:00:00', 'odd', 'usd', -5.0D, array(named_struct('item_id','A','quantity',1,'unit_price',5.0D))"""
CUSTOMERS = """SELECT * FROM VALUES (1, ' anna ', 'ANNA@x.com', 'de', '2025-01-01', 'gold'),
    (2, 'bob', 'bob@x.com', 'us', '2025-01-01', 'gold'), (3, 'x', 'no-mail', 'us', '2025-01-01', 'gold'),
    (CAST(NULL AS INT), 'y', 'y@x.com', 'us', '2025-01-01', 'gold') AS t(customer_id, name, email, country, signup_date, tier)"""
ITEMS = """SELECT * FROM VALUES ('A', 'desk lamp', 'HOME', 10.0D, true), ('B', 'rug', 'Home', 5.0D, false)
    AS t(item_id, name, category, price, in_stock)"""


def test_medallion(spark, tmp_path):
    bronze = {"customers": spark.sql(CUSTOMERS), "orders": spark.sql(ORDERS), "items": spark.sql(ITEMS)}
    out = m.run_medallion(bronze, str(tmp_path / "m"), "2026-12-31")
    assert sorted(r["region"] for r in out["silver_customers"].collect()) == ["EU", "NA"]
    assert [r["discount_amount"] for r in out["silver_orders"].collect()] == [0.0, 0.0]
    assert out["silver_order_items"].count() == 3
    daily = out["gold_daily_revenue"].collect()
    assert [(str(r["order_date"]), r["region"], r["orders"], r["revenue"], r["avg_order_amount"]) for r in daily] == [
        ("2026-06-01", "EU", 2, 80.0, 40.0)]
    report = m.region_report(out["gold_daily_revenue"], out["gold_top_10_customers"], "EU")
    assert report["summary"].first()["summary"] == "EU: revenue of 80.00 from 2 orders on 1 days"
    assert report["top_customers"].first()["name"] == "Anna"
    empty = m.region_report(out["gold_daily_revenue"], out["gold_top_10_customers"], "APAC")["summary"].first()
    assert empty["summary"] == "APAC: revenue of 0.00 from 0 orders on 0 days"
    with pytest.raises(Exception, match="audit failed"):
        m.run_medallion(bronze, str(tmp_path / "m2"), "2026-01-01")


def test_views(spark, df):
    df.createOrReplaceTempView("t_view")
    df.createOrReplaceGlobalTempView("g_view")
    assert spark.table("t_view").count() == spark.newSession().table("global_temp.g_view").count() == 3
    assert not spark.newSession().catalog.tableExists("t_view")


def test_incremental_medallion_equals_batch(spark, tmp_path, rows):
    land, out = tmp_path / "landing", str(tmp_path / "inc")
    schemas = {"customers": spark.sql(CUSTOMERS).schema, "orders": spark.sql(ORDERS).schema,
               "items": spark.sql(ITEMS).schema}
    bronze = {"customers": spark.sql(CUSTOMERS), "orders": spark.sql(ORDERS), "items": spark.sql(ITEMS)}
    places = {n: m.Landing(str(land / n), "json", s) for n, s in schemas.items()}
    bronze["customers"].write.json(str(land / "customers"))
    bronze["items"].write.json(str(land / "items"))
    for condition in ("order_id <= 1", "order_id > 1", "false"):
        bronze["orders"].where(condition).write.mode("append").json(str(land / "orders"))
        got = m.refresh_medallion(spark, places, out, "2026-12-31")
    want = m.run_medallion(bronze, str(tmp_path / "batch"), "2026-12-31")
    for name in want:
        assert rows(got[name]) == rows(want[name]), name
