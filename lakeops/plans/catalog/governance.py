"""Row filters, column masks, restricted views and access logs."""

from pyspark.sql import functions as F

from lakeops.operators.policies import (
    MASK_PII, FilterPolicy, RowRule, apply_mask, apply_policies, apply_row_filter)
from lakeops.functions.columns import EMAIL_MASK
from lakeops.plans import domain as d
from lakeops.plans.domain import check
from lakeops.plans.registry import query

_MASK = EMAIL_MASK[0], EMAIL_MASK[1].replace("$", "\\")  # groups as DuckDB writes them

TEAMS = {"asia_team": "ASIA", "europe_team": "EUROPE", "america_team": "AMERICA"}
RULE = RowRule("region", TEAMS)


@query("row_filter", "G1", sql=check("""
    SELECT 'asia+europe' AS caller, customer_id, region FROM customers WHERE region IN ('ASIA', 'EUROPE')
    UNION ALL SELECT 'admin', customer_id, region FROM customers""", "customers"))
def _(spark, sf):
    rows = d.customers(spark, sf).select("customer_id", "region")
    two = apply_row_filter(rows, ["asia_team", "europe_team"], RULE)
    admin = apply_row_filter(rows, ["admins"], RULE)
    nobody = apply_row_filter(rows, ["guests"], RULE)
    return (two.select(F.lit("asia+europe").alias("caller"), "*")
            .union(admin.select(F.lit("admin"), "*")).union(nobody.select(F.lit("none"), "*")))


@query("column_mask", "G2", sql=check(f"""
    SELECT customer_id, regexp_replace(email, '{_MASK[0]}', '{_MASK[1]}') AS email, email AS clear
    FROM customers""", "customers"))
def _(spark, sf):
    rows = d.customers(spark, sf).select("customer_id", "email", F.col("email").alias("clear"))
    return apply_mask(apply_mask(rows, "email", ["analysts"]), "clear", ["pii_readers"])


@query("tag_policies", "G3", sql=check(f"""
    SELECT customer_id, left(name, 1) || '***' AS name,
           regexp_replace(email, '{_MASK[0]}', '{_MASK[1]}') AS email, region
    FROM customers WHERE region = 'ASIA'""", "customers"))
def _(spark, sf):
    rows = d.customers(spark, sf).select("customer_id", "name", "email", "region")
    tags = {"email": {"pii": "true", "pii_class": "email"},
            "name": {"pii": "true", "pii_class": "name"}, "region": {"region_col": "true"}}
    hide = FilterPolicy(("domain", "customers"), "region_col", TEAMS, ("admins",))
    return apply_policies(rows, tags, {"domain": "customers"}, ["asia_team"], [MASK_PII, hide])


@query("dynamic_view", "G4", "D11", sql=check(f"""
    SELECT region, regexp_replace(email, '{_MASK[0]}', '{_MASK[1]}') AS email, count(*) AS n
    FROM customers WHERE region IN ('ASIA', 'AMERICA') GROUP BY ALL""", "customers"))
def _(spark, sf):
    groups = ["asia_team", "america_team"]
    view = apply_mask(apply_row_filter(d.customers(spark, sf), groups, RULE), "email", groups)
    view.createOrReplaceTempView("customers_for_teams")
    return spark.sql("SELECT region, email, count(*) AS n FROM customers_for_teams GROUP BY ALL")


@query("region_view", "G5", sql=check("""
    SELECT status, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS total
    FROM sales JOIN customers USING (customer_id) WHERE region = 'EUROPE' GROUP BY status""",
    "sales", "customers"))
def _(spark, sf):
    chosen = d.customers(spark, sf).where("region = 'EUROPE'").select("customer_id")
    view = d.orders(spark, sf).join(chosen, "customer_id")
    return view.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total"))


@query("access_log", "G6", sql="""
    SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM events
    WHERE ts > TIMESTAMP '2024-01-31' - INTERVAL 7 DAYS AND event_type LIKE '%ur%'
    ORDER BY events.ts DESC, event_id LIMIT 20""")
def _(spark, sf):
    start = F.lit("2024-01-31").cast("timestamp_ntz") - F.expr("INTERVAL 7 DAYS")
    return (d.events(spark, sf).where((F.col("ts") > start) & F.col("event_type").like("%ur%"))
            .orderBy(F.desc("ts"), "event_id").limit(20)
            .select("event_id", "user_id", "event_type", "ts"))
