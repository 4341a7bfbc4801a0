"""Streams over the given tables, drained to the end and read back."""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lakeops.functions.columns import money
from lakeops.operators import cdc
from lakeops.plans import domain as d
from lakeops.plans.domain import check, table
from lakeops.plans.registry import query
from lakeops.session import scratch_path
from lakeops.sources.drift import UnknownFieldError
from lakeops.streaming import flows, upserts


def stream_table(spark, sf_dir, name):
    """A table as a stream of its files, whether it is a folder or a single file."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
    schema = table(spark, sf_dir, name).schema
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory():
        return flows.read_stream(spark, f"{sf_dir}/{name}.parquet", "parquet", schema)
    return flows.read_stream(spark, sf_dir, "parquet", schema, pathGlobFilter=f"{name}.parquet")


@query("stream_append", "S10", "K6", "K8", "T1", "T4", "T7", sql="""
    SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, true AS has_source
    FROM events GROUP BY ALL""")
def _(spark, sf):
    out = scratch_path(spark, "append")
    flows.with_arrival(stream_table(spark, sf, "events")).createOrReplaceTempView("arriving_events")
    for _run in range(2):  # the second run finds nothing new
        flows.append_stream(spark.sql("SELECT * FROM arriving_events"), f"{out}/data", f"{out}/cp")
    return spark.read.parquet(f"{out}/data").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("users"),
        F.every(F.col("source_file").contains("events.parquet")).alias("has_source"))


@query("stream_complete_aggregate", "K7", "T2", sql="""
    SELECT event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM events GROUP BY ALL""")
def _(spark, sf):
    out = scratch_path(spark, "complete")
    agg = stream_table(spark, sf, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(money("value")).alias("total"))
    flows.complete_stream(agg, f"{out}/data", f"{out}/cp")
    return spark.read.parquet(f"{out}/data")


@query("stream_static_join", "J14", sql=check("""
    SELECT region, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS total
    FROM sales LEFT JOIN (SELECT * FROM customers WHERE region <> 'ASIA') USING (customer_id) GROUP BY ALL""",
    "sales", "customers"))
def _(spark, sf):
    out = scratch_path(spark, "enriched")
    rows = stream_table(spark, sf, "orders").select(
        F.col("o_custkey").alias("customer_id"), money("o_totalprice").alias("amount"))
    people = d.customers(spark, sf).where("region <> 'ASIA'").select("customer_id", "region")
    flows.append_stream(flows.enrich_stream(rows, people, ["customer_id"], "left"), f"{out}/data",
                        f"{out}/cp")
    return spark.read.parquet(f"{out}/data").groupBy("region").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total"))


@query("stream_stream_as_refreshed_table", "J15", sql="""
    SELECT o_orderstatus, count(*) AS n FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    GROUP BY ALL""")
def _(spark, sf):
    # Both sides land in tables; the join is recomputed over them, so no row is ever too late.
    out = scratch_path(spark, "two-streams")
    flows.append_stream(stream_table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"),
                        f"{out}/orders", f"{out}/cp1")
    flows.append_stream(stream_table(spark, sf, "lineitem").select("l_orderkey"),
                        f"{out}/lines", f"{out}/cp2")
    orders, lines = spark.read.parquet(f"{out}/orders"), spark.read.parquet(f"{out}/lines")
    return (orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
            .groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")))


@query("stream_multi_hop", "T3", "T7", "S10", sql=check("""
    SELECT customer_id, CAST(order_date AS VARCHAR) AS order_date, count(*) AS n,
           CAST(sum(amount) AS DOUBLE) AS total
    FROM sales JOIN customers USING (customer_id) GROUP BY ALL""",
    "sales", "customers"))
def _(spark, sf):
    out = scratch_path(spark, "hops")
    flows.append_stream(flows.with_arrival(stream_table(spark, sf, "orders")), f"{out}/bronze",
                        f"{out}/cp-bronze")
    bronze = flows.read_stream(spark, f"{out}/bronze", "parquet",
                               spark.read.parquet(f"{out}/bronze").schema)
    cleaned = bronze.select(
        F.col("o_custkey").alias("customer_id"), F.to_date("o_orderdate").alias("order_date"),
        money("o_totalprice").alias("amount"))
    people = d.customers(spark, sf).select("customer_id", "region")
    flows.append_stream(flows.enrich_stream(cleaned, people, ["customer_id"]), f"{out}/silver",
                        f"{out}/cp-silver")
    silver = flows.read_stream(spark, f"{out}/silver", "parquet",
                               spark.read.parquet(f"{out}/silver").schema)
    gold = silver.groupBy("customer_id", "order_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total"))
    flows.complete_stream(gold, f"{out}/gold", f"{out}/cp-gold")
    return spark.read.parquet(f"{out}/gold")


@query("stream_upsert", "M16", "T6", sql="""
    SELECT user_id, event_id, event_type, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1 AND event_type <> 'error'""")
def _(spark, sf):
    out, order = scratch_path(spark, "upsert"), ["-ts", "-event_id"]
    upserts.upsert_stream(stream_table(spark, sf, "events"), ["user_id"], order, f"{out}/store",
                          f"{out}/cp", "event_type = 'error'")
    return upserts.read_store(spark, f"{out}/store", ["user_id"], order).select(
        "user_id", "event_id", "event_type", "value")


@query("stream_replica", "M14", "T7", sql=check("""
    SELECT customer_id, country, nullif(tier, 'HOUSEHOLD') AS tier FROM customers WHERE balance > 0""",
    "customers"))
def _(spark, sf):
    out = scratch_path(spark, "replica")
    people = d.customers(spark, sf)
    old = people.select("customer_id", "country", "tier")
    new = people.where("balance > 0").select(
        "customer_id", "country", F.nullif("tier", F.lit("HOUSEHOLD")).alias("tier"))
    empty = old.where("false")
    cdc.change_feed(empty, old, ["customer_id"], 1).write.parquet(f"{out}/feed")
    cdc.change_feed(old, new, ["customer_id"], 2).write.mode("append").parquet(f"{out}/feed")
    feed = flows.read_stream(spark, f"{out}/feed", "parquet",
                             spark.read.parquet(f"{out}/feed").schema)
    upserts.replicate_stream(feed, ["customer_id"], f"{out}/store", f"{out}/cp")
    return upserts.read_replica(spark, f"{out}/store", ["customer_id"], old.schema)


@query("stream_upsert_folded", "M16", sql="""
    SELECT user_id, event_id, event_type, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1 AND event_type <> 'error'""")
def _(spark, sf):
    # Half of the events, a fold, the other half: the base and the batches after it.
    out, order = scratch_path(spark, "folded"), ["-ts", "-event_id"]
    events = d.table(spark, sf, "events")
    for part in (0, 1):
        events.where(F.col("event_id") % 2 == part).write.mode("append").parquet(f"{out}/events")
        upserts.upsert_stream(flows.read_stream(spark, f"{out}/events", "parquet", events.schema), ["user_id"], order,
                              f"{out}/store", f"{out}/cp", "event_type = 'error'")
        if part == 0:
            upserts.fold(spark, f"{out}/store", ["user_id"], order)
    return upserts.read_store(spark, f"{out}/store", ["user_id"], order).select(
        "user_id", "event_id", "event_type", "value")


@query("stream_upsert_lookup", "M16", sql="""
    SELECT user_id, event_id, event_type, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1 AND event_type <> 'error' AND user_id IN (SELECT user_id FROM events WHERE event_type = 'signup')""")
def _(spark, sf):
    # All but sign-ups, a fold, the sign-ups, a fold of the buckets they touch; then only the users who signed up.
    out, order, keys = scratch_path(spark, "lookup"), ["-ts", "-event_id"], ["user_id"]
    events = d.table(spark, sf, "events")
    signups = events.where("event_type = 'signup'")
    for rows in (events.where("event_type <> 'signup'"), signups):
        rows.write.mode("append").parquet(f"{out}/events")
        upserts.upsert_stream(flows.read_stream(spark, f"{out}/events", "parquet", events.schema), keys, order,
                              f"{out}/store", f"{out}/cp", "event_type = 'error'", buckets=16)
        upserts.fold(spark, f"{out}/store", keys, order)
    upserts.vacuum(spark, f"{out}/store")
    return upserts.read_keys(spark, f"{out}/store", keys, order, signups).select(
        "user_id", "event_id", "event_type", "value")


@query("stream_evolved_column", "S10", "S11", "T3", sql="""
    SELECT event_id, user_id, CASE WHEN event_type = 'purchase' THEN value END AS price FROM events""")
def _(spark, sf):
    # A second version of the feed brings a column; the run that meets it fails once and records it.
    out = scratch_path(spark, "evolved")
    events = d.table(spark, sf, "events")
    def run():
        flows.ingest_stream(spark, f"{out}/landing", "json", f"{out}/bronze", f"{out}/cp",
                            hints="event_id BIGINT, user_id BIGINT")
    old, new = events.where("event_type <> 'purchase'"), events.where("event_type = 'purchase'")
    old.select("event_id", "user_id").write.mode("append").json(f"{out}/landing")
    run()
    new.select("event_id", "user_id", F.col("value").alias("price")).write.mode("append").json(f"{out}/landing")
    try:
        run()
    except UnknownFieldError as e:
        if e.fields != ["price"]:
            raise
    run()
    silver = flows.follow_sink(spark, f"{out}/bronze").select("event_id", "user_id", F.col("price").cast("double").alias("price"))
    flows.append_stream(silver, f"{out}/silver", f"{out}/cp-silver")
    return spark.read.schema(silver.schema).parquet(f"{out}/silver")


@query("stream_evolution_modes", "S11", sql="""
    SELECT m.mode, count(*) AS n, count(CASE WHEN m.mode = 'rescue' AND event_type = 'purchase' THEN 1 END) AS rescued
    FROM events, (VALUES ('rescue'), ('failOnNewColumns')) AS m(mode)
    WHERE m.mode = 'rescue' OR event_type <> 'purchase' GROUP BY ALL""")
def _(spark, sf):
    # Rescue loads every row and keeps the new field; the failing mode loads none of the new files.
    out, parts = scratch_path(spark, "modes"), []
    events = d.table(spark, sf, "events").select("event_id", "event_type", "value")
    for mode in ("rescue", "failOnNewColumns"):
        place = f"{out}/{mode}"
        for new in (False, True):
            rows = events.where((F.col("event_type") == "purchase") == F.lit(new))
            (rows if new else rows.drop("value")).write.mode("append").json(f"{place}/landing")
            try:
                flows.ingest_stream(spark, f"{place}/landing", "json", f"{place}/bronze", f"{place}/cp",
                                    hints="event_id BIGINT", evolution=mode)
            except UnknownFieldError as e:
                if mode == "rescue" or e.schema_recorded:
                    raise
        parts.append(flows.read_sink(spark, f"{place}/bronze").agg(
            F.lit(mode).alias("mode"), F.count(F.lit(1)).alias("n"), F.count("_rescued_data").alias("rescued")))
    return parts[0].union(parts[1])


@query("stream_interval_trigger", "K8", sql="SELECT event_type, count(*) AS n FROM events GROUP BY ALL")
def _(spark, sf):
    out = scratch_path(spark, "interval")
    running = flows.append_stream(stream_table(spark, sf, "events").select("event_id", "event_type"),
                                  f"{out}/sink", f"{out}/cp", "200 milliseconds")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return spark.read.parquet(f"{out}/sink").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("stream_sort_is_rejected", "T5", sql="SELECT 'AnalysisException' AS error, count(*) AS n FROM events")
def _(spark, sf):
    stream, error = stream_table(spark, sf, "events").orderBy("ts"), "none"
    try:
        flows.append_stream(stream, scratch_path(spark, "sorted"), scratch_path(spark, "cp"))
    except AnalysisException as e:
        error = type(e).__name__
    return d.table(spark, sf, "events").agg(F.lit(error).alias("error"), F.count(F.lit(1)).alias("n"))


@query("stream_mixed_files", "S10", "S11", sql="""
    SELECT event_id, user_id, CASE WHEN event_type = 'purchase' THEN value END AS value,
           CASE WHEN event_type = 'signup' THEN event_type END AS event_type FROM events""")
def _(spark, sf):
    # Parquet files with and without the new column arrive together, later once more.
    out, events = scratch_path(spark, "mixed-stream"), d.table(spark, sf, "events")
    kind = F.col("event_type")
    def run():
        flows.ingest_stream(spark, f"{out}/landing", "parquet", f"{out}/bronze", f"{out}/cp")
    def land(rows, *columns):
        rows.select(*columns).write.mode("append").parquet(f"{out}/landing")
    land(events.where(kind == "click"), "event_id", "user_id")
    land(events.where(kind == "purchase"), "user_id", "value", "event_id")
    run()
    land(events.where(~kind.isin("click", "purchase", "signup")), "event_id", "user_id")
    land(events.where(kind == "signup"), "event_type", "event_id", "user_id")
    try:
        run()
    except UnknownFieldError as e:
        if e.fields != ["event_type"]:
            raise
    run()
    return flows.read_sink(spark, f"{out}/bronze").select("event_id", "user_id", "value", "event_type")


@query("stream_csv_by_name", "S10", "S12", "S14", sql="""
    SELECT event_id, CASE WHEN event_type <> 'signup' THEN user_id END AS user_id, value,
           CASE event_type WHEN 'purchase' THEN '{"channel":"web"}' END AS rescued FROM events""")
def _(spark, sf):
    # A column more in the middle, two columns swapped, and one column less, each in its own files.
    out, events = scratch_path(spark, "csv-stream"), d.table(spark, sf, "events")
    kind = F.col("event_type")
    feeds = [(~kind.isin("purchase", "signup", "error"), ["event_id", "user_id", "value"]),
             (kind == "purchase", ["event_id", F.lit("web").alias("channel"), "user_id", "value"]),
             (kind == "error", ["value", "user_id", "event_id"]), (kind == "signup", ["event_id", "value"])]
    for k, (rows, columns) in enumerate(feeds):
        events.where(rows).select(*columns).write.mode("append").option("header", True).csv(f"{out}/landing")
        if k != 1:
            flows.ingest_stream(spark, f"{out}/landing", "csv", f"{out}/bronze", f"{out}/cp", evolution="rescue",
                                hints="event_id BIGINT, user_id BIGINT, value DOUBLE", header="true")
    extra = F.regexp_replace("_rescued_data", ',"_file_path":"[^"]*"', "")
    return flows.read_sink(spark, f"{out}/bronze").select("event_id", "user_id", "value", extra.alias("rescued"))


@query("stream_widened_types", "S11", sql="""
    SELECT event_type, count(*) AS n, sum(user_id)::BIGINT AS users, CAST(sum(CAST(value AS DECIMAL(20,2))) AS DOUBLE) AS total
    FROM (SELECT event_type, user_id, CASE WHEN event_type = 'click' THEN trunc(value) ELSE value END AS value FROM events)
    GROUP BY ALL""")
def _(spark, sf):
    # Clicks come with narrow numbers; the run that meets wider ones fails once and records them.
    out, events, failed = scratch_path(spark, "widened-stream"), d.table(spark, sf, "events"), []
    def run():
        try:
            flows.ingest_stream(spark, f"{out}/landing", "parquet", f"{out}/bronze", f"{out}/cp",
                                evolution="addNewColumnsWithTypeWidening")
        except UnknownFieldError as e:
            failed.append(e.fields)
    for clicks, number in ((True, "int"), (False, "decimal(12,2)")):
        rows = events.where((F.col("event_type") == "click") == F.lit(clicks))
        user = F.col("user_id").cast("int" if clicks else "bigint")
        value = F.col("value").cast("int") if clicks else money("value")
        rows.select("event_type", user.alias("user_id"), value.cast(number).alias("value")).write.mode("append").parquet(f"{out}/landing")
        run()
    run()
    assert failed == [["user_id", "value"]]
    return flows.read_sink(spark, f"{out}/bronze").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("user_id").alias("users"), F.sum("value").alias("total"))
