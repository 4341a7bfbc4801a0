"""Files, incremental loads, schema evolution, rescue and table writes."""

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lakeops.functions.columns import money
from lakeops.operators.clean import reject_null
from lakeops.operators.tables import SchemaMismatch, empty_like, write_table
from lakeops.plans import domain as d
from lakeops.plans.domain import check, table
from lakeops.plans.registry import query
from lakeops.session import scratch_path
from lakeops.sources.drift import rescue_json, rescue_report
from lakeops.sources.files import apply_schema_hints, list_files, read_files, refresh_and_count, with_provenance
from lakeops.sources.ingest import copy_into, read_loaded
from lakeops.sources.records import decode_records


@query("files_directory", "S1", sql="SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY ALL")
def _(spark, sf):
    return read_files(spark, f"{sf}/supplier.parquet*", "parquet").groupBy("s_nationkey").agg(
        F.count(F.lit(1)).alias("n"))


@query("files_csv_declared", "S3", "K4", sql="""
    SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier""")
def _(spark, sf):
    path = scratch_path(spark, "csv")
    table(spark, sf, "supplier").write.option("header", True).option("sep", ";").csv(path)
    return read_files(spark, path, "csv", table(spark, sf, "supplier").schema, header=True, sep=";")


@query("files_hints", "S5", "S6", sql="""
    SELECT s_suppkey, s_name, TRY_CAST(s_name AS INT)::BIGINT AS bad, s_acctbal FROM supplier""")
def _(spark, sf):
    path = scratch_path(spark, "json")
    table(spark, sf, "supplier").withColumn("bad", F.col("s_name")).drop("s_nationkey").write.json(path)
    raw = read_files(spark, path, "json", infer=False)
    assert {t for _, t in raw.dtypes} == {"string"}
    return apply_schema_hints(raw, "s_suppkey BIGINT, bad INT, s_acctbal DOUBLE")


@query("files_provenance", "S7", "T4", sql="""
    SELECT 'orders.parquet' AS source_name, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL""")
def _(spark, sf):
    # The file name is the last part of the table's path when the table is one file.
    rows = with_provenance(table(spark, sf, "orders"))
    name = F.regexp_extract("source_file", r"/(orders\.parquet)(/|$)", 1)
    return rows.groupBy(name.alias("source_name"), "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


def _loads(spark, sf, **options):
    target = scratch_path(spark, "load")
    copy_into(spark, target, sf, "parquet", pattern="orders.parquet", **options)
    copy_into(spark, target, sf, "parquet", pattern="orders.parquet", **options)
    return read_loaded(spark, target).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum(money("o_totalprice")).alias("total"))


@query("copy_into_twice", "S8", sql="""
    SELECT o_orderstatus, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders GROUP BY ALL""")
def _(spark, sf):
    return _loads(spark, sf, allow_overwrites=True)


@query("copy_into_forced", "S9", sql="""
    SELECT o_orderstatus, 2 * count(*) AS n,
           CAST(2 * sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders GROUP BY ALL""")
def _(spark, sf):
    return _loads(spark, sf, force=True)


@query("copy_into_merge_schema", "S8", "S11", sql="""
    SELECT s_suppkey AS id, s_name AS name, CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS balance,
           NULL AS segment FROM supplier
    UNION ALL SELECT c_custkey, c_name, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE), c_mktsegment FROM customer""")
def _(spark, sf):
    target = scratch_path(spark, "parties")
    copy_into(spark, target, sf, "parquet", pattern="supplier.parquet", select=lambda f: f.select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), money("s_acctbal").alias("balance")))
    copy_into(spark, target, sf, "parquet", pattern="customer.parquet", merge_schema=True,
              select=lambda f: f.select(
                  F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                  money("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")))
    return read_loaded(spark, target)


def _drifting(spark, sf):
    """Events as JSON lines: clicks carry a bad number, sign-ups a key in the wrong case,
    purchases an unknown key."""
    kind = F.col("event_type")
    value = F.when(kind == "click", F.lit('"not-a-number"')).otherwise(F.col("value").cast("string"))
    status = F.when(kind == "signup", F.lit("Status")).otherwise(F.lit("status"))
    extra = F.when(kind == "purchase", F.lit(',"channel":"web"')).otherwise(F.lit(""))
    text = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"value":'),
                    value, F.lit(',"'), status, F.lit('":"'), kind, F.lit('"'), extra, F.lit("}"))
    return d.events(spark, sf).select(kind.alias("source_file"), text.alias("value"))


_RESCUE = "event_id BIGINT, value DOUBLE, status STRING"


@query("rescued_data", "S12", sql="""
    SELECT event_type AS source_file, event_id, CASE WHEN event_type <> 'click' THEN value END AS value,
           CASE WHEN event_type <> 'signup' THEN event_type END AS status,
           CASE event_type WHEN 'click' THEN '{"value":"not-a-number"}' WHEN 'signup' THEN '{"Status":"signup"}'
                WHEN 'purchase' THEN '{"channel":"web"}' END AS _rescued_data FROM events""")
def _(spark, sf):
    return rescue_json(_drifting(spark, sf), _RESCUE)


@query("rescued_data_any_case", "S13", sql="""
    SELECT event_type AS source_file, event_id, CASE WHEN event_type <> 'click' THEN value END AS value,
           event_type AS status,
           CASE event_type WHEN 'click' THEN '{"value":"not-a-number"}'
                WHEN 'purchase' THEN '{"channel":"web"}' END AS _rescued_data FROM events""")
def _(spark, sf):
    return rescue_json(_drifting(spark, sf), _RESCUE, case_sensitive=False)


@query("rescue_report", "S14", sql="""
    SELECT event_type AS file_path, count(*) AS rescued_rows FROM events
    WHERE event_type IN ('click', 'signup', 'purchase') GROUP BY ALL""")
def _(spark, sf):
    return rescue_report(rescue_json(_drifting(spark, sf), _RESCUE))


@query("decoded_records", "S17", sql="""
    SELECT CAST(event_id AS VARCHAR) AS key, event_id AS "offset", user_id, event_type, value FROM events""")
def _(spark, sf):
    body = F.to_json(F.struct("user_id", "event_type", "value"))
    records = d.events(spark, sf).select(
        F.col("event_id").cast("string").cast("binary").alias("key"), body.cast("binary").alias("value"),
        F.col("event_id").alias("offset"))
    return decode_records(records, "user_id BIGINT, event_type STRING, value DOUBLE")


@query("table_partitioned", "K1", "K2", "K5", "Q4", sql=check("""
    SELECT status, priority, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS total FROM sales
    WHERE status = 'F' GROUP BY ALL""", "sales"))
def _(spark, sf):
    path = scratch_path(spark, "orders")
    rows = d.orders(spark, sf).select("order_id", "priority", "amount", "status")
    write_table(rows, path, partition_by=["status"], constraints=["amount > 0"])
    write_table(rows, path, "overwrite_strict", partition_by=["status"])
    return spark.read.parquet(path).where("status = 'F'").groupBy("status", "priority").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total"))


@query("table_appended_to_empty_clone", "K4", "K10", sql="""
    SELECT n_regionkey::BIGINT AS n_regionkey, 2 * count(*) AS n FROM nation GROUP BY ALL""")
def _(spark, sf):
    path = scratch_path(spark, "nation")
    nation = table(spark, sf, "nation")
    write_table(empty_like(nation), path)
    write_table(nation, path, "append")
    write_table(nation, path, "append")
    return spark.read.parquet(path).groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("n"))


@query("files_text_and_binary", "S2", sql="""
    SELECT s_nationkey, count(*) AS n, true AS same_bytes FROM supplier GROUP BY ALL""")
def _(spark, sf):
    # Lines as they are, and the files themselves with their lengths.
    path = scratch_path(spark, "text")
    suppliers = table(spark, sf, "supplier")
    suppliers.select(F.concat_ws("|", F.col("s_suppkey").cast("string"), F.col("s_nationkey").cast("string"))).write.text(path)
    lines = read_files(spark, path, "text")
    size = lines.agg(F.sum(F.length("value") + 1)).first()[0]
    on_disk = list_files(spark, path, "part-*").agg(F.sum("length")).first()[0]
    return lines.groupBy(F.split("value", r"\|")[1].cast("bigint").alias("s_nationkey")).agg(
        F.count(F.lit(1)).alias("n")).withColumn("same_bytes", F.lit(size == on_disk))


def _place_file(spark, rows, path):
    """Write ``rows`` as one file of a given name, over the file that has it."""
    staged = scratch_path(spark, "one-file")
    rows.coalesce(1).write.parquet(staged)
    jvm, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    files = jvm.Path(staged).getFileSystem(conf)
    part = files.globStatus(jvm.Path(f"{staged}/part-*"))[0].getPath()
    jvm.FileUtil.copy(files, part, files, jvm.Path(path), False, True, conf)


@query("copy_into_modified_file", "S15", sql="""
    SELECT n_regionkey::BIGINT AS n_regionkey, count(*) + count(CASE WHEN n_nationkey < 10 THEN 1 END) AS n
    FROM nation GROUP BY ALL""")
def _(spark, sf):
    # The file is loaded, replaced by a longer one of the same name, and loaded again in full.
    out, nation = scratch_path(spark, "modified"), table(spark, sf, "nation")
    for rows in (nation.where("n_nationkey < 10"), nation):
        _place_file(spark, rows, f"{out}/landing/nation.parquet")
        for _ in range(2):
            copy_into(spark, f"{out}/table", f"{out}/landing", "parquet", allow_overwrites=True)
    return read_loaded(spark, f"{out}/table").groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("n"))


@query("refreshed_table_count", "S18", sql="SELECT 2 * count(*) AS counted, count(*) AS n FROM supplier")
def _(spark, sf):
    path, name = scratch_path(spark, "refreshed"), "lakeops_refreshed"
    suppliers = table(spark, sf, "supplier")
    suppliers.write.parquet(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    try:
        spark.table(name).count()
        suppliers.write.mode("append").parquet(path)
        counted = refresh_and_count(spark, name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return suppliers.agg(F.lit(counted).cast("bigint").alias("counted"), F.count(F.lit(1)).alias("n"))


@query("table_schema_replaced", "K3", sql="""
    SELECT 'SchemaMismatch' AS refused, n_name, n_regionkey::BIGINT AS region FROM nation""")
def _(spark, sf):
    # An overwrite with other columns is refused until it is asked for.
    path, nation, refused = scratch_path(spark, "nation"), table(spark, sf, "nation"), "none"
    write_table(nation, path)
    other = nation.select("n_name", F.col("n_regionkey").alias("region"))
    try:
        write_table(other, path, "overwrite_strict")
    except SchemaMismatch as e:
        refused = type(e).__name__
    write_table(other, path, "overwrite_strict", overwrite_schema=True)
    return spark.read.parquet(path).select(F.lit(refused).alias("refused"), "n_name", "region")


@query("assertion_fails_the_load", "F.assertion", sql="""
    SELECT true AS failed, count(*) AS n FROM supplier""")
def _(spark, sf):
    suppliers, failed = table(spark, sf, "supplier"), False
    odd = suppliers.withColumn("s_name", F.when(F.col("s_suppkey") != 1, F.col("s_name")))
    try:
        reject_null(odd, ["s_name"], "supplier").write.format("noop").mode("overwrite").save()
    except PySparkException as e:
        failed = "supplier: NULL in s_name" in str(e)
    return reject_null(suppliers, ["s_name"], "supplier").agg(F.lit(failed).alias("failed"), F.count(F.lit(1)).alias("n"))


@query("rescued_nested_data", "S12", "S13", sql="""
    SELECT event_id, event_type, CASE event_type WHEN 'click' THEN 'lines' WHEN 'signup' THEN 'who' ELSE '' END AS rescued,
           event_type <> 'click' AS typed FROM events""")
def _(spark, sf):
    # Clicks have a bad type inside an array, sign-ups an unknown field inside a struct.
    kind, number = F.col("event_type"), F.col("event_id").cast("string")
    quantity = F.when(kind == "click", F.lit('"two"')).otherwise(F.lit("2"))
    who = F.when(kind == "signup", F.lit('{"id":7,"plan":"x"}')).otherwise(F.lit('{"id":7}'))
    text = F.concat(F.lit('{"event_id":'), number, F.lit(',"event_type":"'), kind, F.lit('","lines":[{"q":'), quantity,
                    F.lit('},{"q":1}],"who":'), who, F.lit("}"))
    got = rescue_json(d.events(spark, sf).select(text.alias("value")),
                      "event_id BIGINT, event_type STRING, lines ARRAY<STRUCT<q: INT>>, who STRUCT<id: INT>")
    keys = F.array_join(F.json_object_keys("_rescued_data"), ",")
    return got.select("event_id", "event_type", F.coalesce(keys, F.lit("")).alias("rescued"),
                      F.col("lines")[0]["q"].isNotNull().alias("typed"))


def _parity(df, key, part):
    return df.where(F.col(key) % 2 == part)


@query("copy_into_mixed_files", "S8", "S11", sql="""
    SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 2 = 1 THEN s_acctbal END AS s_acctbal,
           CASE WHEN s_suppkey % 2 = 0 THEN s_nationkey END AS s_nationkey FROM supplier""")
def _(spark, sf):
    # Files without a column, and files with another one, are loaded by one call.
    out, suppliers = scratch_path(spark, "mixed"), table(spark, sf, "supplier")
    _parity(suppliers, "s_suppkey", 0).select("s_suppkey", "s_nationkey", "s_name").write.parquet(f"{out}/landing")
    _parity(suppliers, "s_suppkey", 1).select("s_name", "s_suppkey", "s_acctbal").write.mode("append").parquet(f"{out}/landing")
    for _ in range(2):
        copy_into(spark, f"{out}/table", f"{out}/landing", "parquet", merge_schema=True)
    return read_loaded(spark, f"{out}/table")


@query("copy_into_csv_by_name", "S8", "S10", sql="""
    SELECT c_custkey, c_name, CASE WHEN c_custkey % 2 = 1 THEN c_mktsegment END AS c_mktsegment FROM customer""")
def _(spark, sf):
    # The second feed has its columns in another order, and one more in the middle.
    out, people = scratch_path(spark, "csv-names"), table(spark, sf, "customer")
    for part, columns in ((0, ["c_custkey", "c_name"]), (1, ["c_name", "c_mktsegment", "c_custkey"])):
        _parity(people, "c_custkey", part).select(*columns).write.mode("append").option("header", True).csv(f"{out}/landing")
    copy_into(spark, f"{out}/table", f"{out}/landing", "csv", merge_schema=True, header=True)
    return read_loaded(spark, f"{out}/table")


@query("copy_into_widened_types", "S8", "S11", sql="""
    SELECT l_suppkey % 3 AS kind, count(*) AS n, sum(l_partkey)::BIGINT AS parts,
           CAST(sum(CAST(l_quantity AS DECIMAL(20,2))) AS DOUBLE) AS quantity FROM lineitem GROUP BY ALL""")
def _(spark, sf):
    # One load has whole numbers, later ones of the same table wider ones and decimals, two kinds at once.
    out, lines = scratch_path(spark, "widened"), table(spark, sf, "lineitem")
    kind = F.col("l_suppkey") % 3
    for part, (key, quantity) in enumerate([("int", "smallint"), ("int", "int"), ("bigint", "decimal(12,2)")]):
        lines.where(kind == part).select(kind.alias("kind"), F.col("l_partkey").cast(key), F.col("l_quantity").cast(
            quantity)).write.mode("append").parquet(f"{out}/landing")
        if part != 1:
            copy_into(spark, f"{out}/table", f"{out}/landing", "parquet", widen_types=True)
    loaded = read_loaded(spark, f"{out}/table")
    assert dict(loaded.dtypes)["l_quantity"] == "decimal(12,2)" and dict(loaded.dtypes)["l_partkey"] == "bigint"
    return loaded.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum("l_partkey").alias("parts"),
                                      F.sum("l_quantity").alias("quantity"))
