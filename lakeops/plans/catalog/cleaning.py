"""Projection, filters and cleaning."""

from pyspark.sql import functions as F

from lakeops.functions.columns import REGION_COUNTRIES, derive_region, money
from lakeops.operators.clean import CUSTOMER_FEED, load_typed, order_lines, tidy, uncastable_rows
from lakeops.operators.ordering import latest_per_key
from lakeops.plans import domain as d
from lakeops.plans.domain import check, table
from lakeops.plans.registry import query


@query("columns_add_rename_drop", "P1", sql="""
    SELECT p_partkey, p_name AS title, p_brand, p_type,
           CAST(CAST(p_retailprice AS DECIMAL(18,2)) * 2 AS DOUBLE) AS double_price FROM part""")
def _(spark, sf):
    return (table(spark, sf, "part").withColumn("double_price", money("p_retailprice") * 2)
            .withColumnRenamed("p_name", "title").drop("p_size", "p_retailprice"))


@query("columns_split", "P2", sql="""
    SELECT p_partkey, split_part(p_name, ' ', 1) AS adjective, split_part(p_name, ' ', 2) AS noun
    FROM part""")
def _(spark, sf):
    words = F.split("p_name", " ")
    return table(spark, sf, "part").select(
        "p_partkey", words.getItem(0).alias("adjective"), words.getItem(1).alias("noun"))


@query("filters", "P3", sql="""
    SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice FROM orders
    WHERE o_orderstatus IN ('O', 'F') AND o_totalprice > 200000
      AND regexp_matches(o_orderpriority, '^[12]-') AND o_orderpriority LIKE '%H%'
      AND o_orderdate IS NOT NULL""")
def _(spark, sf):
    return table(spark, sf, "orders").where(
        F.col("o_orderstatus").isin("O", "F") & (F.col("o_totalprice") > 200000)
        & F.col("o_orderpriority").rlike("^[12]-") & F.col("o_orderpriority").like("%H%")
        & F.col("o_orderdate").isNotNull()
    ).select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")


def _gappy(spark, sf):
    """Customers whose negative balances and machinery segments are missing."""
    return table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") >= 0, money("c_acctbal")).alias("balance"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")).alias("segment"))


_GAPPY = """SELECT c_custkey,
    CASE WHEN c_acctbal >= 0 THEN CAST(c_acctbal AS DECIMAL(18,2)) END AS balance,
    CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END AS segment FROM customer"""


@query("drop_nulls", "P4", sql=f"""
    WITH g AS ({_GAPPY})
    SELECT 'any' AS variant, count(*) AS n FROM g WHERE balance IS NOT NULL AND segment IS NOT NULL
    UNION ALL SELECT 'all', count(*) FROM g WHERE balance IS NOT NULL OR segment IS NOT NULL
    UNION ALL SELECT 'subset', count(*) FROM g WHERE segment IS NOT NULL
    UNION ALL SELECT 'thresh', count(*) FROM g
        WHERE 1 + (balance IS NOT NULL)::INT + (segment IS NOT NULL)::INT >= 2""")
def _(spark, sf):
    g = _gappy(spark, sf)
    variants = {"any": g.dropna(), "all": g.dropna("all", subset=["balance", "segment"]),
                "subset": g.dropna(subset=["segment"]), "thresh": g.dropna("any", thresh=2)}
    counted = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(v).alias("variant"), "n")
               for v, df in variants.items()]
    return counted[0].union(counted[1]).union(counted[2]).union(counted[3])


@query("fill_nulls", "P5", sql=f"""
    WITH g AS ({_GAPPY})
    SELECT c_custkey, CAST(coalesce(balance, 0) AS DOUBLE) AS balance,
           nullif(coalesce(segment, 'unknown'), 'HOUSEHOLD') AS segment FROM g""")
def _(spark, sf):
    return (_gappy(spark, sf).fillna({"balance": 0, "segment": "unknown"})
            .na.replace("HOUSEHOLD", None, subset=["segment"]))


@query("types_standardised", "P6", "S4", sql="""
    SELECT o_orderkey AS order_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date,
           CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS created_at FROM orders""")
def _(spark, sf):
    raw = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        F.col("o_totalprice").cast("string").alias("amount"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("created_at"))
    return load_typed(raw, {"order_id": "bigint", "amount": "decimal(18,2)"}).withColumns({
        "order_date": F.to_date("order_date", "yyyy-MM-dd"),
        "created_at": F.to_timestamp("created_at")})


@query("cast_failures", "P7", sql="""
    WITH raw AS (SELECT l_returnflag, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)
                        || CASE WHEN l_returnflag = 'R' THEN '$' ELSE '' END AS qty FROM lineitem)
    SELECT l_returnflag, qty, count(*) AS n FROM raw
    WHERE TRY_CAST(qty AS INT) IS NULL AND qty IS NOT NULL GROUP BY ALL""")
def _(spark, sf):
    raw = table(spark, sf, "lineitem").select("l_returnflag", F.concat(
        F.col("l_quantity").cast("bigint").cast("string"),
        F.when(F.col("l_returnflag") == "R", "$").otherwise("")).alias("qty"))
    return uncastable_rows(raw, "qty", "int").groupBy("l_returnflag", "qty").agg(
        F.count(F.lit(1)).alias("n"))


@query("string_hygiene", "P8", sql="""
    SELECT s_suppkey, lower(s_name) AS low, upper(s_name) AS up,
           upper(left(s_name, 1)) || lower(substr(s_name, 2)) AS title,
           regexp_replace(s_name, '[^0-9]', '', 'g') AS digits,
           CAST(regexp_extract(s_name, '#0*(\\d+)$', 1) AS VARCHAR) AS number FROM supplier""")
def _(spark, sf):
    padded = table(spark, sf, "supplier").withColumn(
        "s_name", F.concat(F.lit("  "), F.upper("s_name"), F.lit(" ")))
    name = F.trim("s_name")
    return padded.select(
        "s_suppkey", F.lower(F.ltrim(F.rtrim("s_name"))).alias("low"), F.upper(name).alias("up"),
        F.initcap(name).alias("title"), F.regexp_replace("s_name", "[^0-9]", "").alias("digits"),
        F.regexp_extract(name, r"#0*(\d+)$", 1).alias("number"))


_CODES = ["de", "FR ", "us", "CA", "jp", "CN", " br", "MX", "ae", "ZA", "xx", "AT", "in", "CL",
          "eg", "PL", "kr", "CO", "SA", "dk", "au", "AR", "fi", "sg", "zz"]


def _coded_customers(spark, sf):
    codes = F.array(*[F.lit(c) for c in _CODES])
    return table(spark, sf, "customer").withColumn(
        "country", F.get(codes, F.col("c_nationkey")))


_CODE_SQL = "list_extract([" + ", ".join(f"'{c}'" for c in _CODES) + "], c_nationkey + 1)"
_REGION_SQL = "CASE " + " ".join(
    f"WHEN list_contains({list(codes)}, code) THEN '{region}'" for region, codes in REGION_COUNTRIES.items()) + " ELSE 'OTHER' END"


@query("region_from_country", "P9", sql=f"""
    WITH c AS (SELECT upper(trim({_CODE_SQL})) AS code FROM customer)
    SELECT code AS country, {_REGION_SQL} AS region, count(*) AS n FROM c GROUP BY ALL""")
def _(spark, sf):
    rows = _coded_customers(spark, sf).withColumn("region", derive_region("country"))
    return rows.groupBy(F.upper(F.trim("country")).alias("country"), "region").agg(
        F.count(F.lit(1)).alias("n"))


@query("customers_normalised", "P10", sql=f"""
    WITH raw AS (
        SELECT o_custkey AS customer_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS signup_date,
               'Buyer' AS name, lower(o_orderpriority) || '@example.com' AS email,
               CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 1 END AS has_email,
               upper(trim({_CODE_SQL})) AS code
        FROM orders JOIN customer ON o_custkey = c_custkey),
    ranked AS (
        SELECT *, {_REGION_SQL} AS region, row_number() OVER (
            PARTITION BY customer_id ORDER BY signup_date DESC, name, email, code) AS rn
        FROM raw WHERE has_email IS NOT NULL)
    SELECT customer_id, signup_date, name, email, code AS country, region FROM ranked
    WHERE rn = 1""")
def _(spark, sf):
    bought = table(spark, sf, "orders").join(
        _coded_customers(spark, sf), F.col("o_custkey") == F.col("c_custkey"))
    email = F.concat(F.lit(" "), F.upper("o_orderpriority"), F.lit("@EXAMPLE.com "))
    raw = bought.select(
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("signup_date"),
        F.lit(" bUYER ").alias("name"),
        F.when(F.col("o_orderstatus") != "P", email).alias("email"), "country")
    return tidy(raw, CUSTOMER_FEED).withColumn("region", derive_region("country"))


@query("distinct_rows", "P11", sql="""
    SELECT DISTINCT l_returnflag, l_linestatus, CAST(l_shipdate AS DATE)::VARCHAR AS day
    FROM lineitem""")
def _(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_returnflag", "l_linestatus", F.col("l_shipdate").cast("date").alias("day")).distinct()


@query("distinct_keys", "P12", sql="SELECT DISTINCT user_id FROM events")
def _(spark, sf):
    return d.events(spark, sf).dropDuplicates(["user_id"]).select("user_id")


@query("latest_order_per_customer", "P13", "P17", sql=check("""
    SELECT customer_id, order_id, CAST(order_date AS VARCHAR) AS order_date, status,
           CAST(amount AS DOUBLE) AS amount
    FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
                                       ORDER BY order_ts DESC, order_id DESC) AS rn FROM sales)
    WHERE rn = 1""", "sales"))
def _(spark, sf):
    return latest_per_key(d.orders(spark, sf), ["customer_id"], ["-order_ts", "-order_id"]).drop(
        "order_ts", "priority")


@query("select_all_except", "P17", sql=check(
    "SELECT * EXCLUDE (price, size), CAST(price AS DOUBLE) AS price FROM items", "items"))
def _(spark, sf):
    return spark.sql("SELECT * EXCEPT (size) FROM {items}", items=d.items(spark, sf))


@query("struct_access_and_flatten", "P14", sql=check("""
    SELECT customer_id, split_part(name, '#', 1) AS kind, region AS area, country,
           region || '/' || country AS place FROM customers""", "customers"))
def _(spark, sf):
    profile = F.struct(
        F.split("name", "#").getItem(0).alias("kind"),
        F.struct(F.col("region").alias("area"), "country").alias("address"))
    rows = d.customers(spark, sf).select("customer_id", profile.alias("profile"))
    return rows.select("customer_id", "profile.kind", "profile.address.*", F.concat(
        "profile.address.area", F.lit("/"), "profile.address.country").alias("place"))


@query("explode_variants", "P15", sql=check("""
    SELECT 'explode' AS kind, count(*) AS n, sum(quantity)::BIGINT AS units, NULL::BIGINT AS last_pos
    FROM nested_lines
    UNION ALL SELECT 'explode_outer', (SELECT count(*) FROM nested_lines)
        + (SELECT count(*) FROM sales WHERE order_id % 4 = 0),
        (SELECT sum(quantity) FROM nested_lines)::BIGINT, NULL
    UNION ALL SELECT 'posexplode', count(*), sum(quantity)::BIGINT, max(pos) - 1
        FROM nested_lines""", "nested_lines"))
def _(spark, sf):
    nested = d.nested_orders(spark, sf).select("items")
    last = F.lit(None).cast("int").alias("last_pos")
    n, units = F.count(F.lit(1)).alias("n"), F.sum("item.quantity").alias("units")
    plain = nested.select(F.explode("items").alias("item")).agg(n, units).select(
        F.lit("explode").alias("kind"), "n", "units", last)
    outer = nested.select(F.explode_outer("items").alias("item")).agg(n, units).select(
        F.lit("explode_outer").alias("kind"), "n", "units", last)
    placed = nested.select(F.posexplode("items").alias("pos", "item")).agg(
        n, units, F.max("pos").alias("last_pos")).select(
        F.lit("posexplode").alias("kind"), "n", "units", "last_pos")
    return plain.union(outer).union(placed)


@query("order_lines", "P16", sql=check("""
    SELECT order_id, customer_id, CAST(order_date AS VARCHAR) AS order_date, item_id, quantity,
           CAST(unit_price AS DOUBLE) AS unit_price, CAST(quantity * unit_price AS DOUBLE) AS line_total
    FROM nested_lines""", "nested_lines"))
def _(spark, sf):
    return order_lines(d.nested_orders(spark, sf)).drop("order_ts")


@query("range_filter_before_load", "P18", sql=check("""
    SELECT flag, count(*) AS n, sum(quantity)::BIGINT AS units FROM lines
    WHERE quantity > 5 AND line_total BETWEEN 1000 AND 50000 GROUP BY flag""", "lines"))
def _(spark, sf):
    return (d.lines(spark, sf).where("quantity > 5 AND line_total BETWEEN 1000 AND 50000")
            .groupBy("flag").agg(F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("units")))
