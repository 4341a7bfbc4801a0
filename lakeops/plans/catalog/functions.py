"""Built-in scalar, array, JSON and VARIANT functions, and SQL functions."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.sqlfuncs import register_sql_functions
from lakeops.plans import domain as d
from lakeops.plans.domain import check, table
from lakeops.plans.registry import query


@query("string_functions", "F.string", sql=check("""
    SELECT customer_id, 'https://www.' || split_part(email, '@', 2) AS url,
           length(name)::BIGINT AS len, email LIKE '%.com' AS commercial,
           regexp_matches(email, '.+@.+\\..+') AS valid,
           regexp_extract(name, '([0-9]+)', 1) AS digits FROM customers""", "customers"))
def _(spark, sf):
    return d.customers(spark, sf).select(
        "customer_id", F.concat(F.lit("https://www."), F.split("email", "@")[1]).alias("url"),
        F.length("name").alias("len"), F.col("email").like("%.com").alias("commercial"),
        F.col("email").rlike(r".+@.+\..+").alias("valid"),
        F.regexp_extract("name", "([0-9]+)", 1).alias("digits"))


@query("date_functions", "F.date", sql="""
    SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
           strftime(date_trunc('month', ts), '%Y-%m-%d') AS month,
           CAST(floor(epoch(ts)) AS BIGINT) AS unix_s, strftime(ts, '%Y/%m/%d %H') AS label,
           CAST(CAST(ts AS DATE) + 5 AS VARCHAR) AS due,
           strftime(to_timestamp(floor(epoch(ts)))::TIMESTAMP, '%Y-%m-%d %H:%M:%S') AS text,
           ts > TIMESTAMP '2024-01-31' - INTERVAL 14 DAYS AS recent,
           strftime(ts + INTERVAL 90 SECONDS, '%Y-%m-%d %H:%M:%S') AS later,
           TRY_CAST(event_type AS TIMESTAMP) IS NULL AS no_time
    FROM events""")
def _(spark, sf):
    ts = F.col("ts").cast("timestamp")
    seconds = F.unix_timestamp(ts)
    bound = F.lit("2024-01-31").cast("timestamp") - F.expr("INTERVAL 14 DAYS")
    return d.events(spark, sf).select(
        "event_id", F.to_date("ts").alias("day"),
        F.date_trunc("month", ts).cast("date").alias("month"), seconds.alias("unix_s"),
        F.date_format(ts, "yyyy/MM/dd HH").alias("label"),
        F.date_add(F.to_date("ts"), 5).alias("due"),
        F.from_unixtime(seconds, "yyyy-MM-dd HH:mm:ss").alias("text"),
        (ts > bound).alias("recent"),
        F.date_format(F.timestamp_add("SECOND", F.lit(90), ts), "yyyy-MM-dd HH:mm:ss")
        .alias("later"), F.try_to_timestamp("event_type").isNull().alias("no_time"))


@query("numeric_functions", "F.numeric", sql="""
    SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey,
           CAST(l_quantity AS BIGINT) % 7 AS rest, CAST(l_quantity AS BIGINT) // 7 AS whole,
           CASE WHEN l_discount = 0 THEN NULL ELSE l_tax / l_discount END AS ratio,
           TRY_CAST(l_returnflag AS INT)::BIGINT AS not_a_number,
           TRY_CAST(CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS INT)::BIGINT AS a_number
    FROM lineitem""")
def _(spark, sf):
    q = F.col("l_quantity").cast("bigint")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (q % 7).alias("rest"),
        F.expr("CAST(l_quantity AS BIGINT) DIV 7").alias("whole"),
        F.try_divide("l_tax", "l_discount").alias("ratio"),
        F.col("l_returnflag").try_cast("int").alias("not_a_number"),
        F.try_to_number(q.cast("string"), F.lit("99")).cast("int").alias("a_number"))


@query("conditional_functions", "F.conditional", sql="""
    SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN 'debt' WHEN s_acctbal < 5000 THEN 'low' ELSE 'high' END AS band,
           coalesce(CASE WHEN s_acctbal > 0 THEN s_name END, 'none') AS label,
           (CASE WHEN s_acctbal > 0 THEN s_nationkey END) IS NOT DISTINCT FROM NULL AS missing
    FROM supplier""")
def _(spark, sf):
    bal = F.col("s_acctbal")
    return table(spark, sf, "supplier").select(
        "s_suppkey", F.when(bal < 0, "debt").when(bal < 5000, "low").otherwise("high").alias("band"),
        F.coalesce(F.when(bal > 0, F.col("s_name")), F.lit("none")).alias("label"),
        F.expr("(CASE WHEN s_acctbal > 0 THEN s_nationkey END) <=> NULL").alias("missing"))


@query("higher_order_functions", "F.array", sql=check("""
    SELECT order_id, count(*) FILTER (quantity >= 2) AS several,
           coalesce(string_agg(item_id, '|' ORDER BY pos) FILTER (quantity >= 2), '') AS several_ids,
           string_agg(CAST(CAST(trunc(quantity * unit_price * 0.8) AS BIGINT) AS VARCHAR), '|' ORDER BY pos) AS discounted
    FROM nested_lines GROUP BY order_id HAVING count(*) FILTER (quantity >= 2) > 0""", "nested_lines"))
def _(spark, sf):
    several = F.filter("items", lambda i: i["quantity"] >= 2)
    cheaper = F.transform("items", lambda i: (i["quantity"] * i["unit_price"] * F.lit("0.8").cast(
        "decimal(2,1)")).cast("int"))
    rows = d.nested_orders(spark, sf).select(
        "order_id", several.alias("several"), cheaper.alias("discounted"))
    return rows.where(F.size("several") > 0).select(
        "order_id", F.size("several").alias("several"),
        F.col("several.item_id").alias("several_ids"), "discounted")


@query("array_functions", "F.array", sql=check("""
    SELECT order_id, order_id % 4 AS n, (SELECT string_agg(w, '|' ORDER BY i) FROM (
        SELECT unnest(string_split(priority, '-')) AS w, generate_subscripts(string_split(priority, '-'), 1) AS i)) AS words,
        split_part(priority, '-', 2) AS second FROM sales""", "sales"))
def _(spark, sf):
    words = F.split("priority", "-")
    doubled = F.array_distinct(F.flatten(F.array(words, words)))
    return d.nested_orders(spark, sf).select(
        "order_id", F.size("items").alias("n"), doubled.alias("words"),
        F.try_element_at(words, F.lit(2)).alias("second"))


_PAYLOAD = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("kind", T.StringType()),
    T.StructField("at", T.StructType([T.StructField("user", T.LongType()),
                                      T.StructField("value", T.DoubleType())]))])


def _json_events(spark, sf):
    """Events as JSON text with a nested object."""
    body = F.to_json(F.struct(
        F.col("event_id").alias("id"), F.col("event_type").alias("kind"),
        F.struct(F.col("user_id").alias("user"), "value").alias("at"),
        F.array("user_id", "event_id").alias("ids")))
    return d.events(spark, sf).select("event_id", "props", body.alias("payload"))


@query("json_functions", "F.json", sql="""
    SELECT event_id, event_id AS id, event_type AS kind, user_id AS user, value,
           CAST(json_extract(props, '$.k') AS BIGINT) AS k, user_id AS user_by_path,
           event_type AS kind_by_tuple FROM events""")
def _(spark, sf):
    rows = _json_events(spark, sf).withColumn("p", F.from_json("payload", _PAYLOAD))
    tupled = rows.select("*", F.json_tuple("payload", "kind").alias("kind_by_tuple"))
    sample = F.schema_of_json(F.lit('{"k": 1}'))
    return tupled.select(
        "event_id", "p.id", "p.kind", "p.at.*", F.from_json("props", sample)["k"].alias("k"),
        F.get_json_object("payload", "$.at.user").cast("bigint").alias("user_by_path"),
        "kind_by_tuple")


@query("variant_functions", "F.variant", sql="""
    SELECT event_id, user_id AS user, value, user_id AS first_id, event_type AS kind,
           CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def _(spark, sf):
    return spark.sql("""
        SELECT event_id, raw:at.user::BIGINT AS user, raw:at.value::DOUBLE AS value,
               raw:ids[0]::BIGINT AS first_id, raw:kind::STRING AS kind,
               variant_get(extra, '$.k', 'bigint') AS k
        FROM (SELECT event_id, parse_json(payload) AS raw, parse_json(props) AS extra
              FROM {rows})""", rows=_json_events(spark, sf))


@query("sql_scalar_functions", "U1", sql=check("""
    SELECT customer_id, 'https://www.' || split_part(email, '@', 2) AS url,
           CASE WHEN email LIKE '%.com' THEN 'Commercial business'
                WHEN email LIKE '%.org' THEN 'Non-profits organization'
                WHEN email LIKE '%.edu' THEN 'Educational institution'
                ELSE 'Unknow extenstion for domain: ' || split_part(email, '@', 2) END AS site,
           CASE WHEN CAST(balance AS DOUBLE) / 2500 >= 3.5 THEN 'A'
                WHEN CAST(balance AS DOUBLE) / 2500 >= 2.75 THEN 'B'
                WHEN CAST(balance AS DOUBLE) / 2500 >= 2 THEN 'C' ELSE 'F' END AS grade
    FROM customers""", "customers"))
def _(spark, sf):
    register_sql_functions(spark)
    return d.customers(spark, sf).select(
        "customer_id", F.expr("get_url(email)").alias("url"), F.expr("site_type(email)").alias("site"),
        F.expr("get_letter_grade(CAST(balance AS DOUBLE) / 2500)").alias("grade"))


@query("literal_lookup", "S20", sql=check("""
    SELECT label, count(*) AS n FROM sales
    JOIN (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'pending')) AS t(status, label) USING (status)
    GROUP BY label""", "sales"))
def _(spark, sf):
    return spark.sql("""
        SELECT label, count(*) AS n FROM {orders} JOIN
            (SELECT * FROM VALUES ('F', 'finished'), ('O', 'open'), ('P', 'pending') AS t(status, label))
            USING (status) GROUP BY label""", orders=d.orders(spark, sf))
