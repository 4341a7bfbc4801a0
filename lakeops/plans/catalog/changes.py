"""MERGE, UPDATE, DELETE, slowly changing dimensions and change feeds."""

from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions.columns import money
from lakeops.operators import cdc, versions
from lakeops.operators.merge import (
    AMBIGUOUS, by_source_delete, delete_where, matched_delete, matched_update, merge_into, not_matched_insert,
    update_where)
from lakeops.operators.ordering import latest_per_key
from lakeops.operators.tables import copy_version, empty_like, write_table
from lakeops.plans import domain as d
from lakeops.plans.domain import check, table
from lakeops.plans.registry import query
from lakeops.session import scratch_path


@query("update_where", "K12", sql=check("""
    SELECT customer_id, tier, CAST(CASE WHEN region = 'ASIA' AND balance < 0 THEN balance + 100 ELSE balance END
        AS DOUBLE) AS balance FROM customers""", "customers"))
def _(spark, sf):
    rows = d.customers(spark, sf)
    return update_where(rows, "region = 'ASIA' AND balance < 0", {"balance": "balance + 100"}).select(
        "customer_id", "tier", "balance")


@query("delete_where", "K13", sql=check("""
    SELECT order_id, status FROM sales WHERE NOT coalesce(nullif(status, 'P') = 'F', false)""", "sales"))
def _(spark, sf):
    rows = d.orders(spark, sf).select("order_id", "status")
    return delete_where(rows, "nullif(status, 'P') = 'F'")


def _target(spark, sf):
    """Known accounts: customers outside one segment, some without an email."""
    return d.customers(spark, sf).where("tier <> 'MACHINERY'").select(
        "customer_id", "tier", F.when(F.col("balance") > 2000, F.col("email")).alias("email"),
        "balance")


def _batch(spark, sf):
    """A batch with updates, deletions and new accounts."""
    return d.customers(spark, sf).where("region IN ('ASIA', 'EUROPE')").select(
        "customer_id", F.lower("tier").alias("tier"), "email",
        (F.col("balance") * 2).cast("decimal(18,2)").alias("balance"),
        (F.col("balance") < 0).alias("is_deleted"))


_ACCOUNTS = """
    tgt AS (SELECT customer_id, tier, CASE WHEN balance > 2000 THEN email END AS email, balance
            FROM customers WHERE tier <> 'MACHINERY'),
    src AS (SELECT customer_id, lower(tier) AS tier, email, CAST(balance * 2 AS DECIMAL(18,2)) AS balance,
                   balance < 0 AS is_deleted FROM customers WHERE region IN ('ASIA', 'EUROPE')),
    j AS (SELECT t.customer_id AS tid, s.customer_id AS sid, t.tier AS ttier, s.tier AS stier,
                 t.email AS temail, s.email AS semail, t.balance AS tbal, s.balance AS sbal, s.is_deleted AS del
          FROM tgt t FULL OUTER JOIN src s ON t.customer_id = s.customer_id)"""
_VALUES = {"tier": "s.tier", "email": "s.email", "balance": "s.balance"}
_ALL = {"customer_id": "s.customer_id", **_VALUES}


@query("merge_upsert", "M1", sql=check(f"""
    WITH {_ACCOUNTS}
    SELECT coalesce(tid, sid) AS customer_id, CASE WHEN sid IS NULL THEN ttier ELSE stier END AS tier,
           CASE WHEN sid IS NULL THEN temail ELSE semail END AS email,
           CAST(CASE WHEN sid IS NULL THEN tbal ELSE sbal END AS DOUBLE) AS balance
    FROM j WHERE NOT (tid IS NOT NULL AND sid IS NOT NULL AND del)""", "customers"))
def _(spark, sf):
    return merge_into(_target(spark, sf), _batch(spark, sf), ["customer_id"], [
        matched_delete("s.is_deleted"), matched_update(_VALUES), not_matched_insert(_ALL)])


@query("merge_update_only_if", "M2", sql=check(f"""
    WITH {_ACCOUNTS}
    SELECT coalesce(tid, sid) AS customer_id, CASE WHEN tid IS NULL THEN stier ELSE ttier END AS tier,
           CASE WHEN tid IS NULL OR (temail IS NULL AND semail IS NOT NULL) THEN semail ELSE temail END AS email,
           CAST(CASE WHEN tid IS NULL THEN sbal ELSE tbal END AS DOUBLE) AS balance FROM j""", "customers"))
def _(spark, sf):
    return merge_into(_target(spark, sf), _batch(spark, sf), ["customer_id"], [
        matched_update({"email": "s.email"}, "t.email IS NULL AND s.email IS NOT NULL"),
        not_matched_insert()])


@query("merge_insert_only", "M3", sql=check(f"""
    WITH {_ACCOUNTS}
    SELECT coalesce(tid, sid) AS customer_id, CASE WHEN tid IS NULL THEN stier ELSE ttier END AS tier,
           CASE WHEN tid IS NULL THEN semail ELSE temail END AS email,
           CAST(CASE WHEN tid IS NULL THEN sbal ELSE tbal END AS DOUBLE) AS balance
    FROM j WHERE tid IS NOT NULL OR sbal > 1000""", "customers"))
def _(spark, sf):
    return merge_into(_target(spark, sf), _batch(spark, sf), ["customer_id"],
                      [not_matched_insert(_ALL, "s.balance > 1000")])


@query("merge_full_sync", "M4", sql=check(f"""
    WITH {_ACCOUNTS}
    SELECT tid AS customer_id, CASE WHEN del THEN ttier ELSE stier END AS tier,
           CASE WHEN del THEN temail ELSE semail END AS email,
           CAST(CASE WHEN del THEN tbal ELSE sbal END AS DOUBLE) AS balance
    FROM j WHERE tid IS NOT NULL AND sid IS NOT NULL""", "customers"))
def _(spark, sf):
    return merge_into(_target(spark, sf), _batch(spark, sf), ["customer_id"], [
        matched_update(_VALUES, "NOT s.is_deleted"), by_source_delete()])


@query("merge_latest_of_batch", "M6", sql=check("""
    WITH latest AS (SELECT customer_id, status, amount FROM (
        SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY order_ts DESC, order_id DESC) AS rn
        FROM sales) WHERE rn = 1)
    SELECT c.customer_id, coalesce(l.status, c.tier) AS tier,
           CAST(coalesce(l.amount, c.balance) AS DOUBLE) AS balance
    FROM customers c LEFT JOIN latest l USING (customer_id)""", "customers", "sales"))
def _(spark, sf):
    target = d.customers(spark, sf).select("customer_id", "tier", "balance")
    batch = latest_per_key(d.orders(spark, sf), ["customer_id"], ["-order_ts", "-order_id"])
    return merge_into(target, batch, ["customer_id"],
                      [matched_update({"tier": "s.status", "balance": "s.amount"})])


@query("merge_schema_evolution", "M7", sql=check("""
    SELECT c.customer_id, CASE WHEN region = 'ASIA' THEN lower(tier) ELSE tier END AS tier,
           CAST(balance AS DOUBLE) AS balance, CASE WHEN region = 'ASIA' THEN country END AS home
    FROM customers c""", "customers"))
def _(spark, sf):
    people = d.customers(spark, sf)
    batch = people.where("region = 'ASIA'").select(
        "customer_id", F.lower("tier").alias("tier"), F.col("country").alias("home"))
    return merge_into(people.select("customer_id", "tier", "balance"), batch, ["customer_id"],
                      [matched_update(), not_matched_insert()], evolve=True)


@query("merge_twice_is_merge_once", "M8", sql=check(f"""
    WITH {_ACCOUNTS}
    SELECT coalesce(tid, sid) AS customer_id, CASE WHEN sid IS NULL THEN ttier ELSE stier END AS tier,
           CASE WHEN sid IS NULL THEN temail ELSE semail END AS email,
           CAST(CASE WHEN sid IS NULL THEN tbal ELSE sbal END AS DOUBLE) AS balance FROM j""", "customers"))
def _(spark, sf):
    star = [matched_update(_VALUES), not_matched_insert(_ALL)]
    once = merge_into(_target(spark, sf), _batch(spark, sf), ["customer_id"], star)
    return merge_into(once, _batch(spark, sf), ["customer_id"], star)


def _cdc_events(spark, sf):
    return table(spark, sf, "events").select(
        "user_id", "event_type", money("value").alias("value"), "ts")


_CDC = dict(keys=["user_id"], sequence_by="ts", delete_when="event_type = 'error'",
            except_cols=["ts"])
_CDC_LOG = "log AS (SELECT user_id, event_type, CAST(value AS DECIMAL(18,2)) AS value, ts FROM events)"


@query("scd1_state", "M9", "T6", sql=f"""
    WITH {_CDC_LOG}
    SELECT user_id, event_type, CAST(value AS DOUBLE) AS value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM log)
    WHERE rn = 1 AND event_type <> 'error'""")
def _(spark, sf):
    return cdc.scd1_rows(cdc.apply_scd1(_cdc_events(spark, sf), **_CDC))


@query("scd1_in_two_batches", "M9", "T6", sql=f"""
    WITH {_CDC_LOG}
    SELECT user_id, event_type, CAST(value AS DOUBLE) AS value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM log)
    WHERE rn = 1 AND event_type <> 'error'""")
def _(spark, sf):
    # The newer half arrives first; the late half must not overwrite it.
    events = _cdc_events(spark, sf)
    middle = F.lit("2024-01-15").cast("timestamp_ntz")
    state = cdc.apply_scd1(events.where(F.col("ts") >= middle), **_CDC)
    return cdc.scd1_rows(cdc.apply_scd1(events.where(F.col("ts") < middle), **_CDC, state=state))


_SCD2_SQL = f"""
    {_CDC_LOG}, hist AS (
    SELECT user_id, event_type, CAST(value AS DOUBLE) AS value,
           strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS __START_AT,
           strftime(lead(ts) OVER (PARTITION BY user_id ORDER BY ts), '%Y-%m-%d %H:%M:%S.%f') AS __END_AT
    FROM log)"""


@query("scd2_history", "M10", sql=f"WITH {_SCD2_SQL} SELECT * FROM hist WHERE event_type <> 'error'")
def _(spark, sf):
    return cdc.apply_scd2(_cdc_events(spark, sf), **_CDC)


@query("scd2_history_split", "M10", sql=f"""
    WITH {_CDC_LOG}, h AS (SELECT event_type, ts, CAST(floor(value) AS BIGINT) % 3 AS grade FROM log),
    steps AS (SELECT *, lag(grade) OVER w AS prev FROM h WINDOW w AS (PARTITION BY event_type ORDER BY ts)),
    kept AS (SELECT * FROM steps WHERE prev IS NULL OR prev <> grade)
    SELECT event_type, grade, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS __START_AT,
           strftime(lead(ts) OVER (PARTITION BY event_type ORDER BY ts), '%Y-%m-%d %H:%M:%S.%f') AS __END_AT
    FROM kept""")
def _(spark, sf):
    # Five keys hold all rows; their histories are cut along the sequence.
    graded = table(spark, sf, "events").select(
        "event_type", "ts", (F.floor("value") % 3).alias("grade"))
    return cdc.apply_scd2(graded, ["event_type"], "ts", "false", ["ts"], coalesce_noop=True,
                          ranges=40)


@query("scd2_incremental", "M10", "T6", sql=f"WITH {_SCD2_SQL} SELECT * FROM hist WHERE event_type <> 'error'")
def _(spark, sf):
    events = _cdc_events(spark, sf)
    late = F.col("event_type") == "click"
    log = cdc.scd2_log(events.where(~late), **_CDC)
    everything = cdc.scd2_log(events.where(late), **_CDC, state=log)
    return cdc.refresh_scd2(cdc.scd2_history(log, ["user_id"]), everything, events.where(late),
                            ["user_id"])


@query("scd2_current", "M18", sql=f"""
    WITH {_SCD2_SQL} SELECT user_id, event_type, value, __START_AT FROM hist
    WHERE event_type <> 'error' AND __END_AT IS NULL""")
def _(spark, sf):
    return cdc.current_rows(cdc.apply_scd2(_cdc_events(spark, sf), **_CDC)).drop("__END_AT")


def _states(spark, sf):
    now = d.customers(spark, sf).select("customer_id", "country", "tier")
    balance = d.customers(spark, sf)
    old = balance.where("tier <> 'MACHINERY'").select(*now.columns)
    new = balance.where("balance > 0").select(
        "customer_id", F.when(F.col("balance") > 9000, "MOVED").otherwise(F.col("country"))
        .alias("country"), F.nullif("tier", F.lit("HOUSEHOLD")).alias("tier"))
    return old, new


_STATES = """
    old AS (SELECT customer_id, country, tier FROM customers WHERE tier <> 'MACHINERY'),
    new AS (SELECT customer_id, CASE WHEN balance > 9000 THEN 'MOVED' ELSE country END AS country,
                   nullif(tier, 'HOUSEHOLD') AS tier FROM customers WHERE balance > 0)"""


def _feed(spark, sf):
    """Version 1 loads the old state, version 2 leads to the new one."""
    old, new = _states(spark, sf)
    first = old.select("*", F.lit("insert").alias("_change_type"),
                       F.lit(1).cast("bigint").alias("_commit_version"))
    return first.unionByName(cdc.change_feed(old, new, ["customer_id"], 2))


@query("change_feed", "M11", "M13", sql=check(f"""
    WITH {_STATES},
    changed AS (SELECT o.customer_id FROM old o JOIN new n USING (customer_id)
                WHERE o.country IS DISTINCT FROM n.country OR o.tier IS DISTINCT FROM n.tier)
    SELECT *, 'update_preimage' AS _change_type, 2 AS _commit_version FROM old
        WHERE customer_id IN (SELECT customer_id FROM changed)
    UNION ALL SELECT *, 'update_postimage', 2 FROM new WHERE customer_id IN (SELECT customer_id FROM changed)
    UNION ALL SELECT *, 'delete', 2 FROM old WHERE customer_id NOT IN (SELECT customer_id FROM new)
    UNION ALL SELECT *, 'insert', 2 FROM new WHERE customer_id NOT IN (SELECT customer_id FROM old)""",
    "customers"))
def _(spark, sf):
    return cdc.changes_between(_feed(spark, sf), 2, 2)


@query("state_as_of_version", "M12", sql=check(f"""
    WITH {_STATES} SELECT 1 AS version, * FROM old UNION ALL SELECT 2, * FROM new""", "customers"))
def _(spark, sf):
    feed = _feed(spark, sf)
    return cdc.state_as_of(feed, ["customer_id"], 1).select(F.lit(1).alias("version"), "*").union(
        cdc.state_as_of(feed, ["customer_id"], 2).select(F.lit(2).alias("version"), "*"))


@query("change_feed_replica", "M14", sql=check(f"WITH {_STATES} SELECT * FROM new", "customers"))
def _(spark, sf):
    old, new = _states(spark, sf)
    return cdc.apply_change_feed(old, cdc.change_feed(old, new, ["customer_id"], 2), ["customer_id"])


@query("net_changes", "M15", sql=check(f"""
    WITH {_STATES} SELECT customer_id, 'insert' AS net_change FROM new""", "customers"))
def _(spark, sf):
    # Over both versions every surviving row is an insert and the deleted ones leave nothing.
    return cdc.net_changes(_feed(spark, sf), ["customer_id"])


@query("appended_only", "M17", sql=check(f"""
    WITH {_STATES} SELECT customer_id, 1 AS _commit_version FROM old
    UNION ALL SELECT customer_id, 2 FROM new WHERE customer_id NOT IN (SELECT customer_id FROM old)""",
    "customers"))
def _(spark, sf):
    return cdc.appended_only(_feed(spark, sf)).select("customer_id", "_commit_version")


@query("merge_ambiguous_is_refused", "M5", sql=check("""
    SELECT true AS refused, count(*) AS n, CAST(sum(balance) AS DOUBLE) AS balance FROM customers""", "customers"))
def _(spark, sf):
    # Customers with several orders: the merge fails, and the table stays as it was.
    path, refused = scratch_path(spark, "merged"), False
    d.customers(spark, sf).select("customer_id", "tier", "balance").write.parquet(path)
    target = spark.read.parquet(path)
    merged = merge_into(target, d.orders(spark, sf).select("customer_id", "amount"), ["customer_id"],
                        [matched_update({"balance": "s.amount"})])
    try:
        write_table(merged, path, "overwrite_strict", constraints=["true"])
    except PySparkException as e:
        refused = AMBIGUOUS in str(e)
    return spark.read.parquet(path).agg(F.lit(refused).alias("refused"), F.count(F.lit(1)).alias("n"),
                                        F.sum("balance").alias("balance"))


@query("copied_version", "K11", sql=check(f"WITH {_STATES} SELECT * FROM old", "customers"))
def _(spark, sf):
    return copy_version(_feed(spark, sf), ["customer_id"], 1, scratch_path(spark, "version"))


@query("net_changes_of_the_second_version", "M15", sql=check(f"""
    WITH {_STATES} SELECT coalesce(o.customer_id, n.customer_id) AS customer_id,
        CASE WHEN n.customer_id IS NULL THEN 'delete' WHEN o.customer_id IS NULL THEN 'insert' ELSE 'update' END AS net_change
    FROM old o FULL JOIN new n USING (customer_id)
    WHERE o.customer_id IS NULL OR n.customer_id IS NULL OR (o.country, o.tier) IS DISTINCT FROM (n.country, n.tier)""",
    "customers"))
def _(spark, sf):
    return cdc.net_changes(cdc.changes_between(_feed(spark, sf), 2, 2), ["customer_id"])


def _log(spark, sf):
    """Both versions as commits of a log, four days apart."""
    old, new = _states(spark, sf)
    log = scratch_path(spark, "log")
    versions.commit_changes(cdc.change_feed(empty_like(old), old, ["customer_id"], 1), log, "2031-03-01 10:00:00")
    versions.commit_changes(cdc.change_feed(old, new, ["customer_id"], 2), log, "2031-03-05 09:30:00")
    return log


@query("state_as_of_time", "M12", sql=check(f"""
    WITH {_STATES}
    SELECT moment, old.*, true AS refused_before FROM old, (VALUES ('2031-03-01 10:00:00'), ('2031-03-05 09:29:59')) t(moment)
    UNION ALL SELECT moment, new.*, true FROM new, (VALUES ('2031-03-05 09:30:00'), ('2031-04-01 00:00:00')) t(moment)""", "customers"))
def _(spark, sf):
    log, refused, parts = _log(spark, sf), False, []
    try:
        versions.table_as_of(spark, log, ["customer_id"], at="2031-03-01 09:59:59")
    except versions.NoSuchVersion:
        refused = True
    for at in ("2031-03-01 10:00:00", "2031-03-05 09:29:59", "2031-03-05 09:30:00", "2031-04-01 00:00:00"):
        parts.append(versions.table_as_of(spark, log, ["customer_id"], at=at).select(
            F.lit(at).alias("moment"), "*", F.lit(refused).alias("refused_before")))
    return reduce(DataFrame.union, parts)


@query("copied_state_of_a_time", "K11", "M12", sql=check(f"WITH {_STATES} SELECT * FROM old", "customers"))
def _(spark, sf):
    return versions.copy_as_of(spark, _log(spark, sf), ["customer_id"], scratch_path(spark, "copy"), at="2031-03-04")
