import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakeops.operators.cdc import (
    appended_only, apply_change_feed, apply_scd1, apply_scd2, change_feed, changed_rows,
    changes_between, current_rows, net_changes, refresh_scd2, scd1_rows, scd2_history, scd2_log,
    state_as_of)

SCHEMA = "customer_id BIGINT, name STRING, email STRING, tier STRING, op STRING, change_ts TIMESTAMP"


def at(day, hour, minute=0):
    return datetime(2026, 6 if day > 0 else 5, day if day > 0 else 30, hour, minute)


# Same keys, operations and times as the published feed (day 0 stands for 30 May).
EVENTS = [
    (6, "Faisal", "f@x.com", "bronze", "INSERT", at(0, 7)),
    (21, "Ulrich", "u@x.com", "bronze", "INSERT", at(1, 8)),
    (22, "Valentina", "v@x.com", "silver", "INSERT", at(1, 8, 5)),
    (13, "Maya", "m.new@x.com", "gold", "UPDATE", at(1, 9)),
    (3, "Carla", "c@x.com", "silver", "UPDATE", at(1, 10, 30)),
    (6, "Faisal", "f@x.com", "bronze", "DELETE", at(1, 11, 15)),
    (23, "Wei", "w@x.com", "bronze", "INSERT", at(2, 7, 30)),
    (13, "Maya", "m.new@x.com", "gold", "UPDATE", at(2, 9)),
    (22, "Valentina", "v2@x.com", "gold", "UPDATE", at(2, 10)),
    (24, "Xochitl", "x@x.com", "bronze", "INSERT", at(2, 11, 45)),
    (21, "Ulrich", "u2@x.com", "silver", "UPDATE", at(3, 8)),
    (25, "Yara", "y@x.com", "bronze", "INSERT", at(3, 9, 20)),
    (24, "Xochitl", "x@x.com", "bronze", "DELETE", at(3, 15)),
]
ARGS = dict(keys=["customer_id"], sequence_by="change_ts", delete_when="op = 'DELETE'",
            except_cols=["op", "change_ts"])


@pytest.fixture
def events(spark):
    return spark.createDataFrame(EVENTS, SCHEMA)


def test_scd1_of_the_feed(events):
    got = {r["customer_id"]: r for r in scd1_rows(apply_scd1(events, **ARGS)).collect()}
    assert sorted(got) == [3, 13, 21, 22, 23, 25]
    assert got[21]["email"] == "u2@x.com" and set(got[3].asDict()) == {"customer_id", "name", "email", "tier"}


def test_scd2_of_the_feed(events):
    hist = apply_scd2(events, **ARGS)
    assert hist.count() == 11
    assert apply_scd2(events, **ARGS, coalesce_noop=True).count() == 10
    ends = {r["customer_id"]: r["__END_AT"] for r in hist.where("customer_id IN (6, 24)").collect()}
    assert ends == {6: at(1, 11, 15), 24: at(3, 15)}
    cur = current_rows(hist).select("customer_id", "name", "email", "tier")
    scd1 = scd1_rows(apply_scd1(events, **ARGS)).select(*cur.columns)
    assert sorted(map(tuple, cur.collect())) == sorted(map(tuple, scd1.collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_arrival_order_and_batches_do_not_matter(spark, events, rows, seed):
    shuffled = EVENTS[:]
    random.Random(seed).shuffle(shuffled)
    first, second = (spark.createDataFrame(p, SCHEMA) for p in (shuffled[:6], shuffled[6:]))
    state = apply_scd1(second, **ARGS, state=apply_scd1(first, **ARGS))
    assert rows(scd1_rows(state)) == rows(scd1_rows(apply_scd1(events, **ARGS)))
    log1 = scd2_log(first, **ARGS)
    log2 = scd2_log(second, **ARGS, state=log1)
    for noop in (False, True):
        full = rows(apply_scd2(events, **ARGS, coalesce_noop=noop))
        assert rows(scd2_history(log2, ["customer_id"], noop)) == full
        step = refresh_scd2(scd2_history(log1, ["customer_id"], noop), log2, second,
                            ["customer_id"], noop)
        assert rows(step) == full


def test_late_event_cannot_revive_a_deleted_key(spark, events):
    state = apply_scd1(events, **ARGS)
    late = spark.createDataFrame([(24, "Late", "l@x.com", "gold", "UPDATE", at(3, 14))], SCHEMA)
    assert 24 not in {r[0] for r in scd1_rows(apply_scd1(late, **ARGS, state=state)).collect()}


def test_equal_sequence_prefers_the_delete(spark):
    both = spark.createDataFrame([(1, "a", "e", "t", "DELETE", at(1, 1)), (1, "a", "e", "t", "UPDATE", at(1, 1))], SCHEMA)
    assert scd1_rows(apply_scd1(both, **ARGS)).count() == 0
    assert apply_scd2(both, **ARGS).count() == 0


def test_null_sequence_is_an_error(spark):
    bad = spark.createDataFrame([(1, "a", "e", "t", "UPDATE", None)], SCHEMA)
    with pytest.raises(Exception, match="NULL in"):
        apply_scd1(bad, **ARGS).count()


def test_hot_key_history_equals_the_plain_one(spark, rows):
    ev = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 1 ELSE id % 97 + 2 END AS customer_id", "'n' AS name", "'e' AS email",
        "CAST(pmod(xxhash64(id), 3) AS STRING) AS tier",
        "CASE WHEN id % 11 = 0 THEN 'DELETE' ELSE 'UPDATE' END AS op",
        "timestamp_seconds(pmod(xxhash64(id, 1), 100000)) AS change_ts")
    for noop in (False, True):
        split = apply_scd2(ev, **ARGS, coalesce_noop=noop, ranges=30)
        assert rows(split) == rows(apply_scd2(ev, **ARGS, coalesce_noop=noop))


OLD = [(1, "a", 1), (2, "b", None), (3, "c", 3), (None, "n", 0)]
NEW = [(1, "a", 1), (2, "b", 5), (4, "d", 4), (None, "m", 0)]


@pytest.fixture
def states(spark):
    s = "id INT, v STRING, x INT"
    return spark.createDataFrame(OLD, s), spark.createDataFrame(NEW, s)


def test_change_feed_and_replica(states, rows):
    old, new = states
    feed = change_feed(old, new, ["id"], 7)
    kinds = sorted((str(r["id"]), r["_change_type"]) for r in feed.collect())
    assert kinds == [("2", "update_postimage"), ("2", "update_preimage"), ("3", "delete"), ("4", "insert"),
                     ("None", "update_postimage"), ("None", "update_preimage")]
    assert rows(apply_change_feed(old, feed, ["id"])) == rows(new)
    assert rows(apply_change_feed(new, feed, ["id"])) == rows(new)
    assert change_feed(new, new, ["id"], 8).count() == 0


def test_duplicate_keys_in_a_state_are_reported(states):
    old, new = states
    with pytest.raises(Exception, match="not unique"):
        change_feed(old.union(old), new, ["id"], 1).count()


def test_changed_rows(states, rows):
    got = {str(r["id"]): (r["status"], r["changed_columns"]) for r in changed_rows(*states, ["id"]).collect()}
    assert got == {"2": ("changed", ["x"]), "3": ("removed", None), "4": ("added", None), "None": ("changed", ["v"])}


def test_versions_ranges_and_net_changes(spark, states, rows):
    old, new = states
    empty = old.where("false")
    third = new.where("id IS NULL OR id <> 4").union(spark.createDataFrame([(3, "again", 9)], old.schema))
    feed = (change_feed(empty, old, ["id"], 1).union(change_feed(old, new, ["id"], 2))
            .union(change_feed(new, third, ["id"], 3)))
    for version, state in ((1, old), (2, new), (3, third)):
        assert rows(state_as_of(feed, ["id"], version)) == rows(state)
    assert changes_between(feed, 2, 2).count() == 6
    assert appended_only(changes_between(feed, 2)).count() == 2
    net = {str(r["id"]): r["net_change"] for r in net_changes(changes_between(feed, 2), ["id"]).collect()}
    assert net == {"2": "update", "3": "update", "None": "update"}
    first = {str(r["id"]): r["net_change"] for r in net_changes(feed, ["id"]).collect()}
    assert first == {"1": "insert", "2": "insert", "3": "insert", "None": "insert"}


def test_delete_of_an_unknown_key_is_ignored(spark, states, rows):
    feed = spark.createDataFrame([(50, "x", 1, "delete", 3)], "id INT, v STRING, x INT, _change_type STRING, _commit_version BIGINT")
    assert rows(apply_change_feed(states[0], feed, ["id"])) == rows(states[0])
