import json
import os
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lakeops.operators import cdc
from lakeops.sources.drift import UnknownFieldError, rescue_report
from lakeops.streaming import flows, upserts


@pytest.fixture
def land(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()

    def write(name, *lines):
        (folder / name).write_text("\n".join(lines) + "\n")
        return str(folder)
    return write


def test_each_file_is_read_once(spark, tmp_path, land):
    src = land("a.json", '{"id":1}', '{"id":2}')
    sink, cp = str(tmp_path / "s"), str(tmp_path / "c")
    run = lambda: flows.ingest_stream(spark, src, "json", sink, cp, "id BIGINT", prepare=flows.with_arrival)
    run(), run()
    assert spark.read.parquet(sink).count() == 2
    land("b.json", '{"id":3}')
    run()
    got = spark.read.parquet(sink)
    assert got.count() == 3 and got.where("source_file LIKE '%b.json'").count() == 1


def test_new_column_fails_once_then_loads(spark, tmp_path, land):
    src = land("1.json", '{"id":1,"items":[{"q":2}]}')
    sink, cp = str(tmp_path / "s"), str(tmp_path / "c")
    run = lambda **kw: flows.ingest_stream(spark, src, "json", sink, cp, hints="id BIGINT", **kw)
    run()
    land("2.json", '{"id":2,"discount":"0.5"}')
    with pytest.raises(UnknownFieldError) as e:
        run(evolution="failOnNewColumns")
    assert not e.value.schema_recorded
    with pytest.raises(UnknownFieldError) as e:
        run()
    assert e.value.schema_recorded and spark.read.parquet(sink).count() == 1
    run()
    rows = flows.read_sink(spark, sink).orderBy("id").collect()
    assert [(r["id"], r["discount"]) for r in rows] == [(1, None), (2, "0.5")]


def test_a_late_file_with_an_old_time_is_looked_at(spark, tmp_path, land):
    src = land("1.json", '{"id":1}')
    sink, cp = str(tmp_path / "s"), str(tmp_path / "c")
    run = lambda: flows.ingest_stream(spark, src, "json", sink, cp, hints="id BIGINT")
    run()
    land("0.json", '{"id":2,"extra":"kept"}')
    os.utime(f"{src}/0.json", (10**9, 10**9))
    with pytest.raises(UnknownFieldError):
        run()
    run()
    assert sorted((r.id, r.extra) for r in flows.read_sink(spark, sink).collect()) == [(1, None), (2, "kept")]


def test_values_that_do_not_fit_are_kept_in_every_mode(spark, tmp_path, land):
    src = land("1.json", '{"id":1,"v":"2"}', '{"id":"one","v":"3"}')
    for mode in ("addNewColumns", "none", "rescue"):
        sink = str(tmp_path / mode)
        flows.ingest_stream(spark, src, "json", sink, f"{sink}-c", hints="id BIGINT", evolution=mode)
        got = {r.v: r for r in flows.read_sink(spark, sink).collect()}
        assert got["2"]._rescued_data is None and "one" in got["3"]._rescued_data and got["3"].id is None


def test_csv_rescue(spark, tmp_path, land):
    src = land("1.csv", "id,name", "1,lamp", "two,desk", "3,rug,extra")
    sink = str(tmp_path / "s")
    flows.ingest_stream(spark, src, "csv", sink, str(tmp_path / "c"), "id INT, name STRING", evolution="rescue", header="true")
    got = sorted((r.name, r.id, r._rescued_data) for r in flows.read_sink(spark, sink).collect())
    assert [g[:2] for g in got] == [("desk", None), ("lamp", 1), ("rug", 3)]
    assert "two,desk" in got[0][2] and got[1][2] is None and "3,rug,extra" in got[2][2]


def test_a_new_column_reaches_silver(spark, tmp_path):
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    line = {"item_id": "X9", "quantity": 1, "unit_price": 4.0}
    def put(folder, name, row):
        (landing / folder).mkdir(parents=True, exist_ok=True)
        (landing / folder / name).write_text(json.dumps(row) + "\n")
    order = {"order_id": 31, "customer_id": 5, "order_ts": "2031-05-01T10:00:00", "status": "placed", "currency": "EUR",
             "amount": 4.0, "items": [line]}
    put("customers", "a.json", {"customer_id": 5, "name": "Ro", "email": "r@y.example", "country": "FR",
                                "signup_date": "2030-01-01", "tier": "gold"})
    put("items", "a.json", {"item_id": "X9", "name": "thing", "category": "c", "price": 4.0, "in_stock": True})
    put("orders", "1.json", order)
    from lakeops.plans import medallion as m
    hints = {"customers": "customer_id BIGINT", "orders": "order_id BIGINT, customer_id BIGINT, order_ts TIMESTAMP, "
             "amount DOUBLE, items ARRAY<STRUCT<item_id: STRING, quantity: INT, unit_price: DOUBLE>>"}
    places = {n: m.Landing(f"{landing}/{n}", "json", None, {"hints": hints[n]}) for n in hints}
    places["items"] = m.Landing(f"{landing}/items", "json", "item_id STRING, name STRING, category STRING, price DOUBLE, in_stock BOOLEAN")
    silver = _orders_of(m.refresh_medallion(spark, places, out, "2040-01-01"))
    assert silver == {31: 0.0}
    put("orders", "3.json", {**order, "order_id": 33, "discount_amount": 2.5})
    with pytest.raises(UnknownFieldError):
        m.refresh_medallion(spark, places, out, "2040-01-01")
    assert _orders_of(m.refresh_medallion(spark, places, out, "2040-01-01")) == {31: 0.0, 33: 2.5}


def _orders_of(tables):
    return {r.order_id: float(r.discount_amount) for r in tables["silver_orders"].collect()}


def test_complete_aggregate_equals_batch(spark, tmp_path, land):
    src = land("a.json", '{"k":"x","v":1}', '{"k":"y","v":2}')
    sink, cp = str(tmp_path / "s"), str(tmp_path / "c")
    def run():
        s = flows.read_stream(spark, src, "json", "k STRING, v INT")
        flows.complete_stream(s.groupBy("k").agg(F.sum("v").alias("v")), sink, cp)
        return dict(map(tuple, spark.read.parquet(sink).collect()))
    assert run() == {"x": 1, "y": 2}
    land("b.json", '{"k":"x","v":10}')
    assert run() == {"x": 11, "y": 2}


def test_interval_trigger(spark, tmp_path, land):
    src = land("a.json", '{"id":1}')
    sink = str(tmp_path / "s")
    q = flows.append_stream(flows.read_stream(spark, src, "json", "id INT"), sink, str(tmp_path / "c"), "200 milliseconds")
    try:
        q.processAllAvailable()
        assert spark.read.parquet(sink).count() == 1
    finally:
        q.stop()


def test_sorting_a_raw_stream_is_rejected(spark, tmp_path, land):
    s = flows.read_stream(spark, land("a.json", '{"id":1}'), "json", "id INT").orderBy("id")
    with pytest.raises(AnalysisException):
        s.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).start()


def test_daily_aggregate_with_bounded_state(spark, tmp_path, land):
    src = land("a.json", '{"ts":"2026-06-01T10:00:00Z","v":1}', '{"ts":"2026-06-01T23:00:00Z","v":2}')
    land("b.json", '{"ts":"2026-06-09T10:00:00Z","v":4}')
    s = flows.read_stream(spark, src, "json", "ts TIMESTAMP, v INT", maxFilesPerTrigger="1")
    agg = flows.daily_aggregate(s, "ts", [], [F.sum("v").alias("v")])
    sink = str(tmp_path / "s")
    flows.append_stream(agg, sink, str(tmp_path / "c"))
    got = [(str(r["day"]), r["v"]) for r in spark.read.parquet(sink).collect()]
    assert got == [("2026-06-01", 3)]


def test_upsert_store(spark, tmp_path, land, rows):
    def event(i, seq, v, op="U"):
        return f'{{"id":{i},"seq":{seq},"v":"{v}","op":"{op}"}}'
    src = land("a.json", event(1, 1, "a"), event(1, 3, "c"), event(2, 1, "x"))
    store, cp, order = str(tmp_path / "st"), str(tmp_path / "c"), ["-seq"]

    def run(to=store):
        s = flows.read_stream(spark, src, "json", "id INT, seq INT, v STRING, op STRING")
        upserts.upsert_stream(s, ["id"], order, to, cp, "op = 'D'")
        return rows(upserts.read_store(spark, to, ["id"], order).select("id", "v"))

    assert run() == [(1, "c"), (2, "x")]
    land("b.json", event(1, 2, "late"), event(2, 2, "x", "D"), event(3, 1, "n"))
    assert run() == [(1, "c"), (3, "n")]
    last = upserts.fold(spark, store, ["id"], order)
    land("c.json", event(2, 1, "older than the delete"), event(3, 5, "new"))
    assert run() == [(1, "c"), (3, "new")]
    upserts.fold(spark, store, ["id"], order)
    # A crash after the last batch was written: it is replayed under the same number.
    commits = sorted((tmp_path / "c" / "commits").glob("[0-9]*"), key=lambda f: int(f.name))
    commits[-1].write_bytes(b"")
    os.remove(commits[-1])
    (tmp_path / "c" / "commits" / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    assert run() == [(1, "c"), (3, "new")]
    assert last == 1 and len(list((tmp_path / "st" / "base").glob("upto-*"))) == 2


def test_fold_writes_only_touched_buckets(spark, tmp_path, land, rows):
    order, store, cp = ["-seq"], str(tmp_path / "st"), str(tmp_path / "c")

    def run(name, events, schema="id INT, seq INT, v STRING"):
        src = land(name, *[json.dumps(e) for e in events])
        upserts.upsert_stream(flows.read_stream(spark, src, "json", schema), ["id"], order, store, cp, "v = 'gone'", buckets=8)

    def files(part):
        return {str(f.relative_to(tmp_path / "st")) for f in (tmp_path / "st" / part).rglob("*.parquet")}

    def now(reader=upserts.read_store, *more):
        return rows(reader(spark, store, ["id"], order, *more).select("id", "v"))

    run("a.json", [{"id": i, "seq": 1, "v": f"v{i}"} for i in range(200)] + [{"seq": 1, "v": "no id"}])
    assert upserts.fold(spark, store, ["id"], order) == 0
    first = files("base")
    assert {f.split("/")[2] for f in first} == {f"__bucket={b}" for b in range(8)}
    run("b.json", [{"id": 7, "seq": 2, "v": "new"}, {"id": 7, "seq": 0, "v": "late"}])
    assert upserts.fold(spark, store, ["id"], order) == 1
    second = files("base") - first
    place = spark.range(1).select(F.pmod(F.xxhash64(F.lit(7)), F.lit(8))).first()[0]
    assert {f.rpartition("/")[0] for f in second} == {f"base/upto-1/__bucket={place}"}
    expected = sorted([(i, "new" if i == 7 else f"v{i}") for i in range(200)] + [(None, "no id")], key=repr)
    assert now() == expected and upserts.fold(spark, store, ["id"], order) == 1 and files("base") == first | second

    # Folded batches and the replaced bucket go; contents stay, also for a batch with a new column after it.
    assert upserts.vacuum(spark, store) == 3 and files("changes") == set() and now() == expected
    run("c.json", [{"id": 8, "seq": 2, "v": "gone", "w": 1}, {"seq": 2, "v": "none", "w": 2}], "id INT, seq INT, v STRING, w INT")
    wanted = spark.createDataFrame([(7,), (8,), (None,), (7,), (999,)], "id BIGINT")
    assert now(upserts.read_keys, wanted) == [(7, "new"), (None, "none")]
    read = upserts.read_keys(spark, store, ["id"], order, wanted.where("id = 7"))
    assert {f"__bucket={place}"} == {f.split("/")[-2] for f in read.inputFiles() if "/base/" in f}
    assert rows(upserts.read_store(spark, store, ["id"], order).where("w IS NOT NULL").select("id", "w")) == [(None, 2)]


def test_unfinished_batches_and_folds_do_not_count(spark, tmp_path, land, rows, monkeypatch):
    store, order = str(tmp_path / "st"), ["-seq"]
    src = land("a.json", '{"id":1,"seq":1}', '{"id":2,"seq":1}')
    run = lambda: upserts.upsert_stream(flows.read_stream(spark, src, "json", "id INT, seq INT"), ["id"], order, store, str(tmp_path / "c"))
    now = lambda: rows(upserts.read_store(spark, store, ["id"], order))
    with pytest.raises(FileNotFoundError):
        now()
    run()
    # A batch that died while its files were moved in: no reader and no fold may take half of it.
    half = spark.createDataFrame([(1, 9, False)], "id INT, seq INT, __deleted BOOLEAN")
    half.write.parquet(f"{store}/changes/__batch=1/__bucket=0")
    assert now() == [(1, 1), (2, 1)]

    class Death(Exception):
        pass

    def dying(*_):
        raise Death

    with monkeypatch.context() as m:
        m.setattr(type(half), "coalesce", dying)  # the base is written, the note is not
        with pytest.raises(Death):
            upserts.fold(spark, store, ["id"], order)
    assert (tmp_path / "st" / "base" / "upto-0" / "_SUCCESS").exists() and not (tmp_path / "st" / "folds").exists()
    assert now() == [(1, 1), (2, 1)] and upserts.fold(spark, store, ["id"], order) == 0
    land("b.json", '{"id":2,"seq":2}')
    run()
    assert now() == [(1, 1), (2, 2)] and upserts.fold(spark, store, ["id"], order) == 1 and now() == [(1, 1), (2, 2)]


def test_replica_follows_scd2_feed(spark, tmp_path, rows):
    schema = "id INT, v STRING, op STRING, ts TIMESTAMP"
    at = lambda h: datetime(2026, 6, 1, h)
    first = spark.createDataFrame([(1, "a", "I", at(1)), (2, "b", "I", at(1))], schema)
    second = spark.createDataFrame([(1, "a2", "U", at(2)), (2, "b", "D", at(3))], schema)
    args = dict(keys=["id"], sequence_by="ts", delete_when="op = 'D'", except_cols=["op", "ts"])
    h1 = cdc.apply_scd2(first, **args)
    h2 = cdc.apply_scd2(first.union(second), **args)
    keys, feed, store, cp = ["id", "__START_AT"], str(tmp_path / "f"), str(tmp_path / "st"), str(tmp_path / "c")
    empty = h1.where("false")
    for version, (old, new) in enumerate([(empty, h1), (h1, h2)], start=1):
        cdc.change_feed(old, new, keys, version).write.mode("append").parquet(feed)
        s = flows.read_stream(spark, feed, "parquet", spark.read.parquet(feed).schema)
        upserts.replicate_stream(s, keys, store, cp)
        assert rows(upserts.read_replica(spark, store, keys, h1.schema)) == rows(new)


def test_stream_static_join_modes(spark, land):
    s = flows.read_stream(spark, land("a.json", '{"id":1}'), "json", "id INT")
    with pytest.raises(ValueError):
        flows.enrich_stream(s, spark.range(1), ["id"], "right")


@pytest.mark.parametrize("exact,rescued", [(True, {1018, 1019, 1020}), (False, {1018, 1020})])
def test_rescue_mode_keeps_every_row(spark, tmp_path, land, exact, rescued):
    src = land("drift.json", '{"order_id":1018,"amount":"not-a-number","status":"placed"}',
               '{"order_id":1019,"amount":2.5,"Status":"placed"}',
               '{"order_id":1020,"amount":3.5,"status":"placed","referral_code":"R"}',
               '{"order_id":1021,"amount":4.5,"status":"placed"}')
    sink = str(tmp_path / "s")
    flows.ingest_stream(spark, src, "json", sink, str(tmp_path / "c"), "order_id BIGINT, amount DOUBLE, status STRING",
                        evolution="rescue", case_sensitive=exact)
    got = {r["order_id"]: r for r in spark.read.parquet(sink).collect()}
    assert set(got) == {1018, 1019, 1020, 1021}
    assert {k for k, r in got.items() if r["_rescued_data"]} == rescued
    assert "drift.json" in got[1018]["_rescued_data"] and got[1018]["source_file"].endswith("drift.json")
    report = rescue_report(spark.read.parquet(sink)).collect()
    assert [r["rescued_rows"] for r in report] == [len(rescued)]
