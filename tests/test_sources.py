import json
import os
from functools import partial

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.sources.drift import UnknownFieldError, evolve_schema, rescue_json, rescue_report
from lakeops.sources.files import (
    apply_schema_hints, hinted_schema, list_files, read_files, refresh_and_count, skewed_orders,
    synthetic_orders, with_provenance)
from lakeops.sources.ingest import copy_into, read_loaded
from lakeops.sources.records import decode_records, jdbc_options

CSV_A = "id;name;price\n1;Lamp;9.5\n2;Desk;abc\n"
CSV_B = "id;name;price\n3;Rug;7\n"


def put(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)
    return str(folder)


def test_file_glob_directory_text_binary(spark, tmp_path):
    src = put(tmp_path / "in", "a.csv", CSV_A)
    put(tmp_path / "in", "b.csv", CSV_B)
    assert read_files(spark, f"{src}/a.csv", "text").count() == 3
    assert read_files(spark, f"{src}/*.csv", "text").count() == 5
    assert read_files(spark, src, "text").count() == 5
    blob = read_files(spark, src, "binaryFile")
    assert blob.where("length = length(content)").count() == 2


def test_csv_schemas(spark, tmp_path):
    src = put(tmp_path / "in", "b.csv", CSV_B)
    opts = dict(header=True, sep=";")
    declared = read_files(spark, src, "csv", "id BIGINT, name STRING, price DOUBLE", **opts)
    assert declared.collect()[0] == (3, "Rug", 7.0)
    assert dict(read_files(spark, src, "csv", **opts).dtypes)["id"] == "int"
    assert {t for _, t in read_files(spark, src, "csv", infer=False, **opts).dtypes} == {"string"}
    hinted = read_files(spark, src, "csv", hints="price DECIMAL(5,2)", infer=False, **opts)
    assert hinted.dtypes == [("id", "string"), ("name", "string"), ("price", "decimal(5,2)")]


def test_hints_null_what_does_not_fit(spark):
    df = spark.createDataFrame([("1", "x")], "a STRING, b STRING")
    assert apply_schema_hints(df, "a INT, b INT").collect() == [(1, None)]
    assert hinted_schema(df.schema, "c DATE").names == ["a", "b", "c"]


def test_provenance_and_listing(spark, tmp_path):
    src = put(tmp_path / "in", "b.csv", CSV_B)
    row = with_provenance(read_files(spark, src, "csv", "id INT, name STRING, price DOUBLE", header=True, sep=";")).first()
    assert row["source_name"] == "b.csv" and row["source_size"] == len(CSV_B)
    plan = list_files(spark, src)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]


def test_copy_into_is_idempotent(spark, tmp_path):
    src = put(tmp_path / "in", "a.csv", CSV_A)
    target = str(tmp_path / "t")

    def load(**kw):
        return copy_into(spark, target, src, "csv", header=True, sep=";", **kw)

    assert load() == 1 and load() == 0
    put(tmp_path / "in", "b.csv", CSV_B)
    assert load() == 1 and read_loaded(spark, target).count() == 3
    assert load(force=True) == 2 and read_loaded(spark, target).count() == 6


def test_copy_into_pattern_files_and_overwrites(spark, tmp_path):
    src = put(tmp_path / "in", "a.csv", CSV_A)
    put(tmp_path / "in", "b.csv", CSV_B)
    target = str(tmp_path / "t")
    load = partial(copy_into, spark, target, src, "csv", infer=False, header=True, sep=";")
    with pytest.raises(ValueError, match="exclude"):
        load(pattern="*", files=["a.csv"])
    assert load(pattern="b*.csv") == 1
    assert load(files=["a.csv", "b.csv"]) == 1
    os.utime(tmp_path / "in" / "a.csv", (2_000_000_000, 2_000_000_000))
    assert load() == 0
    assert load(allow_overwrites=True) == 1


def test_unfinished_load_is_invisible_and_replaced(spark, tmp_path):
    src = put(tmp_path / "in", "b.csv", CSV_B)
    target = str(tmp_path / "t")
    load = partial(copy_into, spark, target, src, "csv", infer=False, header=True, sep=";")
    load()
    lost = read_loaded(spark, target)
    lost.write.parquet(f"{target}/data/__load=2")  # written, but never entered in the ledger
    assert read_loaded(spark, target).count() == 1
    put(tmp_path / "in", "a.csv", CSV_A)
    load()
    assert sorted(r["id"] for r in read_loaded(spark, target).collect()) == ["1", "2", "3"]


def test_copy_into_schema_merge(spark, tmp_path):
    src = put(tmp_path / "in", "1.json", '{"id":1}\n')
    target = str(tmp_path / "t")
    copy_into(spark, target, src, "json")
    put(tmp_path / "in", "2.json", '{"id":2,"discount":0.5}\n')
    with pytest.raises(UnknownFieldError):
        copy_into(spark, target, src, "json")
    assert copy_into(spark, target, src, "json", merge_schema=True) == 1
    assert sorted(map(tuple, read_loaded(spark, target).collect())) == [(1, None), (2, 0.5)]


def schema(ddl):
    return T.StructType.fromDDL(ddl)


@pytest.mark.parametrize("mode,action,names", [
    ("addNewColumns", "restart", ["a", "b"]), ("failOnNewColumns", "fail", ["a"]),
    ("none", "ok", ["a"]), ("rescue", "ok", ["a"])])
def test_evolution_modes(mode, action, names):
    new, verdict = evolve_schema(schema("a INT"), schema("a INT, b STRING"), mode)
    assert verdict.action == action and new.names == names and verdict.new_fields == ["b"]


def test_type_widening():
    new, verdict = evolve_schema(schema("a INT, b STRING, c DECIMAL(5,2)"),
                                 schema("a BIGINT, b INT, c DECIMAL(8,3)"),
                                 "addNewColumnsWithTypeWidening")
    assert [f.dataType.simpleString() for f in new.fields] == ["bigint", "string", "decimal(8,3)"]
    assert verdict.widened == ["a", "c"]
    assert evolve_schema(schema("a BIGINT"), schema("a INT"), "addNewColumnsWithTypeWidening")[1].action == "ok"


DRIFT = [
    '{"order_id":1018,"amount":"not-a-number","status":"placed"}',
    '{"order_id":1019,"amount":5.5,"Status":"placed","channel":"app"}',
    '{"order_id":1020,"amount":null,"status":"placed","referral":{"code":"R1"}}',
    '{"order_id":1021,"amount":1.0,"status":"placed"}', "no json"]
ORDER = "order_id BIGINT, amount DOUBLE, status STRING"


def test_rescue_keeps_every_row(spark):
    raw = spark.createDataFrame([(f"f{i}", t) for i, t in enumerate(DRIFT)], "source_file STRING, value STRING")
    got = {r["source_file"]: r for r in rescue_json(raw, ORDER).collect()}
    assert len(got) == 5
    rescued = {k: r["_rescued_data"] and json.loads(r["_rescued_data"]) for k, r in got.items()}
    assert rescued["f0"] == {"amount": "not-a-number"} and got["f0"]["amount"] is None
    assert rescued["f1"] == {"Status": "placed", "channel": "app"} and got["f1"]["status"] is None
    assert json.loads(rescued["f2"]["referral"]) == {"code": "R1"}
    assert rescued["f3"] is None and rescued["f4"] == {"_corrupt_record": "no json"}
    any_case = {r["source_file"]: r for r in rescue_json(raw, ORDER, case_sensitive=False).collect()}
    assert any_case["f1"]["status"] == "placed"
    assert json.loads(any_case["f1"]["_rescued_data"]) == {"channel": "app"}
    assert any_case["f0"]["order_id"] == 1018 and any_case["f3"]["_rescued_data"] is None
    with_path = rescue_json(raw, ORDER, path_col="source_file").where("source_file = 'f0'").first()
    assert json.loads(with_path["_rescued_data"]) == {"amount": "not-a-number", "_file_path": "f0"}
    report = rescue_report(rescue_json(raw, ORDER)).collect()
    assert sorted(r["file_path"] for r in report) == ["f0", "f1", "f2", "f4"]


def test_rescue_looks_into_structs_arrays_and_maps(spark):
    shape = "items ARRAY<STRUCT<quantity: INT, tags: ARRAY<INT>>>, c STRUCT<name: STRING>, m MAP<STRING, INT>"
    lines = ['{"items":[{"quantity":1,"tags":[1,2]}],"c":{"name":"x"},"m":{"a":1}}',
             '{"items":[{"quantity":"two","gift":true}],"c":{"extra":9}}', '{"items":[{"quantity":1,"tags":[1,"z"]}]}',
             '{"m":{"a":"b"}}', '{"items":[],"c":{},"m":{}}', '{"items":null}']
    got = [r._rescued_data and json.loads(r._rescued_data) for r in rescue_json(
        spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "n INT, value STRING").repartition(1).sortWithinPartitions("n"),
        shape).sort("n").collect()]
    assert [g and sorted(g) for g in got] == [None, ["c", "items"], ["items"], ["m"], None, None]
    assert json.loads(got[1]["items"]) == [{"quantity": "two", "gift": True}] and json.loads(got[1]["c"]) == {"extra": 9}


def test_decode_records(spark):
    df = spark.createDataFrame([(bytearray(b"k"), bytearray(b'{"a":1,"b":"x"}'), 3), (None, bytearray(b"bad"), 4)],
                               "key BINARY, value BINARY, offset BIGINT")
    assert sorted(map(tuple, decode_records(df, "a INT, b STRING").collect()), key=lambda r: r[1]) == [
        ("k", 3, 1, "x"), (None, 4, None, None)]


def test_jdbc_options():
    got = jdbc_options("jdbc:x", "SELECT id FROM t WHERE v > 1", "id", 1, 100, 4, fetchsize="500")
    assert got["dbtable"] == "(SELECT id FROM t WHERE v > 1) AS src"
    assert (got["partitionColumn"], got["numPartitions"], got["fetchsize"]) == ("id", "4", "500")


def test_refresh_after_append(spark, tmp_path):
    src = put(tmp_path / "in", "b.csv", CSV_B)
    spark.sql(f"CREATE TABLE rugs (id INT, name STRING, price DOUBLE) USING CSV OPTIONS (header true, delimiter ';') LOCATION '{src}'")
    try:
        before = refresh_and_count(spark, "rugs")
        put(tmp_path / "in", "c.csv", CSV_B)
        assert (before, refresh_and_count(spark, "rugs")) == (1, 2)
    finally:
        spark.sql("DROP TABLE rugs")


def test_generated_orders_are_repeatable(spark, rows):
    a, b = synthetic_orders(spark, 500), synthetic_orders(spark, 500).repartition(7)
    assert rows(a) == rows(b) and a.agg(F.max("amount")).first()[0] < 250
    counts = {r[0]: r[1] for r in skewed_orders(spark, 5000).groupBy("customer_id").count().collect()}
    assert counts == {1: 5000, **{i: 100 for i in range(2, 21)}}


def test_scratch_folder_comes_from_the_session(spark, monkeypatch):
    from lakeops import session
    assert session.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))

    class Bare:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "local[2]"

    monkeypatch.setattr(session, "_local_root", [])
    with pytest.raises(ValueError, match="checkpoint"):
        session.scratch_path(Bare, "x")
    session.allow_local_scratch()
    assert "lakeops-" in session.scratch_path(Bare, "x")
    for master in ("yarn", "local-cluster[2,1,1024]"):
        Bare.sparkContext.master = master
        with pytest.raises(ValueError, match="checkpoint"):
            session.scratch_path(Bare, "x")
