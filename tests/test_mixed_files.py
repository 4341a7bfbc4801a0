"""Files of different schemas in one load: footers, headers, types, rescue."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from lakeops.sources.drift import UnknownFieldError
from lakeops.sources.ingest import copy_into, read_loaded
from lakeops.sources.mixed import SchemaConflict, common_type, header_lines, read_mixed, schema_groups
from lakeops.streaming import flows


@pytest.fixture
def land(spark, tmp_path):
    """Parquet files of given rows, or CSV files of given lines, in one folder."""
    folder = tmp_path / "landing"
    folder.mkdir()

    def put(name, *content, ddl=None):
        if ddl is None:
            (folder / name).write_text("".join(f"{line}\n" for line in content))
        else:
            staged = tmp_path / f"staged-{name}"
            spark.createDataFrame(list(content), ddl).coalesce(1).write.parquet(str(staged))
            (folder / name).write_bytes(next(staged.glob("part-*")).read_bytes())
        return str(folder)
    return put


def kind(ddl):
    return T.StructType.fromDDL(f"a {ddl}").fields[0].dataType


@pytest.mark.parametrize("a,b,want", [
    ("int", "bigint", "bigint"), ("double", "float", "double"), ("int", "decimal(5,2)", "decimal(12,2)"),
    ("decimal(5,2)", "decimal(8,4)", "decimal(8,4)"), ("decimal(6,1)", "decimal(5,4)", "decimal(9,4)"),
    ("int", "string", "string"), ("date", "int", "string"), ("decimal(38,0)", "decimal(38,10)", "string"),
    ("array<int>", "array<bigint>", "array<bigint>"), ("map<string,int>", "map<string,string>", "map<string,string>"),
    ("struct<x: int>", "struct<y: int, x: bigint>", "struct<x:bigint,y:int>")])
def test_common_type(spark, a, b, want):
    assert common_type(kind(a), kind(b)).simpleString() == want


def test_types_without_anything_in_common_are_refused(spark):
    with pytest.raises(SchemaConflict):
        common_type(kind("array<int>"), kind("int"), "a")


def test_old_and_new_parquet_files_in_one_load(spark, tmp_path, land, rows):
    src, target = land("b.parquet", (1, "x"), ddl="id INT, name STRING"), str(tmp_path / "t")
    land("c.parquet", (2, "y", "rome"), ddl="id INT, name STRING, city STRING")
    assert copy_into(spark, target, src, "parquet", merge_schema=True) == 2
    assert rows(read_loaded(spark, target)) == [(1, "x", None), (2, "y", "rome")]
    land("d.parquet", ("oslo", 3, 0.5), ddl="city STRING, id INT, price DOUBLE")
    land("e.parquet", (4, "z"), ddl="id INT, name STRING")
    with pytest.raises(UnknownFieldError):
        copy_into(spark, target, src, "parquet")
    assert read_loaded(spark, target).count() == 2
    assert copy_into(spark, target, src, "parquet", merge_schema=True) == 2
    assert rows(read_loaded(spark, target)) == [
        (1, "x", None, None), (2, "y", "rome", None), (3, None, "oslo", 0.5), (4, "z", None, None)]


def test_types_that_differ_between_files(spark, tmp_path, land, rows):
    for k, ddl in enumerate(["int", "bigint", "decimal(9,2)", "int", "bigint", "int"]):
        src = land(f"{k}.parquet", (Decimal("2.50") if "decimal" in ddl else k,), ddl=f"v {ddl}")
    groups = schema_groups(spark, [f"{src}/{k}.parquet" for k in range(6)], "parquet")
    assert sorted(g.schema.simpleString() for g in groups) == ["struct<v:bigint>", "struct<v:decimal(9,2)>", "struct<v:int>"]
    assert sorted(len(g.files) for g in groups) == [1, 2, 3]
    copy_into(spark, str(tmp_path / "t"), src, "parquet")
    assert [str(r[0]) for r in rows(read_loaded(spark, str(tmp_path / "t")))] == ["0.00", "1.00", "2.50", "3.00", "4.00", "5.00"]


def test_a_table_keeps_both_generations_of_a_type(spark, tmp_path, land, rows):
    src, target = land("1.parquet", (1, 10), ddl="id INT, v SMALLINT"), str(tmp_path / "t")
    copy_into(spark, target, src, "parquet")
    land("2.parquet", (2, 1 << 40), ddl="id INT, v BIGINT")
    copy_into(spark, target, src, "parquet", widen_types=True)
    assert rows(read_loaded(spark, target)) == [(1, 10), (2, 1 << 40)]
    assert dict(read_loaded(spark, target).dtypes)["v"] == "bigint"


def test_nested_fields_that_only_some_files_have(spark, land, rows):
    src = land("1.parquet", ({"x": 1}, [{"q": 1}]), ddl="s STRUCT<x: INT>, l ARRAY<STRUCT<q: INT>>")
    land("2.parquet", ({"x": 2, "y": "b"}, [{"q": 5, "p": 0.5}]), ddl="s STRUCT<x: BIGINT, y: STRING>, l ARRAY<STRUCT<q: INT, p: DOUBLE>>")
    groups = schema_groups(spark, [f"{src}/1.parquet", f"{src}/2.parquet"], "parquet")
    got = read_mixed(spark, groups, "parquet").orderBy("s.x").collect()
    assert [r.s.asDict() for r in got] == [{"x": 1, "y": None}, {"x": 2, "y": "b"}]
    assert [r.l[0].asDict() for r in got] == [{"q": 1, "p": None}, {"q": 5, "p": 0.5}]


def test_headers_are_read_without_the_files(spark, land):
    src = land("a b.csv", "id,name", *[f"{i},x" for i in range(50_000)])
    land("empty.csv")
    land("c.csv", "﻿id;'odd ; name'", "1;2")
    assert header_lines(spark, [f"{src}/a b.csv", f"{src}/empty.csv"]) == {f"file:{src}/a b.csv": "id,name"}
    groups = schema_groups(spark, [f"{src}/c.csv"], "csv", header=True, sep=";", quote="'")
    assert groups[0].schema.names == ["id", "odd ; name"] and groups[0].schema["id"].dataType == T.IntegerType()


def test_csv_columns_are_found_by_name(spark, tmp_path, land, rows):
    src, target = land("1.csv", "id,name", "1,cat"), str(tmp_path / "t")
    land("2.csv", "id,city,name", "3,rome,dog")
    land("3.csv", "name,id", "owl,4")
    land("4.csv", "city", "oslo")
    for declared in (None, "id INT, name STRING"):
        copy_into(spark, f"{target}-{declared is None}", src, "csv", declared, header=True)
    assert rows(read_loaded(spark, f"{target}-True").select("id", "name", "city")) == [
        (1, "cat", None), (3, "dog", "rome"), (4, "owl", None), (None, None, "oslo")]
    assert rows(read_loaded(spark, f"{target}-False")) == [(1, "cat"), (3, "dog"), (4, "owl"), (None, None)]


def test_a_csv_stream_by_name(spark, tmp_path, land, rows):
    src, sink, cp = land("1.csv", "id,name", "1,cat"), str(tmp_path / "s"), str(tmp_path / "c")
    run = lambda: flows.ingest_stream(spark, src, "csv", sink, cp, hints="id INT", header="true")
    run()
    land("2.csv", "id,city,name", "3,rome,dog")
    land("3.csv", "name,id", "owl,4")
    with pytest.raises(UnknownFieldError) as e:
        run()
    assert e.value.fields == ["city"] and flows.read_sink(spark, sink).count() == 1
    run()
    assert rows(flows.read_sink(spark, sink).select("id", "name", "city", "_rescued_data")) == [
        (1, "cat", None, None), (3, "dog", "rome", None), (4, "owl", None, None)]


def test_csv_rescue_by_name(spark, tmp_path, land):
    src, sink = land("1.csv", "id,city,name", "3,rome,dog", "x,oslo,owl", "5,bonn,fox,more"), str(tmp_path / "s")
    land("2.csv", "Name,id", "ant,7")
    for exact in (True, False):
        flows.ingest_stream(spark, src, "csv", f"{sink}{exact}", f"{sink}{exact}-c", "id INT, name STRING",
                            evolution="rescue", case_sensitive=exact, header="true")
        got = {r._rescued_data and r._rescued_data.split('"')[3]: r for r in flows.read_sink(spark, f"{sink}{exact}").collect()}
        kept = {k: json.loads(r._rescued_data) for k, r in got.items() if r._rescued_data}
        assert (got["rome"].id, got["rome"].name, kept["rome"]["city"]) == (3, "dog", "rome")
        assert kept["rome"]["_file_path"].endswith("1.csv") and got["rome"].source_file.endswith("1.csv")
        assert got["oslo"].id is None and kept["oslo"]["_corrupt_record"] == "x,oslo,owl"
        assert kept["bonn"]["_corrupt_record"] == "5,bonn,fox,more" and got["bonn"].name == "fox"
        if exact:
            assert (got["ant"].id, got["ant"].name, kept["ant"]["Name"]) == (7, None, "ant")
        else:
            assert (got[None].id, got[None].name) == (7, "ant")


def test_old_and_new_parquet_files_in_one_batch(spark, tmp_path, land, rows):
    src, sink, cp = land("a.parquet", (1, "x"), ddl="id INT, name STRING"), str(tmp_path / "s"), str(tmp_path / "c")
    run = lambda **kw: flows.ingest_stream(spark, src, "parquet", sink, cp, **kw)
    run()
    land("b.parquet", (2, "y"), ddl="id INT, name STRING")
    land("c.parquet", (3, "z", "rome"), ddl="id INT, name STRING, city STRING")
    with pytest.raises(UnknownFieldError):
        run()
    assert flows.read_sink(spark, sink).count() == 1
    run()
    assert rows(flows.read_sink(spark, sink).select("id", "city")) == [(1, None), (2, None), (3, "rome")]


def test_parquet_values_that_do_not_fit_are_rescued(spark, tmp_path, land):
    src, sink = land("a.parquet", (1 << 40, "x", [1]), ddl="id BIGINT, name STRING, more ARRAY<INT>"), str(tmp_path / "s")
    flows.ingest_stream(spark, src, "parquet", sink, str(tmp_path / "c"), "id INT, name STRING", evolution="rescue")
    row = flows.read_sink(spark, sink).first()
    kept = json.loads(row._rescued_data)
    assert (row.id, row.name, kept["id"], kept["more"]) == (None, "x", str(1 << 40), "[1]")


def test_batches_are_bounded(spark, tmp_path, land):
    for k in range(5):
        src = land(f"{k}.json", f'{{"id":{k}}}')
    sink = tmp_path / "s"
    flows.ingest_stream(spark, src, "json", str(sink), str(tmp_path / "c"), maxFilesPerTrigger="2")
    assert len(list(sink.glob("__batch=*"))) == 3 and flows.read_sink(spark, str(sink)).count() == 5


def test_values_of_folder_names(spark, tmp_path, rows):
    for day in ("2031-01-01", "2031-01-02"):
        spark.createDataFrame([(1,)], "id INT").write.parquet(str(tmp_path / f"in/day={day}"))
    flows.ingest_stream(spark, str(tmp_path / "in"), "parquet", str(tmp_path / "s"), str(tmp_path / "c"))
    got = flows.read_sink(spark, str(tmp_path / "s")).select("id", "day")
    assert [(i, str(d)) for i, d in rows(got)] == [(1, "2031-01-01"), (1, "2031-01-02")]
