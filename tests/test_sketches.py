"""Statistics that unite: those of parts give those of the whole, within the stated error."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakeops.operators.sketches import describe, distinct_error, partials, refresh_statistics, unite
from lakeops.sources.ingest import copy_into


def found(df, *by):
    return {tuple(r[c] for c in (*by, "column")): r for r in df.collect()}


def test_parts_unite_to_the_whole(spark):
    rows = spark.range(60_000).select(
        (F.col("id") % 3).alias("part"), (F.col("id") * 7 % 20_011).alias("v"), F.when(F.col("id") % 4 > 0, F.col("id") % 5 / 2).alias("d"))
    whole = found(describe(partials(rows, cols=["v", "d"])))
    united = found(describe(unite(partials(rows, ["part"]))))
    for c, exact in (("v", 20_011), ("d", 5)):
        assert abs(united[c,].approx_distinct - exact) <= 3 * distinct_error() * exact
        assert [united[c,][k] for k in ("rows", "nulls", "min", "max")] == [whole[c,][k] for k in ("rows", "nulls", "min", "max")]
    assert united["d",].nulls == 15_000 and united["d",].max == "2.0"
    assert abs(united["v",].median - 10_005) <= 0.05 * 20_011


def test_odd_values(spark):
    rows = spark.createDataFrame(
        [("", 0.0, None, b"", date(2031, 1, 1), Decimal("1.50"), [1]), ("a", -0.0, None, None, None, None, None),
         (None, float("nan"), None, b"\x00", date(2031, 1, 1), Decimal("1.5"), None)],
        "t STRING, x DOUBLE, nothing INT, b BINARY, day DATE, m DECIMAL(9,2), list ARRAY<INT>")
    got = found(describe(partials(rows)))
    assert {k[0]: (r.nulls, r.approx_distinct) for k, r in got.items()} == {
        "t": (1, 2), "x": (0, 2), "nothing": (3, 0), "b": (1, 2), "day": (1, 1), "m": (1, 1)}
    empty = found(describe(unite(partials(rows.where("false")))))
    assert {(r.rows, r.nulls, r.approx_distinct, r.min, r.median) for r in empty.values()} == {(0, 0, 0, None, None)}
    with pytest.raises(ValueError):
        partials(rows, cols=["list"])


def test_refresh_reads_new_loads_only(spark, tmp_path):
    src, target = str(tmp_path / "src"), str(tmp_path / "t")

    def load(df):
        df.write.mode("append").parquet(src)
        copy_into(spark, target, src, "parquet", merge_schema=True, widen_types=True)
        return found(refresh_statistics(spark, target))

    def parts():
        return sorted(p.name for p in (tmp_path / "t" / "statistics").iterdir())

    one = spark.range(100).select(F.col("id").cast("int").alias("id"))
    assert load(one)["id",].approx_distinct == 100
    # What the first load's data says no longer matters: its statistics are there.
    for f in (tmp_path / "t" / "data" / "__load=1").glob("*.parquet"):
        f.write_bytes(b"not read again")
    got = load(spark.range(50, 150).select("id", F.lit("x").alias("name")))
    assert (got["id",].rows, got["id",].approx_distinct, got["id",].min, got["id",].max) == (200, 150, "0", "149")
    assert (got["name",].nulls, got["name",].approx_distinct) == (100, 1) and parts() == ["0-1", "1-2"]
    # A refresh that died half way has no mark and is made again.
    (tmp_path / "t" / "statistics" / "1-2" / "_SUCCESS").rename(tmp_path / "mark")
    assert found(refresh_statistics(spark, target)) == got and parts() == ["0-1", "1-2"]


def test_another_kind_of_number_is_counted_anew(spark, tmp_path):
    src, target = str(tmp_path / "src"), str(tmp_path / "t")
    for kind in ("int", "decimal(12,2)"):
        spark.range(10).select(F.col("id").cast(kind).alias("v")).write.mode("append").parquet(src)
        copy_into(spark, target, src, "parquet", widen_types=True)
        got = found(refresh_statistics(spark, target))["v",]
    assert (got.rows, got.approx_distinct, got.max) == (20, 10, "9.00")
    assert sorted(p.name for p in (tmp_path / "t" / "statistics").iterdir()) == ["0-1", "0-2"]
