"""Gold follows silver: same contents as a full computation, and only touched files are written."""

import pytest
from pyspark.sql import functions as F

from lakeops.plans import refresh
from lakeops.sources.ingest import save_schema

ROWS = "day DATE, customer INT, amount INT"


@pytest.fixture
def silver(spark, tmp_path):
    def append(*rows):
        df = spark.createDataFrame(list(rows), "day STRING, customer INT, amount INT").select(
            F.col("day").cast("date").alias("day"), "customer", "amount")
        save_schema(spark, f"{tmp_path}/silver/_schema", df.schema)
        df.write.mode("append").parquet(f"{tmp_path}/silver")
        return spark.read.schema(df.schema).parquet(f"{tmp_path}/silver")
    return append


def files(path):
    return {str(f.relative_to(path)) for f in path.rglob("*.parquet")}


def daily(rows):
    return rows.groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total"))


def spend(rows):
    return rows.groupBy("customer").agg(F.sum("amount").alias("total"))


def follow(spark, out, rows):
    refresh.note_touched(spark, out, "silver", {"daily": lambda b: b.select("day"), "spend": lambda b: b.select("customer")})
    return (refresh.refresh_keys(spark, out, "daily", "day DATE", rows, daily, buckets=16),
            refresh.refresh_keys(spark, out, "spend", "customer INT", rows, spend, buckets=8))


def test_only_touched_buckets_are_written(spark, tmp_path, silver, rows):
    out = str(tmp_path)
    first = silver(*[(f"2031-01-{d:02}", c, 10 * d + c) for d in range(1, 6) for c in range(40)], (None, 7, 1))
    got = follow(spark, out, first)
    assert rows(got[0]) == rows(daily(first)) and rows(got[1]) == rows(spend(first))
    before = files(tmp_path / "daily"), files(tmp_path / "spend")
    assert follow(spark, out, first)[0].count() == 6  # nothing new, nothing written
    assert (files(tmp_path / "daily"), files(tmp_path / "spend")) == before

    both = silver(("2031-01-06", 3, 5), (None, 3, 6))
    got = follow(spark, out, both)
    assert rows(got[0]) == rows(daily(both)) and rows(got[1]) == rows(spend(both))
    after = files(tmp_path / "daily"), files(tmp_path / "spend")
    bucket = F.concat(F.lit("__bucket="), F.pmod(F.xxhash64("day"), F.lit(16)).cast("string"))
    days = {r[0] for r in both.where("day IS NULL OR day = '2031-01-06'").select(bucket).distinct().collect()}
    assert {f.split("/")[0] for f in after[0] ^ before[0]} == days and len(days) <= 2 < len(files(tmp_path / "daily"))
    assert len({f.split("/")[0] for f in after[1] ^ before[1]}) == 1  # one bucket of eight


def test_a_refresh_that_dies_is_repeated(spark, tmp_path, silver, rows, monkeypatch):
    out, data = str(tmp_path), silver(("2031-01-01", 1, 5), ("2031-01-02", 2, 6))
    follow(spark, out, data)
    data = silver(("2031-01-02", 1, 7), ("2031-01-03", 3, 8))

    class Death(Exception):
        pass

    def dying(self, path):
        raise Death

    monkeypatch.setattr(refresh.Files, "delete", dying)  # written, but the notes are still there
    with pytest.raises(Death):
        follow(spark, out, data)
    monkeypatch.undo()
    got = follow(spark, out, data)
    assert rows(got[0]) == rows(daily(data)) and rows(got[1]) == rows(spend(data))
    assert refresh.touched_keys(spark, out, "daily", "day DATE") is None
