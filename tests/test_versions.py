from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakeops.operators import cdc, versions

SCHEMA, FIRST, SECOND = "id INT, v STRING", "2031-03-01 10:00:00", "2031-03-05 09:30:00"


@pytest.fixture
def log(spark, tmp_path):
    """Version 1 loads three rows; version 2 changes one, deletes one and adds one."""
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], SCHEMA)
    new = spark.createDataFrame([(1, "a"), (3, "c"), (4, "d")], SCHEMA)
    path = str(tmp_path / "log")
    assert versions.commit_changes(cdc.change_feed(old.limit(0), old, ["id"], 1), path, FIRST) == 1
    assert versions.commit_changes(cdc.change_feed(old, new, ["id"], 2), path, datetime(2031, 3, 5, 9, 30)) == 2
    return path


OLD, NEW = [(1, "a"), (2, "b"), (3, None)], [(1, "a"), (3, "c"), (4, "d")]


@pytest.mark.parametrize("at,want", [
    (FIRST, OLD), ("2031-03-03", OLD), ("2031-03-05 09:29:59.999", OLD), (SECOND, NEW), ("2040-01-01", NEW),
    (datetime(2031, 3, 4), OLD)])
def test_state_at_a_time(spark, log, rows, at, want):
    assert rows(versions.table_as_of(spark, log, ["id"], at=at)) == want


def test_versions_and_what_is_not_there(spark, log, rows, tmp_path):
    assert rows(versions.table_as_of(spark, log, ["id"], version=1)) == OLD
    assert rows(versions.table_as_of(spark, log, ["id"])) == NEW
    for wrong in ({"at": "2031-02-28"}, {"version": 3}, {"version": 0}):
        with pytest.raises(versions.NoSuchVersion):
            versions.table_as_of(spark, log, ["id"], **wrong)
    with pytest.raises(ValueError):
        versions.table_as_of(spark, log, ["id"], version=1, at=FIRST)
    with pytest.raises(versions.NoSuchVersion):
        versions.read_changes(spark, str(tmp_path / "none"))
    assert rows(versions.copy_as_of(spark, log, ["id"], str(tmp_path / "copy"), at="2031-03-02")) == OLD


def test_unfinished_commits_are_invisible_and_replaced(spark, log, rows):
    lost = spark.createDataFrame([(9, "lost", "insert")], f"{SCHEMA}, _change_type STRING")
    lost.write.parquet(f"{log}/changes/_commit_version=3")  # its commit row was never written
    assert rows(versions.table_as_of(spark, log, ["id"])) == NEW
    assert versions.commit_changes(lost.replace("lost", "kept"), log, SECOND) == 3  # equal times keep their order
    assert rows(versions.table_as_of(spark, log, ["id"])) == [*NEW, (9, "kept")]
    assert rows(versions.table_as_of(spark, log, ["id"], version=2)) == NEW


def test_refused_commits(spark, log):
    late = spark.createDataFrame([(9, "x", "insert")], f"{SCHEMA}, _change_type STRING")
    with pytest.raises(ValueError, match="after"):
        versions.commit_changes(late, log, "2031-03-04")
    with pytest.raises(ValueError, match="columns"):
        versions.commit_changes(late.withColumn("more", F.lit(1)), log, "2032-01-01")


def test_only_the_folders_of_a_version_are_read(spark, log):
    plan = versions.read_changes(spark, log, high=1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_commit_version" in plan
    assert versions.read_changes(spark, log, 2, 2).select("_commit_timestamp").distinct().count() == 1
