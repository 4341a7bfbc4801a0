"""A change log with a commit index: the table as of a version or of a time.

Layout of a log: ``changes/_commit_version=N`` holds the changes of commit N and ``commits/_commit_version=N``
one row with its time. The commit row is written last and readers skip versions without one, so a
commit that dies leaves nothing visible and its number is written again. Finding a version reads
the commit rows only; reading changes prunes the folders of other versions.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.cdc import state_as_of
from lakeops.sources.ingest import load_schema, path_exists, save_schema

COMMITS = "_commit_timestamp TIMESTAMP, _commit_version INT"


class NoSuchVersion(ValueError):
    """The log has no commit that early, or no commit of that number."""


def commit_index(spark: SparkSession, log: str) -> DataFrame:
    """(_commit_version, _commit_timestamp) of every finished commit."""
    if not path_exists(spark, f"{log}/commits"):
        return spark.createDataFrame([], COMMITS)
    return spark.read.schema(COMMITS).parquet(f"{log}/commits")


def commit_changes(changes: DataFrame, log: str, at: str | datetime) -> int:
    """Append a batch of changes (rows with ``_change_type``) as the next commit; returns its number.

    Commits are in the order of their times: an ``at`` before the last commit's is refused.
    """
    spark = changes.sparkSession
    last = commit_index(spark, log).agg(
        F.coalesce(F.max("_commit_version"), F.lit(0)).alias("version"),
        F.coalesce(F.max("_commit_timestamp") > _moment(at), F.lit(False)).alias("later")).first()
    if last["later"]:
        raise ValueError(f"the log has a commit after {at}")
    rows = changes.drop("_commit_version", "_commit_timestamp")
    recorded = load_schema(spark, f"{log}/schema")
    if recorded is None:
        save_schema(spark, f"{log}/schema", rows.schema)
    elif [(f.name, f.dataType) for f in recorded] != [(f.name, f.dataType) for f in rows.schema]:
        raise ValueError(f"the log has other columns: {recorded.simpleString()}")
    number = last["version"] + 1
    rows.write.mode("overwrite").parquet(f"{log}/changes/_commit_version={number}")
    (spark.range(1).select(_moment(at).alias("_commit_timestamp")).write.mode("overwrite")
     .parquet(f"{log}/commits/_commit_version={number}"))
    return number


def _moment(at: str | datetime) -> Column:
    return F.lit(at).cast("timestamp")


def version_at(spark: SparkSession, log: str, at: str | datetime) -> int:
    """The last commit that isn't after ``at``."""
    found = commit_index(spark, log).where(F.col("_commit_timestamp") <= _moment(at)).agg(F.max("_commit_version")).first()[0]
    if found is None:
        raise NoSuchVersion(f"no commit until {at}")
    return found


def read_changes(spark: SparkSession, log: str, low: int = 1, high: int | None = None) -> DataFrame:
    """Changes of the finished commits from ``low`` to ``high``, with version and time."""
    index = commit_index(spark, log)
    last = index.agg(F.coalesce(F.max("_commit_version"), F.lit(0))).first()[0]
    if high is not None and not 1 <= high <= last:
        raise NoSuchVersion(f"the log has commits 1 to {last}, not {high}")
    schema = load_schema(spark, f"{log}/schema")
    if schema is None:
        raise NoSuchVersion("the log has no commit")
    whole = T.StructType([*schema.fields, T.StructField("_commit_version", T.IntegerType())])
    rows = spark.read.schema(whole).parquet(f"{log}/changes").where(
        F.col("_commit_version").between(low, last if high is None else high))
    return rows.join(index, "_commit_version").select(*schema.names, "_commit_version", "_commit_timestamp")


def table_as_of(spark: SparkSession, log: str, keys: Sequence[str], version: int | None = None,
                at: str | datetime | None = None) -> DataFrame:
    """The table after commit ``version``, or as it was ``at`` a time; as it is without either."""
    if version is not None and at is not None:
        raise ValueError("a version or a time, not both")
    if at is not None:
        version = version_at(spark, log, at)
    changes = read_changes(spark, log, high=version)
    return state_as_of(changes, keys, (1 << 31) - 1 if version is None else version)


def copy_as_of(spark: SparkSession, log: str, keys: Sequence[str], dst: str, version: int | None = None,
               at: str | datetime | None = None) -> DataFrame:
    """Materialise :func:`table_as_of` as a table of its own."""
    table_as_of(spark, log, keys, version, at).write.mode("errorifexists").parquet(dst)
    return spark.read.parquet(dst)
