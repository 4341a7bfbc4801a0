"""Writing parquet tables: replace, strict overwrite, append, constraints, copies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.cdc import state_as_of
from lakeops.session import settle


class SchemaMismatch(ValueError):
    """The data does not have the columns and types of the table."""


def _shape(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def write_table(df: DataFrame, path: str, mode: str = "replace",
                partition_by: Sequence[str] = (), constraints: Sequence[str] = (),
                overwrite_schema: bool = False) -> None:
    """Write ``df`` to ``path``; ``mode`` is replace, overwrite_strict or append.

    ``overwrite_strict`` and ``append`` refuse other columns or types than the table has
    (``overwrite_schema`` lifts that for an overwrite). ``constraints`` are conditions that must
    not be FALSE; one violating row stops the write before the table changes. An append that
    fails commits nothing; before an overwrite the rows are checked while they are staged in the
    shared folder.
    """
    spark = df.sparkSession
    if mode not in ("replace", "overwrite_strict", "append"):
        raise ValueError(f"unknown mode {mode}")
    if mode != "replace" and not overwrite_schema:
        table = spark.read.parquet(path)
        if mode == "append":
            df = df.select(*table.columns) if set(df.columns) == set(table.columns) else df
        if sorted(_shape(df)) != sorted(_shape(table)):
            raise SchemaMismatch(f"{_shape(df)} does not fit {_shape(table)}")
    if constraints:
        for rule in constraints:
            message = F.lit(f"CHECK constraint violated: {rule}")
            broken = ~F.coalesce(F.expr(rule), F.lit(True))
            df = df.where(F.when(broken, F.raise_error(message).cast("boolean"))
                          .otherwise(F.lit(True)))
        if mode != "append":
            df = settle(df, "checked")
    writer = df.write.mode("append" if mode == "append" else "overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, same columns."""
    return df.where(F.lit(False))


def copy_table(spark: SparkSession, src: str, dst: str) -> DataFrame:
    spark.read.parquet(src).write.mode("errorifexists").parquet(dst)
    return spark.read.parquet(dst)


def copy_version(feed: DataFrame, keys: Sequence[str], version: int, dst: str) -> DataFrame:
    """Materialise the state after commit ``version`` of a change feed."""
    state_as_of(feed, keys, version).write.mode("errorifexists").parquet(dst)
    return feed.sparkSession.read.parquet(dst)
