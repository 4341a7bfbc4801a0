"""The catalogue of queries: name, survey ids, Spark function and check SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    ids: tuple[str, ...]
    build: Build
    sql: str | None


CATALOG: dict[str, Query] = {}


def query(name: str, *ids: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a query; ``sql`` is the same question for DuckDB over the same tables."""
    def add(build: Build) -> Build:
        if name in CATALOG:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return present(build(spark, sf_dir))

        CATALOG[name] = Query(name, ids, run, sql)
        return build
    return add


def present(df: DataFrame) -> DataFrame:
    """Plain output types, so that two engines print a value the same way: whole numbers as
    BIGINT, decimals as DOUBLE, dates and timestamps as text, arrays joined with ``|``."""
    out = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            col = col.cast("bigint")
        elif isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            col = col.cast("double")
        elif isinstance(f.dataType, T.DateType):
            col = col.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, T.ArrayType):
            col = F.array_join(col.cast("array<string>"), "|")
        out.append(col.alias(f.name))
    return df.select(*out)
