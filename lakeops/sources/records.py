"""Records from message logs and databases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.sources.files import SchemaLike, as_struct


def decode_records(df: DataFrame, schema: SchemaLike, value: str = "value",
                   keep: tuple[str, ...] = ("key", "topic", "partition", "offset", "timestamp"),
                   ) -> DataFrame:
    """Typed columns from binary JSON records (the shape of Spark's kafka source)."""
    parsed = F.from_json(F.col(value).cast("string"), as_struct(schema)).alias("__r")
    meta = [F.col(c).cast("string").alias(c) if c == "key" else F.col(c)
            for c in keep if c in df.columns]
    return df.select(*meta, parsed).select(*[c for c in keep if c in df.columns], "__r.*")


def jdbc_options(url: str, query: str, column: str, lower: int, upper: int, partitions: int,
                 **extra: str) -> dict[str, str]:
    """Options of a partitioned read whose subquery runs in the source database."""
    return {"url": url, "dbtable": f"({query}) AS src", "partitionColumn": column,
            "lowerBound": str(lower), "upperBound": str(upper),
            "numPartitions": str(partitions), **extra}


def read_jdbc(spark: SparkSession, url: str, query: str, column: str, lower: int, upper: int,
              partitions: int, **extra: str) -> DataFrame:
    """Read ``query`` over ``partitions`` connections, split on ``column``.

    The bounds only set the stride; rows outside them are read by the first and last partition.
    """
    return (spark.read.format("jdbc")
            .options(**jdbc_options(url, query, column, lower, upper, partitions, **extra))
            .load())
