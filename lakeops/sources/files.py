"""Querying files directly: any format, declared, inferred, hinted or all-string schemas."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SchemaLike = T.StructType | str


def as_struct(schema: SchemaLike) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read_files(spark: SparkSession, path: str | list[str], fmt: str,
               schema: SchemaLike | None = None, hints: str | None = None, infer: bool = True,
               **options: str) -> DataFrame:
    """Read a file, glob or directory.

    ``schema`` declares the columns; otherwise they are inferred, or all STRING with
    ``infer=False``. ``hints`` override the type of single columns.
    """
    if schema is None and hints is not None:
        schema = hinted_schema(read_files(spark, path, fmt, infer=infer, **options).schema, hints)
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        return reader.schema(as_struct(schema)).load(path)
    if fmt == "csv":
        reader = reader.option("inferSchema", infer)
    elif fmt == "json" and not infer:
        reader = reader.option("primitivesAsString", True)
    return reader.load(path)


def hinted_schema(schema: T.StructType, hints: str) -> T.StructType:
    """``schema`` with the types of ``hints``; hinted columns that are missing are added."""
    wanted = {f.name: f for f in as_struct(hints).fields}
    fields = [wanted.pop(f.name, f) for f in schema.fields]
    return T.StructType([*fields, *wanted.values()])


def apply_schema_hints(df: DataFrame, hints: str) -> DataFrame:
    """Cast hinted columns of loaded rows; a value that does not fit becomes NULL."""
    wanted = {f.name: f.dataType for f in as_struct(hints).fields}
    return df.select(*[
        F.col(c).try_cast(wanted[c]).alias(c) if c in wanted else F.col(c) for c in df.columns])


def with_provenance(df: DataFrame) -> DataFrame:
    """Add where each row was read from. Must sit directly on a file read."""
    meta: Mapping[str, str] = {
        "source_file": "file_path", "source_name": "file_name", "source_size": "file_size",
        "source_mtime": "file_modification_time"}
    return df.select("*", *[F.col(f"_metadata.{f}").alias(c) for c, f in meta.items()])


def list_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Paths, modification times and sizes; file contents are not read.

    The number of tasks follows the number of cores, not the bytes behind the names: the sizes of
    scan tasks are set in a session of its own.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 50))
    own.conf.set("spark.sql.files.openCostInBytes", "1")
    reader = own.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select("path", "modificationTime", "length")


def refresh_and_count(spark: SparkSession, table: str) -> int:
    """Row count of a file-backed table after other writers added files to its folder."""
    spark.sql(f"REFRESH TABLE {table}")
    return spark.table(table).count()


def synthetic_orders(spark: SparkSession, n: int, customers: int = 500, days: int = 28,
                     seed: int = 7) -> DataFrame:
    """Generated orders. Every value is drawn by a hash of the id, the column and ``seed``, so any
    partitioning gives the same rows; small customer numbers order most."""
    def draw(column: str, values: int) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(column), F.lit(seed)), F.lit(values))

    share = (draw("customer", 1_000_000) + 1) / 1_000_000
    placed = F.timestamp_seconds(F.lit(1_900_000_000) + draw("day", days) * 86_400 + draw("second", 86_400))
    states = F.array(*[F.lit(s) for s in ("open", "paid", "sent", "returned")])
    return spark.range(n).select(
        F.col("id").alias("order_id"), F.ceil(share * share * customers).alias("customer_id"),
        placed.alias("order_ts"), placed.cast("date").alias("order_date"),
        F.get(states, draw("state", 4).cast("int")).alias("status"),
        (draw("cents", 25_000) / 100).alias("amount"))


def skewed_orders(spark: SparkSession, hot: int, others: int = 19, each: int = 100,
                  seed: int = 7) -> DataFrame:
    """``hot`` orders of customer 1 and ``each`` orders of every other customer."""
    rows = spark.range(hot + others * each)
    rest = F.col("id") - hot
    amount = F.pmod(F.xxhash64(F.col("id"), F.lit(seed)), F.lit(10_000)) / 100
    return rows.select(
        "id", F.when(rest < 0, 1).otherwise(rest % others + 2).alias("customer_id"),
        amount.alias("amount"))
