"""Gold datasets that follow their silver tables: a run computes again only what its new rows touch.

A stream over each silver table notes the keys that its new rows touch (days, customers, items), each
micro-batch under its number, below ``_touched``. A dataset is then refreshed for the noted keys by a
semi-join with silver and overwrites just the buckets they lie in; the notes go when that is done. Each step
can be repeated: a batch notes the same keys again, and a refresh writes the same buckets again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.swaps import Files
from lakeops.session import settle
from lakeops.sources.files import SchemaLike, as_struct
from lakeops.sources.ingest import path_exists
from lakeops.streaming.flows import follow_sink

KeysOf = Callable[[DataFrame], DataFrame]


def note_touched(spark: SparkSession, out: str, source: str, targets: Mapping[str, KeysOf]) -> None:
    """Note, for each target dataset, the keys that rows new in the silver table ``source`` touch."""
    def note(batch: DataFrame, number: int) -> None:
        for target, keys in targets.items():
            keys(batch).distinct().write.mode("overwrite").parquet(f"{out}/_touched/{target}/source={source}/batch={number}")

    (follow_sink(spark, f"{out}/{source}").writeStream.foreachBatch(note)
     .option("checkpointLocation", f"{out}/_checkpoints/touched_{source}")
     .trigger(availableNow=True).start().awaitTermination())


def touched_keys(spark: SparkSession, out: str, target: str, key: SchemaLike) -> DataFrame | None:
    """The keys noted for a dataset since its last refresh; None if there are none."""
    place = f"{out}/_touched/{target}"
    if not path_exists(spark, place):
        return None
    schema = as_struct(key)
    return spark.read.schema(schema).parquet(place).select(*schema.names).distinct()


def _of_keys(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    wanted = keys.select(F.col(key).alias("__key"))
    return rows.join(wanted, F.col(key).eqNullSafe(F.col("__key")), "left_semi")


def refresh_keys(spark: SparkSession, out: str, target: str, key: SchemaLike, rows: DataFrame,
                 compute: Callable[[DataFrame], DataFrame], buckets: int = 64) -> DataFrame:
    """A dataset whose rows follow from the rows of their key, stored in buckets of key hashes: the touched
    keys are computed again, and only the buckets that hold one are written."""
    name, path = as_struct(key).names[0], f"{out}/{target}"
    keys, schema = touched_keys(spark, out, target, key), compute(rows).schema
    bucket = F.pmod(F.xxhash64(name), F.lit(buckets)).cast("int").alias("__bucket")
    whole = T.StructType([*schema.fields, T.StructField("__bucket", T.IntegerType())])
    if keys is not None:
        fresh = compute(_of_keys(rows, keys, name)).select("*", bucket)
        if path_exists(spark, path):
            wanted = keys.select(F.col(name).alias("__key"))
            numbers = [r[0] for r in keys.select(bucket).distinct().collect()]  # at most ``buckets``
            kept = (spark.read.schema(whole).parquet(path).where(F.col("__bucket").isin(numbers))
                    .join(wanted, F.col(name).eqNullSafe(F.col("__key")), "left_anti"))
            # Settled, because what it reads is what it replaces.
            fresh = settle(kept.unionByName(fresh), "touched-buckets")
        (fresh.repartition("__bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("__bucket").parquet(path))
        Files(spark, out).delete(f"{out}/_touched/{target}")
    return spark.read.schema(whole).parquet(path).select(*schema.names)
