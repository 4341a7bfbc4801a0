"""Streams that change a table: upserts and change-feed replicas in a store that is bucketed by key.

Every micro-batch writes its changes under its own batch number and nothing else, so a batch that is
replayed replaces exactly its own rows and the cost of a batch does not depend on the size of
the table. Changes and base lie in folders of key hashes (``__bucket``), whose number is fixed by the first
batch. :func:`fold` merges the changes into new base folders of just the buckets they touch; they count once
``folds`` says so. Readers take the latest change per key from each bucket's last base and the finished
batches after the last fold; :func:`read_keys` opens only the buckets of the keys it is asked for. Batch
numbers belong to a checkpoint: a renewed checkpoint needs a new store.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeops.operators.ordering import latest_per_key
from lakeops.operators.swaps import Files
from lakeops.sources.drift import evolve_schema
from lakeops.sources.ingest import path_exists
from lakeops.streaming.flows import _start

LAYOUT = "buckets INT, fields STRING, __batch BIGINT"
FOLDS = "upto BIGINT, bucket INT"


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _layout(spark: SparkSession, store: str) -> tuple[int, T.StructType] | None:
    """Number of buckets and columns of the rows, as the last batch that changed them noted it."""
    if not path_exists(spark, f"{store}/layout"):
        return None
    last = spark.read.schema(LAYOUT).json(f"{store}/layout").orderBy(F.desc("__batch")).first()
    return last and (last["buckets"], T.StructType.fromJson(json.loads(last["fields"])))


def _note_layout(spark: SparkSession, store: str, number: int, buckets: int, schema: T.StructType) -> None:
    row = spark.range(1).select(F.lit(buckets).alias("buckets"), F.lit(schema.json()).alias("fields"))
    row.write.mode("overwrite").json(f"{store}/layout/__batch={number}")


def _write_buckets(rows: DataFrame, keys: Sequence[str], buckets: int, path: str) -> None:
    """One folder a bucket; AQE cuts a large bucket into several files and puts small ones into one task."""
    (rows.withColumn("__bucket", _bucket(keys, buckets)).hint("rebalance", "__bucket")
     .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("__bucket").parquet(path))


def upsert_stream(stream: DataFrame, keys: Sequence[str], order_by: Sequence[str], store: str,
                  checkpoint: str, delete_when: str = "false",
                  trigger: str | None = None, buckets: int = 32) -> StreamingQuery:
    """Keep ``store`` at the latest row per key of ``stream``.

    ``order_by`` names the sequence (``["-ts", ...]``, a total order), so late rows lose against
    newer ones whatever batch they arrive in. ``buckets`` counts for a new store: about the size of the
    table by what one task should write in a fold. Columns that a later run adds are NULL in earlier rows.
    """
    known: list[int] = []  # the number of buckets, looked up once a run

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        changes = batch.withColumn("__deleted", F.coalesce(F.expr(delete_when), F.lit(False)))
        if not known:
            count, schema = _layout(spark, store) or (buckets, None)
            wider = evolve_schema(schema, changes.schema)[0] if schema else changes.schema
            if wider != schema:
                _note_layout(spark, store, number, count, wider)
            known.append(count)
        _write_buckets(latest_per_key(changes, keys, order_by), keys, known[0], f"{store}/changes/__batch={number}")

    return _start(stream.writeStream.foreachBatch(write)
                  .option("checkpointLocation", checkpoint), trigger)


@dataclass(frozen=True)
class _Store:
    """What there is to read: the base of each bucket (``upto`` by number) and the batches after the last fold."""

    spark: SparkSession
    path: str
    buckets: int
    schema: T.StructType
    upto: int | None
    bases: dict[int, int]
    batches: list[int]

    def entries(self, only: Iterable[int] | None = None) -> DataFrame:
        """Rows with ``__batch`` (-1 for the base), of the buckets ``only``."""
        numbers = None if only is None else sorted(set(only))
        parts = []
        if paths := [f"{self.path}/base/upto-{n}/__bucket={b}" for b, n in sorted(self.bases.items())
                     if numbers is None or b in numbers]:
            parts.append(self.spark.read.schema(self.schema).parquet(*paths).withColumn("__batch", F.lit(-1).cast("bigint")))
        if self.batches:
            place = T.StructType([*self.schema.fields, T.StructField("__batch", T.LongType()),
                                  T.StructField("__bucket", T.IntegerType())])
            changes = (self.spark.read.schema(place).option("basePath", f"{self.path}/changes")
                       .parquet(*[f"{self.path}/changes/__batch={n}" for n in self.batches]))
            parts.append((changes if numbers is None else changes.where(F.col("__bucket").isin(numbers))).drop("__bucket"))
        nothing = self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields],
                                             F.lit(-1).cast("bigint").alias("__batch"))
        return reduce(DataFrame.unionByName, parts or [nothing])


def _number(folder: str) -> int:
    return int(folder.rpartition("=" if "=" in folder else "-")[2])


def _open(spark: SparkSession, store: str) -> _Store | None:
    layout = _layout(spark, store)
    if layout is None:
        return None
    upto, bases = None, {}
    if path_exists(spark, f"{store}/folds"):
        # A row for each bucket, and one for the last fold.
        for bucket, last in spark.read.schema(FOLDS).parquet(f"{store}/folds").groupBy("bucket").agg(F.max("upto")).collect():
            if bucket is None:
                upto = last
            else:
                bases[bucket] = last
    files = Files(spark, store)
    found = [_number(n) for n in files.names(f"{store}/changes") if n.startswith("__batch=")]
    batches = [n for n in sorted(found) if (upto is None or n > upto)
               and files.exists(f"{store}/changes/__batch={n}/_SUCCESS")]
    return _Store(spark, store, *layout, upto, bases, batches)


def _opened(spark: SparkSession, store: str) -> _Store:
    found = _open(spark, store)
    if found is None:
        raise FileNotFoundError(f"no batch has been written to {store}")
    return found


def _current(entries: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    last = latest_per_key(entries, keys, [*order_by, "-__batch"])
    return last.where(~F.col("__deleted")).drop("__deleted", "__batch")


def read_store(spark: SparkSession, store: str, keys: Sequence[str],
               order_by: Sequence[str]) -> DataFrame:
    """The current rows of a store written by :func:`upsert_stream`."""
    return _current(_opened(spark, store).entries(), keys, order_by)


def read_keys(spark: SparkSession, store: str, keys: Sequence[str], order_by: Sequence[str],
              wanted: DataFrame) -> DataFrame:
    """The current rows of the keys in ``wanted`` (columns ``keys``; a NULL key is a key). Only their buckets are read."""
    found = _opened(spark, store)
    asked = wanted.select(*[F.col(k).cast(found.schema[k].dataType).alias(k) for k in keys]).distinct()
    numbers = [r[0] for r in asked.select(_bucket(keys, found.buckets)).distinct().collect()]  # at most ``buckets``
    asked = asked.select(*[F.col(k).alias(f"__{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return _current(found.entries(numbers).join(asked, same, "left_semi"), keys, order_by)


def fold(spark: SparkSession, store: str, keys: Sequence[str], order_by: Sequence[str]) -> int | None:
    """Merge all finished batches into the base, tombstones included; returns the last of them.

    Buckets without a change keep the base they have. Run it between stream runs. A later replay of an included batch
    changes nothing; a fold that dies before its note in ``folds`` is as if it had not been.
    """
    found = _opened(spark, store)
    if not found.batches:
        return found.upto
    files, upto = Files(spark, store), found.batches[-1]
    touched = {_number(f) for n in found.batches for f in files.names(f"{store}/changes/__batch={n}")
               if f.startswith("__bucket=")}
    if touched:
        latest = latest_per_key(found.entries(touched), keys, [*order_by, "-__batch"]).drop("__batch")
        _write_buckets(latest, keys, found.buckets, f"{store}/base/upto-{upto}")
    notes = F.array(F.lit(None).cast("int"), *[F.lit(b) for b in sorted(touched)])
    (spark.range(1).select(F.lit(upto).cast("bigint").alias("upto"), F.explode(notes).alias("bucket"))
     .coalesce(1).write.mode("append").parquet(f"{store}/folds"))
    return upto


def vacuum(spark: SparkSession, store: str) -> int:
    """Delete folded batches and base folders that newer ones replaced; how many. For times without readers or folds."""
    found, files = _opened(spark, store), Files(spark, store)
    gone = [f"{store}/changes/{n}" for n in files.names(f"{store}/changes")
            if n.startswith("__batch=") and found.upto is not None and _number(n) <= found.upto]
    for base in files.names(f"{store}/base"):
        inside = [b for b in files.names(f"{store}/base/{base}") if b.startswith("__bucket=")]
        old = [b for b in inside if found.bases.get(_number(b)) != _number(base)]
        gone += ([f"{store}/base/{base}"] if len(old) == len(inside)
                 else [f"{store}/base/{base}/{b}" for b in old])
    for path in gone:
        files.delete(path)
    return len(gone)


def replicate_stream(feed: DataFrame, keys: Sequence[str], store: str, checkpoint: str,
                     trigger: str | None = None, buckets: int = 32) -> StreamingQuery:
    """Follow a change feed: the last commit per key wins, pre-images are ignored."""
    images = feed.where(F.col("_change_type") != "update_preimage").withColumn(
        "__live", F.col("_change_type") != "delete")
    return upsert_stream(images, keys, REPLICA_ORDER, store, checkpoint,
                         "_change_type = 'delete'", trigger, buckets)


REPLICA_ORDER = ["-_commit_version", "-__live"]


def read_replica(spark: SparkSession, store: str, keys: Sequence[str],
                 schema: T.StructType) -> DataFrame:
    """The replica's rows in the columns of ``schema``; empty before the first batch."""
    if _open(spark, store) is None:
        return spark.createDataFrame([], schema)
    return read_store(spark, store, keys, REPLICA_ORDER).select(*schema.names)
