"""File layout: compaction, multi-column clustering, per-file ranges."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import pairwise

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeops.operators.swaps import recover, replace_folder
from lakeops.session import settle
from lakeops.sources.files import list_files

DRAWN = 64   # rows of the sample for each range of a clustering key
WRITERS = 4  # open files of a task that writes partitions; each holds a row group


def compact(spark: SparkSession, path: str, target_bytes: int = 1 << 30, where: str | None = None,
            partition_by: Sequence[str] = ()) -> int:
    """Rewrite the files of a parquet table into files of about ``target_bytes``, in place; returns the
    planned number of files.

    A table without partitions is packed by the scan: small files share a task, each task writes one
    file, and no row is shuffled. A partitioned table is rebalanced by its partition columns; with
    ``where``, a condition over these columns, only the named partitions are rewritten and all other
    files stay untouched. The new files are written once, beside the table, and take the place of the old ones by
    renames; a job that dies leaves the table as it was, or a swap that the next call of
    :func:`lakeops.operators.swaps.recover` completes. Sizes are set in a session of its own. No task reads
    much more than ``target_bytes``; one that meets at most ``WRITERS`` partitions doesn't sort its rows.
    """
    if where and not partition_by:
        raise ValueError("only whole partitions can be compacted apart: name the partition columns")
    recover(spark, path)
    own = unsorted_writes(spark)
    rows = spark.read.parquet(path)
    chosen = rows.where(where) if where else rows
    total = (chosen.select("_metadata.file_path", "_metadata.file_size").distinct()
             .agg(F.coalesce(F.sum("file_size"), F.lit(0))).first()[0] if where else
             list_files(spark, path).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0])
    parts = max(1, math.ceil(total / target_bytes))
    sizes = ({"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.advisoryPartitionSizeInBytes": target_bytes}
             if partition_by else {"spark.sql.files.maxPartitionBytes": target_bytes,
                                   "spark.sql.files.minPartitionNum": parts, "spark.sql.files.openCostInBytes": 0})
    for key, value in sizes.items():
        own.conf.set(key, str(value))
    packed = own.read.parquet(path)
    packed = packed.where(where) if where else packed
    if partition_by:
        packed = packed.hint("rebalance", *partition_by)
    replace_folder(spark, path, packed.write.partitionBy(*partition_by).parquet, len(partition_by) if where else 0)
    return parts


def unsorted_writes(spark: SparkSession) -> SparkSession:
    """A session whose tasks write up to ``WRITERS`` partitions side by side, and sort only the rows after those of more."""
    own = spark.newSession()
    own.conf.set("spark.sql.maxConcurrentOutputFileWriters", str(WRITERS))
    return own


def cluster_by(df: DataFrame, keys: Sequence[str], n_files: int) -> DataFrame:
    """Lay rows out along a Z-order curve over up to four columns of any orderable types.

    Every key becomes a rank: the number of its range among ranges that hold about as many rows
    each. The more files, the more ranges; the bits of the ranks are interleaved, and rows are
    range-partitioned on the result. One key needs no curve. Keys and a hash of the row come next
    in the range key, so equal ranks stay sorted and equal values can be spread over several files.
    """
    if not 1 <= len(keys) <= 4:
        raise ValueError("one to four clustering keys")
    spread, columns = F.xxhash64(*df.columns), [F.col(f"`{k}`") for k in keys]
    if len(keys) == 1:
        return df.repartitionByRange(n_files, *columns, spread).sortWithinPartitions(*columns)
    bits = max(4, math.ceil(math.log2(max(n_files, 2)) / len(keys)) + 2)
    cuts = _cuts(df, keys, 1 << bits)
    curve = df.withColumns({f"__r{i}": _rank(c, cuts[k]) for i, (k, c) in enumerate(zip(keys, columns, strict=True))})
    z = F.lit(0).cast("bigint")
    for bit in range(bits):
        for i in range(len(keys)):
            one = F.shiftright(F.col(f"__r{i}").cast("bigint"), bit).bitwiseAND(F.lit(1))
            z = z + F.shiftleft(one, bit * len(keys) + i)
    return (curve.withColumn("__z", z).repartitionByRange(n_files, F.col("__z"), *columns, spread)
            .sortWithinPartitions("__z", *columns).select(*df.columns))


def _cuts(df: DataFrame, keys: Sequence[str], ranges: int) -> dict[str, list]:
    """For each key the smallest values of all but the first of ``ranges`` even ranges, as literals.

    One pass over all files side by side draws about ``DRAWN`` rows for each range, whatever the table's size; only this
    sample of all keys goes to one task. A value that fills several ranges is a border once.
    """
    share = min(1.0, DRAWN * ranges / max(df.count(), 1))
    sample = settle(df.select(*[F.col(f"`{k}`") for k in keys]).sample(share, 7).repartition(1), "cluster-sample")
    out = {}
    for k in keys:
        value = F.col(f"`{k}`")
        tile = F.ntile(ranges).over(Window.orderBy(value))
        firsts = (sample.where(value.isNotNull()).select(value.alias("v"), tile.alias("t"))
                  .groupBy("t").agg(F.min("v").alias("v")).orderBy("t").collect())
        out[k] = [b["v"] for a, b in pairwise(firsts) if a["v"] != b["v"]]
    return out


def _rank(value: Column, cuts: list) -> Column:
    """How many cuts aren't above a value, 0 for NULL: a balanced tree of comparisons, which is compiled."""
    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value >= F.lit(cuts[middle]), tree(middle + 1, high)).otherwise(tree(low, middle))

    return F.when(value.isNull(), 0).otherwise(tree(0, len(cuts)))


def file_ranges(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows and min/max of ``cols`` per data file: what file skipping can use."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for c in cols:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.groupBy(F.col("_metadata.file_name").alias("file")).agg(*aggs)
