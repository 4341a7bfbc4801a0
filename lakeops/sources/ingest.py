"""Idempotent incremental file loads into a parquet table with a ledger of loaded files.

Layout of a target: ``data/__load=N`` holds the rows of load N and ``ledger/__load=N`` the files
it read. The ledger entry is written last and readers skip loads without one, so a load that
dies leaves nothing visible and its number is written again by the next attempt.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from itertools import islice

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.sources.drift import UnknownFieldError, evolve_schema
from lakeops.sources.files import SchemaLike, as_struct, list_files
from lakeops.sources.mixed import read_mixed, schema_groups

LEDGER = "path STRING, modificationTime TIMESTAMP, length BIGINT, __load INT"
CHUNK = 10_000


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    try:
        return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
    except Py4JJavaError:
        return False


def _ledger(spark: SparkSession, target: str) -> DataFrame:
    if not path_exists(spark, f"{target}/ledger"):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(f"{target}/ledger")


def last_load(spark: SparkSession, target: str) -> int:
    """The number of the last finished load, 0 before the first."""
    return _ledger(spark, target).agg(F.coalesce(F.max("__load"), F.lit(0))).first()[0]


def save_text(spark: SparkSession, path: str, text: str) -> None:
    spark.range(1).select(F.lit(text)).write.mode("overwrite").text(path)


def save_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    save_text(spark, path, schema.json())


def load_schema(spark: SparkSession, path: str) -> T.StructType | None:
    if not path_exists(spark, path):
        return None
    return T.StructType.fromJson(json.loads(spark.read.text(path).first()[0]))


def read_loads(spark: SparkSession, target: str, after: int = 0, upto: int | None = None) -> DataFrame:
    """Rows of the finished loads after number ``after`` until ``upto``, in the table's current schema, with ``__load``."""
    schema = load_schema(spark, f"{target}/schema")
    if schema is None:
        raise FileNotFoundError(f"nothing has been loaded into {target}")
    last = last_load(spark, target) if upto is None else upto
    with_load = T.StructType([*schema.fields, T.StructField("__load", T.IntegerType())])
    if last == 0:
        return spark.createDataFrame([], with_load)
    data = spark.read.schema(with_load).parquet(f"{target}/data")
    return data.where((F.col("__load") > after) & (F.col("__load") <= last))


def read_loaded(spark: SparkSession, target: str) -> DataFrame:
    """Rows of all finished loads, in the table's current schema."""
    return read_loads(spark, target).drop("__load")


def _chunks(rows: Iterator, size: int) -> Iterator[list]:
    while chunk := list(islice(rows, size)):
        yield chunk


def copy_into(spark: SparkSession, target: str, src: str, fmt: str,
              schema: SchemaLike | None = None,
              select: Callable[[DataFrame], DataFrame] | None = None,
              pattern: str | None = None, files: Sequence[str] | None = None,
              force: bool = False, merge_schema: bool = False, widen_types: bool = False,
              allow_overwrites: bool = False, infer: bool = True, **options: str) -> int:
    """Load the files of ``src`` that were not loaded yet; returns how many files were read.

    ``force`` reloads everything; ``allow_overwrites`` loads a known path again when it was
    modified (in full, so consumers must merge or dedup); ``merge_schema`` lets new columns into
    the table, ``widen_types`` wider types of its columns. Files of a chunk may have different schemas (Parquet and
    ORC footers, CSV headers): columns are found by name in each, and all of them are loaded. File
    names pass through the driver in chunks; rows never do.
    """
    if pattern is not None and files is not None:
        raise ValueError("pattern and files exclude each other")
    found = list_files(spark, src, pattern)
    if files is not None:
        found = found.where(F.element_at(F.split("path", "/"), -1).isin(list(files)))
    if not force:
        done = _ledger(spark, target)
        known = ["path", "modificationTime"] if allow_overwrites else ["path"]
        found = found.join(done.select(*known).distinct(), known, "left_anti")
    loaded = 0
    for chunk in _chunks(found.toLocalIterator(), CHUNK):
        _load_chunk(spark, target, chunk, fmt, schema, select, merge_schema, widen_types, infer, options)
        loaded += len(chunk)
    return loaded


def _load_chunk(spark, target, chunk, fmt, schema, select, merge_schema, widen_types, infer, options) -> None:
    groups = schema_groups(spark, [r["path"] for r in chunk], fmt, infer and schema is None, declared=schema, **options)
    rows = read_mixed(spark, groups, fmt, schema, each=select, **options)
    current = load_schema(spark, f"{target}/schema")
    if current is None:
        current = rows.schema
        save_schema(spark, f"{target}/schema", current)
    else:
        wider, verdict = evolve_schema(current, rows.schema,
                                       "addNewColumnsWithTypeWidening" if widen_types else "addNewColumns")
        if verdict.new_fields and not merge_schema:
            raise UnknownFieldError(verdict.new_fields, schema_recorded=False)
        if verdict.new_fields or verdict.widened:
            # Files of earlier loads keep their types; Parquet readers widen them.
            current = wider
            save_schema(spark, f"{target}/schema", current)
    fitted = [F.col(f.name).cast(f.dataType) if f.name in rows.columns
              else F.lit(None).cast(f.dataType).alias(f.name) for f in current.fields]
    number = last_load(spark, target) + 1
    rows.select(*fitted).write.mode("overwrite").parquet(f"{target}/data/__load={number}")
    entry = spark.createDataFrame([(r["path"], r["modificationTime"], r["length"])
                                   for r in chunk], as_struct(LEDGER.rsplit(",", 1)[0]))
    entry.coalesce(1).write.mode("overwrite").parquet(f"{target}/ledger/__load={number}")
