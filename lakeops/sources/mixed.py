"""Files of different schemas in one load.

Files are grouped by what they say about themselves: Parquet and ORC by their footers, CSV by its header
line. Each group is read in its own terms, every column is found by name, converted to the common
schema, and the groups are put together. What the common schema has no place for can be rescued as JSON.

Footers and headers are read in tasks. The driver sees file names, schemas and one header line per file, so callers
hand in a bounded number of files.
"""

from __future__ import annotations

import csv
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial, reduce
from urllib.parse import unquote

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.sources.drift import INTEGERS, widens
from lakeops.sources.files import SchemaLike, as_struct, hinted_schema, read_files

RESCUED = "_rescued_data"
_BROKEN = "__broken_line"
_PER_FILE = ("parquet", "orc")


class SchemaConflict(ValueError):
    """Files give one column types that have nothing in common."""


@dataclass(frozen=True)
class Group:
    """Files that share a schema; ``header`` if their columns are known by their place in a line."""

    files: tuple[str, ...]
    schema: T.StructType
    header: bool = False


# -- schemas --------------------------------------------------------------------------------------

def common_type(a: T.DataType, b: T.DataType, name: str = "") -> T.DataType:
    """The type both convert to without loss; STRING for scalars that have none."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return common_schema([a, b])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType, name))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(common_type(a.keyType, b.keyType, name), common_type(a.valueType, b.valueType, name))
    nested = (T.StructType, T.ArrayType, T.MapType)
    if isinstance(a, nested) or isinstance(b, nested):
        raise SchemaConflict(f"{name}: {a.simpleString()} and {b.simpleString()}")
    if widens(a, b):
        return b
    if widens(b, a):
        return a
    x, y = _as_decimal(a), _as_decimal(b)
    if x and y:
        scale = max(x.scale, y.scale)
        whole = max(x.precision - x.scale, y.precision - y.scale)
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    return T.StringType()


def _as_decimal(kind: T.DataType) -> T.DecimalType | None:
    if isinstance(kind, T.DecimalType):
        return kind
    digits = INTEGERS.get(kind.simpleString())
    return T.DecimalType(digits, 0) if digits else None


def common_schema(schemas: list[T.StructType]) -> T.StructType:
    """All columns of all schemas, by name, in order of first appearance."""
    found: dict[str, T.DataType] = {}
    for f in (f for s in schemas for f in s.fields):
        found[f.name] = common_type(found[f.name], f.dataType, f.name) if f.name in found else f.dataType
    return T.StructType([T.StructField(n, t) for n, t in found.items()])


def _in_own_types(want: T.DataType, own: T.DataType) -> T.DataType:
    """The shape of ``want`` (all its nested fields) with the leaf types of ``own``."""
    if isinstance(want, T.StructType) and isinstance(own, T.StructType):
        has = {f.name: f.dataType for f in own.fields}
        return T.StructType([T.StructField(f.name, _in_own_types(f.dataType, has[f.name]) if f.name in has
                                           else f.dataType) for f in want.fields])
    if isinstance(want, T.ArrayType) and isinstance(own, T.ArrayType):
        return T.ArrayType(_in_own_types(want.elementType, own.elementType))
    if isinstance(want, T.MapType) and isinstance(own, T.MapType):
        return T.MapType(own.keyType, _in_own_types(want.valueType, own.valueType))
    return own


# -- what files say about themselves --------------------------------------------------------------

def schema_groups(spark: SparkSession, files: list[str], fmt: str, infer: bool = True, hints: str | None = None,
                  declared: SchemaLike | None = None, **options: str) -> list[Group]:
    """``files`` grouped by their schema. Formats that carry names in every row (JSON) are one group, which has
    the ``declared`` schema if there is one."""
    if not files:
        return []
    if fmt in _PER_FILE:
        return _by_footers(spark, files, fmt, options)
    if fmt == "csv" and has_header(options):
        return _by_headers(spark, files, infer, hints, options)
    own = as_struct(declared) if declared is not None else read_files(spark, list(files), fmt, infer=infer, **options).schema
    return [Group(tuple(files), own)]


def has_header(options: dict) -> bool:
    """Whether reading options say that CSV files begin with the names of their columns."""
    return str(options.get("header", "false")).lower() == "true"


def _by_footers(spark: SparkSession, files: list[str], fmt: str, options: dict) -> list[Group]:
    """Spark merges the footers of all files in one job. Where types differ it can't: then the files are
    halved, which finds the places where a feed changed, and compatible parts are put together again."""
    try:
        merged = spark.read.format(fmt).options(**options).option("mergeSchema", True).load(list(files)).schema
        return [Group(tuple(files), _nullable(merged))]
    except (Py4JJavaError, PySparkException) as e:
        if len(files) == 1 or "MERGE" not in str(e):
            raise
    half = len(files) // 2
    out: list[Group] = []
    for group in _by_footers(spark, files[:half], fmt, options) + _by_footers(spark, files[half:], fmt, options):
        kinds = {f.name: f.dataType for f in group.schema.fields}
        for k, other in enumerate(out):
            if all(kinds.get(f.name, f.dataType) == f.dataType for f in other.schema.fields):
                out[k] = Group(other.files + group.files, common_schema([other.schema, group.schema]))
                break
        else:
            out.append(group)
    return out


def _nullable(kind: T.DataType) -> T.DataType:
    """The type without NOT NULL, which a file can only promise for itself."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(_nullable(kind.keyType), _nullable(kind.valueType))
    return kind


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of a task, which reads one file from its beginning; the rest isn't read."""
    for batch in batches:
        if batch.num_rows:
            yield batch.slice(0, 1)
            return


def header_lines(spark: SparkSession, files: list[str]) -> dict[str, str]:
    """First line of every file that has one, by path. One task a file."""
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 50))
    own.conf.set("spark.sql.files.openCostInBytes", str(1 << 50))
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    lines = own.read.text(list(files)).select("value", F.col("_metadata.file_path").alias("path"))
    # Metadata names files as escaped URIs, readers take plain paths.
    return {unquote(r["path"]): r["value"] for r in
            lines.mapInArrow(_first_lines, "value string, path string").collect()}


def _by_headers(spark, files, infer, hints, options) -> list[Group]:
    sep = options.get("sep", options.get("delimiter", ","))
    by_header: dict[tuple[str, ...], list[str]] = {}
    for path, line in sorted(header_lines(spark, files).items()):
        cells = next(csv.reader([line.removeprefix("﻿")], delimiter=sep, quotechar=options.get("quote", '"')))
        names = tuple(c.strip() or f"_c{k}" for k, c in enumerate(cells))
        if len(set(names)) < len(names):
            raise SchemaConflict(f"{path}: a column occurs twice in {line!r}")
        by_header.setdefault(names, []).append(path)
    out = []
    for names, paths in by_header.items():
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        if infer:
            seen = read_files(spark, paths, "csv", **options).schema
            schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, seen.fields, strict=True)])
        if hints:
            wanted = {f.name: f.dataType for f in as_struct(hints).fields}
            schema = T.StructType([T.StructField(f.name, wanted.get(f.name, f.dataType)) for f in schema.fields])
        out.append(Group(tuple(paths), schema, header=True))
    return out


# -- rows -----------------------------------------------------------------------------------------

def read_mixed(spark: SparkSession, groups: list[Group], fmt: str, schema: SchemaLike | None = None,
               rescue: bool = False, case_sensitive: bool = True,
               each: Callable[[DataFrame], DataFrame] | None = None, **options: str) -> DataFrame:
    """The rows of all groups in ``schema`` (default: :func:`common_schema` of the groups).

    Columns are found by name (in any case, unless ``case_sensitive``), missing ones are NULL. With ``rescue``
    other columns, values that don't fit their type and broken lines are kept as JSON in ``_rescued_data`` beside
    the name of the file, and a column ``source_file`` is added; without it other columns are left out and a
    value that doesn't fit is an error (CSV: NULL). ``each`` is applied to every group, where ``_metadata`` is known.
    """
    target = as_struct(schema) if schema is not None else common_schema([g.schema for g in groups])
    target = T.StructType([f for f in target.fields if f.name != RESCUED])
    read = partial(_read_group, spark, fmt=fmt, target=target, rescue=rescue, case_sensitive=case_sensitive,
                   options=options)
    parts = [read(g) for g in groups] or [spark.createDataFrame([], target)]
    return reduce(DataFrame.unionByName, [each(p) if each else p for p in parts])


def _read_group(spark: SparkSession, group: Group, fmt: str, target: T.StructType, rescue: bool,
                case_sensitive: bool, options: dict) -> DataFrame:
    def key(name: str) -> str:
        return name if case_sensitive else name.lower()

    exact = {f.name for f in group.schema.fields}
    by_key = {key(f.name): f for f in group.schema.fields if key(f.name) != f.name or f.name in exact}
    found = {f.name: next((g for g in group.schema.fields if g.name == f.name), by_key.get(key(f.name)))
             for f in target.fields}
    used = {g.name: f for f in target.fields if (g := found[f.name])}
    if group.header:
        # By place in the file's own lines; known columns are parsed as what they shall become.
        shape = [T.StructField(g.name, used[g.name].dataType if g.name in used else T.StringType())
                 for g in group.schema.fields]
        reader = spark.read.format("csv").options(**{"mode": "PERMISSIVE", **options})
        if rescue:
            reader = reader.option("columnNameOfCorruptRecord", _BROKEN)
            shape.append(T.StructField(_BROKEN, T.StringType()))
        rows = reader.schema(T.StructType(shape)).load(list(group.files))
    else:
        shape = [T.StructField(g.name, _in_own_types(used[g.name].dataType, g.dataType) if g.name in used
                               else g.dataType) for g in group.schema.fields if rescue or g.name in used]
        rows = spark.read.format(fmt).options(**options).schema(T.StructType(shape)).load(list(group.files))

    own = dict(zip(rows.columns, [f.dataType for f in rows.schema.fields], strict=True))
    columns, odd = [], []
    for f in target.fields:
        g = found[f.name]
        if g is None:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        raw = F.col(f"`{g.name}`")
        if own[g.name] == f.dataType:
            columns.append(raw.alias(f.name))
        elif rescue:
            columns.append(raw.try_cast(f.dataType).alias(f.name))
            odd.append((g.name, F.when(raw.try_cast(f.dataType).isNull(), _as_text(raw, own[g.name]))))
        else:
            columns.append(raw.cast(f.dataType).alias(f.name))
    if not rescue:
        return rows.select(*columns)
    odd += [(g.name, _as_text(F.col(f"`{g.name}`"), own[g.name])) for g in group.schema.fields
            if g.name not in used]
    if group.header:
        odd.append(("_corrupt_record", F.col(_BROKEN)))
    place = F.col("_metadata.file_path")
    return rows.select(*columns, _json_of(odd, place).alias(RESCUED), place.alias("source_file"))


def _as_text(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(value)
    return value.cast("string")


def _json_of(odd: list[tuple[str, Column]], place: Column) -> Column:
    """The columns that are not NULL, and the file, as JSON; NULL if there are none."""
    if not odd:
        return F.lit(None).cast("string")
    pairs = F.map_from_entries(F.array(*[F.struct(F.lit(n).alias("k"), c.alias("v")) for n, c in odd]))
    kept = F.map_filter(pairs, lambda _, v: v.isNotNull())
    return F.when(F.size(kept) > 0, F.to_json(F.map_concat(kept, F.create_map(F.lit("_file_path"), place))))


def recorded(groups: list[Group], hints: str | None) -> T.StructType:
    """The schema that a feed of these files has, with the types of ``hints``."""
    seen = common_schema([g.schema for g in groups])
    return hinted_schema(seen, hints) if hints else seen
