"""Column statistics that can be united: an appended table is described without scanning it again.

A partial holds, for a group of rows and each column, rows, NULLs, least and greatest value, a HyperLogLog sketch of
the distinct values and, for numbers, a KLL sketch of the quantiles. Partials of parts of a table (files, loads, days)
unite into the partial of the whole, in any order. Sketches are combined in the map tasks, so a hot group moves a
few kB per task. NULLs count in no sketch, the empty text is a value. Columns of arrays, maps, structs
and variants have no statistics.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.swaps import Files
from lakeops.sources.ingest import last_load, read_loads

PLAIN = (T.NumericType, T.StringType, T.BinaryType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def distinct_error(lg_k: int = 12) -> float:
    """The relative standard error of a united distinct count."""
    return 1.04 / 2 ** (lg_k / 2)


def described(schema: T.StructType, cols: Sequence[str] | None = None) -> list[T.StructField]:
    """The fields that have statistics: those of ``cols``, or all of a plain type."""
    if cols is None:
        return [f for f in schema.fields if isinstance(f.dataType, PLAIN)]
    fields = [schema[c] for c in cols]
    if odd := [f.name for f in fields if not isinstance(f.dataType, PLAIN)]:
        raise ValueError(f"no statistics for the types of {odd}")
    return fields


def _value(field: T.StructField) -> Column:
    """What is counted as distinct. Sketches skip empty text, so text gets a first character; -0.0 is 0.0."""
    col = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.IntegralType):
        return col.cast("bigint")
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        col = col + F.lit(0.0).cast(field.dataType)
    if isinstance(field.dataType, T.BinaryType):
        col = F.hex(col)
    return F.concat(F.lit("="), col.cast("string"))


def partials(rows: DataFrame, by: Sequence[str] = (), cols: Sequence[str] | None = None, lg_k: int = 12,
             k: int = 200) -> DataFrame:
    """One row per group of ``by``: ``rows`` and a struct of statistics for each column.

    2 ** ``lg_k`` registers give the error of :func:`distinct_error`; a quantile's rank is off by about
    1.65 % at ``k`` = 200. Without groups there is one row, also for no rows.
    """
    aggs = []
    for f in described(rows.schema, cols):
        if f.name in by:
            continue
        col = F.col(f"`{f.name}`")
        parts = [F.count(col).alias("n"), F.min(col).alias("low"), F.max(col).alias("high"),
                 F.hll_sketch_agg(_value(f), lg_k).alias("distinct")]
        if isinstance(f.dataType, T.NumericType):
            parts.append(F.kll_sketch_agg_double(col.cast("double"), k).alias("quantiles"))
        aggs.append(F.struct(*parts).alias(f.name))
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("__rows"), *aggs)


def _columns(parts: DataFrame, by: Sequence[str]) -> list[T.StructField]:
    return [f for f in parts.schema.fields if isinstance(f.dataType, T.StructType) and f.name not in by]


def unite(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Partials of the union of the rows that ``parts`` describe, per group of ``by``."""
    aggs = []
    for f in _columns(parts, by):
        part = F.col(f"`{f.name}`")
        united = [F.coalesce(F.sum(part["n"]), F.lit(0)).alias("n"), F.min(part["low"]).alias("low"), F.max(part["high"]).alias("high"),
                  F.hll_union_agg(part["distinct"]).alias("distinct")]
        if "quantiles" in f.dataType.names:
            united.append(F.kll_merge_agg_double(part["quantiles"]).alias("quantiles"))
        aggs.append(F.struct(*united).alias(f.name))
    return parts.groupBy(*by).agg(F.coalesce(F.sum("__rows"), F.lit(0)).alias("__rows"), *aggs)


def describe(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per group and column: rows, NULLs, estimated distinct values, min, max and median (numbers) as text."""
    lines = []
    for f in _columns(parts, by):
        part = F.col(f"`{f.name}`")
        middle = F.lit(None).cast("double")
        if "quantiles" in f.dataType.names:
            middle = F.when(part["n"] > 0, F.kll_sketch_get_quantile_double(part["quantiles"], F.lit(0.5)))
        lines.append(F.struct(
            F.lit(f.name).alias("column"), F.col("__rows").alias("rows"), (F.col("__rows") - part["n"]).alias("nulls"),
            F.coalesce(F.hll_sketch_estimate(part["distinct"]), F.lit(0)).alias("approx_distinct"),
            part["low"].cast("string").alias("min"), part["high"].cast("string").alias("max"), middle.alias("median")))
    return parts.select(*by, F.inline(F.array(*lines)))


def _kept_parts(spark: SparkSession, place: str, schema: T.StructType) -> list[tuple[int, int]]:
    """(after, upto) of the parts that follow each other until the last one; none if a column's values
    are counted in another way now (a number that became a decimal, say)."""
    files = Files(spark, place)
    found = {}
    for name in files.names(place):
        if files.exists(f"{place}/{name}/_SUCCESS"):
            after, upto = map(int, name.split("-"))
            found[upto] = min(after, found.get(upto, after))
    chain, upto = [], max(found, default=0)
    while upto:
        chain.append((found[upto], upto))
        upto = found[upto]
    if chain:
        last = spark.read.parquet(f"{place}/{chain[0][0]}-{chain[0][1]}").schema
        for f in described(schema):
            if f.name in last.names:
                was = last[f.name].dataType["low"].dataType
                if was != f.dataType and not (isinstance(was, T.IntegralType) and isinstance(f.dataType, T.IntegralType)):
                    return []
    return chain


def refresh_statistics(spark: SparkSession, target: str, lg_k: int = 12) -> DataFrame:
    """Statistics of a table that ``copy_into`` loads; only loads that came since the last refresh are read.

    The partial of loads A+1 to N lies in ``statistics/A-N`` beside the data and counts once it is complete, so a
    refresh that dies is repeated. A column that a later load added is NULL before. If a
    column was widened to another kind of number, all loads are read again.
    """
    place, last = f"{target}/statistics", last_load(spark, target)
    fresh = read_loads(spark, target, upto=last)
    chain = _kept_parts(spark, place, fresh.drop("__load").schema)
    done = chain[0][1] if chain else 0
    new = partials(fresh.where(F.col("__load") > done).drop("__load"), lg_k=lg_k)
    if done < last:
        new.write.mode("overwrite").parquet(f"{place}/{done}-{last}")
        chain.append((done, last))
    if not chain:
        return describe(new)
    parts = spark.read.schema(new.schema).parquet(*[f"{place}/{a}-{n}" for a, n in chain])
    return describe(unite(parts))
