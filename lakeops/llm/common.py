"""Small helpers that several operators share."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

A_TO_Z, a_to_z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether the row is kept from learning; a row without an id always is."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(True))


def row_key(doc_id: Column, text: Column) -> Column:
    """Names a (doc_id, text) pair. Repeated rows share it, and with it every result."""
    whole = F.coalesce(text, F.lit(""))
    return F.struct(F.coalesce(doc_id.cast("string"), F.lit("-")).alias("id"),
                    F.xxhash64(whole).alias("h"), F.length(whole).alias("n"))


def hash_sample(df: DataFrame, rows: int, *by: str) -> DataFrame:
    """``rows`` rows at most, chosen by a hash of the columns ``by``; all of a smaller table.

    A share of the hashes is taken first, so that no task hands on many more rows than it should.
    """
    scale = 1 << 30
    share = min(scale, -(-scale * rows * 11 // (10 * max(df.count(), 1))) + scale // (1 << 20))
    drawn = F.xxhash64(*by, F.lit("sample"))
    return df.where(F.pmod(drawn, F.lit(scale)) < share).orderBy(drawn, *by).limit(rows)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, A_TO_Z, a_to_z)


def in_slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Short runs of rows, so that a task holds the Python texts of a few rows at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def letters_of_bytes() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself where it is visible
    in Latin-1, else the next one from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in visible else next(others)) for b in range(256)]


def running_starts(sizes: Column, chunk: int = 256) -> Column:
    """Sum of all entries before each entry of ``array<int>``; ``[3, 1, 4]`` gives ``[0, 3, 4]``.

    In two levels (inside chunks, then over the totals of chunks), so that the work of building
    the arrays stays near linear for very long inputs.
    """
    def prefix(values: Column, first: Column) -> Column:
        out = F.aggregate(
            values, F.struct(first.alias("at"), F.array().cast("array<bigint>").alias("out")),
            lambda acc, v: F.struct((acc["at"] + v).alias("at"),
                                    F.concat(acc["out"], F.array(acc["at"])).alias("out")))
        return out["out"]

    sizes = sizes.cast("array<bigint>")
    blocks = F.sequence(F.lit(0), F.floor(F.size(sizes) / F.lit(chunk)).cast("int"))
    cut = F.transform(blocks, lambda b: F.slice(sizes, b * chunk + 1, chunk))
    totals = F.transform(cut, lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda a, v: a + v))
    starts = prefix(totals, F.lit(0).cast("bigint"))
    return F.flatten(F.zip_with(cut, starts, prefix))


def range_of(at: Column, cuts: list, kind: str) -> Column:
    """How many of the sorted ``cuts`` are not above a value, in two steps of about the root of their number."""
    if not cuts:
        return F.lit(0)
    step = max(32, math.isqrt(len(cuts)))

    def literal(values: list) -> Column:
        return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")

    block = F.size(F.filter(literal(cuts[::step]), lambda c: c <= at))
    fine = F.filter(F.slice(literal(cuts), (block - 1) * step + 1, step), lambda c: c <= at)
    return F.when(block > 0, (block - 1) * step + F.size(fine)).otherwise(0)
