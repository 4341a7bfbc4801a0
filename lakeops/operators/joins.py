"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_match(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]],
              aliases: tuple[str, str] = ("t", "s"), null_safe: bool = False) -> Column:
    """Join condition of two aliased frames on (left, right) key columns.

    Equality of the key hashes is part of it. It changes no result, but a side that was grouped
    by the key before cannot offer its partitioning to the join: Spark shuffles both sides for
    it, and AQE, which only splits partitions that come straight from a shuffle, can split the
    hot keys of the other side. The price is one more shuffle of the grouped side.
    """
    a, b = aliases
    tests, same_type = [], True
    for x, y in pairs:
        p, q = F.col(f"{a}.{x}"), F.col(f"{b}.{y}")
        tests.append(p.eqNullSafe(q) if null_safe else p == q)
        same_type &= left.schema[x].dataType == right.schema[y].dataType
    if same_type:  # equal values of different types have different hashes
        tests.append(F.xxhash64(*[F.col(f"{a}.{x}") for x, _ in pairs])
                     == F.xxhash64(*[F.col(f"{b}.{y}") for _, y in pairs]))
    return reduce(lambda m, n: m & n, tests)


def salted_join(big: DataFrame, small: DataFrame, on: Sequence[str], buckets: int = 16,
                row_key: Sequence[str] | None = None, how: str = "inner") -> DataFrame:
    """Equi-join that spreads every key of ``big`` over ``buckets`` partitions.

    The salt is a hash of the row (or of ``row_key``), so a task that runs again sends each row
    to the same place, which a random salt does not. ``small`` is repeated once per bucket.
    Identical copies of one row share a salt; AQE still splits that partition by map output.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("rows of the repeated side would appear once per bucket")
    row = [F.col(c) for c in (row_key or big.columns)]
    left = big.withColumn("__salt", F.pmod(F.xxhash64(*row), F.lit(buckets)).cast("int"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)))
    right = small.withColumn("__salt", salts)
    return left.join(right, [*on, "__salt"], how).drop("__salt")


def plan_bytes(df: DataFrame) -> int:
    """The planner's size estimate of ``df``."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_join(big: DataFrame, small: DataFrame, on, how: str = "inner",
                   max_bytes: int = 32 << 20) -> DataFrame:
    """Join with a broadcast hint on ``small``, given only while its estimate is below
    ``max_bytes``; beyond that Spark and AQE choose (sort-merge, with skew splitting)."""
    if plan_bytes(small) <= max_bytes:
        small = small.hint("broadcast")
    return big.join(small, on, how)


def full_outer(facts: DataFrame, dim: DataFrame, facts_key: str, dim_key: str) -> DataFrame:
    """FULL OUTER JOIN with both key columns kept, for a skewed ``facts`` side.

    AQE cannot split a hot key of a full outer join. A left join plus the unmatched rows of
    ``dim`` gives the same rows, lets a small ``dim`` be broadcast and hot keys be split.
    """
    matched = facts.join(dim, facts[facts_key] == dim[dim_key], "left")
    ordered = facts.select(F.col(facts_key).alias("__k")).distinct()
    lonely = dim.join(ordered, dim[dim_key] == ordered["__k"], "left_anti")
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in facts.schema.fields]
    return matched.unionByName(lonely.select(*empty, *dim.columns))
