"""Order specifications, deterministic dedup and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def order_columns(order_by: Sequence[str]) -> list[Column]:
    """``["-ts", "id"]`` -> descending ts, ascending id (Spark's NULL placement)."""
    return [F.col(c[1:]).desc() if c.startswith("-") else F.col(c).asc() for c in order_by]


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the first under ``order_by``, which must be a total order.

    ``row_number() = 1`` lets Spark keep one row per key in every map task before the shuffle
    (WindowGroupLimit), so a hot key moves at most one row per task.
    """
    return top_k(df, keys, order_by, 1, rank_col="__rn").drop("__rn")


def top_k(df: DataFrame, by: Sequence[str], order_by: Sequence[str], k: int,
          rank_col: str = "rank") -> DataFrame:
    """The first ``k`` rows of every group, with their position."""
    w = Window.partitionBy(*by).orderBy(*order_columns(order_by))
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)

