"""Expectations, their metrics, and audits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

Rules = Mapping[str, tuple[str, str]]


def _holds(condition: str) -> Column:
    """A NULL result counts as a violation."""
    return F.coalesce(F.expr(condition), F.lit(False))


def enforce(df: DataFrame, rules: Rules) -> DataFrame:
    """Apply ``{name: (condition, "warn" | "drop" | "fail")}`` to the output columns.

    ``fail`` raises inside the plan on the first violating row; ``warn`` keeps the row.
    """
    unknown = {a for _, a in rules.values()} - {"warn", "drop", "fail"}
    if unknown:
        raise ValueError(f"unknown action {unknown}")
    for name, (condition, action) in rules.items():
        if action == "fail":
            message = F.lit(f"expectation {name} violated: {condition}")
            df = df.where(F.when(_holds(condition), F.lit(True))
                          .otherwise(F.raise_error(message).cast("boolean")))
    for condition, action in rules.values():
        if action == "drop":
            df = df.where(_holds(condition))
    return df


def _counts(rules: Rules) -> list[Column]:
    out = [F.count(F.lit(1)).alias("__rows")]
    return out + [F.count_if(_holds(c)).alias(name) for name, (c, _) in rules.items()]


def expectation_metrics(df: DataFrame, rules: Rules, dataset: str) -> DataFrame:
    """Rows (dataset, constraint, action, passed, failed), from one pass over ``df``."""
    rows = [F.struct(F.lit(dataset).alias("dataset"), F.lit(name).alias("constraint"),
                     F.lit(action).alias("action"), F.col(name).alias("passed"),
                     (F.col("__rows") - F.col(name)).alias("failed"))
            for name, (_, action) in rules.items()]
    return df.agg(*_counts(rules)).select(F.inline(F.array(*rows)))


def expect(df: DataFrame, rules: Rules, dataset: str = "dataset") -> tuple[DataFrame, DataFrame]:
    """The rows that stay, and the metrics as a second DataFrame."""
    return enforce(df, rules), expectation_metrics(df, rules, dataset)


def expect_observed(df: DataFrame, rules: Rules) -> tuple[DataFrame, Observation]:
    """As :func:`expect`, with counts gathered while the kept rows are written (no extra pass)."""
    seen = Observation()
    return enforce(df.observe(seen, *_counts(rules)), rules), seen


def violations(df: DataFrame, name: str, condition: str) -> DataFrame:
    """One row: how many rows satisfy the violation ``condition``."""
    return df.where(F.expr(condition)).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(name).alias("check"), "n")


def is_empty(df: DataFrame, name: str) -> DataFrame:
    """One row: 1 when the dataset has no rows; reads a single row at most."""
    return df.limit(1).agg((F.lit(1) - F.count(F.lit(1))).alias("n")).select(
        F.lit(name).alias("check"), "n")


def audit(checks: Sequence[DataFrame], on_violation: str = "rows") -> DataFrame:
    """Checks with a positive count; ``on_violation="raise"`` fails the query instead."""
    found = reduce(DataFrame.unionByName, checks).where("n > 0").select(
        "check", F.col("n").alias("violation_count"))
    if on_violation == "rows":
        return found
    message = F.concat(F.lit("audit failed: "), F.col("check"), F.lit(" ("),
                       F.col("violation_count").cast("string"), F.lit(" rows)"))
    return found.where(F.raise_error(message).cast("boolean"))
