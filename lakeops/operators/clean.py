"""Bronze to silver cleaning steps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.columns import uncastable
from lakeops.operators.ordering import latest_per_key


CASES = {"title": F.initcap, "lower": F.lower, "upper": F.upper}


@dataclass(frozen=True)
class Feed:
    """What the rows of a feed become: ``texts`` are trimmed and brought to a case, ``types`` cast (a value
    that does not fit fails the load), rows without a ``required`` value go, and of a key's rows the one
    that is first under ``newest`` stays."""

    key: tuple[str, ...]
    newest: tuple[str, ...]
    required: tuple[str, ...]
    texts: Mapping[str, str]
    types: Mapping[str, str]


CUSTOMER_FEED = Feed(
    key=("customer_id",), newest=("-signup_date",), required=("email", "customer_id"),
    texts={"country": "upper", "email": "lower", "name": "title"},
    types={"signup_date": "date", "customer_id": "bigint"})


def tidy(df: DataFrame, feed: Feed) -> DataFrame:
    """One clean row per key. Rows that are equally new are told apart by all their values, so a re-run
    picks the same one."""
    def value(name: str) -> Column:
        col = F.col(f"`{name}`")
        if name in feed.texts:
            col = CASES[feed.texts[name]](F.trim(col))
        return col.cast(feed.types[name]).alias(name) if name in feed.types else col.alias(name)

    complete = reduce(and_, [F.col(f"`{c}`").isNotNull() for c in feed.required], F.lit(True))
    named = {c.lstrip("-") for c in (*feed.key, *feed.newest)}
    ties = [c for c in df.columns if c not in named]
    return latest_per_key(df.select(*map(value, df.columns)).where(complete), feed.key, [*feed.newest, *ties])


def uncastable_rows(df: DataFrame, col: str, type_name: str) -> DataFrame:
    """The rows whose ``col`` holds a value that is not a ``type_name``."""
    return df.where(uncastable(col, type_name))


def order_lines(orders: DataFrame, items: str = "items",
                carry: Sequence[str] = ()) -> DataFrame:
    """One row per element of the nested items; orders without items give no row."""
    cols = ["order_id", "customer_id", "order_ts", *carry]
    lines = orders.select(*cols, F.inline(items))
    return lines.withColumns({
        "line_total": F.col("quantity") * F.col("unit_price"),
        "order_date": F.col("order_ts").cast("date"),
    })


def load_typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the named columns; a value that does not fit fails the load."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def reject_null(df: DataFrame, cols: Sequence[str], what: str) -> DataFrame:
    """``df``, failing at run time on the first row with a NULL in ``cols``."""
    bad = F.lit(False)
    for c in cols:
        bad = bad | F.col(c).isNull()
    message = F.lit(f"{what}: NULL in {', '.join(cols)}")
    return df.where(F.when(bad, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
