"""Ordered window features that stay parallel when one group holds a large share of the rows.

A plain window puts every row of a group into one task. Here a group of more than ``ROWS`` rows is split into
ranges of its order, which windows treat as groups of their own; what the other ranges of the group
add (rows, sums and values before and after, neighbours) is one row per range and is joined to them. Ranges
follow from the values of a row alone, so every plan that reads the rows puts them in the same range, and
nothing but the columns that the features need is written on the way, for rows of split groups only.
Any orderable types and directions work. Groups that fit a task take Spark's window as it is.

``df`` is read several times (to count groups, to find borders, for the result): it must give the same rows
each time; :func:`lakeops.session.settle` it when it is expensive or random.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.operators.ordering import order_columns, top_k
from lakeops.session import settle

ROWS = 1 << 20          # rows of one group that a task may hold
MOST_RANGES = 100_000   # of all groups together: their borders are broadcast
SAMPLED = 64            # rows of each range that its border is chosen from


def _bare(order_by: Sequence[str]) -> list[str]:
    return [c.lstrip("-") for c in order_by]


def _turned(order_by: Sequence[str]) -> list[str]:
    """The opposite order, NULLs included."""
    return [c[1:] if c.startswith("-") else f"-{c}" for c in order_by]


def _group(keys: Sequence[str]) -> Column:
    return F.struct(F.lit(1).alias("one"), *[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)])


def _place_of(order_by: Sequence[str]) -> Column:
    return F.struct(*[F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(_bare(order_by))])


def _precedes(a: Column, b: Column, order_by: Sequence[str]) -> Column:
    """Whether place ``a`` stands before place ``b``, with Spark's places for NULL."""
    test = F.lit(False)
    for i, c in reversed(list(enumerate(order_by))):
        x, y = (b, a) if c.startswith("-") else (a, b)
        x, y = x[f"o{i}"], y[f"o{i}"]
        smaller = F.coalesce(x < y, x.isNull() & y.isNotNull())
        test = smaller | (x.eqNullSafe(y) & test)
    return test


def _borders(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], ranges: int | None) -> DataFrame | None:
    """(__g, __cuts): for every group to be split, the places where its ranges but the first begin."""
    sizes = df.groupBy(_group(keys).alias("__g")).agg(F.count(F.lit(1)).alias("size"))
    whole = sizes.agg(F.sum("size").alias("rows"), F.max("size").alias("most")).first()
    if not whole["rows"]:
        return None
    limit = math.ceil(whole["rows"] / ranges) if ranges else max(ROWS, math.ceil(whole["rows"] / MOST_RANGES))
    if whole["most"] <= limit:
        return None
    large = sizes.where(F.col("size") > limit).select("__g", F.ceil(F.col("size") / limit).alias("parts"))
    scale = 1 << 30
    drawn = F.pmod(F.xxhash64(*keys, *_bare(order_by), F.lit("border")), F.lit(scale)) < F.lit(min(scale, scale * SAMPLED // limit + 1))
    sample = (df.where(drawn).select(_group(keys).alias("__s"), _place_of(order_by).alias("__o"))
              .join(F.broadcast(large), F.col("__s").eqNullSafe(F.col("__g"))))
    places = [F.col(f"__o.o{i}") for i in range(len(order_by))]
    by = Window.partitionBy("__g").orderBy(*[p.desc() if c.startswith("-") else p.asc()
                                             for p, c in zip(places, order_by, strict=True)])
    part = F.floor((F.row_number().over(by) - 1) * F.col("parts") / F.count(F.lit(1)).over(Window.partitionBy("__g")))
    numbered = sample.select("__g", "__o", part.alias("part"))
    firsts = (numbered.withColumn("before", F.lag("part", 1, 0).over(
        Window.partitionBy("__g").orderBy("part"))).where("part > before"))
    cuts = firsts.groupBy("__g").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("part", "__o"))), lambda s: s["__o"]).alias("__cuts"))
    return settle(cuts, "borders")


def _numbered(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], cuts: DataFrame) -> DataFrame:
    """``df`` with ``__p``, the number of a row's range in its group, and ``__split``."""
    rows = df.withColumns({"__k": _group(keys), "__o": _place_of(order_by)})
    rows = rows.join(F.broadcast(cuts), F.col("__k").eqNullSafe(F.col("__g")), "left")
    # Two steps of about the root of the number of borders.
    n, step = F.size("__cuts"), 32

    def passed(candidates: Column) -> Column:
        return F.size(F.filter(candidates, lambda c: ~_precedes(F.col("__o"), c, order_by)))

    heads = F.filter("__cuts", lambda _, i: i % step == 0)
    block = passed(heads)
    fine = passed(F.slice("__cuts", (block - 1) * step + 1, F.lit(step)))
    number = F.when(n.isNull() | (n <= 0) | (block == 0), 0).otherwise((block - 1) * step + fine)
    return rows.withColumns({"__p": number, "__split": F.col("__g").isNotNull()}).drop("__g", "__cuts")


def in_ranges(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
              ranges: int | None = None) -> DataFrame:
    """``df`` with ``__p``, the number of a row's range in its group: 0 unless the group is split, which it is
    beyond ``ROWS`` rows, or beyond its share of ``ranges`` ranges of the whole table."""
    cuts = _borders(df, keys, order_by, ranges)
    if cuts is None:
        return df.withColumn("__p", F.lit(0))
    return _numbered(df, keys, order_by, cuts).drop("__k", "__o", "__split")


def _local(part: Sequence[str], order_by: Sequence[str], kind: str, args: Sequence[str]) -> Column:
    order = order_columns(order_by)
    seq, ties = Window.partitionBy(*part).orderBy(*order), Window.partitionBy(*part).orderBy(order[0])
    whole = Window.partitionBy(*part)
    build = {
        "row_number": lambda: F.row_number().over(seq).cast("bigint"),
        "rank": lambda: F.rank().over(ties).cast("bigint"),
        "dense_rank": lambda: F.dense_rank().over(ties).cast("bigint"),
        "count": lambda: F.count(F.lit(1)).over(whole),
        "running_sum": lambda c: F.sum(c).over(ties),
        "total": lambda c: F.sum(c).over(whole),
        "lag": lambda c: F.lag(c).over(seq),
        "lead": lambda c: F.lead(c).over(seq),
    }
    return build[kind](*args)


def _plus(a: Column, b: Column) -> Column:
    """The sum of what isn't NULL, as one aggregate over both would give it."""
    return F.when(b.isNull(), a).otherwise(F.coalesce(a, F.lit(0)) + b)


def ordered_features(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                     features: Mapping[str, tuple], ranges: int | None = None) -> DataFrame:
    """Add window columns over ``PARTITION BY keys ORDER BY order_by``.

    ``features`` maps a new column to one of ``("row_number",)``, ``("rank",)``, ``("dense_rank",)``,
    ``("count",)``, ``("running_sum", col)`` (the default RANGE frame on the leading order column:
    ties share a value), ``("total", col)``, ``("lag", col)`` or ``("lead", col)``. Ranks go by the
    leading order column alone. Row numbers and neighbours need a total order. ``ranges`` splits
    groups beyond their share of that many ranges, instead of those beyond ``ROWS`` rows.
    """
    lead = _bare(order_by)[0]
    finish = {"row_number": "int", "rank": "int", "dense_rank": "int"}
    kept = [F.col(f"`{c}`") for c in df.columns if c not in features]
    cuts = _borders(df, keys, order_by, ranges)
    if cuts is None:
        plain = {n: _local(keys, order_by, kind, args) for n, (kind, *args) in features.items()}
        return df.select(*kept, *[(c.cast(finish[features[n][0]]) if features[n][0] in finish else c).alias(n)
                                  for n, c in plain.items()])
    rows, part = _numbered(df, keys, order_by, cuts), [*keys, "__p"]
    columns = {n: _local(part, order_by, kind, args) for n, (kind, *args) in features.items()}
    columns |= {"__n": _local(part, order_by, "row_number", ()), "__size": _local(part, order_by, "count", ())}
    needed = [f"`{c}`" for c in dict.fromkeys([*_summed(features), *_near(features)])]
    split = settle(rows.where("__split").select(
        F.col("__p"), F.col("__k").alias("__c"), F.struct(F.col(f"`{lead}`").alias("__value")).alias("__v"),
        F.col("__o"), *[F.col(c).alias(f"__x{i}") for i, c in enumerate(needed)]), "split-groups")
    names = {c.strip("`"): f"__x{i}" for i, c in enumerate(needed)}
    # One row a range of a split group, of which there are MOST_RANGES at most.
    carry = F.broadcast(_carry(split, order_by, features, names))
    local = rows.withColumns(columns)
    joined = local.join(carry, F.col("__split") & (F.col("__p") == F.col("__cp")) & F.col("__k").eqNullSafe(F.col("__c")), "left")

    none, value = F.lit(0).cast("bigint"), F.col(f"`{lead}`")
    # Whether the row's leading value can also lie in an earlier, or in a later range.
    begun = F.col("__head").isNotNull() & value.eqNullSafe(F.col("__head.__value"))
    goes_on = F.col("__tail").isNotNull() & value.eqNullSafe(F.col("__tail.__value"))
    before = F.coalesce("__rows_before", none)
    merged: dict[str, Column] = {}
    for name, (kind, *args) in features.items():
        here = F.col(f"`{name}`")
        if kind == "row_number":
            merged[name] = (here + before).cast("int")
        elif kind == "rank":
            merged[name] = (here + before - F.coalesce(F.when(begun, F.col("__head.__count")), none)).cast("int")
        elif kind == "dense_rank":
            merged[name] = (here + F.coalesce("__values_before", none)).cast("int")
        elif kind == "count":
            merged[name] = here + F.coalesce("__rows_elsewhere", none)
        elif kind == "total":
            merged[name] = _plus(here, F.col(f"__elsewhere_{args[0]}"))
        elif kind == "running_sum":
            merged[name] = _plus(_plus(here, F.col(f"__before_{args[0]}")),
                                 F.when(goes_on, F.col(f"__tail.{args[0]}")))
        elif kind == "lag":
            merged[name] = F.when((F.col("__n") == 1) & F.col("__cp").isNotNull(),
                                  F.col(f"__c_prev.{args[0]}")).otherwise(here)
        else:
            merged[name] = F.when((F.col("__n") == F.col("__size")) & F.col("__cp").isNotNull(),
                                  F.col(f"__c_next.{args[0]}")).otherwise(here)
    return joined.select(*kept, *[c.alias(n) for n, c in merged.items()])


def _summed(features: Mapping[str, tuple]) -> list[str]:
    return sorted({a[1] for a in features.values() if a[0] in ("running_sum", "total")})


def _near(features: Mapping[str, tuple]) -> list[str]:
    return sorted({a[1] for a in features.values() if a[0] in ("lag", "lead")})


def _carry(split: DataFrame, order_by: Sequence[str], features: Mapping[str, tuple], names: Mapping[str, str]) -> DataFrame:
    """What a split group's other ranges add to its rows in one range: (__cp, __c) and the totals.

    ``split`` has the rows of split groups: range, group, leading value, place and the columns ``names``
    gives for those that features use.
    """
    summed, kinds = _summed(features), {a[0] for a in features.values()}
    near = [F.col(names[c]).alias(c) for c in _near(features)]
    dense = ["__values"] if "dense_rank" in kinds else []
    places = [f"{'-' if c.startswith('-') else ''}__o{i}" for i, c in enumerate(order_by)]
    flat = split.select("*", *[F.col(f"__o.o{i}").alias(f"__o{i}") for i in range(len(order_by))])
    first = top_k(flat, ["__p", "__c"], places, 1, "__rank").select(
        "__p", "__c", F.col("__v").alias("head"), F.struct(F.lit(1), *near).alias("first"))
    last = top_k(flat, ["__p", "__c"], _turned(places), 1, "__rank").select(
        F.col("__p").alias("tp"), F.col("__c").alias("tc"), F.col("__v").alias("tail"),
        F.struct(F.lit(1), *near).alias("last"))
    values = split.groupBy("__p", "__c", "__v").agg(
        F.count(F.lit(1)).alias("__count"), *[F.sum(names[c]).alias(c) for c in summed])
    sizes = (values.groupBy("__p", "__c").agg(
        F.sum("__count").alias("n"), *[F.count(F.lit(1)).alias("n_values") for _ in dense],
        *[F.sum(F.col(f"`{c}`")).alias(f"__sum_{c}") for c in summed]) if kinds & {"rank", "running_sum", "dense_rank"}
        else split.groupBy("__p", "__c").agg(
            F.count(F.lit(1)).alias("n"), *[F.sum(names[c]).alias(f"__sum_{c}") for c in summed]))
    ends = first.join(last, (F.col("__p") == F.col("tp")) & F.col("__c").eqNullSafe(F.col("tc"))).drop("tp", "tc")
    sizes = sizes.withColumnsRenamed({"__p": "sp", "__c": "sc"})
    ranges = ends.join(sizes, (F.col("__p") == F.col("sp")) & F.col("__c").eqNullSafe(F.col("sc"))).drop("sp", "sc")
    ranges = settle(ranges, "range-totals")

    by = Window.partitionBy("__c").orderBy("__p")
    past, whole = by.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("__c")
    known = F.when(F.col("head").eqNullSafe(F.lag("tail").over(by)) & (F.row_number().over(by) > 1), 1).otherwise(0)
    out = ranges.withColumn("known", known).select(
        F.col("__p").alias("__cp"), "__c", "head", "tail", F.sum("n").over(past).alias("__rows_before"),
        (F.sum("n").over(whole) - F.col("n")).alias("__rows_elsewhere"),
        *[(F.coalesce(F.sum(F.col("n_values") - F.col("known")).over(past), F.lit(0)) - F.col("known"))
          .alias("__values_before") for _ in dense],
        *[F.sum(f"__sum_{c}").over(past).alias(f"__before_{c}") for c in summed],
        *[_plus(F.sum(f"__sum_{c}").over(past), F.sum(f"__sum_{c}").over(
            by.rowsBetween(1, Window.unboundedFollowing))).alias(f"__elsewhere_{c}") for c in summed],
        F.lag("last").over(by).alias("__c_prev"), F.lead("first").over(by).alias("__c_next"))
    if not kinds & {"rank", "running_sum"}:
        return out.drop("head", "tail").withColumns({"__head": F.lit(None), "__tail": F.lit(None)})

    # Rows with the first or last leading value of their range: such a value can go on in others.
    edges = ranges.select(F.col("__p").alias("ep"), F.col("__c").alias("ec"), "head", "tail")
    values = (values.join(F.broadcast(edges), (F.col("__p") == F.col("ep")) & F.col("__c").eqNullSafe(F.col("ec")))
              .where(F.col("__v").eqNullSafe(F.col("head")) | F.col("__v").eqNullSafe(F.col("tail"))))
    along = Window.partitionBy("__c", "__v").orderBy("__p")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    later = along.rowsBetween(1, Window.unboundedFollowing)
    values = values.select(
        F.col("__p").alias("vp"), F.col("__c").alias("vc"), "__v",
        F.struct(F.col("__v.__value").alias("__value"), F.sum("__count").over(earlier).alias("__count")).alias("__head"),
        F.struct(F.col("__v.__value").alias("__value"), *[F.sum(c).over(later).alias(c) for c in summed]).alias("__tail"))

    head, tail = values.drop("__tail"), values.drop("__head")

    def meet(side: DataFrame, value: str) -> Column:
        return ((F.col("__cp") == side["vp"]) & F.col("__c").eqNullSafe(side["vc"])
                & F.col(value).eqNullSafe(side["__v"]))

    out = out.join(head, meet(head, "head"), "left").drop("vp", "vc", "__v")
    return out.join(tail, meet(tail, "tail"), "left").drop("vp", "vc", "__v", "head", "tail")


def rank_within(df: DataFrame, keys: Sequence[str], by: str, rank: str = "rnk",
                dense: str = "dense_rnk", percent: str = "pct", ranges: int | None = None) -> DataFrame:
    """``rank``, ``dense_rank`` and ``percent_rank`` of ``by`` (``"-x"`` = descending) per group.

    A hash of the row comes second in the order, so that a value with very many rows can lie in
    several ranges too.
    """
    spread = df.withColumn("__tie", F.xxhash64(*df.columns))
    ranked = ordered_features(spread, keys, [by, "__tie"], {
        rank: ("rank",), dense: ("dense_rank",), "__all": ("count",)}, ranges)
    share = F.when(F.col("__all") > 1, (F.col(f"`{rank}`") - 1) / (F.col("__all") - 1)).otherwise(F.lit(0.0))
    return ranked.select(*[F.col(f"`{c}`") for c in df.columns], rank, dense, share.alias(percent))


def top_k_any(df: DataFrame, by: Sequence[str], rankings: Mapping[str, Sequence[str]], k: int) -> DataFrame:
    """Rows within the first ``k`` of at least one ranking, with their position in all of them.

    ``rankings`` maps a rank column to a total order. The first ``k`` of every ranking are limited in
    the map tasks; these candidates are at most ``k`` times the rankings per group. Their place
    in a ranking is one more than the rows before them: each row finds the first of its group's
    candidates that it precedes, and is counted there. Every ranking reads ``df``;
    :func:`lakeops.session.settle` it first when it is expensive.
    """
    found = None
    for order_by in rankings.values():
        first = top_k(df, by, order_by, k, "__rank").drop("__rank")
        found = first if found is None else found.union(first)
    found = settle(found.distinct(), "candidates")
    out = found
    for name, order_by in rankings.items():
        out = _place(df, out, found, by, name, order_by)
    return out


def _place(df: DataFrame, out: DataFrame, found: DataFrame, by: Sequence[str], name: str,
           order_by: Sequence[str]) -> DataFrame:
    """``out`` with the position ``name`` of its rows among all rows of ``df`` in one ranking."""
    w = Window.partitionBy(*by).orderBy(*order_columns(order_by))
    group = F.struct(*[F.col(f"`{b}`") for b in by])
    # Candidates in their order; a group has no more of them than k times the rankings.
    places = found.select(group.alias("__g"), _place_of(order_by).alias("__o"), F.row_number().over(w).alias("__i"))
    lists = places.groupBy("__g").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("__i", "__o"))), lambda s: s["__o"]).alias("__list"))
    counted = (df.select(group.alias("__g"), _place_of(order_by).alias("__o")).join(lists, "__g")
               .select("__g", (F.size(F.filter("__list", lambda c: ~_precedes(F.col("__o"), c, order_by))) + 1).alias("__i"))
               .groupBy("__g", "__i").agg(F.count(F.lit(1)).alias("n")))
    running = Window.partitionBy("__g").orderBy("__i")
    placed = (places.join(counted, ["__g", "__i"], "left")
              .select("__g", "__o", (F.sum(F.coalesce("n", F.lit(0))).over(running) + 1).cast("int").alias(name)))
    ours = out.select("*", group.alias("__g2"), _place_of(order_by).alias("__o2"))
    return (ours.join(placed, F.col("__g2").eqNullSafe(F.col("__g")) & F.col("__o2").eqNullSafe(F.col("__o")))
            .drop("__g", "__o", "__g2", "__o2"))
