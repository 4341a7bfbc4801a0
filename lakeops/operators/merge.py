"""MERGE semantics as a DataFrame transformation.

The target is only ever the left side of a left join: a small source is broadcast and the target
is not shuffled, and with a large source AQE can split hot target keys (it cannot in a full outer
join). Inserts are the source rows without a target key, found by an anti join on keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.operators.joins import key_match

AMBIGUOUS = "MERGE: several source rows match one target row"


@dataclass(frozen=True)
class Clause:
    """One WHEN clause; ``values`` of None means every column (``SET *`` / ``INSERT *``).

    Conditions and values are SQL text over the aliases ``t`` (target) and ``s`` (source).
    """

    kind: str
    action: str
    condition: str | None = None
    values: Mapping[str, str] | None = None

    def applies(self) -> Column:
        if self.condition is None:
            return F.lit(True)
        return F.coalesce(F.expr(self.condition), F.lit(False))


def matched_update(values: Mapping[str, str] | None = None,
                   condition: str | None = None) -> Clause:
    return Clause("matched", "update", condition, values)


def matched_delete(condition: str | None = None) -> Clause:
    return Clause("matched", "delete", condition)


def not_matched_insert(values: Mapping[str, str] | None = None,
                       condition: str | None = None) -> Clause:
    return Clause("not_matched", "insert", condition, values)


def by_source_update(values: Mapping[str, str], condition: str | None = None) -> Clause:
    return Clause("by_source", "update", condition, values)


def by_source_delete(condition: str | None = None) -> Clause:
    return Clause("by_source", "delete", condition)


def merge_into(target: DataFrame, source: DataFrame, on: Sequence[str | tuple[str, str]],
               clauses: Sequence[Clause], evolve: bool = False,
               null_safe: bool = False) -> DataFrame:
    """The target after the merge. ``on`` names key columns, or (target, source) pairs.

    Clauses of one kind are tried in order and the first whose condition is TRUE acts. A target
    row that matches several source rows fails the query, unless the only matched clause is an
    unconditional delete. ``evolve`` adds the source's new columns (NULL in untouched rows).
    """
    pairs = [(k, k) if isinstance(k, str) else tuple(k) for k in on]
    by_kind = {kind: [c for c in clauses if c.kind == kind]
               for kind in ("matched", "by_source", "not_matched")}
    _check_star(target, source, clauses, evolve)
    added = [c for c in source.columns if c not in target.columns] if evolve else []
    columns = [*target.columns, *added]
    types = {f.name: f.dataType for f in [*source.schema.fields, *target.schema.fields]}

    if by_kind["matched"] or by_kind["by_source"]:
        kept = _updated_target(target, source, pairs, by_kind, columns, types, null_safe)
    else:
        kept = target.select(*target.columns,
                             *[F.lit(None).cast(types[c]).alias(c) for c in added])
    if not by_kind["not_matched"]:
        return kept
    return kept.unionByName(
        _inserted(target, source, pairs, by_kind["not_matched"], columns, types, null_safe))


def _check_star(target: DataFrame, source: DataFrame, clauses: Sequence[Clause],
                evolve: bool) -> None:
    star = any(c.values is None and c.action != "delete" for c in clauses)
    missing = [c for c in target.columns if c not in source.columns]
    if star and missing and not evolve:
        raise ValueError(f"source lacks {missing}: name the values or use evolve=True")


def _chosen(clauses: Sequence[Clause], offset: int) -> Column | None:
    """Index of the first clause that applies, NULL when none does."""
    choice = None
    for i, clause in enumerate(clauses):
        hit = clause.applies()
        choice = F.when(hit, offset + i) if choice is None else choice.when(hit, offset + i)
    return F.lit(None).cast("int") if choice is None else choice


def _updated_target(target, source, pairs, by_kind, columns, types, null_safe) -> DataFrame:
    matched, by_source = by_kind["matched"], by_kind["by_source"]
    source_keys = [b for _, b in pairs]
    only_delete = len(matched) == 1 and matched[0].action == "delete" and matched[0].condition is None
    rows = source.withColumn("__found", F.lit(True))
    joined = target.alias("t").join(
        rows.alias("s"), key_match(target, rows, pairs, null_safe=null_safe), "left")
    is_match = F.col("s.__found").isNotNull()
    if matched and not only_delete:
        # Keys alone are counted (a hash aggregate); keys that occur twice are few, mostly none.
        twice = (source.groupBy(*source_keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1"))
        joined = joined.join(twice.alias("d"), reduce(
            lambda m, n: m & n, [F.col(f"t.{a}").eqNullSafe(F.col(f"d.{b}")) for a, b in pairs]), "left")
        several = is_match & F.col("d.__n").isNotNull()
        joined = joined.where(F.when(several, F.raise_error(F.lit(AMBIGUOUS)).cast("boolean"))
                              .otherwise(F.lit(True)))
    choice = (F.when(is_match, _chosen(matched, 0))
              .otherwise(_chosen(by_source, len(matched))))
    joined = joined.withColumn("__clause", choice)
    acting = [*matched, *by_source]
    deletes = [i for i, c in enumerate(acting) if c.action == "delete"]
    if deletes:
        joined = joined.where(F.col("__clause").isNull() | ~F.col("__clause").isin(deletes))

    out = []
    for name in columns:
        value = F.col(f"t.{name}") if name in target.columns else F.lit(None).cast(types[name])
        for i, clause in enumerate(acting):
            new = _update_value(clause, name, source)
            if new is not None:
                value = F.when(F.col("__clause") == i, new.cast(types[name])).otherwise(value)
        out.append(value.alias(name))
    return joined.select(*out)


def _update_value(clause: Clause, name: str, source: DataFrame) -> Column | None:
    if clause.action != "update":
        return None
    if clause.values is None:
        return F.col(f"s.{name}") if name in source.columns else None
    return F.expr(clause.values[name]) if name in clause.values else None


def _inserted(target, source, pairs, clauses, columns, types, null_safe) -> DataFrame:
    target_keys, source_keys = [a for a, _ in pairs], [b for _, b in pairs]
    # Reduce the target to the keys the source names before anything of it is shuffled.
    wanted, known = source.select(*source_keys).distinct(), target.select(*target_keys)
    present = known.alias("t").join(
        wanted.alias("s"), key_match(known, wanted, pairs, null_safe=null_safe), "left_semi")
    back = [(b, a) for a, b in pairs]
    new = source.alias("s").join(
        present.distinct().alias("t"),
        key_match(source, present, back, ("s", "t"), null_safe), "left_anti")
    new = new.withColumn("__clause", _chosen(clauses, 0)).where(F.col("__clause").isNotNull())
    out = []
    for name in columns:
        value = F.lit(None).cast(types[name])
        for i, clause in enumerate(clauses):
            if clause.values is None:
                col = F.col(f"s.{name}") if name in source.columns else None
            else:
                col = F.expr(clause.values[name]) if name in clause.values else None
            if col is not None:
                value = F.when(F.col("__clause") == i, col.cast(types[name])).otherwise(value)
        out.append(value.alias(name))
    return new.select(*out)


def update_where(df: DataFrame, condition: str, values: Mapping[str, str]) -> DataFrame:
    """UPDATE ... SET ... WHERE: rows whose condition is not TRUE stay as they are."""
    hit = F.coalesce(F.expr(condition), F.lit(False))
    new = {c: F.when(hit, F.expr(e).cast(df.schema[c].dataType)).otherwise(F.col(c))
           for c, e in values.items()}
    return df.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])


def delete_where(df: DataFrame, condition: str | None = None) -> DataFrame:
    """DELETE [WHERE]: rows whose condition is TRUE go; without one, all do."""
    if condition is None:
        return df.where(F.lit(False))
    return df.where(~F.coalesce(F.expr(condition), F.lit(False)))
