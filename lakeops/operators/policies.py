"""Row filters and column masks as DataFrame transformations.

The caller's groups are an argument; they decide the predicate and the select list when the plan
is built, so a filtered or masked column costs one expression.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.columns import as_column, first_letter_mask, mask_email

# The region each team may read; admins read all, nobody else reads OTHER.
REGION_TEAMS = {"eu_team": "EU", "na_team": "NA", "apac_team": "APAC", "latam_team": "LATAM",
                "emea_team": "EMEA"}


@dataclass(frozen=True)
class RowRule:
    """Which values of a column each group may read."""

    column: str
    allowed: Mapping[str, str]
    admins: Collection[str] = ("admins",)


REGION_RULE = RowRule("region", REGION_TEAMS)


def apply_row_filter(df: DataFrame, groups: Collection[str], rule: RowRule = REGION_RULE) -> DataFrame:
    if set(groups) & set(rule.admins):
        return df
    visible = sorted({v for g, v in rule.allowed.items() if g in groups})
    return df.where(F.col(rule.column).isin(visible) if visible else F.lit(False))


def apply_mask(df: DataFrame, col: str, groups: Collection[str],
               readers: Collection[str] = ("pii_readers",),
               mask: Callable[[Column], Column] = mask_email) -> DataFrame:
    if set(groups) & set(readers):
        return df
    return df.withColumn(col, mask(as_column(col)))


@dataclass(frozen=True)
class MaskPolicy:
    """Mask every column that carries ``tag``, except for ``exempt`` groups."""

    tag: tuple[str, str]
    exempt: Collection[str]
    masks: Mapping[str, Callable[[Column], Column]]
    class_tag: str = "pii_class"


@dataclass(frozen=True)
class FilterPolicy:
    """Filter every table that carries ``tag`` on the column tagged ``column_tag``."""

    tag: tuple[str, str]
    column_tag: str
    allowed: Mapping[str, str]
    exempt: Collection[str]


MASK_PII = MaskPolicy(("pii", "true"), ("pii_readers",),
                      {"email": mask_email, "name": first_letter_mask})
HIDE_REGIONS = FilterPolicy(("domain", "customers"), "region_col", REGION_TEAMS, ("admins",))


def apply_policies(df: DataFrame, column_tags: Mapping[str, Mapping[str, str]],
                   table_tags: Mapping[str, str], groups: Collection[str],
                   policies: Collection[MaskPolicy | FilterPolicy] = (MASK_PII, HIDE_REGIONS),
                   ) -> DataFrame:
    """Apply all policies that match the tags. Filters see the unmasked values."""
    matching = [p for p in policies if not set(groups) & set(p.exempt)]
    for policy in matching:
        if isinstance(policy, FilterPolicy) and table_tags.get(policy.tag[0]) == policy.tag[1]:
            for col, tags in column_tags.items():
                if policy.column_tag in tags:
                    df = apply_row_filter(df, groups, RowRule(col, policy.allowed, ()))
    masked: dict[str, Column] = {}
    for policy in matching:
        if isinstance(policy, MaskPolicy):
            for col, tags in column_tags.items():
                if tags.get(policy.tag[0]) == policy.tag[1]:
                    mask = policy.masks.get(tags.get(policy.class_tag, ""), first_letter_mask)
                    masked[col] = mask(F.col(col))
    return df.withColumns(masked) if masked else df
