"""Column expressions shared by the cleaning steps and the queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The country codes of each sales region; any other code is OTHER.
REGION_COUNTRIES = {
    "EU": ("DE", "FR", "IT", "ES", "NL", "PL", "IE", "SE", "CZ", "AT", "BE", "DK", "FI"),
    "NA": ("US", "CA"),
    "APAC": ("JP", "CN", "IN", "SG", "AU", "KR"),
    "LATAM": ("BR", "MX", "AR", "CL", "CO"),
    "EMEA": ("AE", "SA", "EG", "ZA"),
}
# Fixed value: first letter and domain stay readable.
EMAIL_MASK = (r"(^.)(.*)(@.*$)", "$1***$3")


def as_column(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def money(col: str | Column) -> Column:
    """Two-decimal amount; decimal sums do not depend on the order of the rows."""
    return as_column(col).cast("decimal(18,2)")


def derive_region(country: str | Column) -> Column:
    """Sales region of a country code, trimmed and upper-cased first."""
    code = F.upper(F.trim(as_column(country)))
    region = F.lit("OTHER")
    for name, codes in REGION_COUNTRIES.items():
        region = F.when(code.isin(*codes), name).otherwise(region)
    return region


def mask_email(col: str | Column) -> Column:
    return F.regexp_replace(as_column(col), *EMAIL_MASK)


def first_letter_mask(col: str | Column) -> Column:
    """Mask for values without a domain: the first letter, then ``***``."""
    return F.regexp_replace(as_column(col), r"(?s)(^.).*", "$1***")


def uncastable(col: str | Column, type_name: str) -> Column:
    """TRUE where a non-NULL value does not parse as ``type_name``."""
    c = as_column(col)
    return c.isNotNull() & c.try_cast(type_name).isNull()
