"""Row tags and promotion flags."""

from pyspark.sql import Column, functions as F

from saleslake.functions import fixed_values as fixed


def error_reason(pln: Column, actual: Column, surplus: Column | None = None) -> Column:
    """Tag of a raw row. A line with more cells than columns comes first, as none of its cells can
    be trusted. The key is tested as text: a repeated header line carries the column name in its
    key cell. A key that is no number counts as missing."""
    return (
        F.when(F.lit(False) if surplus is None else surplus, fixed.MALFORMED)
        .when(pln == fixed.HEADER_CELL, fixed.HEADER_POLLUTION)
        .when(pln.try_cast("bigint").isNull() | actual.isNull(), fixed.MISSING_KEYS)
        .otherwise(fixed.VALID)
    )


def is_promo(promo: Column) -> Column:
    return promo == "Y"


def promo_label(flag: Column) -> Column:
    return F.when(flag, "Y").otherwise("N")
