"""Percentages with the zero rules of the reports."""

from pyspark.sql import Column, functions as F


def pct_change(current: Column, previous: Column) -> Column:
    """Growth in percent; 0.0 when there is nothing to compare with."""
    no_base = previous.isNull() | (previous == 0)
    return F.when(no_base, F.lit(0.0)).otherwise((current - previous) / previous * 100.0)


def part_pct(part: Column, whole: Column) -> Column:
    """Part of the whole in percent; 0.0 when the whole is 0."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole * 100.0)


def share_pct(value: Column, total: Column) -> Column:
    """Share in percent; null when the total is 0."""
    return value / F.nullif(total, F.lit(0.0)) * 100


def zero_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))
