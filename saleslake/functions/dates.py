"""Calendar expressions."""

import datetime

from pyspark.sql import Column, functions as F

from saleslake.functions.fixed_values import WEEK_OFFSET
from saleslake.functions.text import unquote

GRAINS = {"weekly": None, "monthly": "MM", "yearly": "YEAR"}


def legacy_date(week: Column) -> Column:
    """``1YYMMDD`` code, perhaps in quotes, to DATE; null when it is not a date."""
    code = F.try_add(unquote(week).try_cast("bigint"), F.lit(WEEK_OFFSET))
    digits = F.when(code.between(10000000, 99999999), code.cast("string"))
    iso = F.concat_ws("-", F.substring(digits, 1, 4), F.substring(digits, 5, 2), F.substring(digits, 7, 2))
    return iso.try_cast("date")


def date_key(d: Column) -> Column:
    return (F.year(d) * 10000 + F.month(d) * 100 + F.day(d)).cast("int")


def same_weekday_last_year(d: Column) -> Column:
    return F.date_sub(d, 364)


def same_day_last_year_key(key: Column) -> Column:
    """Calendar form: 29 February gives a key without a real date."""
    return (key - 10000).cast("int")


def truncate(d: Column, grain: str) -> Column:
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {sorted(GRAINS)}, not {grain!r}")
    unit = GRAINS[grain]
    return d if unit is None else F.trunc(d, unit)


def weeks_between(first: Column, last: Column) -> Column:
    """Weekly points from first to last, both counted; part weeks are cut."""
    return (F.date_diff(last, first) / 7 + 1).cast("bigint")


def as_date(value) -> Column:
    """A DATE column from a Column, a date or ISO text."""
    if isinstance(value, Column):
        return value.cast("date")
    if isinstance(value, str):
        value = datetime.date.fromisoformat(value)
    return F.lit(value)


def lookback_start(end: Column, weeks: int, earliest: Column) -> Column:
    """Start of the last ``weeks`` weeks, not before the first date there is."""
    if weeks < 1:
        raise ValueError("weeks must be at least 1")
    return F.greatest(F.date_sub(end, 7 * weeks), earliest)
