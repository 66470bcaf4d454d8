"""Weekly series: sums, lags by rows, re-sums.

Facts are summed by the few groups that are asked for, before any shuffle: where a
group hangs on the product, the facts first meet the one or two product columns they
need (Spark broadcasts these when they are small, and else splits a hot product), as
date and product together are nearly the grain of the facts.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from saleslake.functions import dates, ratios
from saleslake.sources.layers import MONTH, Gold, month_of

WEEK_BACK = 1
YEAR_BACK = 52


def sales() -> Column:
    """Sum of sales; FLOAT amounts are added up as DOUBLE."""
    return F.sum("actual_sales")


def promo_sales() -> Column:
    return F.sum(F.when(F.col("is_promo"), F.col("actual_sales")).otherwise(F.lit(0.0)))


def by_key(fact: DataFrame, low: Column | None = None, high: Column | None = None) -> DataFrame:
    """Facts whose date key lies between two keys, both included. The date key orders like the
    date, so the test sits on the fact itself and reaches the Parquet scan; where the facts lie in
    folders by month, the months of the keys choose the folders, also when a key is only known at
    run time."""
    key, month = F.col("date_key"), F.col(MONTH) if MONTH in fact.columns else None
    if low is not None:
        fact = fact.filter(key >= low if month is None else (key >= low) & (month >= month_of(low)))
    if high is not None:
        fact = fact.filter(key <= high if month is None else (key <= high) & (month <= month_of(high)))
    return fact.drop(MONTH)


def in_range(gold: Gold, start=None, end=None) -> DataFrame:
    """Facts from start to end, both included; an open range holds the undated ones, too."""
    low, high = (None if day is None else dates.date_key(dates.as_date(day)) for day in (start, end))
    return by_key(gold.fact if gold.by_month is None else gold.by_month, low, high)


def between_dates(rows: DataFrame, start=None, end=None, on: str = "date") -> DataFrame:
    if start is not None:
        rows = rows.filter(F.col(on) >= dates.as_date(start))
    if end is not None:
        rows = rows.filter(F.col(on) <= dates.as_date(end))
    return rows


def not_in(rows: DataFrame, column: str, excluded) -> DataFrame:
    """Drop the listed values. As in SQL, a null group goes too once a list is given."""
    return rows.filter(~F.col(column).isin(list(excluded))) if excluded else rows


def with_date(rows: DataFrame, gold: Gold) -> DataFrame:
    days = gold.dates.select("date_key", F.col("full_date").alias("date"))
    return rows.join(days, "date_key").drop("date_key")


def weeks_back(gold: Gold, start, weeks: int = YEAR_BACK) -> Column:
    """Date key of the earliest of the last ``weeks`` dates before ``start``, or of
    ``start``: every date in the date table has facts, so a lag needs no earlier ones."""
    day = dates.as_date(start)
    before = gold.dates.filter(F.col("full_date") < day).orderBy(F.desc("full_date")).limit(weeks)
    return F.coalesce(before.agg(F.min("date_key")).scalar(), dates.date_key(day))


def weekly_sales(gold: Gold, until=None, since_key: Column | None = None) -> DataFrame:
    """``(date, current_sales)``"""
    high = None if until is None else dates.date_key(dates.as_date(until))
    fact = by_key(gold.fact if gold.by_month is None else gold.by_month, since_key, high)
    weekly = fact.groupBy("date_key").agg(sales().alias("current_sales"))
    return with_date(weekly, gold).groupBy("date").agg(F.sum("current_sales").alias("current_sales"))


def with_product(fact: DataFrame, gold: Gold, attribute: str, alias: str, excluded=None) -> DataFrame:
    """Facts with an attribute of their product; those without a product are left out, as are the
    excluded values. Facts in buckets meet the products of the same buckets."""
    parted = gold.parted is not None and "part" in fact.columns
    products, keys = (gold.parted, ["pln_id", "part"]) if parted else (gold.products, ["pln_id"])
    return fact.join(not_in(products.select(*keys, F.col(attribute).alias(alias)), alias, excluded), keys)


def weekly_group_sales(gold: Gold, attribute: str, excluded=None, until=None) -> DataFrame:
    """``(date, grp, current_sales, promo_sales)`` by a product attribute."""
    weekly = (
        with_product(in_range(gold, end=until), gold, attribute, "grp", excluded)
        .groupBy("date_key", "grp")
        .agg(sales().alias("current_sales"), promo_sales().alias("promo_sales"))
    )
    return (
        with_date(weekly, gold)
        .groupBy("date", "grp")
        .agg(F.sum("current_sales").alias("current_sales"), F.sum("promo_sales").alias("promo_sales"))
    )


def lag_rows(offset: int, column: str = "current_sales", *, group: str | None = None) -> Column:
    """The value ``offset`` rows back among the dates that are there: a missing week
    is not counted. Meant for rows already summed to one per date (and group), so a
    window never holds more rows than there are dates."""
    window = Window.partitionBy(group).orderBy("date") if group else Window.orderBy("date")
    return F.lag(column, offset).over(window)


def weekly_growth(weekly: DataFrame) -> DataFrame:
    lagged = weekly.withColumns({"prev_sales": lag_rows(WEEK_BACK), "prev_yoy_sales": lag_rows(YEAR_BACK)})
    current = F.col("current_sales")
    return lagged.withColumns(
        {
            "wow_pct_increase": ratios.pct_change(current, F.col("prev_sales")),
            "yoy_pct_increase": ratios.pct_change(current, F.col("prev_yoy_sales")),
        }
    )


def lagged_groups(weekly: DataFrame) -> DataFrame:
    return weekly.withColumns(
        {
            "prev_week_sales": lag_rows(WEEK_BACK, group="grp"),
            "prev_year_sales": lag_rows(YEAR_BACK, group="grp"),
        }
    )


def period_sums(lagged: DataFrame) -> DataFrame:
    """Sums of the weekly values and of their lags; null lags are skipped."""
    sums = ["current_sales", "prev_week_sales", "promo_sales", "prev_year_sales"]
    return lagged.groupBy("grp").agg(*[F.sum(c).alias(c) for c in sums])


def period_growth(sums: DataFrame) -> DataFrame:
    """Percentages from the raw sums first, then missing sums as 0.0."""
    current = F.col("current_sales")
    return sums.select(
        "grp",
        "current_sales",
        *[ratios.zero_if_null(F.col(c)).alias(c) for c in ("prev_week_sales", "promo_sales", "prev_year_sales")],
        ratios.pct_change(current, F.col("prev_week_sales")).alias("period_wow_pct"),
        ratios.pct_change(current, F.col("prev_year_sales")).alias("period_yoy_pct"),
        ratios.part_pct(F.col("promo_sales"), current).alias("promo_penetration_pct"),
    )


def top_n(rows: DataFrame, n: int, by: str = "current_sales", tie: str = "grp") -> DataFrame:
    """The n greatest, on equal values in order of the tie column."""
    return rows.orderBy(F.desc(by), F.asc(tie)).limit(n)


def rollup_period(rows: DataFrame, grain: str, value: str, *keys: str) -> DataFrame:
    """Weekly values summed by month or year; weekly stays as it is."""
    period = rows.withColumn("date", dates.truncate(F.col("date"), grain))
    return period.groupBy("date", *keys).agg(F.sum(value).alias(value))


def share_within(rows: DataFrame, value: str, key: str) -> DataFrame:
    """Percent of the sum of the same key, over rows already summed by key and one
    more column of few values."""
    total = F.sum(value).over(Window.partitionBy(key))
    return rows.withColumn("pct", ratios.share_pct(F.col(value), total))


def share_of_all(rows: DataFrame, value: str) -> DataFrame:
    """Percent of the overall sum. The total is a scalar subquery, summed in parallel;
    no row is moved to one task for it."""
    total = rows.agg(F.sum(value)).scalar()
    return rows.withColumn("pct", ratios.share_pct(F.col(value), total))
