"""The questions asked of the gold tables. Dates are Columns, dates or ISO text; a
missing bound leaves that side open, and the default is the full range."""

from pyspark.sql import DataFrame, functions as F

from saleslake.functions import dates, flags
from saleslake.functions.fixed_values import HIDDEN_CATEGORIES
from saleslake.operators import growth
from saleslake.sources.layers import Gold

GROUPS = {
    "PRODUCT_CATEGORY": "broad_category",
    "OPSTUDY_LABEL": "opstudy_label",
    "PLN_LABEL": "pln_label",
    "BU": "business_unit",
}


def filters(gold: Gold) -> DataFrame:
    """``(min_date, max_date)`` of the dates with facts."""
    keys = gold.fact.select("date_key").distinct()
    return growth.with_date(keys, gold).agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def chosen_range(gold: Gold, *picked) -> tuple:
    """Bounds as columns: nothing picked is the full range, one date is that date only. Every date
    in the date table has facts, so that table names the full range."""
    if len(picked) > 2:
        raise ValueError("a range has at most two dates")
    if picked:
        return dates.as_date(picked[0]), dates.as_date(picked[-1])
    return gold.dates.agg(F.min("full_date")).scalar(), gold.dates.agg(F.max("full_date")).scalar()


def last_weeks(gold: Gold, weeks: int, end=None) -> tuple:
    """Bounds of the last ``weeks`` weeks as columns, for any of the questions below."""
    first, last = chosen_range(gold)
    last = dates.as_date(end) if end is not None else last
    return dates.lookback_start(last, weeks, first), last


def weekly_metrics(gold: Gold, start=None, end=None) -> DataFrame:
    """Sales per week with growth over the week and the year before. The range is
    applied after the lags, so its first week has a previous value; facts after the
    end, or before the longest lag of the start, are never read."""
    since = growth.weeks_back(gold, start) if start is not None else None
    weeks = growth.weekly_growth(growth.weekly_sales(gold, until=end, since_key=since))
    return growth.between_dates(weeks, start, end).orderBy("date")


def top_metrics(gold: Gold, start, end, group: str, n: int = 10, exclude=None) -> DataFrame:
    """The n groups with most sales, smallest first, with growth and promotion share."""
    if group not in GROUPS:
        raise ValueError(f"group must be one of {sorted(GROUPS)}, not {group!r}")
    if n < 1:
        raise ValueError("n must be at least 1")
    weekly = growth.weekly_group_sales(gold, GROUPS[group], exclude, until=end)
    lagged = growth.between_dates(growth.lagged_groups(weekly), start, end)
    ranked = growth.top_n(growth.period_growth(growth.period_sums(lagged)), n)
    return ranked.orderBy("current_sales", F.desc("grp")).withColumnRenamed("grp", group.lower())


def segment_metrics(gold: Gold, start=None, end=None) -> DataFrame:
    """``(seg, actual)``"""
    dated = growth.in_range(gold, start, end).groupBy("date_key", "segment_id")
    sums = dated.agg(growth.sales().alias("actual")).join(gold.dates.select("date_key"), "date_key")
    by_segment = sums.groupBy("segment_id").agg(F.sum("actual").alias("actual"))
    return by_segment.join(gold.segments, "segment_id").select(F.col("segment_id").alias("seg"), "actual")


def promo_metrics(gold: Gold, start=None, end=None) -> DataFrame:
    """``(date, promo, actual)``"""
    sums = (
        growth.in_range(gold, start, end)
        .groupBy("date_key", "is_promo")
        .agg(growth.sales().alias("actual"))
    )
    return (
        growth.with_date(sums, gold)
        .groupBy("date", "is_promo")
        .agg(F.sum("actual").alias("actual"))
        .select("date", flags.promo_label(F.col("is_promo")).alias("promo"), "actual")
        .orderBy("date")
    )


def _by_category(gold: Gold, start, end, keys: list[str], excluded=None) -> DataFrame:
    """Sums by date, broad category and further fact columns."""
    sums = (
        growth.with_product(growth.in_range(gold, start, end), gold, "broad_category", "product_category", excluded)
        .groupBy("date_key", "product_category", *keys)
        .agg(growth.sales().alias("actual"))
    )
    return growth.with_date(sums, gold)


def promo_lift_metrics(gold: Gold, start=None, end=None) -> DataFrame:
    """``(product_category, promo, actual)``"""
    sums = _by_category(gold, start, end, ["is_promo"])
    return (
        sums.groupBy("product_category", "is_promo")
        .agg(F.sum("actual").alias("actual"))
        .select("product_category", flags.promo_label(F.col("is_promo")).alias("promo"), "actual")
    )


def category_mix_metrics(gold: Gold, start=None, end=None) -> DataFrame:
    """``(date, product_category, actual)`` without the catch-all categories."""
    sums = _by_category(gold, start, end, [], HIDDEN_CATEGORIES)
    return sums.groupBy("date", "product_category").agg(F.sum("actual").alias("actual")).orderBy("date")


#: The reports that ``report_sums`` gives, with the columns each is summed by.
REPORTS = {
    "promo": ["date", "promo"],
    "promo_lift": ["product_category", "promo"],
    "category_mix": ["date", "product_category"],
    "segment": ["segment"],
}
#: What tells, within a report, whether its own join would have found the row.
CONDITIONS = {"promo_lift": ["listed"], "category_mix": ["listed"], "segment": ["known"]}


def report_sums(gold: Gold, start=None, end=None) -> DataFrame:
    """``(report, date, product_category, promo, segment, actual)``: sales by promotion, promotion
    lift, category mix and segment sales from one pass over the facts.

    Facts are summed by all four columns first, before any shuffle; the grouping sets then work on
    those sums. A column that a report is not summed by is null in its rows. A product, a date or a
    segment that is in no table counts where its own question would count it."""
    categories = gold.products.select("pln_id", F.col("broad_category").alias("product_category"), F.lit(True).alias("listed"))
    facts = growth.in_range(gold, start, end).join(categories, "pln_id", "left")
    sums = facts.groupBy("date_key", "product_category", "listed", "is_promo", "segment_id").agg(growth.sales().alias("actual"))
    known = gold.segments.select("segment_id", F.lit(True).alias("known"))
    cells = growth.with_date(sums, gold).join(known, "segment_id", "left").withColumnRenamed("segment_id", "segment")
    # The flag itself is what a report is summed by; its label comes last.
    cells = cells.withColumnRenamed("is_promo", "promo")
    sets = {name: [*columns, *CONDITIONS.get(name, [])] for name, columns in REPORTS.items()}
    columns = ["date", "product_category", "promo", "segment", "listed", "known"]
    grouped = cells.groupingSets([list(map(F.col, s)) for s in sets.values()], *columns).agg(
        F.sum("actual").alias("actual"), F.grouping_id().alias("set")
    )
    # Bits of the columns that a set leaves out, the first column highest.
    left_out = {name: sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in s) for name, s in sets.items()}
    named = grouped.withColumn("report", F.coalesce(*[F.when(F.col("set") == bits, name) for name, bits in left_out.items()]))
    report = F.col("report")
    hidden = F.col("product_category").isin(HIDDEN_CATEGORIES)
    counts = (
        (report == "promo")
        | ((report == "promo_lift") & F.col("listed"))
        | ((report == "category_mix") & F.col("listed") & ~hidden)
        | ((report == "segment") & F.col("known"))
    )
    label = F.when(report.isin("promo", "promo_lift"), flags.promo_label(F.col("promo"))).alias("promo")
    return named.filter(counts).select("report", "date", "product_category", label, "segment", "actual")
