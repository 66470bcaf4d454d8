"""Key figures, roll-ups and shares on top of the metrics; each is part of the same
plan, nothing passes through the driver."""

from pyspark.sql import DataFrame, functions as F

from saleslake.functions import ratios
from saleslake.functions.fixed_values import HIDDEN_CATEGORIES
from saleslake.operators import growth
from saleslake.plans import metrics
from saleslake.sources.layers import Gold

GROWTH_COLUMNS = {"wow": "wow_pct_increase", "yoy": "yoy_pct_increase"}


def kpis(gold: Gold, start=None, end=None) -> DataFrame:
    """Total sales and the growth of the last week; 0.0 for an empty range."""
    weeks = metrics.weekly_metrics(gold, start, end)
    return weeks.agg(
        ratios.zero_if_null(F.sum("current_sales")).alias("total_sales"),
        ratios.zero_if_null(F.max_by("wow_pct_increase", "date")).alias("latest_wow_pct"),
        ratios.zero_if_null(F.max_by("yoy_pct_increase", "date")).alias("latest_yoy_pct"),
    )


def sales_trend(gold: Gold, grain: str = "weekly", start=None, end=None) -> DataFrame:
    weekly = growth.between_dates(growth.weekly_sales(gold, until=end), start, end)
    return growth.rollup_period(weekly, grain, "current_sales").orderBy("date")


def growth_trend(gold: Gold, metric: str = "wow", start=None, end=None) -> DataFrame:
    if metric not in GROWTH_COLUMNS:
        raise ValueError(f"metric must be one of {sorted(GROWTH_COLUMNS)}, not {metric!r}")
    return metrics.weekly_metrics(gold, start, end).select("date", GROWTH_COLUMNS[metric]).orderBy("date")


def category_mix_pct(gold: Gold, start=None, end=None) -> DataFrame:
    mix = metrics.category_mix_metrics(gold, start, end)
    return growth.share_within(mix, "actual", "date").orderBy("date")


def promo_trend(gold: Gold, grain: str = "weekly", percent: bool = True, start=None, end=None) -> DataFrame:
    promo = growth.rollup_period(metrics.promo_metrics(gold, start, end), grain, "actual", "promo")
    return (growth.share_within(promo, "actual", "date") if percent else promo).orderBy("date")


def promo_lift(gold: Gold, percent: bool = True, start=None, end=None, excluded=HIDDEN_CATEGORIES) -> DataFrame:
    lift = growth.not_in(metrics.promo_lift_metrics(gold, start, end), "product_category", excluded)
    if percent:
        lift = growth.share_within(lift, "actual", "product_category")
    return lift.orderBy(F.desc("actual"))


def segment_share(gold: Gold, start=None, end=None) -> DataFrame:
    return growth.share_of_all(metrics.segment_metrics(gold, start, end), "actual")
