"""Questions asked of gold, whole loads, data quality, audit."""

from pyspark.sql import functions as F

from checks import report_sql as sql
from checks.registry import END, START, check
from checks.relational import ALL_DATES, CARDINALITY, CATEGORY_DIST, DROP_STATS, GAPS, NULL_COUNTS, describe_sql, share
from saleslake.functions.fixed_values import HIDDEN_CATEGORIES
from saleslake.operators import audit, quality, silver, star
from saleslake.plans import metrics, trends
from saleslake.sources import buckets

RANGE = f"date {sql.RANGE}"
LAST_12 = """BETWEEN greatest((SELECT max(full_date) FROM days) - 84, (SELECT min(full_date) FROM days))
    AND (SELECT max(full_date) FROM days)"""

# --- Questions -----------------------------------------------------------------


@check("q_filters", "SELECT min(full_date) AS min_date, max(full_date) AS max_date FROM days")
def q_filters(ctx):
    return metrics.filters(ctx.gold)


@check("q_weekly_metrics", f"SELECT * FROM weekly_growth WHERE {RANGE}")
def q_weekly_metrics(ctx):
    return metrics.weekly_metrics(ctx.gold, START, END)


@check("q_top_category", sql.top("product_category", "product_category", 10, hidden=True))
def q_top_category(ctx):
    return metrics.top_metrics(ctx.gold, START, END, "PRODUCT_CATEGORY", 10, HIDDEN_CATEGORIES)


@check("q_top_opstudy", sql.top("opstudy_label", "opstudy_label", 10))
def q_top_opstudy(ctx):
    return metrics.top_metrics(ctx.gold, START, END, "OPSTUDY_LABEL", 10)


@check("q_top_label", sql.top("pln_label", "pln_label", 10))
def q_top_label(ctx):
    return metrics.top_metrics(ctx.gold, START, END, "PLN_LABEL", 10)


@check("q_top_bu", sql.top("bu", "bu", 10, dates=LAST_12))
def q_top_bu(ctx):
    """The last twelve weeks, as the reports ask by default."""
    return metrics.top_metrics(ctx.gold, *metrics.last_weeks(ctx.gold, 12), "BU", 10)


@check("q_segment", sql.segment())
def q_segment(ctx):
    return metrics.segment_metrics(ctx.gold, START, END)


@check("q_promo", sql.promo())
def q_promo(ctx):
    return metrics.promo_metrics(ctx.gold, START, END)


@check("q_promo_lift", sql.lift())
def q_promo_lift(ctx):
    return metrics.promo_lift_metrics(ctx.gold, START, END)


@check("q_category_mix", sql.mix())
def q_category_mix(ctx):
    return metrics.category_mix_metrics(ctx.gold, START, END)


@check(
    "q_kpis",
    f"""SELECT coalesce(sum(current_sales), 0.0) AS total_sales,
    coalesce(arg_max(wow_pct_increase, date), 0.0) AS latest_wow_pct,
    coalesce(arg_max(yoy_pct_increase, date), 0.0) AS latest_yoy_pct FROM weekly_growth WHERE {RANGE}""",
)
def q_kpis(ctx):
    return trends.kpis(ctx.gold, START, END)


def rolled(unit: str, where: str = RANGE) -> str:
    return f"""SELECT CAST(date_trunc('{unit}', date) AS DATE) AS date, sum(current_sales) AS current_sales
    FROM weekly WHERE {where} GROUP BY 1"""


@check("q_sales_trend", rolled("month"))
def q_sales_trend(ctx):
    return trends.sales_trend(ctx.gold, "monthly", START, END)


@check("q_sales_trend_yearly", rolled("year", "TRUE"))
def q_sales_trend_yearly(ctx):
    return trends.sales_trend(ctx.gold, "yearly")


@check("q_sales_trend_weekly", "SELECT * FROM weekly")
def q_sales_trend_weekly(ctx):
    return trends.sales_trend(ctx.gold, "weekly")


@check("q_growth_trend", f"SELECT date, yoy_pct_increase FROM weekly_growth WHERE {RANGE}")
def q_growth_trend(ctx):
    return trends.growth_trend(ctx.gold, "yoy", START, END)


@check("q_growth_trend_wow", "SELECT date, wow_pct_increase FROM weekly_growth")
def q_growth_trend_wow(ctx):
    return trends.growth_trend(ctx.gold, "wow")


@check("q_category_mix_pct", share(sql.mix(), "PARTITION BY date"))
def q_category_mix_pct(ctx):
    return trends.category_mix_pct(ctx.gold, START, END)


YEARLY_PROMO = f"""SELECT CAST(date_trunc('year', date) AS DATE) AS date, promo, sum(actual) AS actual
    FROM ({sql.promo()}) p GROUP BY 1, 2"""


@check("q_promo_trend", share(YEARLY_PROMO, "PARTITION BY date"))
def q_promo_trend(ctx):
    return trends.promo_trend(ctx.gold, "yearly", True, START, END)


@check("q_promo_trend_volume", sql.promo(ALL_DATES))
def q_promo_trend_volume(ctx):
    return trends.promo_trend(ctx.gold, "weekly", False)


LIFT_SHOWN = f"SELECT * FROM ({sql.lift()}) l WHERE product_category NOT IN {sql.HIDDEN}"


@check("q_promo_lift_pct", share(LIFT_SHOWN, "PARTITION BY product_category"))
def q_promo_lift_pct(ctx):
    return trends.promo_lift(ctx.gold, True, START, END)


@check("q_promo_lift_volume", LIFT_SHOWN)
def q_promo_lift_volume(ctx):
    return trends.promo_lift(ctx.gold, False, START, END)


def as_report(name: str, inner: str, **columns: str) -> str:
    named = {"date": "NULL::DATE", "product_category": "NULL::VARCHAR", "promo": "NULL::VARCHAR", "segment": "NULL::VARCHAR"} | columns
    return f"SELECT '{name}' AS report, " + ", ".join(f"{c} AS {n}" for n, c in named.items()) + f", actual FROM ({inner}) r"


@check(
    "agg_grouping_sets",
    " UNION ALL ".join(
        [
            as_report("promo", sql.promo(), date="date", promo="promo"),
            as_report("promo_lift", sql.lift(), product_category="product_category", promo="promo"),
            as_report("category_mix", sql.mix(), date="date", product_category="product_category"),
            as_report("segment", sql.segment(), segment="seg"),
        ]
    ),
)
def agg_grouping_sets(ctx):
    """Four reports from one pass over the facts."""
    return metrics.report_sums(ctx.gold, START, END)


@check("join_star_buckets", sql.top("pln_label", "pln_label", 10))
def join_star_buckets(ctx):
    """The top labels from facts and products in buckets, those with many facts in parts."""
    database = "buckets_" + ctx.folder("x").rsplit("-", 1)[-1]
    buckets.write_buckets(ctx.spark, ctx.lake.base, database, buckets=8, part_rows=20)
    return metrics.top_metrics(buckets.read_buckets(ctx.spark, ctx.lake.base, database), START, END, "PLN_LABEL", 10)


@check("q_segment_share", share(sql.segment(), ""))
def q_segment_share(ctx):
    return trends.segment_share(ctx.gold, START, END)


# --- Loads ---------------------------------------------------------------------


@check("pipe_clean", "SELECT * FROM tagged")
def pipe_clean(ctx):
    return ctx.tagged


@check("pipe_silver", "SELECT * FROM silver")
def pipe_silver(ctx):
    return silver.to_silver(ctx.tagged)


@check("star_dim_date", "SELECT * FROM dim_date")
def star_dim_date(ctx):
    return star.dim_date(ctx.silver)


@check("star_dim_product", "SELECT * FROM dim_product")
def star_dim_product(ctx):
    return star.dim_product(ctx.silver)


@check("star_dim_segment", "SELECT * FROM dim_segment")
def star_dim_segment(ctx):
    return star.dim_segment(ctx.silver)


@check("star_fact_sales", "SELECT * FROM fact_sales")
def star_fact_sales(ctx):
    return star.fact_sales(ctx.silver)


@check("star_cal_dim_date", "SELECT *, date_key - 10000 AS same_week_last_year_key FROM days")
def star_cal_dim_date(ctx):
    return star.build_star(ctx.silver, "calendar").dates


@check(
    "star_cal_dim_product",
    """SELECT p.* REPLACE (coalesce(e.category, 'Other') AS broad_category)
    FROM dim_product p LEFT JOIN exact_rules e ON p.legacy_category_label = e.label""",
)
def star_cal_dim_product(ctx):
    return star.build_star(ctx.silver, "calendar").products


@check("star_cal_dim_segment", "SELECT * FROM dim_segment")
def star_cal_dim_segment(ctx):
    return star.build_star(ctx.silver, "calendar").segments


@check("star_cal_fact_sales", "SELECT * FROM fact_sales WHERE date_key IS NOT NULL")
def star_cal_fact_sales(ctx):
    return star.build_star(ctx.silver, "calendar").fact


@check("pipe_run", DROP_STATS)
def pipe_run(ctx):
    return ctx.lake.report.stats


# --- Data quality --------------------------------------------------------------


@check(
    "dq_parity_source",
    "SELECT count(*) AS source_rows, count(*) AS copy_rows, TRUE AS ok FROM raw_feed",
)
def dq_parity_source(ctx):
    return quality.source_parity(ctx.raw, ctx.lake.feed)


@check(
    "dq_parity_gold",
    """SELECT source_rows, gold_rows, gold_rows > 0 AND gold_rows <= source_rows AS ok
    FROM (SELECT (SELECT count(*) FROM raw_feed) AS source_rows, (SELECT count(*) FROM fact_sales) AS gold_rows) c""",
)
def dq_parity_gold(ctx):
    return quality.gold_parity(ctx.lake.feed, ctx.gold.fact)


@check(
    "dq_quarantine_report",
    "SELECT ERROR_REASON AS error_reason, count(*) AS row_count FROM tagged WHERE ERROR_REASON <> 'Valid' GROUP BY ERROR_REASON",
)
def dq_quarantine_report(ctx):
    return ctx.lake.report.reasons


# --- Audit ---------------------------------------------------------------------


def long(section: str, inner: str, columns: list[str], prefix: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, '{prefix}{c}' AS item, {c}::DOUBLE AS value FROM ({inner}) x" for c in columns
    )


FIGURES = ["row_count", "null_count", "mean", "std", "min", "p25", "p50", "p75", "max"]
DESCRIBED = " UNION ALL ".join(
    f"SELECT 'describe', column_name || '.{f}', {f}::DOUBLE FROM ({describe_sql('{}')}) x" for f in FIGURES
)
PROFILE = " UNION ALL ".join(
    [
        long("shape", "SELECT count(*) AS row_count, 17 AS column_count FROM flat", ["row_count", "column_count"]),
        f"SELECT 'nulls', column_name, null_count::DOUBLE FROM ({NULL_COUNTS}) n",
        """SELECT 'duplicates', 'duplicate_rows', coalesce(sum(n), 0)::DOUBLE
        FROM (SELECT f.*, count(*) AS n FROM flat f GROUP BY ALL HAVING count(*) > 1) g""",
        "SELECT 'anomalies', 'nonpositive_rows', count(*)::DOUBLE FROM flat WHERE actual <= 0",
        DESCRIBED,
        long(
            "cardinality",
            CARDINALITY,
            ["unique_plns", "unique_categories", "unique_opstudies", "unique_segments", "unique_bus"],
        ),
    ]
)


@check("audit_profile", f"SELECT section, item, round(value, 4) AS value FROM ({PROFILE}) p")
def audit_profile(ctx):
    return audit.profile(ctx.gold, ctx.folder("profile")).withColumn("value", F.round("value", 4))


@check("audit_categories", CATEGORY_DIST)
def audit_categories(ctx):
    return audit.category_distribution(ctx.gold)


@check(
    "audit_other_share",
    f"SELECT product_category, sales_pct FROM ({CATEGORY_DIST}) d WHERE product_category = 'Other'",
)
def audit_other_share(ctx):
    return audit.other_share(ctx.gold)


@check("audit_gaps", GAPS)
def audit_gaps(ctx):
    return audit.gaps(ctx.gold)


@check(
    "audit_gap_summary",
    f"""SELECT 'unique_dates' AS item, count(DISTINCT date) + max((date IS NULL)::INT) AS value FROM flat
    UNION ALL SELECT 'combinations_with_gaps', count(*) FROM ({GAPS}) g""",
)
def audit_gap_summary(ctx):
    return audit.gap_summary(ctx.gold)


RAW_TEXTS = ["WEEK", "PLN", "PLN_LABEL", "BU", "PRODUCT_CATEGORY_LABEL", "OPSTUDY_LABEL", "SEG", "PROMO"]
BEFORE = ", ".join(f"r.{c} AS raw_{c.lower()}" for c in RAW_TEXTS)


@check(
    "audit_showcase",
    f"""SELECT {BEFORE}, r.ACTUAL AS raw_actual, t.DATE, t.PLN, CAST(t.ACTUAL AS FLOAT) AS ACTUAL, t.SEG, t.PROMO,
      s.pln_label AS PLN_LABEL, s.business_unit AS BU, s.legacy_category_label AS PRODUCT_CATEGORY_LABEL,
      s.opstudy_label AS OPSTUDY_LABEL
    FROM (SELECT DISTINCT * FROM raw_feed WHERE PLN <> 'PLN' AND ACTUAL IS NOT NULL) r
    JOIN (SELECT DISTINCT v.WEEK, v.DATE, v.PLN, v.ACTUAL, v.SEG AS given_seg, v.PROMO AS given_promo,
        CASE WHEN v.SEG = 'na' THEN 'Unknown' ELSE v.SEG END AS SEG, coalesce(v.PROMO, 'N') AS PROMO FROM valid v) t
      ON r.WEEK IS NOT DISTINCT FROM t.WEEK AND CAST(r.PLN AS BIGINT) = t.PLN AND r.ACTUAL = t.ACTUAL
      AND replace(r.SEG, 'NoSegment-', '') = t.given_seg
      AND replace(replace(r.PROMO, '"', ''), ',,', '') IS NOT DISTINCT FROM t.given_promo
    JOIN dim_product s ON t.PLN = s.pln_id""",
)
def audit_showcase(ctx):
    return audit.showcase(ctx.raw).withColumn("raw_actual", F.col("raw_actual").cast("double"))
