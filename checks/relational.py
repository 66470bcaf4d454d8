"""Filters, joins, aggregates, windows, sorts."""

from pyspark.sql import functions as F

from checks import report_sql as sql
from checks.registry import END, START, check
from checks.sources_and_functions import rule_tables
from saleslake.functions import flags
from saleslake.functions.fixed_values import HIDDEN_CATEGORIES
from saleslake.operators import audit, classify, cleaning, growth, quality, silver, star
from saleslake.plans import metrics, trends

ALL_DATES = "IS NOT NULL"


def col(name: str):
    return F.col(name)


# --- Filters -------------------------------------------------------------------


@check("flt_quarantine", "SELECT * FROM tagged WHERE ERROR_REASON <> 'Valid'")
def flt_quarantine(ctx):
    return cleaning.quarantine_rows(ctx.tagged)


@check("flt_valid", "SELECT * FROM valid")
def flt_valid(ctx):
    return cleaning.valid_rows(ctx.tagged)


@check(
    "flt_dates",
    f"""SELECT f.* FROM fact_sales f JOIN dim_date d ON f.date_key = d.date_key
    WHERE d.full_date BETWEEN DATE '{START}' AND DATE '{END}'""",
)
def flt_dates(ctx):
    return growth.in_range(ctx.gold, START, END)


@check(
    "flt_dates_after_lag",
    f"SELECT date, current_sales, prev_sales FROM weekly_lagged WHERE date BETWEEN DATE '{START}' AND DATE '{END}'",
)
def flt_dates_after_lag(ctx):
    weekly = growth.weekly_sales(ctx.gold, until=END)
    return growth.between_dates(weekly.withColumn("prev_sales", growth.lag_rows(1)), START, END)


@check("flt_not_in", f"SELECT * FROM dim_product WHERE broad_category NOT IN {sql.HIDDEN}")
def flt_not_in(ctx):
    return growth.not_in(ctx.gold.products, "broad_category", HIDDEN_CATEGORIES)


@check(
    "flt_drop_nulls",
    """SELECT 'date' AS dimension, CAST(DATE AS VARCHAR) AS member FROM silver WHERE DATE IS NOT NULL GROUP BY ALL
    UNION ALL SELECT 'segment', SEG FROM silver WHERE SEG IS NOT NULL GROUP BY ALL
    UNION ALL SELECT 'product', CAST(PLN AS VARCHAR) FROM silver WHERE PLN IS NOT NULL GROUP BY ALL""",
)
def flt_drop_nulls(ctx):
    """The members of the three dimensions, from silver rows of which some have gaps."""

    def members(name, df, column):
        return df.select(F.lit(name).alias("dimension"), col(column).cast("string").alias("member"))

    days = members("date", star.dim_date(ctx.silver), "full_date")
    segments = members("segment", star.dim_segment(ctx.silver), "segment_id")
    return days.unionAll(segments).unionAll(members("product", star.dim_product(ctx.silver), "pln_id"))


@check("flt_nonpositive", "SELECT * FROM fact_sales WHERE actual_sales <= 0")
def flt_nonpositive(ctx):
    return audit.nonpositive(ctx.gold.fact)


@check(
    "flt_category",
    "SELECT legacy_category_label, sum(actual) AS total_sales FROM flat WHERE product_category = 'Other' GROUP BY ALL",
)
def flt_category(ctx):
    return audit.top_unmapped(ctx.gold, 1_000_000)


@check(
    "flt_latest",
    """SELECT wow_pct_increase AS latest_wow_pct, yoy_pct_increase AS latest_yoy_pct FROM weekly_growth
    WHERE date = (SELECT max(date) FROM weekly_growth)""",
)
def flt_latest(ctx):
    return trends.kpis(ctx.gold).drop("total_sales")


# --- Joins ---------------------------------------------------------------------


@check(
    "join_heal",
    """SELECT a.WEEK, a.DATE, a.PLN, a.ACTUAL, a.SEG, a.PROMO, g.PLN_LABEL, g.BU, g.PRODUCT_CATEGORY_LABEL, g.OPSTUDY_LABEL
    FROM aliased a LEFT JOIN golden g ON a.PLN = g.PLN""",
)
def join_heal(ctx):
    return silver.heal(ctx.aliased, ctx.golden)


@check("join_category", "SELECT * FROM dim_product")
def join_category(ctx):
    products = ctx.gold.products.drop("broad_category")
    labels = products.select(col("legacy_category_label").alias("label"))
    found = classify.classify_labels(labels, *rule_tables(ctx.spark))
    return classify.map_category(products, found.withColumnRenamed("label", "legacy_category_label"))


@check("join_fact_date", "SELECT * FROM fact_sales WHERE date_key IS NOT NULL")
def join_fact_date(ctx):
    return star.join_fact_date(ctx.silver, ctx.gold.dates)


@check("join_star_date", "SELECT date, pln AS pln_id, seg AS segment_id, is_promo, actual AS actual_sales FROM flat WHERE date IS NOT NULL")
def join_star_date(ctx):
    return growth.with_date(ctx.gold.fact, ctx.gold)


@check("join_star_product", sql.cells("product_category"))
def join_star_product(ctx):
    return growth.weekly_group_sales(ctx.gold, "broad_category")


@check("join_star_segment", sql.segment(ALL_DATES))
def join_star_segment(ctx):
    return metrics.segment_metrics(ctx.gold)


@check("join_flat", "SELECT * FROM flat")
def join_flat(ctx):
    return audit.join_flat(ctx.gold)


# --- Aggregates and distinct ---------------------------------------------------


@check("dst_rows", "SELECT * FROM deduped")
def dst_rows(ctx):
    return silver.drop_copies(ctx.valid)


PRODUCT_TUPLES = "pln_id, pln_label, legacy_category_label, opstudy_label, business_unit"


@check("dst_subset", f"SELECT {PRODUCT_TUPLES} FROM dim_product")
def dst_subset(ctx):
    return star.one_per_product(star.product_rows(ctx.silver))


@check("dst_product_rows", f"SELECT DISTINCT {PRODUCT_TUPLES} FROM dim_product")
def dst_product_rows(ctx):
    return star.product_rows(ctx.silver)


@check(
    "dst_values",
    """SELECT 'DATE' AS column_name, CAST(full_date AS VARCHAR) AS value FROM days
    UNION ALL SELECT 'SEG', SEG FROM silver WHERE SEG IS NOT NULL GROUP BY ALL
    UNION ALL SELECT 'PRODUCT_CATEGORY_LABEL', label FROM category_map""",
)
def dst_values(ctx):
    """The distinct values that the load takes from silver: dates, segments, labels."""
    labels = classify.classify_labels(
        ctx.silver.select(col("PRODUCT_CATEGORY_LABEL").alias("label")), *rule_tables(ctx.spark)
    )
    parts = [
        ("DATE", star.dim_date(ctx.silver), "full_date"),
        ("SEG", star.dim_segment(ctx.silver), "segment_id"),
        ("PRODUCT_CATEGORY_LABEL", labels, "label"),
    ]
    named = [df.select(F.lit(n).alias("column_name"), col(c).cast("string").alias("value")) for n, df, c in parts]
    return named[0].unionAll(named[1]).unionAll(named[2])


@check("agg_golden", "SELECT * FROM golden")
def agg_golden(ctx):
    return silver.golden_records(ctx.valid)


@check("agg_reason", "SELECT ERROR_REASON AS error_reason, count(*) AS row_count FROM tagged GROUP BY ERROR_REASON")
def agg_reason(ctx):
    return quality.reason_counts(ctx.tagged).orderBy(F.desc("row_count"))


DROP_STATS = """SELECT total_rows, quarantined_rows, silver_rows,
    total_rows - quarantined_rows - silver_rows AS duplicate_rows
  FROM (SELECT (SELECT count(*) FROM tagged) AS total_rows,
    (SELECT count(*) FROM tagged WHERE ERROR_REASON <> 'Valid') AS quarantined_rows,
    (SELECT count(*) FROM silver) AS silver_rows) s"""


@check("agg_drop_stats", DROP_STATS)
def agg_drop_stats(ctx):
    return quality.drop_stats(ctx.tagged, ctx.silver)


@check("agg_sum_week", "SELECT * FROM weekly")
def agg_sum_week(ctx):
    return growth.weekly_sales(ctx.gold)


@check(
    "agg_sum_week_group",
    f"SELECT date, grp, current_sales FROM ({sql.cells('bu')}) w",
)
def agg_sum_week_group(ctx):
    return growth.weekly_group_sales(ctx.gold, "business_unit").drop("promo_sales")


@check("agg_cond_sum", f"SELECT date, grp, promo_sales FROM ({sql.cells('opstudy_label')}) w")
def agg_cond_sum(ctx):
    return growth.weekly_group_sales(ctx.gold, "opstudy_label").drop("current_sales")


@check("agg_resum", sql.groups("product_category"))
def agg_resum(ctx):
    lagged = growth.lagged_groups(growth.weekly_group_sales(ctx.gold, "broad_category", until=END))
    return growth.period_sums(growth.between_dates(lagged, START, END))


@check(
    "agg_minmax_date",
    """SELECT min(d.full_date) AS min_date, max(d.full_date) AS max_date
    FROM dim_date d JOIN fact_sales f ON d.date_key = f.date_key""",
)
def agg_minmax_date(ctx):
    return metrics.filters(ctx.gold)


@check("agg_group2", sql.promo(ALL_DATES))
def agg_group2(ctx):
    return metrics.promo_metrics(ctx.gold)


@check(
    "agg_rollup_period",
    f"""SELECT CAST(date_trunc('year', date) AS DATE) AS date, promo, sum(actual) AS actual
    FROM ({sql.promo(ALL_DATES)}) p GROUP BY 1, 2""",
)
def agg_rollup_period(ctx):
    return growth.rollup_period(metrics.promo_metrics(ctx.gold), "yearly", "actual", "promo")


@check(
    "agg_total",
    f"SELECT coalesce(sum(current_sales), 0.0) AS total_sales FROM weekly WHERE date BETWEEN DATE '{START}' AND DATE '{END}'",
)
def agg_total(ctx):
    return trends.kpis(ctx.gold, START, END).select("total_sales")


FLAT_COLUMNS = [
    "date_key", "pln", "seg", "is_promo", "actual", "date", "year", "month", "week_of_year",
    "same_week_last_year_date", "same_week_last_year_key", "pln_label", "legacy_category_label",
    "opstudy_label", "bu", "product_category", "promo",
]
NULL_COUNTS = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM flat" for c in FLAT_COLUMNS
)


@check("agg_null_count", NULL_COUNTS)
def agg_null_count(ctx):
    return audit.null_counts(ctx.gold)


@check(
    "agg_dup_rows",
    """SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows
    FROM (SELECT count(*) AS n FROM raw_feed GROUP BY ALL HAVING count(*) > 1) g""".replace(
        "SELECT count(*) AS n FROM raw_feed GROUP BY ALL",
        "SELECT WEEK, PLN, PLN_LABEL, BU, PRODUCT_CATEGORY_LABEL, OPSTUDY_LABEL, ACTUAL, SEG, PROMO, count(*) AS n "
        "FROM raw_feed GROUP BY ALL",
    ),
)
def agg_dup_rows(ctx):
    return audit.duplicate_rows(ctx.raw)


@check(
    "agg_dup_rows_flat",
    """SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows
    FROM (SELECT f.*, count(*) AS n FROM flat f GROUP BY ALL HAVING count(*) > 1) g""",
)
def agg_dup_rows_flat(ctx):
    return audit.duplicate_rows(ctx.gold.fact)


NUMERIC = ["date_key", "pln", "actual", "year", "month", "week_of_year", "same_week_last_year_key"]


def describe_sql(shown: str = "round({}, 4)") -> str:
    def quartile(column: str, q: float) -> str:
        rank = f"round((count({column}) - 1) * {q}::DOUBLE)"
        return f"list_sort(list({column}::DOUBLE) FILTER (WHERE {column} IS NOT NULL))[CAST({rank} AS BIGINT) + 1]"

    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS row_count, count(*) - count({c}) AS null_count,
        {shown.format(f"avg({c}::DOUBLE)")} AS mean, {shown.format(f"stddev_samp({c}::DOUBLE)")} AS std,
        min({c})::DOUBLE AS min, {quartile(c, 0.25)} AS p25, {quartile(c, 0.5)} AS p50, {quartile(c, 0.75)} AS p75,
        max({c})::DOUBLE AS max FROM flat"""
        for c in NUMERIC
    )


@check("agg_describe", describe_sql())
def agg_describe(ctx):
    return audit.describe(ctx.gold, ctx.folder("describe")).withColumns({c: F.round(c, 4) for c in ("mean", "std")})


CARDINALITY = """SELECT count(DISTINCT pln) + max((pln IS NULL)::INT) AS unique_plns,
    count(DISTINCT product_category) + max((product_category IS NULL)::INT) AS unique_categories,
    count(DISTINCT opstudy_label) + max((opstudy_label IS NULL)::INT) AS unique_opstudies,
    count(DISTINCT seg) + max((seg IS NULL)::INT) AS unique_segments,
    count(DISTINCT bu) + max((bu IS NULL)::INT) AS unique_bus FROM flat"""


@check("agg_nunique", CARDINALITY)
def agg_nunique(ctx):
    return audit.cardinality(ctx.gold)


@check("agg_shape", "SELECT count(*) AS row_count, CAST(17 AS BIGINT) AS column_count FROM flat")
def agg_shape(ctx):
    return audit.shape(ctx.gold)


CATEGORY_DIST = """SELECT product_category, count(*) AS row_count, sum(actual) AS total_sales,
    sum(actual) / sum(sum(actual)) OVER () * 100 AS sales_pct FROM flat GROUP BY product_category"""


@check("agg_category_dist", CATEGORY_DIST)
def agg_category_dist(ctx):
    return audit.category_distribution(ctx.gold)


# --- Windows -------------------------------------------------------------------


@check("win_lag1", "SELECT date, current_sales, prev_sales AS earlier FROM weekly_lagged")
def win_lag1(ctx):
    return growth.weekly_sales(ctx.gold).withColumn("earlier", growth.lag_rows(growth.WEEK_BACK))


@check("win_lag52", "SELECT date, current_sales, prev_yoy_sales AS earlier FROM weekly_lagged")
def win_lag52(ctx):
    return growth.weekly_sales(ctx.gold).withColumn("earlier", growth.lag_rows(growth.YEAR_BACK))


def group_lag(column: str, lag: str) -> str:
    return f"SELECT date, grp, current_sales, promo_sales, {lag} AS earlier FROM ({sql.cells_with_past(column)}) l"


@check("win_lag1_group", group_lag("bu", "prev_week_sales"))
def win_lag1_group(ctx):
    weekly = growth.weekly_group_sales(ctx.gold, "business_unit")
    return weekly.withColumn("earlier", growth.lag_rows(growth.WEEK_BACK, group="grp"))


@check("win_lag52_group", group_lag("pln_label", "prev_year_sales"))
def win_lag52_group(ctx):
    weekly = growth.weekly_group_sales(ctx.gold, "pln_label")
    return weekly.withColumn("earlier", growth.lag_rows(growth.YEAR_BACK, group="grp"))


def share(inner: str, partition: str) -> str:
    return f"SELECT *, actual / sum(actual) OVER ({partition}) * 100 AS pct FROM ({inner}) x"


@check("win_share_date", share(sql.promo(ALL_DATES), "PARTITION BY date"))
def win_share_date(ctx):
    return growth.share_within(metrics.promo_metrics(ctx.gold), "actual", "date")


@check("win_share_category", share(sql.lift(ALL_DATES), "PARTITION BY product_category"))
def win_share_category(ctx):
    return growth.share_within(metrics.promo_lift_metrics(ctx.gold), "actual", "product_category")


@check("win_share_total", share(sql.segment(ALL_DATES), ""))
def win_share_total(ctx):
    return growth.share_of_all(metrics.segment_metrics(ctx.gold), "actual")


# --- Sorts and limits ----------------------------------------------------------


@check(
    "srt_topn",
    """SELECT pln_id, sum(actual_sales) AS current_sales FROM fact_sales GROUP BY pln_id
    ORDER BY current_sales DESC, pln_id LIMIT 100""",
)
def srt_topn(ctx):
    sums = ctx.gold.fact.groupBy("pln_id").agg(growth.sales().alias("current_sales"))
    return growth.top_n(sums, 100, tie="pln_id")


@check("srt_date", "SELECT date, current_sales FROM weekly ORDER BY date")
def srt_date(ctx):
    return growth.weekly_sales(ctx.gold).orderBy("date")


@check("srt_sales_desc", f"SELECT * FROM ({sql.lift(ALL_DATES)}) l ORDER BY actual DESC")
def srt_sales_desc(ctx):
    return metrics.promo_lift_metrics(ctx.gold).orderBy(F.desc("actual"))


def top_in_other(label: str, n: int) -> str:
    return f"""SELECT {label}, sum(actual) AS total_sales FROM flat WHERE product_category = 'Other'
    GROUP BY {label} ORDER BY total_sales DESC, {label} LIMIT {n}"""


@check("top_unmapped", top_in_other("legacy_category_label", 30))
def top_unmapped(ctx):
    return audit.top_unmapped(ctx.gold)


@check("top_other_products", top_in_other("pln_label", 20))
def top_other_products(ctx):
    return audit.top_other_products(ctx.gold)


GAPS = """SELECT *, expected_weeks - weeks_present AS missing_weeks FROM (
    SELECT pln, seg, promo, count(DISTINCT date) + max((date IS NULL)::INT) AS weeks_present,
      min(date) AS first_seen, max(date) AS last_seen,
      CAST(trunc((max(date) - min(date)) / 7.0 + 1) AS BIGINT) AS expected_weeks
    FROM flat GROUP BY pln, seg, promo) g WHERE expected_weeks - weeks_present > 0"""


@check("flt_missing", GAPS)
def flt_missing(ctx):
    spans = audit.date_presence(ctx.gold)
    return spans.filter(col("missing_weeks") > 0)


@check("top_gaps", f"SELECT * FROM ({GAPS}) g ORDER BY missing_weeks DESC, pln, seg, promo LIMIT 5")
def top_gaps(ctx):
    return audit.top_gaps(ctx.gold)
