"""Sources, sinks, SQL surface, scalar functions."""

from pyspark.sql import functions as F

from checks.registry import END, START, check
from checks.rules import EXACT_ROWS, KEYWORD_ROWS, STUDY_ROWS
from saleslake.functions import dates, flags, ratios, taxonomy, text
from saleslake.operators import growth, silver, star
from saleslake.operators.cleaning import clean
from saleslake.operators.classify import classify_labels, map_category
from saleslake.plans import metrics
from saleslake.sources import catalog, feed, literals
from saleslake.sources.layers import MONTH, Layers


def rows():
    return F.count(F.lit(1)).alias("row_count")


def col(name: str):
    return F.col(name)


# --- Sources, sinks, SQL -------------------------------------------------------

# Lines of the feed are well formed; see src_raw_csv_ragged for others.
NO_LINE = "CAST(NULL AS VARCHAR) AS MALFORMED_LINE"
FEED_TEXTS = "PLN_LABEL, BU, PRODUCT_CATEGORY_LABEL, nullif(OPSTUDY_LABEL, '') AS OPSTUDY_LABEL, ACTUAL, SEG, PROMO"


@check("src_raw_csv", f"SELECT WEEK, PLN, {FEED_TEXTS}, {NO_LINE} FROM raw_feed")
def src_raw_csv(ctx):
    read = ctx.lake.feed
    return read.withColumn("ACTUAL", col("ACTUAL").try_cast("double")).withColumnRenamed("PROMO,,", "PROMO")


# Every 13th product line has a cell too many, every 17th of the others lacks its last one.
TEXTS = ["WEEK", "PLN", "PLN_LABEL", "BU", "PRODUCT_CATEGORY_LABEL", "OPSTUDY_LABEL", "ACTUAL", "SEG", "PROMO"]
RAGGED = "coalesce(try_cast(PLN AS BIGINT), 0)"
RAGGED_LINES = f"""SELECT *, concat_ws('|', {', '.join(f"coalesce(CAST({'CAST(floor(ACTUAL) AS BIGINT)' if c == 'ACTUAL' else c} AS {{text}}), '')" for c in TEXTS[:-1])}) AS begun,
  {RAGGED} % 13 = 1 AS surplus, {RAGGED} % 13 <> 1 AND {RAGGED} % 17 = 1 AS short FROM raw_feed"""


@check(
    "src_raw_csv_ragged",
    f"""SELECT tag AS error_reason, line AS malformed_line, count(*) AS row_count FROM (
      SELECT CASE WHEN surplus THEN begun || '|' || coalesce(PROMO, '') || '|more' WHEN short THEN begun END AS line,
        CASE WHEN surplus THEN 'Malformed Line' WHEN PLN = 'PLN' THEN 'Header Pollution'
          WHEN PLN IS NULL OR ACTUAL IS NULL THEN 'Missing Critical Keys' ELSE 'Valid' END AS tag
      FROM ({RAGGED_LINES.format(text='VARCHAR')}) r) t GROUP BY ALL""",
)
def src_raw_csv_ragged(ctx):
    """A feed with lines of another length, read and tagged: tags, and texts of such lines."""
    ctx.raw.createOrReplaceTempView("raw_feed")
    lines = catalog.run_sql(ctx.spark, RAGGED_LINES.format(text="STRING"))
    promo = F.coalesce("PROMO", F.lit(""))
    ended = F.when(col("surplus"), F.concat_ws("|", "begun", promo, F.lit("more"))).when(col("short"), col("begun"))
    folder = ctx.folder("ragged")
    feed.write_lines(lines.select(F.coalesce(ended, F.concat_ws("|", "begun", promo))), TEXTS, folder)
    tagged = clean(feed.read_feed(ctx.spark, folder))
    return tagged.groupBy(col("ERROR_REASON").alias("error_reason"), col(feed.LINE).alias("malformed_line")).agg(rows())


@check("src_header_fix", "SELECT PROMO, count(*) AS row_count FROM raw_feed GROUP BY PROMO")
def src_header_fix(ctx):
    return feed.fix_promo_header(ctx.lake.feed).groupBy("PROMO").agg(rows())


@check("src_row_count", "SELECT count(*) AS row_count FROM raw_feed")
def src_row_count(ctx):
    return feed.row_count(ctx.lake.feed)


@check("src_parquet", "SELECT * FROM fact_sales")
def src_parquet(ctx):
    return ctx.gold.fact


STUDIES = ", ".join(f"('{code}', '{name}')" for code, name in STUDY_ROWS)


@check(
    "src_literal",
    f"""SELECT l.code, l.name, count(*) AS row_count FROM (VALUES {STUDIES}, ('NO CODE', NULL)) l(code, name)
    LEFT JOIN tagged t ON t.OPSTUDY_LABEL = l.code GROUP BY ALL""",
)
def src_literal(ctx):
    """A table of literals, the study names, meets every tagged row. Rows are counted by label before
    they are dealt out, so that a label with very many is a few rows; a name that meets none stands
    for one row, as in any left join."""
    names = literals.table(ctx.spark, "code STRING, name STRING", [*STUDY_ROWS, ("NO CODE", None)])
    labels = ctx.tagged.groupBy("OPSTUDY_LABEL").agg(rows())
    met = names.join(labels, col("OPSTUDY_LABEL") == col("code"), "left")
    return met.groupBy("code", "name").agg(F.sum(F.coalesce("row_count", F.lit(1))).alias("row_count"))


@check(
    "src_literal_rules",
    """SELECT d.label, coalesce(e.category, 'Other') AS category FROM
      (SELECT DISTINCT legacy_category_label AS label FROM dim_product) d LEFT JOIN exact_rules e ON d.label = e.label""",
)
def src_literal_rules(ctx):
    """The listed labels as a table of literals: the rules of the calendar variant, joined in the plan."""
    exact = literals.table(ctx.spark, "label STRING, category STRING", EXACT_ROWS)
    labels = ctx.gold.products.select(col("legacy_category_label").alias("label")).distinct()
    return labels.join(exact, "label", "left").select("label", F.coalesce("category", F.lit("Other")).alias("category"))


QUARANTINED = f"""SELECT WEEK, PLN, PLN_LABEL, BU, PRODUCT_CATEGORY_LABEL, nullif(OPSTUDY_LABEL, '') AS OPSTUDY_LABEL,
  ACTUAL, SEG, PROMO, DATE, ERROR_REASON, {NO_LINE} FROM tagged WHERE ERROR_REASON <> 'Valid'"""


@check("sink_quarantine", QUARANTINED)
def sink_quarantine(ctx):
    return ctx.lake.quarantine


@check("sink_silver", "SELECT * FROM silver")
def sink_silver(ctx):
    return ctx.lake.silver


TYPED_FACTS = "SELECT *, 'int,bigint,string,boolean,float' AS types FROM fact_sales"


def typed(df):
    return df.withColumn("types", F.concat_ws(",", *[F.typeof(c) for c in df.columns]))


@check("sink_gold", TYPED_FACTS)
def sink_gold(ctx):
    """The facts as they lie in their folders by month, with the types found there."""
    return typed(ctx.spark.read.parquet(Layers.of(ctx.spark, ctx.lake.base).gold("fact_sales")).drop(MONTH))


@check("cat_register", TYPED_FACTS)
def cat_register(ctx):
    """The facts by way of the catalog, with the types declared there."""
    return typed(catalog.run_sql(ctx.spark, f"SELECT * FROM {registered(ctx)}.fact_sales").drop(MONTH))


@check(
    "cat_register_star",
    """SELECT p.broad_category, d.year, s.segment_id, count(*) AS row_count, sum(f.actual_sales) AS actual
    FROM fact_sales f JOIN dim_date d ON f.date_key = d.date_key JOIN dim_product p ON f.pln_id = p.pln_id
    JOIN dim_segment s ON f.segment_id = s.segment_id GROUP BY ALL""",
)
def cat_register_star(ctx):
    """All four tables by way of the catalog, joined by their statistics."""
    database = registered(ctx)
    catalog.analyze(ctx.spark, database)
    return catalog.run_sql(
        ctx.spark,
        f"""SELECT p.broad_category, d.year, s.segment_id, count(*) AS row_count, sum(f.actual_sales) AS actual
        FROM {database}.fact_sales f JOIN {database}.dim_date d ON f.date_key = d.date_key
        JOIN {database}.dim_product p ON f.pln_id = p.pln_id JOIN {database}.dim_segment s ON f.segment_id = s.segment_id
        GROUP BY p.broad_category, d.year, s.segment_id""",
    )


def registered(ctx):
    """The database of the lake, its tables declared."""
    database = "lake_" + ctx.lake.base.rsplit("-", 1)[-1]
    catalog.create_tables(ctx.spark, ctx.lake.base, database)
    return database


@check("sql_run", f"SELECT * FROM weekly WHERE date BETWEEN DATE '{START}' AND DATE '{END}'")
def sql_run(ctx):
    catalog.create_views(ctx.gold)
    query = """SELECT d.full_date AS date, sum(f.actual_sales) AS current_sales
        FROM fact_sales f JOIN dim_date d ON f.date_key = d.date_key
        WHERE d.full_date BETWEEN CAST(:start AS DATE) AND CAST(:end AS DATE) GROUP BY d.full_date"""
    return catalog.run_sql(ctx.spark, query, start=START, end=END)


@check(
    "sql_alias",
    """SELECT date AS "DATE", current_sales AS "CURRENT_SALES", prev_sales AS "PREV_SALES",
    prev_yoy_sales AS "PREV_YOY_SALES", wow_pct_increase AS "WOW_PCT_INCREASE",
    yoy_pct_increase AS "YOY_PCT_INCREASE" FROM weekly_growth""",
)
def sql_alias(ctx):
    return catalog.report_names(metrics.weekly_metrics(ctx.gold))


# --- Scalar functions over the whole feed, counted by input and output ----------


def mapped(df, value, result, name="result"):
    return df.select(value.alias("value"), result.alias(name)).groupBy("value", name).agg(rows())


@check(
    "fn_legacy_date",
    "SELECT WEEK AS value, DATE AS result, count(*) AS row_count FROM tagged GROUP BY WEEK, DATE",
)
def fn_legacy_date(ctx):
    return mapped(ctx.raw, col("WEEK"), dates.legacy_date(col("WEEK")))


@check(
    "fn_unquote",
    "SELECT PLN_LABEL AS value, replace(PLN_LABEL, '\"', '') AS result, count(*) AS row_count FROM raw_feed GROUP BY PLN_LABEL",
)
def fn_unquote(ctx):
    return mapped(ctx.raw, col("PLN_LABEL"), text.unquote(col("PLN_LABEL")))


@check(
    "fn_drop_commas",
    "SELECT PROMO AS value, replace(PROMO, ',,', '') AS result, count(*) AS row_count FROM raw_feed GROUP BY PROMO",
)
def fn_drop_commas(ctx):
    return mapped(ctx.raw, col("PROMO"), text.drop_commas(col("PROMO")))


@check(
    "fn_strip_prefix",
    "SELECT SEG AS value, replace(SEG, 'NoSegment-', '') AS result, count(*) AS row_count FROM raw_feed GROUP BY SEG",
)
def fn_strip_prefix(ctx):
    return mapped(ctx.raw, col("SEG"), text.drop_segment_prefix(col("SEG")))


@check(
    "fn_label_norm",
    """SELECT PLN_LABEL AS pln, PRODUCT_CATEGORY_LABEL AS category, OPSTUDY_LABEL AS opstudy, BU AS bu,
    count(*) AS row_count FROM tagged GROUP BY ALL""",
)
def fn_label_norm(ctx):
    names = {"pln": "PLN_LABEL", "category": "PRODUCT_CATEGORY_LABEL", "opstudy": "OPSTUDY_LABEL"}
    tidy = ctx.raw.select(*[text.tidy_label(col(c)).alias(n) for n, c in names.items()], col("BU").alias("bu"))
    return tidy.groupBy("pln", "category", "opstudy", "bu").agg(rows())


@check(
    "fn_null_alias",
    """SELECT WEEK, DATE, PLN, PLN_LABEL, BU, PRODUCT_CATEGORY_LABEL, OPSTUDY_LABEL, ACTUAL, SEG, PROMO FROM aliased""",
)
def fn_null_alias(ctx):
    return ctx.aliased


@check(
    "fn_polish",
    """SELECT t.OPSTUDY_LABEL AS value, coalesce(o.name, t.OPSTUDY_LABEL) AS result, count(*) AS row_count
    FROM tagged t LEFT JOIN opstudy_names o ON t.OPSTUDY_LABEL = o.code GROUP BY t.OPSTUDY_LABEL, o.name""",
)
def fn_polish(ctx):
    return mapped(ctx.tagged, col("OPSTUDY_LABEL"), text.readable_opstudy(col("OPSTUDY_LABEL")))


@check(
    "fn_impute",
    """SELECT coalesce(PROMO, 'N') AS promo, coalesce(SEG, 'Unknown') AS seg, coalesce(BU, 'Unknown') AS bu,
    coalesce(OPSTUDY_LABEL, 'Unknown') AS opstudy, coalesce(PRODUCT_CATEGORY_LABEL, 'Unknown') AS category,
    coalesce(PLN_LABEL, 'Unknown') AS label, count(*) AS row_count FROM aliased GROUP BY ALL""",
)
def fn_impute(ctx):
    names = {
        "PROMO": "promo",
        "SEG": "seg",
        "BU": "bu",
        "OPSTUDY_LABEL": "opstudy",
        "PRODUCT_CATEGORY_LABEL": "category",
        "PLN_LABEL": "label",
    }
    filled = silver.fill_gaps(ctx.aliased).select(*[col(c).alias(n) for c, n in names.items()])
    return filled.groupBy(*names.values()).agg(rows())


@check("fn_narrow", "SELECT * EXCLUDE (WEEK) REPLACE (CAST(ACTUAL AS FLOAT) AS ACTUAL) FROM valid")
def fn_narrow(ctx):
    return silver.narrow(ctx.valid)


@check("fn_drop_cols", "SELECT * FROM silver")
def fn_drop_cols(ctx):
    """What the load drops is gone: the columns of silver are those of the SQL."""
    return silver.to_silver(ctx.tagged, ctx.golden)


@check(
    "fn_error_tag",
    """SELECT PLN AS pln, ACTUAL IS NULL AS no_actual, ERROR_REASON AS reason, count(*) AS row_count
    FROM tagged GROUP BY ALL""",
)
def fn_error_tag(ctx):
    reason = flags.error_reason(col("PLN"), col("ACTUAL"))
    tags = ctx.raw.select(col("PLN").alias("pln"), col("ACTUAL").isNull().alias("no_actual"), reason.alias("reason"))
    return tags.groupBy("pln", "no_actual", "reason").agg(rows())


@check(
    "fn_date_key",
    """SELECT DATE AS value, CAST(strftime(DATE, '%Y%m%d') AS INTEGER) AS result, count(*) AS row_count
    FROM tagged GROUP BY DATE""",
)
def fn_date_key(ctx):
    return mapped(ctx.tagged, col("DATE"), dates.date_key(col("DATE")))


@check("fn_calendar", "SELECT full_date, year, month, week_of_year FROM days")
def fn_calendar(ctx):
    return star.dim_date(ctx.silver).select("full_date", "year", "month", "week_of_year")


@check("fn_last_year_364", "SELECT full_date, same_week_last_year_date, same_week_last_year_key FROM dim_date")
def fn_last_year_364(ctx):
    return star.dim_date(ctx.silver).select("full_date", "same_week_last_year_date", "same_week_last_year_key")


@check("fn_last_year_cal", "SELECT full_date, date_key - 10000 AS same_week_last_year_key FROM days")
def fn_last_year_cal(ctx):
    return star.dim_date(ctx.silver, "calendar").select("full_date", "same_week_last_year_key")


@check(
    "fn_promo_flag",
    "SELECT PROMO AS value, PROMO = 'Y' AS result, count(*) AS row_count FROM silver GROUP BY PROMO",
)
def fn_promo_flag(ctx):
    return mapped(ctx.silver, col("PROMO"), flags.is_promo(col("PROMO")))


@check(
    "fn_promo_label",
    """SELECT is_promo AS value, CASE WHEN is_promo THEN 'Y' ELSE 'N' END AS result, count(*) AS row_count
    FROM fact_sales GROUP BY is_promo""",
)
def fn_promo_label(ctx):
    return mapped(ctx.gold.fact, col("is_promo"), flags.promo_label(col("is_promo")))


@check(
    "fn_pct_change",
    """SELECT f.pln_id, f.seg_sales, p.promo_sales,
    CASE WHEN p.promo_sales IS NULL OR p.promo_sales = 0 THEN 0.0::DOUBLE
      ELSE (f.seg_sales - p.promo_sales) / p.promo_sales * 100.0::DOUBLE END AS pct
    FROM (SELECT pln_id, sum(actual_sales) AS seg_sales FROM fact_sales GROUP BY pln_id) f
    JOIN (SELECT pln_id, sum(CASE WHEN is_promo THEN actual_sales END) AS promo_sales FROM fact_sales GROUP BY pln_id) p
      ON f.pln_id = p.pln_id""",
)
def fn_pct_change(ctx):
    sums = ctx.gold.fact.groupBy("pln_id").agg(
        F.sum("actual_sales").alias("seg_sales"),
        F.sum(F.when(col("is_promo"), col("actual_sales"))).alias("promo_sales"),
    )
    return sums.withColumn("pct", ratios.pct_change(col("seg_sales"), col("promo_sales")))


@check(
    "fn_promo_pct",
    """SELECT pln_id, CASE WHEN total = 0 THEN 0.0::DOUBLE ELSE promo / total * 100.0::DOUBLE END AS pct FROM (
    SELECT pln_id, sum(actual_sales) AS total, sum(CASE WHEN is_promo THEN actual_sales ELSE 0 END) AS promo
    FROM fact_sales GROUP BY pln_id) s""",
)
def fn_promo_pct(ctx):
    sums = ctx.gold.fact.groupBy("pln_id").agg(growth.sales().alias("total"), growth.promo_sales().alias("promo"))
    return sums.select("pln_id", ratios.part_pct(col("promo"), col("total")).alias("pct"))


@check(
    "fn_coalesce0",
    """SELECT pln_id, date_key, coalesce(sum(CASE WHEN is_promo THEN actual_sales END), 0.0) AS promo_sales
    FROM fact_sales GROUP BY pln_id, date_key""",
)
def fn_coalesce0(ctx):
    promo = F.sum(F.when(col("is_promo"), col("actual_sales")))
    return ctx.gold.fact.groupBy("pln_id", "date_key").agg(ratios.zero_if_null(promo).alias("promo_sales"))


@check("fn_category", "SELECT label, category AS broad_category FROM category_map")
def fn_category(ctx):
    labels = ctx.silver.select(col("PRODUCT_CATEGORY_LABEL").alias("label")).distinct()
    return labels.withColumn("broad_category", taxonomy.broad_category(col("label")))


def rule_tables(spark):
    return (
        spark.createDataFrame(EXACT_ROWS, "label string, category string"),
        spark.createDataFrame(KEYWORD_ROWS, "priority int, category string, keyword string"),
    )


@check("fn_category_tables", "SELECT label, category AS broad_category FROM category_map")
def fn_category_tables(ctx):
    labels = ctx.silver.select(col("PRODUCT_CATEGORY_LABEL").alias("label"))
    return classify_labels(labels, *rule_tables(ctx.spark))


LISTED = """SELECT m.label, coalesce(e.category, 'Other') AS broad_category
  FROM category_map m LEFT JOIN exact_rules e ON m.label = e.label"""


@check("fn_category_exact", LISTED)
def fn_category_exact(ctx):
    labels = ctx.silver.select(col("PRODUCT_CATEGORY_LABEL").alias("label")).distinct()
    return labels.withColumn("broad_category", taxonomy.listed_category(col("label")))


@check(
    "fn_category_fill",
    """SELECT p.pln_id, p.legacy_category_label, coalesce(e.category, 'Other / Miscellaneous') AS broad_category
    FROM dim_product p LEFT JOIN exact_rules e ON p.legacy_category_label = e.label""",
)
def fn_category_fill(ctx):
    exact, _ = rule_tables(ctx.spark)
    listed = exact.withColumnsRenamed({"label": "legacy_category_label", "category": "broad_category"})
    return map_category(ctx.gold.products.select("pln_id", "legacy_category_label"), listed)


@check(
    "fn_share",
    """SELECT pln_id, sales, sales / sum(sales) OVER () * 100 AS pct
    FROM (SELECT pln_id, sum(actual_sales) AS sales FROM fact_sales GROUP BY pln_id) s""",
)
def fn_share(ctx):
    return growth.share_of_all(ctx.gold.fact.groupBy("pln_id").agg(growth.sales().alias("sales")), "sales")


def truncated(unit: str) -> str:
    return f"SELECT full_date, CAST(date_trunc('{unit}', full_date) AS DATE) AS period FROM days"


@check("fn_trunc_month", truncated("month"))
def fn_trunc_month(ctx):
    return ctx.gold.dates.select("full_date", dates.truncate(col("full_date"), "monthly").alias("period"))


@check("fn_trunc_year", truncated("year"))
def fn_trunc_year(ctx):
    return ctx.gold.dates.select("full_date", dates.truncate(col("full_date"), "yearly").alias("period"))


@check(
    "fn_weeks_between",
    """SELECT PLN AS pln, CAST(trunc((max(DATE) - min(DATE)) / 7.0 + 1) AS BIGINT) AS weeks FROM silver GROUP BY PLN""",
)
def fn_weeks_between(ctx):
    span = dates.weeks_between(F.min("DATE"), F.max("DATE"))
    return ctx.silver.groupBy(col("PLN").alias("pln")).agg(span.alias("weeks"))


@check(
    "fn_lookback",
    """SELECT full_date AS end_date, greatest(full_date - 84, (SELECT min(full_date) FROM days)) AS start_date FROM days""",
)
def fn_lookback(ctx):
    earliest = metrics.filters(ctx.gold).select("min_date").scalar()
    start = dates.lookback_start(col("full_date"), 12, earliest)
    return ctx.gold.dates.select(col("full_date").alias("end_date"), start.alias("start_date"))


@check(
    "fn_range_default",
    f"""SELECT 'all' AS choice, min(full_date) AS start_date, max(full_date) AS end_date FROM days
    UNION ALL SELECT 'one', DATE '{START}', DATE '{START}' UNION ALL SELECT 'two', DATE '{START}', DATE '{END}'""",
)
def fn_range_default(ctx):
    one = metrics.filters(ctx.gold)
    picks = {"all": (), "one": (START,), "two": (START, END)}
    frames = []
    for choice, picked in picks.items():
        start, end = metrics.chosen_range(ctx.gold, *picked)
        frames.append(one.select(F.lit(choice).alias("choice"), start.alias("start_date"), end.alias("end_date")))
    return frames[0].unionAll(frames[1]).unionAll(frames[2])
