"""Silver rows to the star schema.

Two variants of the same four tables:

``same_day``   last year's key is the same weekday (364 days back); categories come
               from exact labels and keywords, and a product without label is
               unmapped; undated rows stay, with a null key.
``calendar``   last year's key is the same calendar day; categories come from exact
               labels only, and a product without label is Other; undated rows are
               left out.
"""

from pyspark.sql import DataFrame, functions as F

from saleslake.functions import dates, flags
from saleslake.functions.fixed_values import OTHER, UNMAPPED
from saleslake.functions.taxonomy import Taxonomy, broad_category, listed_category
from saleslake.operators.classify import RuleTables, classify_labels, map_category
from saleslake.sources.layers import Gold

# Category of a product without label, by variant.
NO_LABEL = {"same_day": UNMAPPED, "calendar": OTHER}
VARIANTS = tuple(NO_LABEL)

PRODUCT_COLUMNS = {
    "PLN": "pln_id",
    "PLN_LABEL": "pln_label",
    "PRODUCT_CATEGORY_LABEL": "legacy_category_label",
    "OPSTUDY_LABEL": "opstudy_label",
    "BU": "business_unit",
}


def dim_date(silver: DataFrame, variant: str = "same_day") -> DataFrame:
    days = silver.select(F.col("DATE").alias("full_date")).dropna().distinct()
    day = F.col("full_date")
    days = days.select(
        "full_date",
        dates.date_key(day).alias("date_key"),
        F.year(day).cast("int").alias("year"),
        F.month(day).cast("int").alias("month"),
        F.weekofyear(day).cast("int").alias("week_of_year"),
    )
    if variant == "calendar":
        return days.withColumn("same_week_last_year_key", dates.same_day_last_year_key(F.col("date_key")))
    last_year = dates.same_weekday_last_year(day)
    return days.withColumns(
        {"same_week_last_year_date": last_year, "same_week_last_year_key": dates.date_key(last_year)}
    )


def product_rows(silver: DataFrame) -> DataFrame:
    """Distinct product tuples: a hash aggregate that leaves one row per product and
    task before the shuffle."""
    return silver.select(*PRODUCT_COLUMNS).distinct().withColumnsRenamed(PRODUCT_COLUMNS)


def one_per_product(products: DataFrame) -> DataFrame:
    """One row per key. Healed attributes agree, so any would do; taking the greatest
    gives the same row again when a task is repeated."""
    rest = [c for c in products.columns if c != "pln_id"]
    return (
        products.dropna(subset=["pln_id"])
        .groupBy("pln_id")
        .agg(F.max(F.struct(*rest)).alias("p"))
        .select("pln_id", *[F.col(f"p.{c}").alias(c) for c in rest])
    )


def dim_product(
    silver: DataFrame, variant: str = "same_day", rules: Taxonomy | RuleTables | None = None
) -> DataFrame:
    products = product_rows(silver)
    label = F.col("legacy_category_label")
    if variant == "same_day":
        products = one_per_product(products)
    if isinstance(rules, RuleTables):
        keywords = rules.keywords if variant == "same_day" else rules.keywords.limit(0)
        labels = products.select(label.alias("label"))
        found = classify_labels(labels, rules.exact, keywords, as_listed=variant == "calendar")
        return map_category(products, found.withColumnRenamed("label", "legacy_category_label"), NO_LABEL[variant])
    category = listed_category(label, rules) if variant == "calendar" else broad_category(label, rules)
    return products.withColumn("broad_category", F.when(label.isNull(), NO_LABEL[variant]).otherwise(category))


def dim_segment(silver: DataFrame) -> DataFrame:
    return silver.select(F.col("SEG").alias("segment_id")).dropna().distinct()


def fact_rows(silver: DataFrame, date_key) -> DataFrame:
    return silver.select(
        date_key.alias("date_key"),
        F.col("PLN").alias("pln_id"),
        F.col("SEG").alias("segment_id"),
        flags.is_promo(F.col("PROMO")).alias("is_promo"),
        F.col("ACTUAL").cast("float").alias("actual_sales"),
    )


def fact_sales(silver: DataFrame, variant: str = "same_day") -> DataFrame:
    """One fact row per silver row. The calendar variant keeps the rows that find
    their date; every date of silver is in its date table, so a null test says the
    same as the join (``join_fact_date``) and needs no second table."""
    dated = silver.filter(F.col("DATE").isNotNull()) if variant == "calendar" else silver
    return fact_rows(dated, dates.date_key(F.col("DATE")))


def join_fact_date(silver: DataFrame, date_table: DataFrame) -> DataFrame:
    """Fact rows that find their date in a given date table."""
    found = silver.join(date_table.select("full_date", "date_key"), F.col("DATE") == F.col("full_date"))
    return fact_rows(found, F.col("date_key"))


def build_star(silver: DataFrame, variant: str = "same_day", rules: Taxonomy | RuleTables | None = None) -> Gold:
    if variant not in VARIANTS:
        raise ValueError(f"variant must be one of {VARIANTS}, not {variant!r}")
    return Gold(
        fact_sales(silver, variant),
        dim_date(silver, variant),
        dim_product(silver, variant, rules),
        dim_segment(silver),
    )
