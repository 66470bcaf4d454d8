"""The gold tables in the session catalog, and SQL over them."""

from pyspark.sql import DataFrame, SparkSession

from saleslake.sources.layers import GOLD_COLUMNS, GOLD_TABLES, MONTH, Gold, Layers

# --- Fixed values: report names of result columns, by their lower-case form ----
REPORT_NAMES = {
    "date": "DATE",
    "current_sales": "CURRENT_SALES",
    "prev_sales": "PREV_SALES",
    "prev_yoy_sales": "PREV_YOY_SALES",
    "wow_pct_increase": "WOW_PCT_INCREASE",
    "yoy_pct_increase": "YOY_PCT_INCREASE",
    "prev_week_sales": "PREV_WEEK_SALES",
    "promo_sales": "PROMO_SALES",
    "prev_year_sales": "PREV_YEAR_SALES",
    "period_wow_pct": "Period_WOW_PCT",
    "period_yoy_pct": "Period_YOY_PCT",
    "promo_penetration_pct": "Promo_Penetration_PCT",
    "seg": "SEG",
    "actual": "ACTUAL",
    "promo": "PROMO",
    "product_category": "PRODUCT_CATEGORY",
    "opstudy_label": "OPSTUDY_LABEL",
    "pln_label": "PLN_LABEL",
    "bu": "BU",
}


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def create_database(spark: SparkSession, base: str, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)} LOCATION {_literal(f'{base}/catalog')}")


def create_tables(spark: SparkSession, base: str, database: str) -> None:
    """External tables over the gold folders in use. A table that is there stays as it is, unless a
    later load has put another folder into use: then it is declared anew over that."""
    layers, name = Layers.of(spark, base), quoted(database)
    create_database(spark, base, database)
    for table in GOLD_TABLES:
        where, columns, months = layers.gold(table), GOLD_COLUMNS[table], ""
        if spark.catalog.tableExists(f"{name}.{table}"):
            if _location(spark, f"{name}.{table}").endswith(layers.folders[table]):
                continue
            spark.sql(f"DROP TABLE {name}.{table}")  # an external table: its files stay
        if table == "fact_sales":
            columns, months = f"{columns}, {MONTH} INT", f"PARTITIONED BY ({MONTH})"
        spark.sql(f"CREATE TABLE {name}.{table} ({columns}) USING PARQUET {months} LOCATION {_literal(where)}")
        if months:
            spark.sql(f"ALTER TABLE {name}.{table} RECOVER PARTITIONS")


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'")
    return rows.first()["data_type"].rstrip("/")


def analyze(spark: SparkSession, database: str) -> None:
    """Table and column statistics of the four tables, so that joins are planned by rows that
    remain and not by sizes of files. Of the facts only the keys that joins and filters use are
    read; their size comes with that pass."""
    name = quoted(database)
    for table in GOLD_TABLES:
        columns = "FOR COLUMNS date_key, pln_id, segment_id" if table == "fact_sales" else "FOR ALL COLUMNS"
        spark.sql(f"ANALYZE TABLE {name}.{table} COMPUTE STATISTICS {columns}")


def read_tables(spark: SparkSession, database: str) -> Gold:
    """The four tables by way of the catalog, with their statistics."""
    fact, *others = (spark.table(f"{quoted(database)}.{table}") for table in GOLD_TABLES)
    return Gold(fact.drop(MONTH), *others, fact)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_views(gold: Gold) -> None:
    for table, df in gold.tables().items():
        df.createOrReplaceTempView(table)


def run_sql(spark: SparkSession, text: str, **params) -> DataFrame:
    """SQL with named parameters (``:start``); values never become SQL text."""
    return spark.sql(text, args=params)


def report_names(df: DataFrame) -> DataFrame:
    """Result columns under the names used by the reports."""
    return df.withColumnsRenamed({c: REPORT_NAMES.get(c.lower(), c) for c in df.columns})
