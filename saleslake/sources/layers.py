"""The Parquet layers under one base path: quarantine, silver and the gold tables."""

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from saleslake.sources.versions import in_use

# --- Fixed values: columns of the gold tables ----------------------------------
GOLD_COLUMNS = {
    "fact_sales": "date_key INT, pln_id BIGINT, segment_id STRING, is_promo BOOLEAN, actual_sales FLOAT",
    "dim_date": (
        "full_date DATE, date_key INT, year INT, month INT, week_of_year INT, same_week_last_year_key INT"
    ),
    "dim_product": (
        "pln_id BIGINT, pln_label STRING, legacy_category_label STRING, opstudy_label STRING, "
        "business_unit STRING, broad_category STRING"
    ),
    "dim_segment": "segment_id STRING",
}
GOLD_TABLES = tuple(GOLD_COLUMNS)


#: The facts lie in one folder per month of their date key; undated ones have a folder of their own.
MONTH = "month_key"


@dataclass(frozen=True)
class Layers:
    """Paths of the tables in use under one base, which is any URI Spark can reach."""

    base: str
    folders: Mapping[str, str]

    @classmethod
    def of(cls, spark: SparkSession, base: str) -> "Layers":
        return cls(base, in_use(spark, base).used)

    def path(self, table: str) -> str:
        if table not in self.folders:
            raise FileNotFoundError(f"no load under {self.base} has written {table}")
        return f"{self.base}/{self.folders[table]}"

    @property
    def quarantine(self) -> str:
        return self.path("quarantine")

    @property
    def silver(self) -> str:
        return self.path("silver")

    def gold(self, table: str) -> str:
        return self.path(table)


@dataclass(frozen=True)
class Gold:
    """The four gold tables as frames. ``by_month``, if there, is the fact with the month it is
    stored under: a range of dates then reads the folders of its months only. ``parted``, if there,
    is the product table laid out like these facts (see ``sources.buckets``)."""

    fact: DataFrame
    dates: DataFrame
    products: DataFrame
    segments: DataFrame
    by_month: DataFrame | None = None
    parted: DataFrame | None = None

    @classmethod
    def read(cls, spark: SparkSession, base: str) -> "Gold":
        """The stored tables. Only the date table differs between variants, so only
        its columns are looked up in the files."""
        layers = Layers.of(spark, base)

        def table(name: str, more: str = "") -> DataFrame:
            reader = spark.read if name == "dim_date" else spark.read.schema(GOLD_COLUMNS[name] + more)
            return reader.parquet(layers.gold(name))

        by_month = table("fact_sales", f", {MONTH} INT")
        return cls(by_month.drop(MONTH), *map(table, GOLD_TABLES[1:]), by_month)

    def tables(self) -> dict[str, DataFrame]:
        return dict(zip(GOLD_TABLES, (self.fact, self.dates, self.products, self.segments)))


def month_of(date_key: Column) -> Column:
    """The month of a date key, as it names a folder of facts."""
    return F.floor(date_key / F.lit(100)).cast("int")


def together(spark: SparkSession, *writes: Callable[[], None]) -> None:
    """Submit independent writes at the same time, so that small ones fill the gaps of
    large ones; fails when one of them fails."""
    with ThreadPoolExecutor(len(writes)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(write)) for write in writes]:
            done.result()


def write_quarantine(rows: DataFrame, path: str) -> None:
    """A few bad rows out of many files: rebalancing leaves few, right-sized files."""
    rows.hint("rebalance").write.parquet(path)


def write_silver(rows: DataFrame, path: str) -> None:
    rows.write.parquet(path)


def write_gold(gold: Gold, path: Callable[[str], str]) -> None:
    """One folder per table, named by ``path``; in that of the facts one per month.

    The facts are dealt out by ranges of date, so a month lies in few files and a range of dates
    skips row groups. The other columns take part in the ranges: without them all rows of one
    date would end in one task."""
    months = gold.fact.withColumn(MONTH, month_of(F.col("date_key")))
    clustered = months.repartitionByRange(
        "date_key", "pln_id", "segment_id", "actual_sales"
    ).sortWithinPartitions(MONTH, "date_key", "pln_id")
    frames = {**gold.tables(), "fact_sales": clustered}

    def write(table: str, to: str) -> Callable[[], None]:
        writer = frames[table].write
        return lambda: (writer.partitionBy(MONTH) if table == "fact_sales" else writer).parquet(to)

    together(gold.fact.sparkSession, *[write(table, path(table)) for table in GOLD_TABLES])
