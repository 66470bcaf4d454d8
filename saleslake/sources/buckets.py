"""Facts and products in buckets of equal keys, so that their join moves no fact.

Where the product table has outgrown a broadcast, every report by a product attribute would deal out
all facts by product. Both tables can be stored in that order once: in buckets by product, and by a
part of the product where one product has very many facts. Products are repeated for their parts, so
the join is by product and part; a hot product then fills many buckets instead of one.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from saleslake.sources.catalog import create_database, quoted
from saleslake.sources.layers import MONTH, Gold, Layers
from saleslake.sources.scratch import work_folder, written
from saleslake.sources.versions import new_version

FACTS, PRODUCTS = "fact_sales_by_product", "dim_product_by_part"
KEYS = ("pln_id", "part")
#: Facts of one product that lie in one bucket; a product with more is cut into parts.
PART_ROWS = 5_000_000


def _name(database: str, folder: str) -> str:
    """The catalog name of a bucketed table: its version is part of it, so one in use is never dropped."""
    _, version, table = folder.split("/")
    return f"{quoted(database)}.{table}_{version}"


def product_parts(fact: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """``(pln_id, parts)`` of products with more facts than one part may have; counted before the shuffle."""
    counted = fact.groupBy("pln_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > part_rows)
    return counted.select("pln_id", F.ceil(F.col("n") / part_rows).cast("int").alias("parts"))


def write_buckets(spark: SparkSession, base: str, database: str, buckets: int, part_rows: int = PART_ROWS) -> None:
    """Store facts and products of the gold tables in use in ``buckets`` buckets, as tables of the
    catalog and as part of the lake. To be repeated after a load, as its tables are new ones."""
    gold = Gold.read(spark, base)
    create_database(spark, base, database)
    with work_folder(spark, base) as work, new_version(spark, base) as version:
        hot = written(product_parts(gold.fact, part_rows), f"{work}/hot")
        parts = F.coalesce("parts", F.lit(1))

        def store(rows: DataFrame, table: str, months: list[str]) -> None:
            path = version.path(table)
            # Dealt out as the buckets are, so that a task writes one bucket.
            writer = rows.repartition(buckets, *KEYS).write.bucketBy(buckets, *KEYS).sortBy(*KEYS).option("path", path)
            (writer.partitionBy(*months) if months else writer).saveAsTable(_name(database, version.folders[table]))

        placed = gold.by_month.withColumn("place", F.monotonically_increasing_id())
        facts = placed.join(hot, "pln_id", "left").withColumn("part", F.pmod("place", parts).cast("int"))
        store(facts.drop("place", "parts"), FACTS, [MONTH])
        each = F.explode(F.sequence(F.lit(0), parts - 1))
        store(gold.products.join(hot, "pln_id", "left").withColumn("part", each).drop("parts"), PRODUCTS, [])


def read_buckets(spark: SparkSession, base: str, database: str) -> Gold:
    """The gold tables, with facts and products from the buckets: reports by product attributes join
    them without an exchange of the facts."""
    gold, folders = Gold.read(spark, base), Layers.of(spark, base).folders
    missing = [table for table in (FACTS, PRODUCTS) if table not in folders]
    if missing:
        raise FileNotFoundError(f"no buckets under {base}: {missing}")
    facts, products = (spark.table(_name(database, folders[table])) for table in (FACTS, PRODUCTS))
    return Gold(facts.select(gold.fact.columns), gold.dates, gold.products, gold.segments, facts, products)
