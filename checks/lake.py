"""A dirty sales feed derived from ``lineitem`` and ``part``, and the lake loaded from it."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from saleslake.plans.load import run
from saleslake.sources.feed import read_feed, write_feed
from saleslake.sources.layers import Gold, Layers

LABELS = [
    '" cHoCoLaTe  "', "Daily Vitamins", "red wine 750ml", "CEREAL", "HAIR GEL", "STEAK KNIFE",
    "LATEX GLOVE", "SPONGE MOP", "WEIRD OBJECT", "UNKNOWN", "DOG FOOD", "GIFT CARD",
]
STUDIES = [" NVLTY/GUM/MINT ", "Dental Nds", "HHD SP/DET", "Other Ops", ""]
WEEKS_ON = 1043 * 7 + 6


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as one raw row, some of them twice (exact copies)."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    shipped = F.col("l_shipdate").cast("date")
    sunday = F.date_add(F.date_sub(shipped, F.weekday(shipped)), WEEKS_ON)
    rows = items.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"),
        "l_partkey", "l_extendedprice", "l_discount", "l_returnflag", "p_name", "p_brand",
        sunday.alias("wk"),
    )
    k, part, week = F.col("k"), F.col("l_partkey"), F.col("wk")

    def every(n: int):
        return k % n == 0

    def pick(texts: list[str]):
        return F.element_at(F.array(*map(F.lit, texts)), (part % len(texts) + 1).cast("int"))

    code = (F.year(week) * 10000 + F.month(week) * 100 + F.day(week) - 19000000).cast("string")
    segment = F.when(F.col("l_returnflag") == "A", "A").when(F.col("l_returnflag") == "N", "B").otherwise("C")
    price = F.col("l_extendedprice")
    feed = rows.select(
        k.alias("k"),
        F.when(k % 10 == 5, F.concat(F.lit('"'), code, F.lit('"'))).when(every(89), None).otherwise(code).alias("WEEK"),
        F.when(every(97), "PLN").when(every(83), None).otherwise(part.cast("string")).alias("PLN"),
        F.when(every(73), "na")
        .when(F.year(week) < 2018, F.concat(F.lit('"  '), F.col("p_name"), F.lit(' old  "')))
        .otherwise(F.col("p_name"))
        .alias("PLN_LABEL"),
        F.when(every(19), "NoBusinessUnit").when(every(23), "none").otherwise(F.col("p_brand")).alias("BU"),
        pick(LABELS).alias("PRODUCT_CATEGORY_LABEL"),
        pick(STUDIES).alias("OPSTUDY_LABEL"),
        F.when(every(101), None).when(every(211), -price).otherwise(price).alias("ACTUAL"),
        F.when(every(61), "na").when(every(3), F.concat(F.lit("NoSegment-"), segment)).otherwise(segment).alias("SEG"),
        F.when(every(53), None)
        .when(every(7), '"Y",,')
        .when(F.col("l_discount") >= 0.05, "Y")
        .otherwise("N")
        .alias("PROMO"),
    )
    copies = F.explode(F.sequence(F.lit(1), F.when(every(31), 2).otherwise(1)))
    return feed.withColumn("copy", copies).drop("k", "copy")


_LOCAL: dict[str, str] = {}


def check_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the session shares; a session without one (a local
    process) gets a temporary folder of its own."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    application, master = spark.sparkContext.applicationId, spark.sparkContext.master
    if not shared:
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = _LOCAL.setdefault(application, tempfile.mkdtemp(prefix="saleslake-checks-"))
    return f"{shared.rstrip('/')}/{application}/{name}-{uuid.uuid4().hex}"


class Lake:
    """Feed file, quarantine, silver and gold of one scale, loaded once per application."""

    _loaded: dict[tuple[str, str], "Lake"] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.base = check_folder(spark, "lake")
        self.feed_path = f"{self.base}/feed"
        # The feed arrives with its dirty header, compressed.
        write_feed(raw_feed(spark, sf_dir).withColumnRenamed("PROMO", "PROMO,,"), self.feed_path, packed=True)
        self.report = run(spark, self.feed_path, self.base)

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Lake":
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in cls._loaded:
            cls._loaded[key] = cls(spark, sf_dir)
        return cls._loaded[key]

    @property
    def feed(self) -> DataFrame:
        return read_feed(self.spark, self.feed_path)

    @property
    def quarantine(self) -> DataFrame:
        return self.spark.read.parquet(Layers.of(self.spark, self.base).quarantine)

    @property
    def silver(self) -> DataFrame:
        return self.spark.read.parquet(Layers.of(self.spark, self.base).silver)

    @property
    def gold(self) -> Gold:
        return Gold.read(self.spark, self.base)
