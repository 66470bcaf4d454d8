"""Valid rows to the silver table.

The order of the steps decides row counts and labels: exact copies go first, on the
texts as they came, then texts that mean "no value" become null, then the newest
known attributes of each product are looked up, and only then gaps are filled.
"""

from pyspark.sql import DataFrame, functions as F, types as T

from saleslake.functions import fixed_values as fixed, text
from saleslake.operators.cleaning import valid_rows

ATTRIBUTES = ["PLN_LABEL", "BU", "PRODUCT_CATEGORY_LABEL", "OPSTUDY_LABEL"]


def drop_copies(rows: DataFrame) -> DataFrame:
    """One of each set of equal rows. Nearly all rows differ, so tasks before the shuffle would only
    fill tables with them, as large as their split, and spill: rows are dealt out by all their
    columns first, which spreads a product or date with very many rows, and compared where they meet.
    The width is the session's; adaptive execution would put as many rows together as compress to
    its size, though in memory they are several times that."""
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(width, *[F.col(f"`{c}`") for c in rows.columns]).distinct()


def nullify_aliases(rows: DataFrame) -> DataFrame:
    texts = [f.name for f in rows.schema if isinstance(f.dataType, T.StringType)]
    return rows.withColumns({c: text.null_if_alias(F.col(c)) for c in texts})


def golden_records(rows: DataFrame) -> DataFrame:
    """Per product and per attribute the newest value that is not null; the four may
    come from different rows. Undated rows count as oldest, and on equal dates the
    greatest text wins.

    The first grouping keeps the last date of each combination of attributes as they
    stand: a hash aggregate that shrinks even a product with most of the rows to a
    handful of rows per task before the shuffle. Only those few are tested for texts
    that mean "no value" and reach ``max_by``.
    """
    combinations = rows.groupBy("PLN", *ATTRIBUTES).agg(F.max("DATE").alias("last_seen"))
    known = nullify_aliases(combinations)
    # max_by skips a null order, so a null attribute never wins.
    newest = {c: F.when(F.col(c).isNotNull(), F.struct("last_seen", c)) for c in ATTRIBUTES}
    return known.groupBy("PLN").agg(*[F.max_by(c, order).alias(c) for c, order in newest.items()])


def heal(rows: DataFrame, golden: DataFrame) -> DataFrame:
    """Every row gets the golden attributes of its product.

    ``golden`` is best a written table: Spark then broadcasts it when its size allows,
    and otherwise both join inputs are plain shuffles, in which adaptive execution can
    split a product that holds a large part of the rows.
    """
    return rows.drop(*ATTRIBUTES).join(golden, "PLN", "left")


def readable(rows: DataFrame) -> DataFrame:
    return rows.withColumn("OPSTUDY_LABEL", text.readable_opstudy(F.col("OPSTUDY_LABEL")))


def fill_gaps(rows: DataFrame) -> DataFrame:
    return rows.fillna({"PROMO": fixed.NO_PROMO, "SEG": fixed.UNKNOWN, **dict.fromkeys(ATTRIBUTES, fixed.UNKNOWN)})


def narrow(rows: DataFrame) -> DataFrame:
    """Amounts as FLOAT; the week code has served its purpose."""
    return rows.withColumn("ACTUAL", F.col("ACTUAL").cast("float")).drop("WEEK")


def healed_rows(rows: DataFrame, golden: DataFrame) -> DataFrame:
    """Valid rows without copies, each with the golden attributes of its product, as silver has them."""
    return narrow(fill_gaps(readable(heal(nullify_aliases(rows), golden))))


def to_silver(tagged: DataFrame, golden: DataFrame | None = None) -> DataFrame:
    """Tagged rows to silver rows. Without a ``golden`` table the records are part of
    the same plan."""
    valid = valid_rows(tagged)
    golden = golden_records(valid) if golden is None else golden
    return healed_rows(drop_copies(valid), golden)
