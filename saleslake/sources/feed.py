"""The raw delimited feed."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from saleslake.functions.fixed_values import FEED_SEPARATOR, PROMO_MARK


#: The text of a line with more or fewer cells than the header, else null.
LINE = "MALFORMED_LINE"


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Feed with a header line and no quoting. Every column is read as text, so the
    result does not depend on type inference and needs no extra pass over the data.

    A line with too few cells is padded with nulls, one with too many is cut; both keep their
    whole text in a last column (null for all other lines). A file whose header differs from the
    others' is refused: its cells would land in wrong columns."""
    reader = (
        spark.read.option("sep", FEED_SEPARATOR)
        .option("header", True)
        .option("quote", "")
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", False)
        # All cells of a line are counted, also where a step needs few of them.
        .option("columnPruning", False)
        .option("columnNameOfCorruptRecord", LINE)
    )
    return reader.schema(reader.csv(path).schema.add(LINE, "string")).csv(path)


def surplus_cells(line: Column, columns: int) -> Column:
    """Whether a line (null: a well-formed one) has more cells than there are columns."""
    return F.coalesce(F.size(F.split(line, f"[{FEED_SEPARATOR}]")) > columns, F.lit(False))


#: Rows of a compressed feed file, which is read by one task.
PACKED_ROWS = 1_000_000


def write_feed(df: DataFrame, path: str, packed: bool = False) -> None:
    """Write rows as a feed: nothing quoted, nothing trimmed, null as an empty cell. ``packed``
    compresses the files, which have at most ``PACKED_ROWS`` rows then."""
    (
        df.write.mode("overwrite")
        .option("sep", FEED_SEPARATOR)
        .option("header", True)
        .option("quote", "")
        .option("emptyValue", "")
        .option("nullValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .options(**{"compression": "gzip", "maxRecordsPerFile": PACKED_ROWS} if packed else {})
        .csv(path)
    )


def write_lines(lines: DataFrame, header: list[str], path: str) -> None:
    """Write whole lines (one column) as a feed, a header line at the head of every file."""
    named = lines.toDF(FEED_SEPARATOR.join(header))
    named.write.mode("overwrite").option("sep", "\x01").option("header", True).option("quote", "").option("emptyValue", "").csv(path)


def fix_promo_header(df: DataFrame) -> DataFrame:
    """The first column with PROMO in its name becomes PROMO."""
    named = next((c for c in df.columns if PROMO_MARK in c), PROMO_MARK)
    return df.withColumnRenamed(named, PROMO_MARK)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))
