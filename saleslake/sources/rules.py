"""Category rules kept as files: CSV with a header line (lines with # are comments), or Parquet."""

from pyspark.sql import DataFrame, SparkSession

from saleslake.operators.classify import RuleTables

EXACT_COLUMNS = "label STRING, category STRING"
KEYWORD_COLUMNS = "priority INT, category STRING, keyword STRING"


def _read(spark: SparkSession, path: str, columns: str) -> DataFrame:
    reader = spark.read.schema(columns)
    return reader.parquet(path) if path.rstrip("/").endswith(".parquet") else reader.option("header", True).option("comment", "#").csv(path)


def read_rules(spark: SparkSession, exact_path: str, keyword_path: str) -> RuleTables:
    """Exact labels and keywords; the priority is the place of the category in the
    order of precedence, the same for all its keywords."""
    return RuleTables(_read(spark, exact_path, EXACT_COLUMNS), _read(spark, keyword_path, KEYWORD_COLUMNS))
