"""Row counts by reason, drop statistics, parity checks."""

from pyspark.sql import DataFrame, functions as F

from saleslake.functions.fixed_values import VALID


def reason_counts(tagged: DataFrame) -> DataFrame:
    return tagged.groupBy(F.col("ERROR_REASON").alias("error_reason")).agg(F.count(F.lit(1)).alias("row_count"))


def counts(**frames: DataFrame) -> DataFrame:
    """One row with the row count of each frame, in one pass over each."""
    names = list(frames)
    marks = None
    for name, df in frames.items():
        part = df.select(*[F.lit(1 if n == name else 0).cast("bigint").alias(n) for n in names])
        marks = part if marks is None else marks.unionAll(part)
    return marks.agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in names])


def drop_stats(tagged: DataFrame, silver: DataFrame) -> DataFrame:
    """Rows in, quarantined, kept in silver, and dropped as copies."""
    bad = tagged.filter(F.col("ERROR_REASON") != VALID)
    total = counts(total_rows=tagged, quarantined_rows=bad, silver_rows=silver)
    return total.withColumn(
        "duplicate_rows", F.col("total_rows") - F.col("quarantined_rows") - F.col("silver_rows")
    )


def source_parity(source: DataFrame, copy: DataFrame) -> DataFrame:
    """A copy must have exactly the rows of its source."""
    found = counts(source_rows=source, copy_rows=copy)
    return found.withColumn("ok", F.col("source_rows") == F.col("copy_rows"))


def gold_parity(source: DataFrame, fact: DataFrame) -> DataFrame:
    """Facts must exist and may not outnumber the source."""
    found = counts(source_rows=source, gold_rows=fact)
    return found.withColumn("ok", (F.col("gold_rows") > 0) & (F.col("gold_rows") <= F.col("source_rows")))


def require(check: DataFrame) -> DataFrame:
    """Fail when a one-row parity check is not ok."""
    row = check.first()
    if not row["ok"]:
        raise ValueError(f"row count check failed: {row.asDict()}")
    return check
