"""The load: feed to quarantine, silver and gold."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from saleslake.functions.fixed_values import HEADER_POLLUTION, MALFORMED, MISSING_KEYS, VALID
from saleslake.functions.taxonomy import Taxonomy
from saleslake.operators import cleaning, silver, star
from saleslake.operators.classify import RuleTables
from saleslake.sources import layers
from saleslake.sources.feed import read_feed
from saleslake.sources.scratch import work_folder, written
from saleslake.sources.versions import Version, new_version

TAGS = (VALID, HEADER_POLLUTION, MISSING_KEYS, MALFORMED)


@dataclass(frozen=True)
class Report:
    """What a load saw: one row of statistics, and quarantined rows by reason, most first."""

    stats: DataFrame
    reasons: DataFrame


def _report(spark: SparkSession, tags: dict[str, int], silver_rows: int) -> Report:
    total, bad = sum(tags.values()), {tag: n for tag, n in tags.items() if tag != VALID and n}
    quarantined = sum(bad.values())
    stats = spark.createDataFrame(
        [(total, quarantined, silver_rows, total - quarantined - silver_rows)],
        "total_rows long, quarantined_rows long, silver_rows long, duplicate_rows long",
    )
    by_reason = sorted(bad.items(), key=lambda item: (-item[1], item[0]))
    return Report(stats, spark.createDataFrame(by_reason, "error_reason string, row_count long"))


def _write_silver(spark: SparkSession, feed_path: str, version: Version) -> Report:
    """The text is parsed once: tagged rows go to a work folder under the base path, as they come
    (a directory per tag would have every task sort its rows by tag), and all later steps read only
    the columns they need. Golden records are a work table too (see ``silver.heal``). Rows are counted as they are written, by tag and
    in silver: no table is read for the statistics."""
    by_tag, kept = Observation("by tag"), Observation("silver")
    with work_folder(spark, version.base) as work:
        cleaned = cleaning.clean(read_feed(spark, feed_path))
        tagged = written(
            cleaned.observe(by_tag, *[F.count_if(F.col("ERROR_REASON") == tag).alias(tag) for tag in TAGS]),
            f"{work}/tagged",
        )
        golden = written(silver.golden_records(cleaning.valid_rows(tagged)), f"{work}/golden")
        rows = silver.to_silver(tagged, golden).observe(kept, F.count(F.lit(1)).alias("rows"))
        quarantine, valid = version.path("quarantine"), version.path("silver")
        layers.together(
            spark,
            lambda: layers.write_quarantine(cleaning.quarantine_rows(tagged), quarantine),
            lambda: layers.write_silver(rows, valid),
        )
    return _report(spark, by_tag.get, kept.get["rows"])


def _write_gold(spark: SparkSession, silver_path: str, version: Version, variant: str, rules) -> None:
    layers.write_gold(star.build_star(spark.read.parquet(silver_path), variant, rules), version.path)


def load_silver(spark: SparkSession, feed_path: str, base: str) -> Report:
    """Feed to quarantine and silver, taken into use together."""
    with new_version(spark, base) as version:
        return _write_silver(spark, feed_path, version)


def load_gold(spark: SparkSession, base: str, variant: str = "same_day", rules=None) -> None:
    """Silver as stored to the four gold tables, taken into use together."""
    with new_version(spark, base) as version:
        _write_gold(spark, layers.Layers.of(spark, base).silver, version, variant, rules)


def run(
    spark: SparkSession,
    feed_path: str,
    base: str,
    variant: str = "same_day",
    rules: Taxonomy | RuleTables | None = None,
) -> Report:
    """Whole load. All tables are taken into use together at its end; a load that fails leaves the
    tables of the load before."""
    with new_version(spark, base) as version:
        report = _write_silver(spark, feed_path, version)
        _write_gold(spark, f"{base}/{version.folders['silver']}", version, variant, rules)
    return report
