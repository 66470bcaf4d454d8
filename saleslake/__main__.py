"""``python -m saleslake load|audit|parity``; exit code 1 when it fails or a check is not ok."""

import argparse
import sys

from pyspark.sql import SparkSession

from saleslake.operators import audit, quality
from saleslake.operators.star import VARIANTS
from saleslake.plans.load import run
from saleslake.sources.feed import read_feed
from saleslake.sources.layers import Gold
from saleslake.sources.rules import read_rules
from saleslake.sources.scratch import work_folder
from saleslake.sources.versions import remove_unused


def load(spark: SparkSession, options: argparse.Namespace) -> None:
    """Feed to quarantine, silver and gold; facts must exist and not outnumber the feed."""
    rules = read_rules(spark, *options.rules) if options.rules else None
    report = run(spark, options.feed, options.base, options.variant, rules)
    report.stats.show()
    report.reasons.show(truncate=False)
    quality.require(quality.gold_parity(read_feed(spark, options.feed), Gold.read(spark, options.base).fact))


def audit_gold(spark: SparkSession, options: argparse.Namespace) -> None:
    """Profile, categories and gaps of the gold tables."""
    gold = Gold.read(spark, options.base)
    with work_folder(spark, options.base) as work:
        audit.profile(gold, work).orderBy("section", "item").show(200, False)
    for report in (
        audit.category_distribution(gold),
        audit.top_unmapped(gold),
        audit.top_other_products(gold),
        audit.gap_summary(gold),
        audit.top_gaps(gold),
    ):
        report.show(50, False)


def parity(spark: SparkSession, options: argparse.Namespace) -> None:
    """Row counts: a copy against its source, and the facts against the feed."""
    feed = read_feed(spark, options.feed)
    if options.copy:
        quality.require(quality.source_parity(feed, read_feed(spark, options.copy))).show()
    if options.base:
        quality.require(quality.gold_parity(feed, Gold.read(spark, options.base).fact)).show()


def clean(spark: SparkSession, options: argparse.Namespace) -> None:
    """Remove the tables of loads that were killed. Not while a load runs."""
    for name in remove_unused(spark, options.base):
        print(f"removed {name}")


def arguments_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="saleslake", description="Sales feed to star schema, audit and row checks.")
    commands = parser.add_subparsers(required=True)

    loading = commands.add_parser("load", help=load.__doc__)
    loading.set_defaults(command=load)
    loading.add_argument("feed", help="file, folder or URI of the feed")
    loading.add_argument("base", help="folder or URI for quarantine, silver and gold")
    loading.add_argument("--variant", choices=VARIANTS, default="same_day")
    loading.add_argument(
        "--rules",
        nargs=2,
        metavar=("EXACT", "KEYWORDS"),
        help="rule tables (label, category) and (priority, category, keyword), CSV with header or .parquet",
    )

    auditing = commands.add_parser("audit", help=audit_gold.__doc__)
    auditing.set_defaults(command=audit_gold)
    auditing.add_argument("base", help="folder or URI of a load")

    checking = commands.add_parser("parity", help=parity.__doc__)
    checking.set_defaults(command=parity)
    checking.add_argument("feed", help="file, folder or URI of the feed")
    checking.add_argument("--copy", help="a copy that must have the same number of rows")
    checking.add_argument("--base", help="folder or URI of a load")

    cleaning = commands.add_parser("clean", help=clean.__doc__)
    cleaning.set_defaults(command=clean)
    cleaning.add_argument("base", help="folder or URI of a load")
    return parser


def main(arguments: list[str] | None = None) -> int:
    options = arguments_parser().parse_args(arguments)
    spark = SparkSession.builder.appName("saleslake").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        options.command(spark, options)
    except Exception as error:
        print(f"{options.command.__name__} failed: {error}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
