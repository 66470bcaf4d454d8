"""Times of the load, the reports and the audit: prints one JSON line.

``BENCH_SF_DIR``  tables to derive the feed from (default /root/testdata/sf0.1)
``BENCH_CPUS``    local cores (default 4)
``BENCH_RUNS``    timed runs after one warm-up; the median counts (default 3)
``BENCH_COPIES``  times the feed is repeated, each time with products of its own (default 1)
"""

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.lake import check_folder, raw_feed  # noqa: E402
from saleslake.functions.fixed_values import HIDDEN_CATEGORIES  # noqa: E402
from saleslake.operators import audit  # noqa: E402
from saleslake.plans import load, metrics, trends  # noqa: E402
from saleslake.sources.feed import read_feed, write_feed  # noqa: E402
from saleslake.sources.layers import Gold  # noqa: E402
from saleslake.sources.scratch import work_folder  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "4")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
COPIES = int(os.environ.get("BENCH_COPIES", "1"))
START, END = "2016-01-01", "2020-12-31"


def larger_feed(spark: SparkSession):
    """The feed of the tables, repeated under other product keys."""
    feed = raw_feed(spark, SF_DIR)
    if COPIES == 1:
        return feed
    copies = feed.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    key = F.coalesce((F.col("PLN").try_cast("bigint") * COPIES + F.col("copy")).cast("string"), F.col("PLN"))
    return copies.withColumn("PLN", key).drop("copy")


def steps(spark: SparkSession, feed: str, base: str) -> dict:
    def gold() -> Gold:
        return Gold.read(spark, base)

    def top(group, exclude=None):
        return lambda: metrics.top_metrics(gold(), START, END, group, 10, exclude)

    reports = {
        "q_filters": lambda: metrics.filters(gold()),
        "q_weekly_metrics": lambda: metrics.weekly_metrics(gold(), START, END),
        "q_top_category": top("PRODUCT_CATEGORY", HIDDEN_CATEGORIES),
        "q_top_opstudy": top("OPSTUDY_LABEL"),
        "q_top_label": top("PLN_LABEL"),
        "q_top_bu": top("BU"),
        "q_top_bu_last_12": lambda: metrics.top_metrics(gold(), *metrics.last_weeks(gold(), 12), "BU", 10),
        "q_segment": lambda: metrics.segment_metrics(gold(), START, END),
        "q_promo": lambda: metrics.promo_metrics(gold(), START, END),
        "q_promo_lift": lambda: metrics.promo_lift_metrics(gold(), START, END),
        "q_category_mix": lambda: metrics.category_mix_metrics(gold(), START, END),
        "four_reports_in_one": lambda: metrics.report_sums(gold(), START, END),
        "q_kpis": lambda: trends.kpis(gold(), START, END),
        "audit_categories": lambda: audit.category_distribution(gold()),
        "top_unmapped": lambda: audit.top_unmapped(gold()),
        "top_other_products": lambda: audit.top_other_products(gold()),
        "audit_gap_summary": lambda: audit.gap_summary(gold()),
        "top_gaps": lambda: audit.top_gaps(gold()),
    }

    def collected(build):
        return lambda: build().collect()

    def profile(sketched):
        with work_folder(spark, base) as work:
            audit.profile(gold(), work, sketched).collect()

    return {
        "load_silver": lambda: load.load_silver(spark, feed, base),
        "load_gold": lambda: load.load_gold(spark, base),
        **{name: collected(build) for name, build in reports.items()},
        "audit_profile": lambda: profile(False),
        "audit_profile_sketched": lambda: profile(True),
    }


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("saleslake-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        # The steps compile more stages than the default cache of 100 keeps.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    base = check_folder(spark, "bench")
    feed = f"{base}/feed"
    # Several files, as a feed of many weeks would come.
    write_feed(larger_feed(spark).repartition(int(CPUS) * COPIES).withColumnRenamed("PROMO", "PROMO,,"), feed)
    rows = read_feed(spark, feed).count()

    seconds: dict[str, list[float]] = {}
    for turn in range(RUNS + 1):
        for name, step in steps(spark, feed, base).items():
            started = time.perf_counter()
            step()
            if turn:
                seconds.setdefault(name, []).append(time.perf_counter() - started)
    queries = {name: round(statistics.median(times), 3) for name, times in seconds.items()}
    load_seconds = queries["load_silver"] + queries["load_gold"]
    print(
        json.dumps(
            {
                "metric": "sum of median seconds: load, reports, audit",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "feed_rows": rows,
                "load_rows_per_sec": round(rows / load_seconds),
                "cpus": int(CPUS),
                "runs": RUNS,
                "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
