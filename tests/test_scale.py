"""Plans: what must not be in them, and what a hot key does to them."""

import contextlib
import datetime
import pathlib
import re

import pytest
from pyspark.sql import functions as F

from checks import relational, reports_and_loads, sources_and_functions  # noqa: F401  (register)
from checks.lake import Lake, check_folder
from checks.registry import QUERIES
from saleslake.operators import audit, growth, silver, star
from saleslake.operators.cleaning import clean
from saleslake.plans import load, metrics
from saleslake.sources.layers import Gold, Layers, write_gold
from saleslake.sources.scratch import written

SF_DIR = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def settings(spark, **values):
    old = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_pair_joins_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert not [word for word in FORBIDDEN if word in text]


def test_date_range_and_columns_reach_the_scan(spark):
    gold = Lake.of(spark, SF_DIR).gold
    text = plan(metrics.promo_metrics(gold, "2016-01-01", "2016-12-31"))
    fact = next(line for line in text.splitlines() if "FileScan" in line and "actual_sales" in line)
    assert "GreaterThanOrEqual(date_key,20160101)" in fact and "LessThanOrEqual(date_key,20161231)" in fact
    assert "pln_id" not in fact


def scans(node):
    """The file scans of an executed plan, with what they read."""
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return scans(node.executedPlan())
    if kind.endswith("QueryStageExec"):
        return scans(node.plan())
    found = [node] if kind == "FileSourceScanExec" else []
    for i in range(node.children().size()):
        found += scans(node.children().apply(i))
    return found


def months_read(df):
    """How many folders of facts each scan of them has opened."""
    df.collect()
    facts = [s for s in scans(df._jdf.queryExecution().executedPlan()) if "actual_sales" in s.output().toString()]
    return [s.metrics().apply("numPartitions").value() for s in facts]


def test_a_date_range_opens_the_folders_of_its_months_only(spark):
    gold = Lake.of(spark, SF_DIR).gold
    all_months = gold.by_month.select("month_key").distinct().count()
    for report, months in (
        (metrics.promo_metrics(gold, "2016-03-01", "2016-05-31"), 3),
        (metrics.segment_metrics(gold, "2016-12-20", "2017-01-10"), 2),
        (metrics.promo_lift_metrics(gold, "2017-02-01", "2017-02-28"), 1),
    ):
        assert "month_key" in re.search(r"PartitionFilters: \[([^\]]*)\]", plan(report)[plan(report).index("actual_sales") :]).group(1)
        assert months_read(report) == [months]
    assert months_read(metrics.segment_metrics(gold)) == [all_months]


def test_bounds_known_at_run_time_choose_the_folders_too(spark):
    """The last weeks end at the last date there is, which a scalar subquery finds."""
    gold = Lake.of(spark, SF_DIR).gold
    report = metrics.segment_metrics(gold, *metrics.last_weeks(gold, 8))
    fact = next(line for line in plan(report).splitlines() if "FileScan" in line and "actual_sales" in line)
    # (The line is cut after a hundred characters, before the subquery.)
    assert re.search(r"PartitionFilters: \[.*month_key#\d+ >= ", fact) and "Subquery" in plan(report)
    assert 1 <= months_read(report)[0] <= 3
    weekly = metrics.weekly_metrics(gold, "2019-01-01", "2019-03-31")
    assert months_read(weekly) and months_read(weekly)[0] <= 16
    # The same rows as from a fact without folders.
    flat = Gold(gold.fact, gold.dates, gold.products, gold.segments)
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, metrics.segment_metrics(flat, *metrics.last_weeks(flat, 8)).collect()))


def test_undated_facts_have_a_folder_of_their_own(spark, folder):
    rows = hot_rows(spark, 3_000).withColumn("DATE", F.expr("if(PLN % 5 = 1, null, DATE)"))
    stars = star.build_star(rows)
    write_gold(stars, lambda table: f"{folder}/{table}")
    undated = [p for p in pathlib.Path(folder, "fact_sales").iterdir() if p.name == "month_key=__HIVE_DEFAULT_PARTITION__"]
    assert len(undated) == 1
    found = spark.read.parquet(f"{folder}/fact_sales/month_key=__HIVE_DEFAULT_PARTITION__")
    assert found.filter("date_key IS NOT NULL").count() == 0 and found.count() == stars.fact.filter("date_key IS NULL").count() > 0


def executions(spark):
    """The plans that Spark SQL has run so far in this session."""
    store = spark._jsparkSession.sharedState().statusStore()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return [store.executionsList().apply(i).physicalPlanDescription() for i in range(store.executionsList().size())]


def test_a_load_counts_without_reading_again(spark, folder):
    """Statistics and reasons come from the writes: four of them, and nothing else reads a table."""
    feed = Lake.of(spark, SF_DIR).feed_path
    before = len(executions(spark))
    report = load.load_silver(spark, feed, f"{folder}/lake")
    stats, reasons = report.stats.first(), report.reasons.collect()
    ran = executions(spark)[before:]
    writes = [text for text in ran if "InsertIntoHadoopFsRelationCommand" in text]
    assert len(writes) == 4  # tagged rows, golden records, quarantine, silver
    assert not [text for text in ran if text not in writes and "Scan parquet" in text]
    assert stats["quarantined_rows"] == sum(r["row_count"] for r in reasons) > 0
    stored = Layers.of(spark, f"{folder}/lake")
    assert stats["silver_rows"] == spark.read.parquet(stored.silver).count()
    bad = spark.read.parquet(stored.quarantine).groupBy("ERROR_REASON").count().collect()
    assert {r["error_reason"]: r["row_count"] for r in reasons} == {r["ERROR_REASON"]: r["count"] for r in bad}


def test_lags_read_no_more_than_they_need(spark):
    """Neither facts after the end nor those before the longest lag of the start."""
    gold = Lake.of(spark, SF_DIR).gold
    weeks = metrics.weekly_metrics(gold, "2019-01-01", "2019-12-31")
    text = plan(weeks)
    assert "LessThanOrEqual(date_key,20191231)" in text and "date_key#" in text
    bound = gold.dates.filter("full_date < '2019-01-01'").orderBy(F.desc("full_date")).limit(52).agg(F.min("date_key")).first()[0]
    assert gold.dates.select(growth.weeks_back(gold, "2019-01-01")).first()[0] == bound
    whole = growth.between_dates(growth.weekly_growth(growth.weekly_sales(gold)), "2019-01-01", "2019-12-31")
    assert sorted(map(tuple, weeks.collect())) == sorted(map(tuple, whole.collect()))


@contextlib.contextmanager
def jobs(spark):
    """The numbers of the jobs that run meanwhile."""
    group, found = f"jobs-{id(object())}", []
    spark.sparkContext.setJobGroup(group, "")
    yield found
    found += spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_building_a_plan_starts_no_job(spark):
    lake = Lake.of(spark, SF_DIR)
    gold, raw = lake.gold, lake.feed.withColumnRenamed("PROMO,,", "PROMO")
    with jobs(spark) as started:
        silver.to_silver(clean(raw))
        audit.showcase(raw)
        audit.null_counts(gold)
        metrics.weekly_metrics(gold, "2019-01-01")
        metrics.top_metrics(gold, *metrics.last_weeks(gold, 12), "BU", 10)
    assert started == []


def test_a_load_leaves_settings_and_no_work_tables(spark, folder):
    feed = Lake.of(spark, SF_DIR).feed_path
    before = dict(spark.conf.getAll)
    load.run(spark, feed, f"{folder}/lake")
    assert dict(spark.conf.getAll) == before
    assert [p.name for p in (pathlib.Path(folder) / "lake").iterdir() if p.name == "work" and list(p.iterdir())] == []


def test_facts_meet_their_group_before_any_shuffle(spark):
    """A small product table is broadcast: only sums by date and group are dealt out."""
    gold = Lake.of(spark, SF_DIR).gold
    text = plan(growth.weekly_group_sales(gold, "broad_category"))
    assert "hashpartitioning(pln_id" not in text
    assert "hashpartitioning(date_key" in text and "Exchange SinglePartition" not in text


def test_a_hot_product_is_split_where_the_product_table_is_large(spark):
    facts = written(star.fact_sales(hot_rows(spark, 300_000)), check_folder(spark, "hot"))
    stars = star.build_star(hot_rows(spark, 300_000))
    products = written(stars.products, check_folder(spark, "products"))
    gold = Gold(facts, written(stars.dates, check_folder(spark, "dates")), products, stars.segments)
    with settings(
        spark,
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        },
    ):
        weekly = growth.weekly_group_sales(gold, "pln_label")
        weekly.collect()
        assert "skew=true" in plan(weekly)


def test_the_audit_reads_the_facts_once(spark):
    gold = Lake.of(spark, SF_DIR).gold
    fact_files = {f.rsplit("/", 1)[-1] for f in gold.fact.inputFiles()}
    work = check_folder(spark, "profile")
    profile = audit.profile(gold, work)
    profile.collect()
    # What is left in the plan reads the work tables, not the facts.
    assert not [f for f in profile.inputFiles() if f.rsplit("/", 1)[-1] in fact_files]


def test_gaps_deal_out_combinations_only(spark):
    """Dates become bits before the shuffle: one exchange stands above the facts, and one scan of them is enough."""
    gold = Lake.of(spark, SF_DIR).gold
    for report in (audit.gaps(gold), audit.gap_summary(gold)):
        text = plan(report)
        assert text.count("hashpartitioning(") == 1 and "hashpartitioning(pln_id" in text
        assert len([line for line in text.splitlines() if "FileScan" in line and "is_promo" in line]) == 1
        assert "date_key#" not in re.search(r"hashpartitioning\(([^)]*)\)", text).group(1)


def test_sketches_move_no_values(spark):
    gold = Lake.of(spark, SF_DIR).gold
    text = plan(audit.describe_sketched(gold))
    assert len([line for line in text.splitlines() if "FileScan" in line and "actual_sales" in line]) == 1
    dealt = re.findall(r"(?:hash|range)partitioning\(([^)]*)\)", text)
    assert dealt and all(re.match(r"(task|column_name)#", d) for d in dealt)


def test_no_quartile_join_is_dealt_by_the_few_columns(spark):
    """Values meet their ranges by column and range, even where nothing is broadcast."""
    gold = Lake.of(spark, SF_DIR).gold
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        text = plan(audit.describe(gold, check_folder(spark, "describe")))
    joins = re.findall(r"SortMergeJoin \[([^\]]*)\], \[[^\]]*\], Inner", text)
    assert any("bracket" in j for j in joins)
    # The others join sums: one row per column, or per column and range.
    assert all("bracket" in j or j.startswith("column_name") for j in joins)


def hot_rows(spark, rows):
    """A third of all rows belongs to product 0 and to one date."""
    i = F.col("id")
    hot = i % 3 == 0
    return spark.range(rows).select(
        F.when(hot, 0).otherwise(i).alias("PLN"),
        F.when(hot, F.lit(datetime.date(2020, 1, 5)))
        .otherwise(F.date_add(F.lit(datetime.date(2020, 1, 5)), (i % 700).cast("int")))
        .alias("DATE"),
        i.cast("float").alias("ACTUAL"),
        F.lit("A").alias("SEG"),
        F.lit("Y").alias("PROMO"),
        F.concat(F.lit("label "), i % 7).alias("PLN_LABEL"),
        *[F.lit(c).alias(c) for c in ("BU", "PRODUCT_CATEGORY_LABEL", "OPSTUDY_LABEL")],
    )


def test_golden_records_shrink_before_the_shuffle(spark):
    """The hot product sends a few combinations per task, not its rows."""
    golden = silver.golden_records(written(hot_rows(spark, 90_000), check_folder(spark, "hot")))
    golden.collect()
    text = plan(golden)
    final = text[: text.index("Initial Plan")]
    assert final.index("HashAggregate", final.index("Exchange")) > 0
    assert final.rindex("HashAggregate") > final.rindex("Exchange")


def test_a_hot_product_is_split_in_the_heal_join(spark):
    rows = written(hot_rows(spark, 300_000), check_folder(spark, "hot"))
    with settings(
        spark,
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        },
    ):
        golden = written(silver.golden_records(rows), check_folder(spark, "golden"))
        healed = silver.heal(silver.drop_copies(rows), golden)
        assert healed.count() == 300_000
        sums = healed.groupBy("PLN_LABEL", "DATE").agg(F.sum("ACTUAL"), F.count("BU"))
        sums.collect()
        assert "skew=true" in plan(sums)


def test_a_hot_date_is_split_in_the_fact_files(spark, folder):
    facts = star.fact_sales(hot_rows(spark, 60_000))
    gold = star.build_star(hot_rows(spark, 60_000))
    with settings(spark, **{"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        write_gold(Gold(facts, gold.dates, gold.products, gold.segments), lambda table: f"{folder}/{table}")
    stored = spark.read.parquet(f"{folder}/fact_sales").groupBy(F.input_file_name().alias("f")).count()
    sizes = [r["count"] for r in stored.collect()]
    assert sum(sizes) == 60_000
    assert max(sizes) < 60_000 / 3
    files = spark.read.parquet(f"{folder}/fact_sales").filter("date_key = 20200105")
    assert files.select(F.input_file_name()).distinct().count() > 1


def test_no_machine_internals():
    """No code path collects frames, crosses them, changes the session or writes on one machine.
    The operators for training data have rules and tests of their own."""
    package = pathlib.Path(__file__).parent.parent / "saleslake"
    text = "\n".join(p.read_text() for p in package.rglob("*.py") if "llm" not in p.parts)
    for word in (
        "localCheckpoint", "crossJoin", "toPandas", ".rdd", "F.udf", "pandas_udf", "F.broadcast(", "conf.set", "tempfile",
        ".collect()",
    ):
        assert word not in text
