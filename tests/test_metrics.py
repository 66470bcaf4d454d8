import datetime

import pytest

from checks.lake import Lake
from saleslake.plans import metrics, trends
from saleslake.sources.catalog import report_names, run_sql, create_views
from saleslake.sources.layers import GOLD_COLUMNS, Gold
from tests.rows import as_set, frame, one

FIRST = datetime.date(2020, 1, 5)


def week(i):
    return FIRST + datetime.timedelta(weeks=i)


def key(day):
    return day.year * 10000 + day.month * 100 + day.day


@pytest.fixture
def gold(spark):
    """60 weeks of product 1; product 2 sells in weeks 0 and 55 only; one undated row."""
    facts = [(key(week(i)), 1, "A", i % 2 == 0, float(100 + i)) for i in range(60)]
    facts += [(key(week(0)), 2, "B", False, 10.0), (key(week(55)), 2, "B", True, 30.0), (None, 1, "A", True, 999.0)]
    days = [(week(i), key(week(i)), week(i).year, week(i).month, 1, 0) for i in range(60)]
    products = [(1, "P1", "L1", "O1", "B1", "Health"), (2, "P2", "L2", "O1", None, "Other")]
    rows = (facts, days, products, [("A",), ("B",)])
    return Gold(*[frame(spark, GOLD_COLUMNS[t], *r) for t, r in zip(GOLD_COLUMNS, rows)])


def test_filters(gold):
    assert tuple(one(metrics.filters(gold))) == (week(0), week(59))


def test_first_week_of_a_range_has_a_previous_value(gold):
    rows = metrics.weekly_metrics(gold, week(55), str(week(56))).collect()
    assert [r["date"] for r in rows] == [week(55), week(56)]
    first = rows[0]
    assert (first["current_sales"], first["prev_sales"], first["prev_yoy_sales"]) == (185.0, 154.0, 103.0)
    assert first["wow_pct_increase"] == (185.0 - 154.0) / 154.0 * 100.0
    assert first["yoy_pct_increase"] == (185.0 - 103.0) / 103.0 * 100.0


def test_no_base_is_zero_percent(gold):
    row = one(metrics.weekly_metrics(gold, end=week(0)))
    assert (row["prev_sales"], row["wow_pct_increase"], row["yoy_pct_increase"]) == (None, 0.0, 0.0)


def test_lag_counts_the_dates_of_the_group(gold):
    """Product 2 has no row in weeks 1 to 54, so its week before week 55 is week 0."""
    rows = {r["pln_label"]: r for r in metrics.top_metrics(gold, week(55), week(55), "PLN_LABEL").collect()}
    assert rows["P2"]["prev_week_sales"] == 10.0
    assert rows["P2"]["period_wow_pct"] == 200.0
    assert (rows["P2"]["prev_year_sales"], rows["P2"]["period_yoy_pct"]) == (0.0, 0.0)
    assert rows["P2"]["promo_penetration_pct"] == 100.0
    assert rows["P1"]["prev_week_sales"] == 154.0


def test_top_is_smallest_first_and_cut(gold):
    assert [r["pln_label"] for r in metrics.top_metrics(gold, week(0), week(59), "PLN_LABEL").collect()] == ["P2", "P1"]
    assert [r["pln_label"] for r in metrics.top_metrics(gold, week(0), week(59), "PLN_LABEL", 1).collect()] == ["P1"]


def test_exclusion_drops_null_groups_only_once_given(gold):
    groups = {r["bu"] for r in metrics.top_metrics(gold, None, None, "BU").collect()}
    assert groups == {"B1", None}
    assert {r["bu"] for r in metrics.top_metrics(gold, None, None, "BU", exclude=["X"]).collect()} == {"B1"}


def test_arguments_are_checked(gold):
    with pytest.raises(ValueError):
        metrics.top_metrics(gold, None, None, "pln_label; DROP TABLE x")
    with pytest.raises(ValueError):
        metrics.top_metrics(gold, None, None, "BU", 0)
    with pytest.raises(ValueError):
        metrics.last_weeks(gold, 0)
    with pytest.raises(ValueError):
        trends.sales_trend(gold, "daily")
    with pytest.raises(ValueError):
        trends.growth_trend(gold, "mom")


def test_any_length_of_list_and_look_back(gold):
    assert metrics.top_metrics(gold, *metrics.last_weeks(gold, 200), "PLN_LABEL", 500).count() == 2


def test_last_weeks_has_both_ends(gold):
    start, end = metrics.last_weeks(gold, 2)
    assert [r["date"] for r in metrics.weekly_metrics(gold, start, end).collect()] == [week(57), week(58), week(59)]
    start, end = metrics.last_weeks(gold, 156, end=week(1))
    assert metrics.weekly_metrics(gold, start, end).count() == 2


def test_chosen_range(gold):
    one_day = metrics.chosen_range(gold, week(3))
    assert [r["date"] for r in metrics.weekly_metrics(gold, *one_day).collect()] == [week(3)]
    assert metrics.weekly_metrics(gold, *metrics.chosen_range(gold)).count() == 60
    with pytest.raises(ValueError):
        metrics.chosen_range(gold, 1, 2, 3)


def test_sums(gold):
    assert as_set(metrics.segment_metrics(gold, week(0), week(0))) == {("A", 100.0), ("B", 10.0)}
    assert as_set(metrics.promo_metrics(gold, week(0), week(0))) == {(week(0), "Y", 100.0), (week(0), "N", 10.0)}
    lift = {("Health", "Y", 100.0), ("Other", "N", 10.0)}
    assert as_set(metrics.promo_lift_metrics(gold, week(0), week(0))) == lift
    assert as_set(metrics.category_mix_metrics(gold, week(0), week(0))) == {(week(0), "Health", 100.0)}


def test_trends(gold):
    kpis = one(trends.kpis(gold))
    assert kpis["total_sales"] == sum(100 + i for i in range(60)) + 40.0
    assert kpis["latest_wow_pct"] == (159.0 - 158.0) / 158.0 * 100.0
    yearly = as_set(trends.sales_trend(gold, "yearly").select("date"))
    assert yearly == {(datetime.date(2020, 1, 1),), (datetime.date(2021, 1, 1),)}
    assert trends.sales_trend(gold, "monthly").count() == 14
    assert trends.growth_trend(gold, "yoy").columns == ["date", "yoy_pct_increase"]
    assert {r["pct"] for r in trends.category_mix_pct(gold).collect()} == {100.0}
    shares = trends.promo_trend(gold, "yearly").groupBy("date").sum("pct").collect()
    assert all(abs(r[1] - 100) < 1e-9 for r in shares)
    assert {r["product_category"] for r in trends.promo_lift(gold).collect()} == {"Health"}
    assert abs(sum(r["pct"] for r in trends.segment_share(gold).collect()) - 100) < 1e-9


def test_empty_range(gold):
    assert tuple(one(trends.kpis(gold, "1990-01-01", "1990-12-31"))) == (0.0, 0.0, 0.0)


def test_sql_with_parameters(spark, gold):
    create_views(gold)
    query = "SELECT count(*) AS n FROM fact_sales WHERE pln_id = :product"
    assert run_sql(spark, query, product=2).first()["n"] == 2


def test_report_names(gold):
    names = report_names(metrics.top_metrics(gold, None, None, "BU")).columns
    assert names[0] == "BU"
    assert "Promo_Penetration_PCT" in names


def test_four_reports_in_one_are_the_four_reports(spark, gold):
    """Also with facts whose product, segment or date is in no table, and without any facts."""
    more = frame(
        spark,
        GOLD_COLUMNS["fact_sales"],
        (key(week(3)), 77, "A", True, 5.0), (key(week(3)), 1, "Z", False, 7.0), (key(week(3)), 1, None, None, 9.0), (19990101, 1, "A", True, 11.0),
    )
    for facts, start, end in ((gold.fact.union(more), None, None), (gold.fact.union(more), week(2), week(20)), (gold.fact.limit(0), None, None)):
        some = Gold(facts, gold.dates, gold.products, gold.segments)
        sums = metrics.report_sums(some, start, end)
        separate = {
            "promo": metrics.promo_metrics(some, start, end).select("date", "promo", "actual"),
            "promo_lift": metrics.promo_lift_metrics(some, start, end).select("product_category", "promo", "actual"),
            "category_mix": metrics.category_mix_metrics(some, start, end).select("date", "product_category", "actual"),
            "segment": metrics.segment_metrics(some, start, end).select("seg", "actual"),
        }
        for name, report in separate.items():
            assert as_set(sums.filter(f"report = '{name}'").select(*metrics.REPORTS[name], "actual")) == as_set(report), name
        assert sums.count() == sum(report.count() for report in separate.values())
        for name, columns in metrics.REPORTS.items():
            others = [c for c in ("date", "product_category", "promo", "segment") if c not in columns]
            assert sums.filter(f"report = '{name}'").dropna(subset=others, how="all").count() == 0


def test_four_reports_read_the_facts_once(gold, spark):
    stored = Lake.of(spark, "/root/testdata/sf0.001").gold
    text = metrics.report_sums(stored, week(0))._jdf.queryExecution().executedPlan().toString()
    assert len([line for line in text.splitlines() if "FileScan" in line and "actual_sales" in line]) == 1
    # Four rows for each of the sums, not for each fact.
    assert text.index("Expand") < text.index("HashAggregate", text.index("Expand")) < text.rindex("FileScan")
