import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from saleslake.operators import audit
from saleslake.sources.layers import GOLD_COLUMNS, Gold
from tests.rows import DIRTY, RAW, as_set, frame, one

DAYS = [datetime.date(2020, 1, 5) + datetime.timedelta(weeks=i) for i in range(10)]


def key(day):
    return day.year * 10000 + day.month * 100 + day.day


def gold_of(spark, facts):
    days = [(d, key(d), d.year, d.month, 1, 0) for d in DAYS]
    products = [(1, "P1", "L1", "O1", "B1", "Health"), (2, "P2", "L2", "O1", None, "Other"), (3, "P2", "L3", "O1", "B1", "Other")]
    rows = (facts, days, products, [("A",), ("B",)])
    return Gold(*[frame(spark, GOLD_COLUMNS[t], *r) for t, r in zip(GOLD_COLUMNS, rows)])


@pytest.fixture
def gold(spark):
    return gold_of(
        spark,
        [
            (key(DAYS[0]), 1, "A", True, 1.0),
            (key(DAYS[0]), 1, "A", True, 1.0),
            (key(DAYS[0]), 1, "A", True, 1.0),
            (key(DAYS[9]), 1, "A", True, 5.0),
            (None, 1, "A", True, 5.0),
            (key(DAYS[1]), 2, "B", False, -2.0),
            (key(DAYS[2]), 3, "B", False, 0.0),
            (key(DAYS[3]), 4, "B", False, None),
        ],
    )


def test_flat_view(gold):
    flat = audit.join_flat(gold)
    assert flat.count() == 8
    assert one(flat.filter("pln = 4").select("bu", "product_category", "promo")) == (None, None, "N")


def test_shape_counts_the_flat_view(gold):
    assert tuple(one(audit.shape(gold))) == (8, len(audit.join_flat(gold).columns))


def test_null_counts_match_the_flat_view(gold):
    flat = audit.join_flat(gold)
    expected = {c: flat.filter(F.col(c).isNull()).count() for c in flat.columns}
    assert dict(as_set(audit.null_counts(gold))) == expected


def test_all_members_of_duplicate_groups_count(gold):
    assert one(audit.duplicate_rows(gold.fact))[0] == 3
    flat = audit.join_flat(gold)
    assert one(audit.duplicate_rows(flat))[0] == 3


def test_cardinality_counts_null_once(gold):
    assert one(audit.cardinality(gold)).asDict() == {
        "unique_plns": 4,
        "unique_categories": 3,
        "unique_opstudies": 2,
        "unique_segments": 2,
        "unique_bus": 2,
    }


def test_categories(gold):
    rows = {r["product_category"]: r for r in audit.category_distribution(gold).collect()}
    assert (rows["Health"]["row_count"], rows["Health"]["total_sales"]) == (5, 13.0)
    assert rows["Other"]["sales_pct"] == -2.0 / 11.0 * 100
    assert one(audit.other_share(gold))["sales_pct"] == rows["Other"]["sales_pct"]
    assert [tuple(r) for r in audit.top_unmapped(gold).collect()] == [("L3", 0.0), ("L2", -2.0)]
    assert [tuple(r) for r in audit.top_other_products(gold).collect()] == [("P2", -2.0)]
    assert audit.nonpositive(gold.fact).count() == 2


def test_gaps(gold):
    row = one(audit.gaps(gold))
    # Two dates and the missing one are present, ten weeks are expected.
    assert (row["pln"], row["weeks_present"], row["expected_weeks"], row["missing_weeks"]) == (1, 3, 10, 7)
    assert as_set(audit.gap_summary(gold)) == {("unique_dates", 6), ("combinations_with_gaps", 1)}


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 100, 3000])
def test_statistics_against_brute_force(spark, folder, size):
    rng = random.Random(size)
    # A third of all amounts is one value.
    amounts = [7.5 if rng.random() < 0.33 else float(round(rng.gauss(0, 50), 1)) for _ in range(size)]
    facts = [(key(rng.choice(DAYS)), rng.randint(1, 3), "A", True, a) for a in amounts] + [(None, 1, "A", True, None)]
    gold = gold_of(spark, facts)
    stored = sorted(r[0] for r in gold.fact.select("actual_sales").dropna().collect())
    row = one(audit.describe(gold, folder).filter("column_name = 'actual'"))
    mean = sum(stored) / size
    assert (row["row_count"], row["null_count"], row["min"], row["max"]) == (size, 1, stored[0], stored[-1])
    assert math.isclose(row["mean"], mean, abs_tol=1e-9)
    for name, q in audit.QUANTILES.items():
        assert row[name] == stored[math.floor((size - 1) * q + 0.5)]
    if size == 1:
        assert row["std"] is None
    else:
        assert math.isclose(row["std"], math.sqrt(sum((x - mean) ** 2 for x in stored) / (size - 1)), rel_tol=1e-9)


def test_profile_has_every_section(gold, folder):
    sections = {r["section"] for r in audit.profile(gold, folder).collect()}
    assert sections == {"shape", "nulls", "duplicates", "anomalies", "describe", "cardinality"}


def test_showcase(spark):
    row = one(audit.showcase(frame(spark, RAW, DIRTY))).asDict()
    assert (row["raw_week"], row["raw_bu"], row["raw_promo"]) == ('"1231015"', "none", '"Y",,')
    assert (row["DATE"], row["BU"], row["PROMO"]) == (datetime.date(2023, 10, 15), "Unknown", "Y")


def test_more_dates_than_a_bitmap_holds(spark, monkeypatch):
    """Bitmaps of one word: combinations with more dates have several rows on the way."""
    days = [datetime.date(2000, 1, 2) + datetime.timedelta(weeks=i) for i in range(150)]
    draw = random.Random(4)
    facts = {(draw.choice([key(d), None, 99]) if draw.random() < 0.02 else key(d), p, s, s == "A", 1.0) for d in days for p in (1, 2, 3) for s in "AB" if draw.random() < 0.6}
    tables = (list(facts), [(d, key(d), d.year, d.month, 1, 0) for d in days], [], [])
    gold = Gold(*[frame(spark, GOLD_COLUMNS[t], *r) for t, r in zip(GOLD_COLUMNS, tables)])
    want, keys = {}, {key(d): d for d in days}
    for date_key, p, s, promo, _ in facts:
        want.setdefault((p, s, "Y" if promo else "N"), set()).add(keys.get(date_key))
    expected = set()
    for c, seen in want.items():
        there = sorted(d for d in seen if d)
        span = (there[-1] - there[0]).days // 7 + 1
        expected.add((*c, len(seen), there[0], there[-1], span, span - len(seen)))
    columns = ["pln", "seg", "promo", "weeks_present", "first_seen", "last_seen", "expected_weeks", "missing_weeks"]
    results = [as_set(audit.date_presence(gold).select(*columns)), as_set(audit.gap_summary(gold))]
    assert results[0] == expected
    monkeypatch.setattr(audit, "WORDS", 1)
    assert [as_set(audit.date_presence(gold).select(*columns)), as_set(audit.gap_summary(gold))] == results


def test_gaps_of_no_facts(spark):
    empty = gold_of(spark, [])
    assert audit.gaps(empty).collect() == []
    assert as_set(audit.gap_summary(empty)) == {("unique_dates", 0), ("combinations_with_gaps", 0)}


def test_sketched_quartiles_have_a_small_rank_error(spark):
    draw = random.Random(11)
    values = [round(draw.lognormvariate(3, 2), 2) for _ in range(30_000)] + [5.0] * 15_000
    facts = [(key(DAYS[i % 10]) if i % 50 else None, i % 700, "A", True, None if i % 90 == 0 else v) for i, v in enumerate(values)]
    gold = gold_of(spark, facts)
    gold = Gold(gold.fact.repartition(13), gold.dates, gold.products, gold.segments)
    found = {r["column_name"]: r for r in audit.describe_sketched(gold).collect()}
    there = sorted(r[0] for r in gold.fact.select("actual_sales").dropna().collect())
    actual = found["actual"]
    assert (actual["row_count"], actual["null_count"]) == (len(there), len(facts) - len(there))
    assert (actual["min"], actual["max"]) == (there[0], there[-1])
    mean = math.fsum(there) / len(there)
    assert math.isclose(actual["mean"], mean, rel_tol=1e-12)
    assert math.isclose(actual["std"], math.sqrt(math.fsum((v - mean) ** 2 for v in there) / (len(there) - 1)), rel_tol=1e-9)
    for q, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")):
        low, high = sum(v < actual[name] for v in there), sum(v <= actual[name] for v in there)
        assert low - 0.005 * len(there) <= q * len(there) <= high + 0.005 * len(there)
    assert found["year"]["row_count"] == sum(i % 50 > 0 for i in range(len(facts))) and found["month"]["p50"] in (1, 2)
    assert audit.describe_sketched(gold_of(spark, [])).collect() == []


def test_both_profiles_have_the_same_items(spark, gold, folder):
    exact = {(r["section"], r["item"]): r["value"] for r in audit.profile(gold, f"{folder}/a").collect()}
    sketched = {(r["section"], r["item"]): r["value"] for r in audit.profile(gold, f"{folder}/b", sketched=True).collect()}
    assert exact.keys() == sketched.keys()
    assert {k: v for k, v in exact.items() if k[0] != "describe"} == {k: v for k, v in sketched.items() if k[0] != "describe"}
