import datetime

import pytest

from saleslake.operators import star
from tests.rows import as_set, frame, one

SILVER = "DATE date, PLN bigint, ACTUAL float, SEG string, PROMO string, PLN_LABEL string, BU string, PRODUCT_CATEGORY_LABEL string, OPSTUDY_LABEL string"
DAY = datetime.date(2021, 1, 3)


@pytest.fixture
def silver(spark):
    return frame(
        spark,
        SILVER,
        (DAY, 1, 2.5, "A", "Y", "P1", "B1", "RED WINE", "O1"),
        (DAY, 1, 2.5, "A", "Y", "P1", "B1", "RED WINE", "O1"),
        (None, 2, 3.0, "Unknown", "N", "P2", "B1", "CHOCOLATE", "O1"),
        (datetime.date(2024, 2, 29), 2, 4.0, "A", "N", "P2", "B1", "CHOCOLATE", "O1"),
    )


def test_same_day_dates(silver):
    row = one(star.dim_date(silver).filter("date_key = 20210103"))
    assert (row["year"], row["month"], row["week_of_year"]) == (2021, 1, 53)
    assert row["same_week_last_year_date"] == datetime.date(2020, 1, 5)
    assert row["same_week_last_year_key"] == 20200105


def test_calendar_dates(silver):
    keys = as_set(star.dim_date(silver, "calendar").select("date_key", "same_week_last_year_key"))
    assert keys == {(20210103, 20200103), (20240229, 20230229)}


def test_products(silver):
    columns = ["pln_id", "broad_category"]
    assert as_set(star.dim_product(silver).select(*columns)) == {(1, "Beverages"), (2, "Confectionery")}
    assert as_set(star.dim_product(silver, "calendar").select(*columns)) == {(1, "Other"), (2, "Confectionery")}


def test_one_row_per_product(spark, silver):
    other_label = frame(spark, SILVER, (DAY, 1, 1.0, "A", "Y", "P0", "B1", "RED WINE", "O1"))
    assert one(star.dim_product(silver.union(other_label)).filter("pln_id = 1"))["pln_label"] == "P1"
    assert star.dim_product(silver.union(other_label), "calendar").filter("pln_id = 1").count() == 2


def test_segments(silver):
    assert as_set(star.dim_segment(silver)) == {("A",), ("Unknown",)}


def test_facts_keep_the_grain(silver):
    same_day, calendar = star.fact_sales(silver), star.fact_sales(silver, "calendar")
    assert same_day.count() == 4
    assert same_day.filter("date_key IS NULL").count() == 1
    assert calendar.count() == 3
    assert sorted(map(tuple, calendar.collect())) == sorted(
        map(tuple, star.join_fact_date(silver, star.dim_date(silver)).collect())
    )
    assert dict(same_day.dtypes) == {
        "date_key": "int",
        "pln_id": "bigint",
        "segment_id": "string",
        "is_promo": "boolean",
        "actual_sales": "float",
    }


def test_variant_is_checked(silver):
    with pytest.raises(ValueError):
        star.build_star(silver, "fiscal")
