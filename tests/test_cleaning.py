import datetime

import pytest
from pyspark.sql import functions as F

from saleslake.functions import dates, text
from saleslake.operators.cleaning import clean, quarantine_rows, valid_rows
from tests.rows import DIRTY, RAW, frame, one

FIRST = "WEEK string, PLN string, ACTUAL double, `PROMO,,` string, SEG string, PRODUCT_CATEGORY_LABEL string, OPSTUDY_LABEL string, PLN_LABEL string"


@pytest.fixture
def cleaned(spark):
    return clean(
        frame(
            spark,
            FIRST,
            ('"1231015"', "1001", 10.5, '"Y",,', "NoSegment-A", '"Candy"', " Test ", "Item 1"),
            ("1231016", "PLN", 0.0, "N", "B", "Snacks", "Test2", "Item 2"),
            (None, None, None, None, None, None, None, None),
        )
    )


def test_header_is_repaired(cleaned):
    assert "PROMO" in cleaned.columns
    assert "PROMO,," not in cleaned.columns


def test_valid_row(cleaned):
    row = one(cleaned.filter("ERROR_REASON = 'Valid'"))
    assert row["DATE"] == datetime.date(2023, 10, 15)
    assert (row["PROMO"], row["SEG"]) == ("Y", "A")
    assert (row["PRODUCT_CATEGORY_LABEL"], row["OPSTUDY_LABEL"], row["PLN_LABEL"]) == ("CANDY", "TEST", "ITEM 1")


def test_every_bad_row_is_tagged(cleaned):
    reasons = {r["ERROR_REASON"] for r in quarantine_rows(cleaned).collect()}
    assert reasons == {"Header Pollution", "Missing Critical Keys"}
    assert valid_rows(cleaned).count() == 1
    assert dict(valid_rows(cleaned).dtypes)["PLN"] == "bigint"


def test_empty_row(spark):
    row = one(clean(frame(spark, FIRST.replace("`PROMO,,`", "PROMO"), (None,) * 8)))
    assert row["ERROR_REASON"] == "Missing Critical Keys"


@pytest.mark.parametrize(
    "key, amount, reason",
    [
        ("PLN", None, "Header Pollution"),
        ("12x", "1.0", "Missing Critical Keys"),
        ("12", "n/a", "Missing Critical Keys"),
        ("12", "-1.5", "Valid"),
    ],
)
def test_cells_that_do_not_parse(spark, key, amount, reason):
    row = list(DIRTY)
    row[1], row[6] = key, amount
    assert one(clean(frame(spark, RAW, tuple(row))))["ERROR_REASON"] == reason


def evaluate(spark, value, function):
    return frame(spark, "x string", (value,)).select(function(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "code, date",
    [
        ('"1231015"', datetime.date(2023, 10, 15)),
        ("1150208", datetime.date(2015, 2, 8)),
        ("990101", datetime.date(1999, 1, 1)),
        ("1231315", None),
        ("1230229", None),
        ("WEEK", None),
        ("", None),
        (None, None),
        ("99999999999999", None),
        ("9223372036854775807", None),
    ],
)
def test_week_codes(spark, code, date):
    assert evaluate(spark, code, dates.legacy_date) == date


@pytest.mark.parametrize("given, left", [("Y,,", "Y"), ("Y,", "Y,"), (",,,", ","), (",,,,", ""), (None, None)])
def test_commas(spark, given, left):
    assert evaluate(spark, given, text.drop_commas) == left


def test_all_white_space_is_stripped(spark):
    assert evaluate(spark, '\t "  a b "　\r\n', text.tidy_label) == "A B"


@pytest.mark.parametrize("alias", ["na", " NONE ", "Unknown", "NaN", "null", "", "  ", "NoBusinessUnit", "\tna"])
def test_null_aliases(spark, alias):
    assert evaluate(spark, alias, text.null_if_alias) is None


def test_other_texts_stay_as_they_are(spark):
    assert evaluate(spark, " Nations ", text.null_if_alias) == " Nations "
