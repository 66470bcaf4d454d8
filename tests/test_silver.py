import datetime

import pytest

from saleslake.operators import silver
from saleslake.operators.cleaning import clean, valid_rows
from tests.rows import DIRTY, RAW, TAGGED, as_set, frame, one, tagged_row

OLD, NEW = datetime.date(2023, 1, 1), datetime.date(2023, 12, 31)


def to_silver(spark, *rows):
    return silver.to_silver(frame(spark, TAGGED, *rows))


def test_newest_labels_heal_older_rows(spark):
    healed = to_silver(
        spark,
        tagged_row(WEEK="old", DATE=OLD, PLN_LABEL="Old Name", PRODUCT_CATEGORY_LABEL="Old Cat"),
        tagged_row(WEEK="new", DATE=NEW, PLN_LABEL="New Name", PRODUCT_CATEGORY_LABEL="New Cat"),
    )
    assert healed.count() == 2
    assert as_set(healed.select("PLN_LABEL", "PRODUCT_CATEGORY_LABEL")) == {("New Name", "New Cat")}


def test_each_attribute_has_its_own_newest_row(spark):
    healed = to_silver(
        spark,
        tagged_row(DATE=OLD, PLN_LABEL="Old Name", BU="Old BU"),
        tagged_row(DATE=NEW, PLN_LABEL="na", BU="New BU"),
    )
    assert as_set(healed.select("PLN_LABEL", "BU")) == {("Old Name", "New BU")}


def test_undated_rows_are_oldest_and_ties_go_to_the_greatest_text(spark):
    healed = to_silver(
        spark,
        tagged_row(WEEK=None, DATE=None, PLN_LABEL="Z", BU="Z"),
        tagged_row(WEEK="1", DATE=OLD, PLN_LABEL="A", BU="none"),
        tagged_row(WEEK="1", DATE=OLD, PLN_LABEL="B", BU="none"),
    )
    assert as_set(healed.select("PLN_LABEL", "BU")) == {("B", "Z")}


def test_null_aliases_become_unknown(spark):
    row = one(to_silver(spark, tagged_row(PLN_LABEL="na", BU="none", PRODUCT_CATEGORY_LABEL="UNKNOWN", OPSTUDY_LABEL="")))
    assert {row[c] for c in silver.ATTRIBUTES} == {"Unknown"}


def test_study_names(spark):
    assert one(to_silver(spark, tagged_row(OPSTUDY_LABEL="NVLTY/GUM/MINT")))["OPSTUDY_LABEL"] == "Gum & Mints"
    assert one(to_silver(spark, tagged_row(OPSTUDY_LABEL="OTHER OPS")))["OPSTUDY_LABEL"] == "OTHER OPS"


def test_exact_copies_collapse(spark):
    assert to_silver(spark, *[tagged_row()] * 3).count() == 1


def test_copies_are_found_before_aliases(spark):
    """``na`` and null mean the same, but they are two rows."""
    assert to_silver(spark, tagged_row(SEG="na"), tagged_row(SEG=None)).count() == 2


def test_gaps_are_filled(spark):
    row = one(to_silver(spark, tagged_row(**dict.fromkeys([*silver.ATTRIBUTES, "PROMO", "SEG"]))))
    assert (row["PROMO"], row["SEG"], row["PLN_LABEL"]) == ("N", "Unknown", "Unknown")


def test_dirty_row_from_feed_to_silver(spark):
    row = one(silver.to_silver(clean(frame(spark, RAW, DIRTY)))).asDict()
    assert row == {
        "DATE": datetime.date(2023, 10, 15),
        "PLN": 1001,
        "ACTUAL": 10.5,
        "SEG": "A",
        "PROMO": "Y",
        "PLN_LABEL": "MESSY ITEM NAME",
        "BU": "Unknown",
        "PRODUCT_CATEGORY_LABEL": "CHOCOLATE",
        "OPSTUDY_LABEL": "Gum & Mints",
    }


def test_types(spark):
    types = dict(to_silver(spark, tagged_row()).dtypes)
    assert (types["PLN"], types["ACTUAL"], types["DATE"]) == ("bigint", "float", "date")
    assert "WEEK" not in types


@pytest.mark.parametrize("seed", range(3))
def test_golden_records_against_brute_force(spark, seed):
    import random

    rng = random.Random(seed)
    days = [None, OLD, NEW, datetime.date(2022, 5, 1)]
    names = ["a", "b", "na", None, "c"]
    rows = [
        tagged_row(
            WEEK=str(i),
            PLN=str(rng.randrange(5)),
            DATE=rng.choice(days),
            **{c: rng.choice(names) for c in silver.ATTRIBUTES},
        )
        for i in range(200)
    ]
    found = silver.golden_records(valid_rows(frame(spark, TAGGED, *rows)))
    position = {c: i for i, c in enumerate(["WEEK", "DATE", "PLN", *silver.ATTRIBUTES])}
    for record in found.collect():
        for c in silver.ATTRIBUTES:
            known = [
                (r[1] or datetime.date.min, r[position[c]])
                for r in rows
                if int(r[2]) == record["PLN"] and r[position[c]] not in (None, "na")
            ]
            assert record[c] == (max(known)[1] if known else None)
