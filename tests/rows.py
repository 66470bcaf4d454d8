"""Small inline frames."""

RAW = "WEEK string, PLN string, PLN_LABEL string, BU string, PRODUCT_CATEGORY_LABEL string, OPSTUDY_LABEL string, ACTUAL string, SEG string, `PROMO,,` string"
TAGGED = "WEEK string, DATE date, PLN string, PLN_LABEL string, BU string, PRODUCT_CATEGORY_LABEL string, OPSTUDY_LABEL string, PROMO string, SEG string, ACTUAL double, ERROR_REASON string"
DIRTY = ('"1231015"', "1001", '"  mEsSy ItEm NaMe  "', "none", '" cHoCoLaTe  "', " NVLTY/GUM/MINT ", "10.5", "NoSegment-A", '"Y",,')


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def tagged_row(**changes):
    import datetime

    row = {
        "WEEK": "1",
        "DATE": datetime.date(2023, 1, 1),
        "PLN": "1001",
        "PLN_LABEL": "Item",
        "BU": "BU1",
        "PRODUCT_CATEGORY_LABEL": "Cat",
        "OPSTUDY_LABEL": "Op",
        "PROMO": "N",
        "SEG": "A",
        "ACTUAL": 5.0,
        "ERROR_REASON": "Valid",
        **changes,
    }
    return tuple(row.values())


def one(df):
    found = df.collect()
    assert len(found) == 1
    return found[0]


def as_set(df):
    return {tuple(r) for r in df.collect()}
