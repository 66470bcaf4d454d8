"""Raw feed to tagged rows: one projection, no shuffle."""

from pyspark.sql import DataFrame, functions as F

from saleslake.functions import dates, flags, text
from saleslake.functions.fixed_values import VALID
from saleslake.sources.feed import LINE, fix_promo_header, surplus_cells

LABELS = ["PLN_LABEL", "PRODUCT_CATEGORY_LABEL", "OPSTUDY_LABEL"]


def clean(raw: DataFrame) -> DataFrame:
    """Clean texts, parse the week code and the amount, and tag every row.
    Nothing is dropped, and a cell that does not parse becomes null. A line with too few cells is
    judged by those it has, one with too many is tagged and keeps its text."""
    raw = fix_promo_header(raw)
    cleaned = raw.withColumns(
        {
            "DATE": dates.legacy_date(F.col("WEEK").cast("string")),
            "PLN": F.col("PLN").cast("string"),
            "ACTUAL": F.col("ACTUAL").try_cast("double"),
            "PROMO": text.drop_commas(text.unquote(F.col("PROMO").cast("string"))),
            "SEG": text.drop_segment_prefix(F.col("SEG").cast("string")),
            **{c: text.tidy_label(F.col(c).cast("string")) for c in LABELS},
        }
    )
    surplus = surplus_cells(F.col(LINE), len(raw.columns) - 1) if LINE in raw.columns else None
    return cleaned.withColumn("ERROR_REASON", flags.error_reason(F.col("PLN"), F.col("ACTUAL"), surplus))


def quarantine_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("ERROR_REASON") != VALID)


def valid_rows(tagged: DataFrame) -> DataFrame:
    """Valid rows without their tag and the text of their line; the key becomes a number here."""
    return (
        tagged.filter(F.col("ERROR_REASON") == VALID)
        .drop("ERROR_REASON", LINE)
        .withColumn("PLN", F.col("PLN").try_cast("bigint"))
    )
