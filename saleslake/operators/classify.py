"""Classification with rule tables of any size.

``functions.taxonomy`` turns the rules into one expression. Here they stay tables: every part of a label that is as long as some keyword is looked up with
an equi-join, so there is no label-by-keyword comparison and no rule ever has to fit
in one process.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from saleslake.functions.fixed_values import OTHER, UNMAPPED
from saleslake.functions.text import strip


@dataclass(frozen=True)
class RuleTables:
    """``exact(label, category)`` and ``keywords(priority, category, keyword)``."""

    exact: DataFrame
    keywords: DataFrame


def keyword_matches(texts: DataFrame, keywords: DataFrame) -> DataFrame:
    """``(text)`` to ``(text, category)`` of the first category with a keyword in it."""
    # Keyword lengths are few by nature: an array no longer than the longest keyword.
    lengths = keywords.agg(F.collect_set(F.length("keyword"))).scalar()
    sized = texts.withColumn("sizes", lengths).withColumn("size", F.explode("sizes"))
    parts = (
        sized.filter(F.col("size") <= F.length("text"))
        .withColumn("start", F.explode(F.sequence(F.lit(1), F.length("text") - F.col("size") + 1)))
        .select("text", F.substring("text", F.col("start"), F.col("size")).alias("keyword"))
        .distinct()
    )
    first = F.min(F.struct("priority", "category")).getField("category")
    return parts.join(keywords, "keyword").groupBy("text").agg(first.alias("swept"))


def classify_labels(
    labels: DataFrame, exact: DataFrame, keywords: DataFrame, as_listed: bool = False
) -> DataFrame:
    """``(label)`` to ``(label, broad_category)``, one row per distinct label. With
    ``as_listed`` a label is compared as it stands, otherwise trimmed and upper-cased."""
    label = F.col("label")
    text = label if as_listed else F.upper(strip(label))
    texts = labels.select("label").distinct().select("label", text.alias("text"))
    listed = exact.select(F.col("label").alias("text"), F.col("category").alias("listed"))
    swept = keyword_matches(texts.select("text").distinct(), keywords)
    return (
        texts.join(listed, "text", "left")
        .join(swept, "text", "left")
        .select("label", F.coalesce("listed", "swept", F.lit(OTHER)).alias("broad_category"))
    )


def map_category(products: DataFrame, category_map: DataFrame, missing: str = UNMAPPED) -> DataFrame:
    """Products LEFT JOIN ``(legacy_category_label, broad_category)``."""
    return products.join(category_map, "legacy_category_label", "left").withColumn(
        "broad_category", F.coalesce("broad_category", F.lit(missing))
    )
