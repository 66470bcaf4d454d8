import pytest
from pyspark.sql import functions as F

from saleslake.functions.taxonomy import Taxonomy, broad_category, listed_category
from saleslake.operators.classify import RuleTables, classify_labels
from saleslake.operators.star import dim_product
from tests.rows import frame

CASES = [
    ("CHOCOLATE", "Confectionery"),
    ("   cHoCoLaTe  ", "Confectionery"),
    ("DAILY VITAMINS", "Health"),
    ("RED WINE 750ML", "Beverages"),
    ("red wine 750ml", "Beverages"),
    ("WEIRD UNKNOWN OBJECT", "Other"),
    ("SOMETHING ELSE", "Other"),
    ("   ", "Other"),
    ("", "Other"),
    (None, "Other"),
    ("STEAK KNIFE", "Beverages"),  # TEA
    ("LATEX GLOVE", "Health"),  # also a word of Apparel, Health comes first
    ("SPONGE MOP", "Beauty"),  # also a word of Household
    ("GIFT CARD", "Toys"),  # CARD comes before GIFT CARD
]


def rule_tables(spark, rules):
    words = [(i, c, w) for i, (c, ws) in enumerate(rules.keywords.items()) for w in ws]
    return RuleTables(
        spark.createDataFrame(list(rules.exact.items()), "label string, category string"),
        spark.createDataFrame(words, "priority int, category string, keyword string"),
    )


@pytest.mark.parametrize("label, category", CASES)
def test_expression(spark, label, category):
    df = frame(spark, "label string", (label,))
    assert df.select(broad_category(F.col("label")).alias("c")).first()["c"] == category


def test_rule_tables_give_the_same(spark):
    labels = frame(spark, "label string", *[(label,) for label, _ in CASES])
    tables = rule_tables(spark, Taxonomy())
    found = {r["label"]: r["broad_category"] for r in classify_labels(labels, tables.exact, tables.keywords).collect()}
    assert {k: v for k, v in found.items() if k is not None} == {k: v for k, v in CASES if k is not None}


def test_listed_labels_only(spark):
    df = frame(spark, "label string", ("CHOCOLATE",), ("RED WINE 750ML",), (None,))
    assert [r[0] for r in df.select(listed_category(F.col("label"))).collect()] == ["Confectionery", "Other", "Other"]


def by_hand(text):
    """The rules as they are told: listed, else the first category with a word in the text."""
    rules = Taxonomy()
    found = [c for c, words in rules.keywords.items() if any(w in text for w in words)]
    return rules.exact.get(text) or (found[0] if found else "Other")


def test_the_rule_files_are_whole():
    rules = Taxonomy()
    assert (len(rules.exact), len(rules.keywords), sum(map(len, rules.keywords.values()))) == (229, 17, 493)
    assert list(rules.keywords)[:3] == ["Beverages", "Confectionery", "Health"] and list(rules.keywords)[-1] == "Other"


def test_every_listed_label_and_every_keyword(spark):
    rules = Taxonomy()
    texts = [*rules.exact, *[w for ws in rules.keywords.values() for w in ws], *[f"1 {w} x" for ws in rules.keywords.values() for w in ws]]
    df = spark.createDataFrame([(t,) for t in texts], "label string")
    inline = df.select("label", broad_category(F.col("label")).alias("c")).collect()
    assert [(r["label"], r["c"]) for r in inline] == [(t, by_hand(t)) for t in texts]
    tables = rule_tables(spark, rules)
    joined = {r["label"]: r["broad_category"] for r in classify_labels(df, tables.exact, tables.keywords).collect()}
    assert joined == {t: by_hand(t) for t in texts}
    listed = df.select("label", listed_category(F.col("label")).alias("c")).collect()
    assert [r["c"] for r in listed] == [rules.exact.get(t, "Other") for t in texts]


def test_own_rules(spark):
    own = Taxonomy({"A.B": "One"}, {"Two": ["X+Y", "(Z)"], "Three": ["X"]})
    df = frame(spark, "label string", ("a.b",), ("AxB",), ("ax+yb",), ("(z)",), ("Q",))
    want = ["One", "Three", "Two", "Two", "Other"]
    assert [r[0] for r in df.select(broad_category(F.col("label"), own)).collect()] == want
    tables = rule_tables(spark, own)
    joined = {r["label"]: r["broad_category"] for r in classify_labels(df, tables.exact, tables.keywords).collect()}
    assert [joined[r["label"]] for r in df.collect()] == want


@pytest.mark.parametrize("variant", ["same_day", "calendar"])
def test_product_table_by_expression_and_by_join(spark, variant):
    columns = "PLN bigint, PLN_LABEL string, PRODUCT_CATEGORY_LABEL string, OPSTUDY_LABEL string, BU string"
    rows = [(i, f"P{i}", label, "O", "B") for i, (label, _) in enumerate(CASES)]
    products = frame(spark, columns, *rows)
    inline = dim_product(products, variant)
    joined = dim_product(products, variant, rule_tables(spark, Taxonomy())).select(*inline.columns)
    assert sorted(map(tuple, inline.collect())) == sorted(map(tuple, joined.collect()))
    missing = {"same_day": "Other / Miscellaneous", "calendar": "Other"}[variant]
    assert {r["broad_category"] for r in inline.filter("legacy_category_label IS NULL").collect()} == {missing}
