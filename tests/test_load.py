import pytest
from pyspark.sql import functions as F

from saleslake.__main__ import main
from saleslake.operators import quality
from saleslake.plans import load
from saleslake.sources import catalog
from saleslake.sources.feed import LINE, read_feed, surplus_cells, write_feed
from saleslake.sources.layers import GOLD_COLUMNS, MONTH, Gold, Layers
from tests.rows import DIRTY, RAW, as_set, frame, one


@pytest.fixture
def feed(spark, folder):
    clean = ("1231022", "1002", "Other", "B1", "CEREAL", "", "7.25", "B", "N")
    header = ("WEEK", "PLN", "PLN_LABEL", "BU", "PRODUCT_CATEGORY_LABEL", "OPSTUDY_LABEL", "ACTUAL", "SEG", "PROMO")
    rows = [DIRTY, DIRTY, clean, header, (None,) * 9]
    write_feed(frame(spark, RAW, *rows), f"{folder}/feed")
    return f"{folder}/feed"


def test_feed_round_trip(spark, feed):
    rows = read_feed(spark, feed)
    assert set(dict(rows.dtypes).values()) == {"string"}
    assert rows.columns[-2:] == ["PROMO,,", LINE]
    assert (*DIRTY, None) in as_set(rows)


def test_lines_of_another_length_keep_their_text(spark, folder):
    lines = ["A|B|C", "1|2", '"1|2|3', "1|2|3|4", "1|2|3|", "", "|||||"]
    spark.createDataFrame([(x,) for x in lines], "v string").coalesce(1).write.text(f"{folder}/t")
    rows = read_feed(spark, f"{folder}/t")
    assert as_set(rows) == {
        ("1", "2", None, "1|2"), ('"1', "2", "3", None), ("1", "2", "3", "1|2|3|4"), ("1", "2", "3", "1|2|3|"), (None, None, None, "|||||"),
    }
    # The same, where a step needs one column only.
    surplus = rows.filter(surplus_cells(F.col(LINE), 3)).select("A", LINE)
    assert as_set(surplus) == {("1", "1|2|3|4"), ("1", "1|2|3|"), (None, "|||||")}
    assert rows.count() == 5
    assert sorted(r["A"] or "" for r in rows.select("A").collect()) == ["", '"1', "1", "1", "1"]


def test_a_line_with_too_many_cells_is_quarantined_with_its_text(spark, feed, folder):
    header = "WEEK|PLN|PLN_LABEL|BU|PRODUCT_CATEGORY_LABEL|OPSTUDY_LABEL|ACTUAL|SEG|PROMO"
    whole, surplus, short = "1231022|1|L|B|C|O|2.5|A|N", "1231022|2|L|x|B|C|O|2.5|A|N", "1231022|3|L|B|C|O|2.5|A"
    with open(f"{folder}/ragged.csv", "w") as out:
        out.write("\n".join([header, whole, surplus, short, header + "|more"]) + "\n")
    report = load.run(spark, f"{folder}/ragged.csv", f"{folder}/out")
    assert tuple(one(report.stats)) == (4, 2, 2, 0) and as_set(report.reasons) == {("Malformed Line", 2)}
    bad = spark.read.parquet(Layers.of(spark, f"{folder}/out").quarantine)
    assert as_set(bad.select(LINE, "ERROR_REASON")) == {(surplus, "Malformed Line"), (header + "|more", "Malformed Line")}
    stored = spark.read.parquet(Layers.of(spark, f"{folder}/out").silver)
    assert LINE not in stored.columns and as_set(stored.select("PLN", "PROMO")) == {(1, "N"), (3, "N")}


def test_whole_load(spark, feed, folder):
    stats = one(load.run(spark, feed, folder).stats)
    assert stats.asDict() == {"total_rows": 5, "quarantined_rows": 2, "silver_rows": 2, "duplicate_rows": 1}
    gold = Gold.read(spark, folder)
    assert gold.fact.count() == 2
    assert Layers.of(spark, folder).folders.keys() == {"quarantine", "silver", *GOLD_COLUMNS}
    reasons = {r["ERROR_REASON"] for r in spark.read.parquet(Layers.of(spark, folder).quarantine).collect()}
    assert reasons == {"Header Pollution", "Missing Critical Keys"}
    assert as_set(gold.products.select("pln_id", "broad_category")) == {(1001, "Confectionery"), (1002, "Grocery")}


def test_loading_twice_gives_the_same(spark, feed, folder):
    load.run(spark, feed, folder)
    before = {t: as_set(df) for t, df in Gold.read(spark, folder).tables().items()}
    load.run(spark, feed, folder)
    assert {t: as_set(df) for t, df in Gold.read(spark, folder).tables().items()} == before


def test_calendar_variant(spark, feed, folder):
    load.run(spark, feed, folder, "calendar")
    assert "same_week_last_year_date" not in Gold.read(spark, folder).dates.columns


def test_catalog(spark, feed, folder):
    load.run(spark, feed, folder)
    for _ in range(2):
        catalog.create_tables(spark, folder, "shop")
    assert spark.table("shop.fact_sales").count() == 2
    for table, columns in GOLD_COLUMNS.items():
        declared = ", ".join(f"{n} {t.upper()}" for n, t in spark.table(f"shop.{table}").drop(MONTH).dtypes)
        assert declared == columns
    spark.sql("DROP DATABASE shop CASCADE")


def test_command_line(spark, feed, folder, capsys):
    base = f"{folder}/out"
    assert main(["load", feed, base]) == 0
    assert "silver_rows" in capsys.readouterr().out
    assert main(["load", f"{folder}/nowhere", base]) == 1
    assert main(["audit", base]) == 0
    assert "unique_plns" in capsys.readouterr().out
    assert main(["parity", feed, "--copy", feed, "--base", base]) == 0
    write_feed(read_feed(spark, feed).limit(1), f"{folder}/part")
    assert main(["parity", feed, "--copy", f"{folder}/part"]) == 1
    assert main(["parity", f"{folder}/part", "--base", base]) == 1


def test_command_line_with_own_rules(spark, feed, folder):
    exact, words = f"{folder}/exact.csv", f"{folder}/words.parquet"
    with open(exact, "w") as out:
        out.write('label,category\nCEREAL,"Food, dry"\n')
    spark.createDataFrame([(0, "Treats", "CHOC")], "priority int, category string, keyword string").write.parquet(words)
    assert main(["load", feed, f"{folder}/out", "--rules", exact, words]) == 0
    products = Gold.read(spark, f"{folder}/out").products
    assert as_set(products.select("pln_id", "broad_category")) == {(1001, "Treats"), (1002, "Food, dry")}


def test_parity(spark, feed, folder):
    rows = read_feed(spark, feed)
    assert one(quality.source_parity(rows, rows))["ok"]
    broken = quality.source_parity(rows, rows.filter("PLN = 'PLN'"))
    assert tuple(one(broken)) == (5, 1, False)
    with pytest.raises(ValueError):
        quality.require(broken)
    quality.require(quality.gold_parity(rows, rows.filter("PLN = 'PLN'")))
    assert not one(quality.gold_parity(rows, rows.filter("FALSE")))["ok"]
    assert not one(quality.gold_parity(rows, rows.union(rows)))["ok"]


def test_files_with_another_header_are_refused(spark, folder):
    for name, lines in (("1", ["A|B", "1|2"]), ("2", ["B|A", "2|1"])):
        with open(f"{folder}/{name}.csv", "w") as out:
            out.write("\n".join(lines) + "\n")
    with pytest.raises(Exception, match="header"):
        read_feed(spark, folder).collect()


def test_catalog_takes_any_path(spark, feed, folder):
    base = f"{folder}/it's"
    load.run(spark, feed, base)
    catalog.create_tables(spark, base, "odd")
    assert spark.table("`odd`.fact_sales").count() == 2
    spark.sql("DROP DATABASE `odd` CASCADE")
