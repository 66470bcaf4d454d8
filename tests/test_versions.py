"""Tables are taken into use together, and a load that fails leaves those of the load before."""

import pathlib

import pytest

from saleslake.__main__ import main
from saleslake.plans import load
from saleslake.sources import catalog, layers
from saleslake.sources.feed import write_feed
from saleslake.sources.layers import Gold, Layers
from saleslake.sources.versions import FOLDER, in_use, new_version, remove_unused, take_into_use
from tests.rows import DIRTY, RAW, as_set, frame


@pytest.fixture
def feeds(spark, folder):
    """Two feeds of different rows."""
    other = ("1231022", "1002", "Other", "B1", "CEREAL", "", "7.25", "B", "N")
    for name, rows in (("one", [DIRTY]), ("two", [DIRTY, other])):
        write_feed(frame(spark, RAW, *rows), f"{folder}/{name}")
    return f"{folder}/one", f"{folder}/two"


def contents(spark, base):
    paths = Layers.of(spark, base)
    stored = {name: as_set(spark.read.parquet(getattr(paths, name))) for name in ("quarantine", "silver")}
    return {**stored, **{name: as_set(df) for name, df in Gold.read(spark, base).tables().items()}}


def versions(base):
    folder = pathlib.Path(base) / FOLDER
    return sorted(p.name for p in folder.iterdir()) if folder.exists() else []


@pytest.mark.parametrize("step", ["write_quarantine", "write_silver", "write_gold"])
def test_a_failed_load_leaves_all_old_tables(spark, feeds, folder, monkeypatch, step):
    base = f"{folder}/lake"
    load.run(spark, feeds[0], base)
    before, kept = contents(spark, base), versions(base)

    def fails(*arguments):
        raise OSError("disk full")

    with monkeypatch.context() as patched:
        patched.setattr(layers, step, fails)
        with pytest.raises(OSError):
            load.run(spark, feeds[1], base)
    assert contents(spark, base) == before and versions(base) == kept
    load.run(spark, feeds[1], base)
    assert len(contents(spark, base)["fact_sales"]) == 2


def test_gold_that_fails_midway_is_not_seen(spark, feeds, folder, monkeypatch):
    """Some gold tables are written, one is not: none of them is taken into use."""
    base = f"{folder}/lake"
    load.run(spark, feeds[0], base)
    before = contents(spark, base)
    build = load.star.build_star

    def broken(*arguments):
        gold = build(*arguments)
        return Gold(gold.fact, gold.dates, gold.products.selectExpr("*", "raise_error('no') AS bad"), gold.segments)

    with monkeypatch.context() as patched:
        patched.setattr(load.star, "build_star", broken)
        with pytest.raises(Exception, match="no"):
            load.run(spark, feeds[1], base)
    assert contents(spark, base) == before


def test_a_reader_that_has_planned_reads_on(spark, feeds, folder):
    base = f"{folder}/lake"
    load.run(spark, feeds[0], base)
    planned = Gold.read(spark, base)
    load.run(spark, feeds[1], base)
    assert planned.fact.count() == 1 and Gold.read(spark, base).fact.count() == 2
    load.run(spark, feeds[1], base)
    assert len(versions(base)) == 2


def test_silver_and_gold_by_themselves(spark, feeds, folder):
    """Silver alone leaves gold in use, and gold follows from silver as stored."""
    base = f"{folder}/lake"
    load.run(spark, feeds[0], base)
    load.load_silver(spark, feeds[1], base)
    assert len(contents(spark, base)["silver"]) == 2 and len(contents(spark, base)["fact_sales"]) == 1
    load.load_gold(spark, base)
    assert len(contents(spark, base)["fact_sales"]) == 2


def test_leftovers_are_removed(spark, feeds, folder, capsys):
    base = f"{folder}/lake"
    assert remove_unused(spark, base) == [] and in_use(spark, base).used == {}
    with pytest.raises(FileNotFoundError):
        Gold.read(spark, base)
    load.run(spark, feeds[0], base)
    # A killed load: its folder is there, nothing points to it.
    spark.range(1).write.parquet(f"{base}/{FOLDER}/killed/silver")
    before = contents(spark, base)
    assert main(["clean", base]) == 0 and "removed killed" in capsys.readouterr().out
    assert contents(spark, base) == before and "killed" not in versions(base)


def test_a_block_that_writes_nothing_changes_nothing(spark, feeds, folder):
    base = f"{folder}/lake"
    load.run(spark, feeds[0], base)
    used = in_use(spark, base).used
    with new_version(spark, base):
        pass
    assert in_use(spark, base).used == used
    take_into_use(spark, base, {"other": "versions/x/other"})
    assert in_use(spark, base).used == {**used, "other": "versions/x/other"} and in_use(spark, base).before == used


def test_the_catalog_follows(spark, feeds, folder):
    base = f"{folder}/lake"
    load.run(spark, feeds[0], base)
    catalog.create_tables(spark, base, "following")
    assert spark.table("following.fact_sales").count() == 1
    load.run(spark, feeds[1], base)
    assert spark.table("following.fact_sales").count() == 1
    catalog.create_tables(spark, base, "following")
    assert spark.table("following.fact_sales").count() == 2
    catalog.analyze(spark, "following")
    rows = {t: spark.sql(f"DESCRIBE EXTENDED following.{t}").filter("col_name = 'Statistics'").first()[1] for t in Gold.read(spark, base).tables()}
    assert rows["fact_sales"].endswith(" 2 rows") and rows["dim_product"].endswith(" 2 rows")
    column = {r[0]: r[1] for r in spark.sql("DESCRIBE EXTENDED following.dim_product pln_id").collect()}
    assert (column["distinct_count"], column["min"], column["max"]) == ("2", "1001", "1002")
    gold = catalog.read_tables(spark, "following")
    stored = Gold.read(spark, base).tables()
    # The declared columns; that of the same-day date table is in the files only.
    assert {t: as_set(df) for t, df in gold.tables().items()} == {t: as_set(stored[t].select(*df.columns)) for t, df in gold.tables().items()}
    spark.sql("DROP DATABASE following CASCADE")
