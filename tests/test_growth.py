"""What must not grow faster than the input: rows held, sorted or moved on the way."""

import pathlib
import re

from checks.lake import raw_feed
from checks.registry import QUERIES
from saleslake.operators import audit, silver
from saleslake.plans import load
from saleslake.sources import feed as feeds
from saleslake.sources.feed import read_feed, write_feed
from tests.rows import DIRTY, RAW, TAGGED, as_set, frame, tagged_row

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_task_holds_its_split_to_find_copies(spark):
    """Rows are dealt out as they are and compared once they have met, over one shuffle."""
    text = plan(silver.drop_copies(frame(spark, TAGGED, tagged_row())))
    assert text.count("Exchange ") == 1
    assert "Aggregate" not in text[text.index("Exchange ") :]


def test_copies_are_the_same_whatever_their_numbers_look_like(spark):
    texts = "(0.0D, 'a'), (-0.0D, 'a'), (double('NaN'), 'b'), (double('NaN'), 'b'), (1.5D, null), (1.5D, null), (null, null), (null, null)"
    rows = spark.sql(f"SELECT * FROM VALUES {texts} AS t(`amount.1`, `name,,`)").repartition(4)
    assert sorted(map(str, silver.drop_copies(rows).collect())) == sorted(map(str, rows.distinct().collect()))
    assert silver.drop_copies(rows).count() == 4


def test_tagged_rows_are_written_as_they_come(spark, folder, monkeypatch):
    """A folder per tag would sort every task's rows."""
    plans = []

    def written(df, path, partition_by=None):
        plans.append((path.rsplit("/", 1)[-1], partition_by))
        return keep(df, path, partition_by)

    keep = load.written
    monkeypatch.setattr(load, "written", written)
    write_feed(frame(spark, RAW, DIRTY, DIRTY, (None,) * 9), f"{folder}/feed")
    stats = load.run(spark, f"{folder}/feed", f"{folder}/lake").stats.first()
    assert tuple(stats) == (3, 1, 1, 1)
    assert ("tagged", None) in plans


def test_a_packed_feed_has_the_same_rows_in_files_of_bounded_length(spark, folder, monkeypatch):
    monkeypatch.setattr(feeds, "PACKED_ROWS", 40)
    rows = raw_feed(spark, SF_DIR).limit(200).coalesce(1).localCheckpoint()
    write_feed(rows, f"{folder}/plain")
    write_feed(rows, f"{folder}/packed", packed=True)
    assert len(list(pathlib.Path(folder, "packed").glob("*.csv.gz"))) == 5
    plain, packed = (sorted(map(str, read_feed(spark, f"{folder}/{name}").collect())) for name in ("plain", "packed"))
    assert plain == packed and len(packed) == 200


def test_labels_are_counted_before_they_meet_the_literals(spark):
    """No task gets all rows of one of the few labels."""
    text = plan(QUERIES["src_literal"](spark, SF_DIR))
    assert re.search(r"partial_count", text[re.search(r"Join ", text).start() :])


def test_the_showcase_moves_each_text_once_to_find_copies(spark):
    rows = frame(spark, RAW.replace("ACTUAL string", "ACTUAL double"), *[(*DIRTY[:6], 10.5, *DIRTY[7:])] * 3, (*DIRTY[:6], -1.0, *DIRTY[7:]))
    shown = audit.showcase(rows)
    dealt = next(line for line in plan(shown).splitlines() if "REPARTITION_BY_NUM" in line)
    assert "PLN_LABEL" in dealt and "DATE" not in dealt
    texts = as_set(shown.select("raw_week", "raw_pln", "raw_pln_label", "raw_actual", "raw_promo", "ACTUAL", "PROMO", "PLN_LABEL"))
    assert texts == {(*DIRTY[:3], a, DIRTY[8], float(a), "Y", "MESSY ITEM NAME") for a in ("10.5", "-1.0")}
    assert shown.count() == 2
