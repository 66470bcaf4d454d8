import datetime

import pytest

from saleslake.sources import literals
from tests.rows import as_set


def test_rows_of_a_literal_table(spark):
    rows = [("it's", 1, datetime.date(2020, 1, 5), 2.5, True), (None, None, None, None, None), ("\\n:a ?", -(2**40), None, float("inf"), False)]
    table = literals.table(spark, "`a.b` string, n long, d date, x double, y boolean", rows)
    assert [f.simpleString() for f in table.schema] == ["a.b:string", "n:bigint", "d:date", "x:double", "y:boolean"]
    assert as_set(table) == set(rows)
    # Order and pairs survive many rows.
    many = [(f"k{i}", i) for i in range(600)]
    assert [tuple(r) for r in literals.table(spark, "k string, i int", many).orderBy("i").collect()] == many
    assert literals.table(spark, "k string, i int", []).collect() == []
    with pytest.raises(ValueError):
        literals.table(spark, "k string, i int", [("a", 1), ("b",)])


def test_it_is_part_of_the_plan(spark):
    table = literals.table(spark, "k string, i int", [("a", 1), ("b", 2)])
    joined = spark.range(10).selectExpr("cast(id as int) AS i").join(table, "i")
    text = joined._jdf.queryExecution().executedPlan().toString()
    assert "LocalTableScan" in text and "BroadcastHashJoin" in text and "Python" not in text
