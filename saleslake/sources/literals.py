"""Tables of literals, such as rules and names, for plans to join."""

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, columns: str, rows: Iterable[tuple]) -> DataFrame:
    """A relation of the given rows, ``columns`` as in a table definition (``code STRING, n INT``).

    The rows are a VALUES relation inside the plan: no job, no file and no Python makes them, the
    optimizer knows their number and size, and a join with them is planned accordingly. Values are
    parameters, never SQL text. No rows give an empty relation of these columns."""
    given = [tuple(row) for row in rows]
    empty = spark.createDataFrame([], columns)
    if not given:
        return empty
    fields = empty.schema.fields
    if any(len(row) != len(fields) for row in given):
        raise ValueError(f"every row must have {len(fields)} values")
    names = [f"c{i}" for i in range(len(fields))]
    cells = {f"r{at}{name}": cell for at, row in enumerate(given) for name, cell in zip(names, row)}
    marks = ", ".join("(" + ", ".join(f":r{at}{name}" for name in names) + ")" for at in range(len(given)))
    values = spark.sql(f"SELECT * FROM VALUES {marks} AS v({', '.join(names)})", args=cells)
    return values.selectExpr(*[f"CAST({n} AS {f.dataType.simpleString()}) AS `{f.name}`" for n, f in zip(names, fields)])
