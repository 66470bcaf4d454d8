"""Connected components of a graph in tables: labels move to the least id, jumping over labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from saleslake.llm.tables import written


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` (the least id reachable) of every id in ``edges`` (columns ``a, b``).

    Each round every id takes the least label among its neighbours' and its own, then the label
    of that label; a path of n ids settles in about log n rounds. Both tables are written each
    round, so a lost executor costs a read. Nothing is collected but one count a round. Edges
    within a component are dropped as they appear, so the table of edges shrinks.
    """
    both = edges.filter("a <> b").select("a", "b")
    edges = written(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(edges.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("component")), "labels")
    while True:
        label_of = labels.select(F.col("id").alias("b"), F.col("component").alias("of_b"))
        own = labels.select(F.col("id").alias("a"), F.col("component").alias("of_a"))
        open_edges = written(edges.join(label_of, "b").join(own, "a").filter("of_a <> of_b"), "open")
        if not open_edges.take(1):
            return _settled(labels)
        # An id offers the labels next to it to its own label, so that whole trees are hooked.
        offers = open_edges.groupBy(F.col("of_a").alias("id")).agg(F.min("of_b").alias("offer"))
        hooked = offers.filter("offer < id").withColumnRenamed("id", "component")
        labels = written(
            labels.join(hooked, "component", "left").select("id", F.coalesce("offer", "component").alias("component")), "labels"
        )
        labels = _settled(labels)
        edges = open_edges.select("a", "b")


def _settled(labels: DataFrame) -> DataFrame:
    """Labels that are followed to their end."""
    while True:
        up = labels.select(F.col("id").alias("component"), F.col("component").alias("above"))
        jumped = labels.join(up, "component", "left").select(
            "id", F.coalesce("above", "component").alias("component"), (F.col("above") < F.col("component")).alias("moved")
        )
        jumped = written(jumped, "labels")
        if not jumped.filter("moved").take(1):
            return jumped.select("id", "component")
        labels = jumped.select("id", "component")
