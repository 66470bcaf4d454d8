import duckdb
import pytest
from pyspark.sql import functions as F

from checks.compare import difference
from saleslake.llm.queries import SHARDS_SQL
from saleslake.llm.sharding import document_shards, write_shards
from tests.llm.odd import documents, odd_documents


@pytest.mark.parametrize("limit", [100_000, 3_000, 100])
def test_only_oversized_shards_split(spark, limit):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    connection = duckdb.connect()
    connection.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    assert difference(document_shards(docs, limit), connection, SHARDS_SQL.format(limit=limit)) == ""


def test_a_hot_key_splits(spark):
    i = F.col("id")
    rows = spark.range(3000).select(
        F.when(i % 3 == 0, 7).when(i % 3 == 1, None).otherwise(i).alias("doc_id"), F.lit("x" * 100).alias("text"), i.alias("shard")
    )
    out = document_shards(rows, 10_000).collect()
    assert len(out) == 3000 and max(r.shard_bytes for r in out) <= 10_000
    names = {r.shard for r in out}
    assert not [a for a in names for b in names if a != b and b.startswith(a)]


def test_odd_documents(spark, folder):
    out = document_shards(odd_documents(spark), 1000).collect()
    assert len(out) == 12
    assert all(r.shard_bytes <= 1000 or r.shard_docs == 1 for r in out)
    assert {r.n_bytes for r in out if r.doc_id in (1, 2)} == {0}
    empty = documents(spark, [])
    assert document_shards(empty, 10).collect() == []
    write_shards(odd_documents(spark).drop("shard"), f"{folder}/shards", 1000)
    assert spark.read.parquet(f"{folder}/shards").count() == 12


def test_no_python_on_the_main_path(spark):
    plan = document_shards(odd_documents(spark), 1000)._jdf.queryExecution().executedPlan().toString()
    assert not [w for w in ("Python", "Arrow", "Pandas") if w in plan]
