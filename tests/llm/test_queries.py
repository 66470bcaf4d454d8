"""The registered queries against their SQL, and the pipeline stage by stage."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from checks.compare import connect, difference
from saleslake.llm.quality_classifier import fit
from saleslake.llm.language_id import remainder
from saleslake.llm.registry import ORACLE, QUERIES
from saleslake.llm.tables import written
from tests.llm.odd import brute_components, documents, odd_documents
from tests.llm.test_secrets import plain

SF = "/root/testdata/sf0.01"


def test_all_are_registered():
    names = list(entry.queries())
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("name", list(ORACLE))
def test_equals_its_sql(spark, name):
    assert difference(QUERIES[name](spark, SF), connect(SF), ORACLE[name]) == ""


def masked_plainly(text):
    parts, at = [], 0
    for _, start, end in plain(text):
        if start >= at:
            parts += [text[at:start], "[SECRET]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def test_stages_against_brute_force(spark):
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")

    def run(name, df):
        return written(stages[name](spark, df, SF), name)

    def rows(df):
        return {r.doc_id: r for r in df.collect()}

    classified = run("quality_classifier", docs)
    model = fit(docs, labels.filter(remainder(3) != 1))
    assert set(rows(classified)) == {i for i, r in rows(docs).items() if model.score(r.text) >= 0.5}

    ruled = run("quality_rules", classified)
    connection = duckdb.connect()
    connection.register("documents", classified.toArrow())
    kept = connection.execute(f"SELECT doc_id FROM ({ORACLE['op5_quality_rules']}) WHERE kept").fetchall()
    assert set(rows(ruled)) == {i for (i,) in kept}

    alone = run("minhash_near_dedup", ruled)
    found = brute_components([(i, r.text) for i, r in sorted(rows(ruled).items())], 5, 80)
    assert set(rows(alone)) == {i for i, _, least in found if i == least}

    masked = run("secret_scans", alone)
    assert {i: r.text for i, r in rows(masked).items()} == {i: masked_plainly(r.text) for i, r in rows(alone).items()}
    for df in (classified, ruled, alone, masked):
        assert df.columns == docs.columns

    packed = run("packing", masked).collect()
    assert {r.doc_id for r in packed} == set(rows(masked))
    sequences = {}
    for r in packed:
        sequences[r.sequence_id] = sequences.get(r.sequence_id, 0) + r.length
    assert max(sequences.values()) <= 2048


@pytest.mark.parametrize("empty", [False, True])
def test_stages_take_odd_documents(spark, empty):
    docs = documents(spark, []) if empty else odd_documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        after = written(stage(spark, docs, SF), name)
        after.collect()
        if name != "packing":
            assert sorted(after.columns) == sorted(docs.columns)
