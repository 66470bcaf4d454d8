import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from saleslake.llm import near_dedup
from saleslake.llm.components import components
from saleslake.llm.near_dedup import estimates, keep_one_of_each, near_duplicates, registers, shingles
from saleslake.llm.tables import written
from tests.llm.odd import LONG, brute_components, documents, odd_documents, shingle_set


def copies(rng, base, edits):
    words = base.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(seed, groups=12, size=12, words=60, edits=4):
    """Groups of copies with few to many edits, some exact, and a passage that many share."""
    rng, texts = random.Random(seed), []
    passage = " ".join(f"p{i}" for i in range(25))
    for g in range(groups):
        base = " ".join(f"g{g}x{rng.randrange(500)}" for _ in range(words))
        texts += [copies(rng, base, rng.randint(0, edits)) + (" " + passage if g % 3 == 0 else "") for _ in range(size)]
    texts += [copies(rng, passage, 0).upper() + f" tail{i} of{i} it{i} {' '.join(f'n{i}y{k}' for k in range(i % 50))}" for i in range(40)]
    texts += ["", None, "one", "ONE", "one two", "one  two", "\n\t "]
    rng.shuffle(texts)
    return list(enumerate(texts))


def found(spark, rows, width, percent):
    out = near_duplicates(documents(spark, rows), width, percent).collect()
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in out), out


@pytest.mark.parametrize("seed, width, percent", [(1, 3, 85), (2, 5, 80)])
def test_equals_all_pairs(spark, seed, width, percent):
    rows = corpus(seed)
    got, out = found(spark, rows, width, percent)
    assert got == sorted(brute_components(rows, width, percent))
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_a_large_group_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 16)
    rows = corpus(3, groups=1, size=150, edits=6)
    assert found(spark, rows, 3, 85)[0] == sorted(brute_components(rows, 3, 85))


def test_estimates_follow_similarity():
    rng = random.Random(7)
    for share in (0.3, 0.6, 0.85):
        errors = []
        for _ in range(40):
            common = [rng.getrandbits(60) for _ in range(int(400 * share))]
            a, b = (common + [rng.getrandbits(60) for _ in range(400 - len(common))] for _ in "ab")
            true = len(set(a) & set(b)) / len(set(a) | set(b))
            same = (registers(np.array(a, dtype=np.uint64), 80) == registers(np.array(b, dtype=np.uint64), 80)).mean()
            errors.append(float(estimates(np.array([same]), np.array([400.0]), np.array([400.0]))[0]) - true)
        assert abs(np.mean(errors)) < 0.03 and np.max(np.abs(errors)) < 0.25


def test_shingles_are_the_sets_of_word_windows():
    for text in ["", "a", "A a", "a b c a b c a", "x\x0by\x0cz   é É", LONG]:
        for width in (1, 3, 5):
            assert len(shingles(text, width)) == len(shingle_set(text, width))
    assert (shingles("A\tB  c", 3) == shingles("a b C", 3)).all()
    assert len(set(shingles("a b", 3)) | set(shingles("a b a", 3)) | set(shingles("ab", 3))) == 3


def test_odd_documents(spark):
    out = near_duplicates(odd_documents(spark), 3, 85).collect()
    assert len(out) == 12
    of = {r.doc_id: r for r in out}
    assert (of[5].component_id, of[6].component_id, of[6].kept) == (5, 5, False)
    assert all((of[i].n_shingles, of[i].component_id, of[i].kept) == (0, i, True) for i in (1, 2, 3))
    assert all(r.component_id is None and r.kept is None for r in out if r.doc_id is None)
    left = keep_one_of_each(odd_documents(spark))
    assert left.columns == odd_documents(spark).columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == [1, 2, 3, 4, 5, 7, 8, 9]
    assert left.filter("doc_id IS NULL").count() == 2


def test_ids_that_occur_with_several_texts(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(30)) for c in "ab")
    out = near_duplicates(documents(spark, [(9, a), (9, b), (4, a), (7, b), (8, "other words here")]), 3, 85).collect()
    assert {(r.doc_id, r.component_id) for r in out} == {(9, 4), (4, 4), (7, 4), (8, 8)}


@pytest.mark.parametrize("common, linked", [(900, False), (920, True)])
def test_blocks_link_by_the_sets_at_hand(common, linked):
    one, two = np.arange(1000), np.arange(1000) + 1000 - common
    rows = [(1, 100, one), (1, 1000, one), (2, 1000, two)]  # the first with n of another text of its id
    bands = [np.ones(19, dtype=np.int64)] * 3
    table = pa.table(
        {
            "id": [r[0] for r in rows], "component": [r[0] for r in rows], "band": [0] * 3, "n": [r[1] for r in rows], "bands": bands,
            "block": [0] * 3, "one": [0] * 3, "two": [0] * 3, "shingles": pa.array([r[2] for r in rows], pa.list_(pa.int64())),
        }
    )
    links = near_dedup._block_links(table, 85, near_dedup.least_estimate(85)).to_pylist()
    assert {frozenset(x.values()) for x in links} == ({frozenset((1, 2))} if linked else set())


def test_empty_table(spark):
    assert near_duplicates(documents(spark, []), 3, 85).collect() == []
    assert keep_one_of_each(documents(spark, [])).collect() == []


@pytest.mark.parametrize("kind", ["path", "star", "random", "none"])
def test_components(spark, kind):
    rng = random.Random(4)
    n = 200
    edges = {
        "path": [(rng_i, rng_i + 1) for rng_i in range(n - 1)],
        "star": [(n, i) for i in range(n)],
        "random": [(rng.randrange(n), rng.randrange(n)) for _ in range(120)],
        "none": [],
    }[kind]
    order = list(range(n + 1))
    rng.shuffle(order)
    edges = [(order[a], order[b]) for a, b in edges]
    above = {x: x for e in edges for x in e if e[0] != e[1]}

    def root(x):
        while above[x] != x:
            x = above[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            above[max(x, y)] = min(x, y)
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == sorted((x, root(x)) for x in above)


def test_a_hot_band_key_is_split(spark):
    """A third of 100,000 classes share a key in every band."""
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n, v in names.items():
            spark.conf.set(n, v)
        i = F.col("id")
        keys = F.array(*[F.when(i % 3 == 0, F.lit(band)).otherwise((i * 7 + band) % 50_000).cast("long") for band in range(2)])
        classes = written(spark.range(100_000).select("id", keys.alias("bands")).repartition(8), "classes")
        members = near_dedup.band_members(classes)
        found = members.collect()
        assert "skew=true" in members._jdf.queryExecution().executedPlan().toString()
        hot = [r for r in found if r.size > 1000]
        assert len(hot) >= 2 * 33_334 and all(r.pivot == 0 or r.pivot < r.id for r in hot)
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def test_a_filter_of_ids_is_bounded_and_exact_enough(spark, monkeypatch):
    """With few words nearly every id passes, and results stay as they are."""
    docs = documents(spark, [(i, f"the text number {i // 3} has the same words in three documents each and no others") for i in range(60)])
    docs = docs.unionByName(documents(spark, [(None, "the text number 1 has the same words"), (7, "another text under an id that is there")]))
    want = sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in near_dedup.keep_one_of_each(docs).collect())
    words = near_dedup._id_filter(spark.range(500_000).withColumnRenamed("id", "doc_id"))
    assert words.count() <= near_dedup.FILTER_WORDS
    monkeypatch.setattr(near_dedup, "FILTER_WORDS", 1)
    assert near_dedup._id_filter(docs.select("doc_id")).count() == 1
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in near_dedup.keep_one_of_each(docs).collect()) == want
    assert len(want) == 21
