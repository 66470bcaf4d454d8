import math
import random

import pytest

from saleslake.llm.top_k import integer_vectors, top_k


def brute(rows, step, k, reach=2**61):
    usable = [
        (vec_id, [math.floor(256.0 * x) for x in v])
        for vec_id, v in rows
        if vec_id is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for at, (q, v) in enumerate(usable):
        if q % step == 0:
            held = [(max(-reach, min(reach, sum(a * b for a, b in zip(v, w)))), c) for i, (c, w) in enumerate(usable) if i != at]
            scores = sorted((-s, c) for s, c in held)
            out += [(q, r, c, -s) for r, (s, c) in enumerate(scores[:k], 1)]
    return sorted(out)


def answers(spark, rows, step=2, k=3, bins=16):
    table = spark.createDataFrame([(i, v, i, i) for i, v in rows], "vec_id long, embedding array<double>, score long, rank long")
    vectors = integer_vectors(table)
    return sorted(map(tuple, top_k(vectors, vectors.filter(f"vec_id % {step} = 0"), k, bins).collect()))


@pytest.mark.parametrize("size", [0.01, 1.0, 1e6])
def test_equals_brute_force(spark, size):
    rng = random.Random(size)
    rows = [(i, [rng.choice([rng.gauss(0, size), 0.5]) for _ in range(4)]) for i in range(60)]
    assert answers(spark, rows) == brute(rows, 2, 3)


def test_ties_go_to_smaller_ids(spark):
    rows = [(i, [1.0, 0.0]) for i in range(40)]
    assert answers(spark, rows, step=20, k=5) == brute(rows, 20, 5)


def test_odd_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (None, [1.0, 1.0]), (5, [3.0, -1.0])]
    rows += [(6, []), (7, [2.0]), (5, [3.0, -1.0]), (8, [0.001, -0.001])]
    assert answers(spark, rows, k=9) == brute(rows, 2, 9)


def test_few_candidates_and_none(spark):
    assert answers(spark, [(0, [1.0]), (1, [2.0])], k=5) == [(0, 1, 1, 256 * 512)]
    assert answers(spark, [(0, [1.0])]) == []
    assert answers(spark, []) == []


def test_rows_under_one_id_are_all_candidates_and_queries(spark):
    assert answers(spark, [(0, [1.0]), (1, [2.0]), (1, [5.0]), (3, [3.0])], k=4) == [
        (0, 1, 1, 256 * 1280), (0, 2, 3, 256 * 768), (0, 3, 1, 256 * 512),
    ]
    rng = random.Random(2)
    rows = [(rng.randint(0, 9), [rng.choice([1.0, 2.0, -1.0]) for _ in range(3)]) for _ in range(50)]
    assert answers(spark, rows, step=3, k=4) == brute(rows, 3, 4)
    assert answers(spark, [(4, [1.0, 2.0])] * 5, k=3) == brute([(4, [1.0, 2.0])] * 5, 2, 3)


def test_scores_out_of_range_are_held(spark):
    rows = [(0, [1e8, 0.0]), (1, [1e8, 0.0]), (3, [1e8, 0.0]), (4, [-1e8, 1.0]), (5, [1e3, 1.0])]
    assert answers(spark, rows, k=4, bins=1024) == brute(rows, 2, 4)
    assert [r for r in answers(spark, rows, k=4) if r[0] == 0][:2] == [(0, 1, 1, 2**61), (0, 2, 3, 2**61)]
