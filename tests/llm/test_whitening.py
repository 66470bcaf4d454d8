import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from saleslake.llm.qdwh import leading_eigenvectors, polar_factor
from saleslake.llm.whitening import fit_whitening, integer_vectors, whitened_embeddings

SF = "/root/testdata/sf0.01"


def spectrum(kind, d, draw):
    if kind == "plain":
        return draw.standard_normal((4 * d, d)) * np.linspace(1, 5, d)
    if kind == "low rank":
        return draw.standard_normal((4 * d, max(d // 3, 1))) @ draw.standard_normal((max(d // 3, 1), d))
    if kind == "equal":
        return np.sqrt(4 * d) * np.linalg.qr(draw.standard_normal((4 * d, d)))[0] * np.repeat([3.0, 1.0], [d // 2, d - d // 2])
    return draw.standard_normal((4 * d, d)) * np.logspace(0, -8, d)


@pytest.mark.parametrize("kind", ["plain", "low rank", "equal", "steep"])
@pytest.mark.parametrize("d", [1, 2, 3, 17, 64, 130])
def test_eigenvectors_against_numpy(kind, d):
    x = spectrum(kind, d, np.random.default_rng(d))
    v = x.T @ x / len(x)
    e, w = leading_eigenvectors(v, 16)
    want = np.linalg.eigvalsh(v)[::-1][:16]
    assert w.shape == (d, min(d, 16)) and np.all(np.diff(e) <= 1e-15 * want[0])
    assert np.abs(e - want).max() < 1e-13 * want[0]
    assert np.abs(w.T @ w - np.eye(len(e))).max() < 1e-13
    assert np.abs(v @ w - w * e).max() < 1e-13 * want[0]


def test_polar_factor():
    q = np.linalg.qr(np.random.default_rng(1).standard_normal((30, 30)))[0]
    values = np.concatenate([np.logspace(-12, 0, 14), -np.logspace(-10, 2, 16)])
    u = polar_factor((q * values) @ q.T)
    assert np.abs(u - (q * np.sign(values)) @ q.T).max() < 1e-3 and np.abs(u @ u - np.eye(30)).max() < 1e-13
    e, w = leading_eigenvectors(np.zeros((3, 3)), 2)
    assert e.tolist() == [0, 0] and np.abs(w.T @ w - np.eye(2)).max() == 0


def plainly(vectors):
    """n, exact deviations, eigenvalues, trace and absolute whitened values by exact sums and numpy."""
    xs = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]
    fit = sorted(set(map(tuple, xs)))
    n, sums = len(fit), [sum(column) for column in zip(*fit)]
    deviations = [sum((n * x - s) ** 2 for x, s in zip(v, sums)) for v in xs]
    centred = np.array([[float(n * x - s) / n for x, s in zip(v, sums)] for v in fit])
    covariance = centred.T @ centred / n
    e, w = np.linalg.eigh(covariance)
    e, w = e[::-1], w[:, ::-1]
    rows = np.array([[float(n * x - s) / n for x, s in zip(v, sums)] for v in xs])
    return n, deviations, e, np.trace(covariance), rows @ w / np.sqrt(np.maximum(e, 1e-300))


def compare(out, ids, vectors, components):
    n, deviations, e, trace, white = plainly(vectors)
    rows = {}
    for r in out:
        rows.setdefault(r.vec_id, {})[r.component] = r
    assert sorted(rows) == sorted(ids)
    z = np.array([[rows[i][k].whitened for k in range(1, components + 1)] for i in ids])
    for i, deviation in zip(ids, deviations):
        assert len(rows[i]) == components
        assert {(r.n, r.deviation) for r in rows[i].values()} == {(n, deviation)}
        assert all(abs(r.explained - e[k - 1] / trace) <= 1e-10 for k, r in rows[i].items())
    # The same sign for all rows.
    signs = np.sign((z * white[:, :components]).sum(axis=0))
    assert np.abs(z * signs - white[:, :components]).max() < 1e-8
    return rows


def test_whole_table_against_numpy(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    out = whitened_embeddings(table).collect()
    given = [(r.vec_id, r.embedding) for r in table.collect()]
    compare(out, [i for i, _ in given], [v for _, v in given], 16)
    assert len({r.identity_error for r in out}) == 1 and out[0].identity_error < 1e-10


def test_odd_rows(spark):
    """Null, short, empty, repeated and infinite vectors, null and repeated ids, clashing names."""
    draw = np.random.default_rng(3)
    good = [draw.standard_normal(3).tolist() for _ in range(40)]
    rows = [(i, v) for i, v in enumerate(good)]
    rows += [(100, good[0]), (101, good[0]), (None, good[1])]
    rows += [(200, None), (201, [1.0, None, 2.0]), (202, [float("nan"), 1.0, 1.0]), (203, [1.0, float("-inf"), 1.0]), (204, []), (205, [1.0])]
    df = spark.createDataFrame([(i, v, "a", "b", "c") for i, v in rows], "vec_id long, embedding array<double>, x string, n string, `a.b` string")
    out = whitened_embeddings(df.repartition(6)).collect()
    taking_part = [(i, v) for i, v in rows if v and len(v) == 3 and all(c is not None and math.isfinite(c) for c in v)]
    null = [r for r in out if r.vec_id is None]
    assert len(null) == 3
    rows_of = compare([r for r in out if r.vec_id is not None], [i for i, _ in taking_part if i is not None], [v for i, v in taking_part if i is not None], 3)
    assert [r.whitened for r in sorted(null, key=lambda r: r.component)] == [rows_of[1][k].whitened for k in (1, 2, 3)]


def test_no_components(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        out = whitened_embeddings(spark.createDataFrame(rows, schema))
        assert out.collect() == [] and out.columns[-1] == "identity_error"


def test_constant_and_repeated_dimensions_give_fewer_components(spark):
    draw = np.random.default_rng(5)
    rows = [(i, [a, 2 * a, 1.0, b]) for i, (a, b) in enumerate(draw.integers(-50, 50, (200, 2)).astype(float).tolist())]
    out = whitened_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.component for r in out} == {1, 2} and out[0].identity_error < 1e-10


def test_large_entries_and_layouts(spark):
    """Entries out of range are held; sums stay exact, too large deviations are null; files may lie anyhow."""
    rows = [(i, [float(i % 7) * 1e300 * (-1) ** i, float(i)]) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = whitened_embeddings(df).collect()
    # The second dimension is rounding beside the first.
    assert len(out) == 50 and all(math.isfinite(r.whitened) for r in out)
    assert {r.deviation for r in out if r.vec_id == 1} == {None}
    vectors = integer_vectors(spark.read.parquet(f"{SF}/embeddings.parquet"))
    a, b = fit_whitening(vectors.repartition(1), 4), fit_whitening(vectors.repartition(13, F.col("vec_id")), 4)
    assert (a.n, a.base.tolist(), a.rest.tolist()) == (b.n, b.base.tolist(), b.rest.tolist())
    assert np.abs(a.values - b.values).max() < 1e-9 and np.abs(np.abs((a.vectors * b.vectors).sum(axis=0)) - 1).max() < 1e-12
