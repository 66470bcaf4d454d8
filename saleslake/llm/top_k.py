"""Exact top-k search by distributed histogram selection.

Every candidate is scored against every query in blocks of bounded size. The k-th highest score
of each query is located by score histograms, refined until a bin is one score wide; then only
scores at or above it leave their block, and ties go to the smaller id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from saleslake.llm.tables import written

BINS = 1024
CANDIDATE_BLOCK = 4096
QUERY_BLOCK = 1024
EXACT_DOUBLE = 2**53
#: Scores beyond are held there, so that the difference of two fits 64 bits.
REACH = 2**61


def integer_vectors(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """``row, vec_id, v``: ``floor(scale * x)`` of every component, under a row number.

    A null id, and a vector that is null or holds a null, NaN or infinite component, take no
    part. Rows that repeat an id are rows of their own; the number, fixed by writing the table,
    tells them apart. Other columns are ignored, whatever their names.
    """
    x = F.col(vector)
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e.cast("double")) == float("inf")))
    kept = rows.filter(F.col(id_column).isNotNull() & x.isNotNull() & ~bad)
    floors = F.transform(x, lambda e: F.floor(F.lit(float(scale)) * e.cast("double")))
    row = F.monotonically_increasing_id().alias("row")
    return written(kept.select(row, F.col(id_column).cast("long").alias("vec_id"), floors.alias("v")), "rows")


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors as rows; missing components of shorter ones are 0."""
    arr = column.combine_chunks()
    lengths = np.asarray(arr.value_lengths(), dtype=np.int64)
    flat = np.asarray(arr.flatten(), dtype=np.int64)
    out = np.zeros((len(lengths), int(lengths.max(initial=0))), dtype=np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = flat
    return out


def _scores(queries: pa.Table, candidates: pa.Table, bound: float) -> np.ndarray:
    """Inner products, held within REACH; doubles add integers exactly below 2**53."""
    q, c = _matrix(queries["v"]), _matrix(candidates["v"])
    n = min(q.shape[1], c.shape[1])
    if bound < EXACT_DOUBLE:
        return (q[:, :n].astype(np.float64) @ c[:, :n].T.astype(np.float64)).astype(np.int64)
    exact = q[:, :n].astype(object) @ c[:, :n].T.astype(object) if n else np.zeros((len(q), len(c)), dtype=object)
    return np.clip(exact, -REACH, REACH).astype(np.int64)


def _grid(vectors: DataFrame, queries: DataFrame, n_candidates: int, n_queries: int):
    """Both sides dealt over (candidate block, query block)."""
    c_blocks = -(-n_candidates // CANDIDATE_BLOCK)
    q_blocks = -(-n_queries // QUERY_BLOCK)
    c_of, q_of = F.sequence(F.lit(0), F.lit(c_blocks - 1)), F.sequence(F.lit(0), F.lit(q_blocks - 1))
    block = F.xxhash64(F.lit(7), "row")
    candidates = vectors.withColumn("cb", F.pmod(block, F.lit(c_blocks)).cast("int")).withColumn("qb", F.explode(q_of))
    asked = queries.withColumn("qb", F.pmod(F.xxhash64(F.lit(7), "query"), F.lit(q_blocks)).cast("int"))
    return candidates.groupBy("cb", "qb").cogroup(asked.withColumn("cb", F.explode(c_of)).groupBy("cb", "qb"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, bins: int = BINS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k highest inner products of each query.

    ``vectors`` and ``queries`` have ``row, vec_id, v``, the queries being rows of the same table.
    The query's own row does not count; others under its id do, and each of them is a query of its
    own. Ties go to the smaller id, then the smaller row. All candidates are returned where there
    are fewer than k; no candidates, no rows. Scores beyond +-2**61 are held there, and tie.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score long"
    vectors = written(vectors.select("row", "vec_id", "v"), "vectors")
    asked = written(queries.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"), "v"), "asked")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    n_candidates, largest = vectors.agg(F.count("*"), F.max(square)).first()
    n_queries, asked_largest = asked.agg(F.count("*"), F.max(square)).first()
    if not n_candidates or not n_queries:
        return spark.createDataFrame([], schema)
    bound = float(np.sqrt(largest * asked_largest))  # no score is larger than the product of the norms
    reach = min(int(bound) + 2, REACH)
    state = asked.select("query", F.lit(-reach).cast("long").alias("lo"), F.lit(0).cast("long").alias("above"))
    width = 2 * reach + 1

    while width > 1:
        span, width = width, -(-width // bins)  # the bin of the last pass, and the bins it is cut into

        inside, w = span, width  # of this pass

        def histogram(c: pa.Table, q: pa.Table) -> pa.Table:
            if not (c.num_rows and q.num_rows):
                return pa.table({"query": pa.array([], pa.int64()), "bin": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
            ids, lo = np.asarray(q["query"]), np.asarray(q["lo"])
            need = k - np.asarray(q["above"])
            scores = _scores(q, c, bound)
            past = scores - lo[:, None]
            at = past // w
            ok = (past >= 0) & (past < inside) & (np.asarray(c["row"])[None, :] != ids[:, None])
            counts = np.bincount((at + np.arange(len(ids))[:, None] * bins)[ok], minlength=len(ids) * bins).reshape(len(ids), bins)
            higher = counts[:, ::-1].cumsum(axis=1)[:, ::-1] - counts
            # The global k-th score is no lower than the block's own: lower bins need not leave it.
            rows, columns = np.nonzero((counts > 0) & (higher < need[:, None]))
            return pa.table({"query": ids[rows], "bin": columns.astype(np.int64), "n": counts[rows, columns].astype(np.int64)})

        counted = _grid(vectors, asked.join(state, "query"), n_candidates, n_queries).applyInArrow(
            histogram, "query long, bin long, n long"
        )
        bins_of = counted.groupBy("query", "bin").agg(F.sum("n").alias("n")).join(state, "query")
        down = Window.partitionBy("query").orderBy(F.desc("bin"))
        seen = bins_of.withColumn("upto", F.sum("n").over(down))
        # The first bin that reaches k, or the lowest where there are fewer than k candidates.
        reached = F.col("above") + F.col("upto") >= k
        best = F.max_by(F.struct("bin", "n", "upto"), F.when(reached, F.col("bin")).otherwise(-F.lit(bins) - F.col("bin") - 1))
        state = written(
            seen.groupBy("query", "lo", "above")
            .agg(best.alias("b"))
            .select(
                "query",
                (F.col("lo") + F.col("b.bin") * width).alias("lo"),
                (F.col("above") + F.col("b.upto") - F.col("b.n")).alias("above"),
            ),
            "kth",
        )

    def select(c: pa.Table, q: pa.Table) -> pa.Table:
        names = ["query", "query_id", "row", "vec_id", "score"]
        if not (c.num_rows and q.num_rows):
            return pa.table({n: pa.array([], pa.int64()) for n in names})
        c = c.sort_by([("vec_id", "ascending"), ("row", "ascending")])
        kth, need = np.asarray(q["lo"])[:, None], k - np.asarray(q["above"])[:, None]
        scores, own = _scores(q, c, bound), np.asarray(c["row"])
        other = own[None, :] != np.asarray(q["query"])[:, None]
        ties = other & (scores == kth)
        rows, columns = np.nonzero((other & (scores > kth)) | (ties & (ties.cumsum(axis=1) <= need)))
        found = [np.asarray(q["query"])[rows], np.asarray(q["query_id"])[rows], own[columns], np.asarray(c["vec_id"])[columns]]
        return pa.table(dict(zip(names, [*found, scores[rows, columns]])))

    found = _grid(vectors, asked.join(state, "query"), n_candidates, n_queries).applyInArrow(
        select, "query long, query_id long, row long, vec_id long, score long"
    )
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
