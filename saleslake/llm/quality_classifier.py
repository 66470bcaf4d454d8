"""Quality classifier: naive Bayes support vectors.

Indicators of character n-grams (as they stand and by shape) and of repeated words are scaled by the log ratio of their
counts in the two classes; a linear hinge-loss model over them is fitted by dual coordinate descent.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from saleslake.llm.language_id import remainder
from saleslake.llm.ngrams import code_points, hashed, shapes
from saleslake.llm.tables import with_computed
from saleslake.llm.texts import word_hashes

BITS = 14
ORDERS = (1, 2, 3)
SHAPE_ORDERS = (2, 3, 4, 5, 6)
REPEAT_ORDERS = (1, 3)  # of marks whether a word equals the one before it
#: Labelled rows of each class that the model is fitted on, the least by a hash of the id.
PER_CLASS = 3000
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 20


def indicators(text: str | None) -> np.ndarray:
    """The hashed n-grams that occur in the text, in order; none in an empty one."""
    points = code_points(text or "")
    shaped = shapes()[points]
    found = np.zeros(1 << BITS, dtype=bool)
    for n in ORDERS:
        found[hashed(points, n, BITS)] = True
    for n in SHAPE_ORDERS:
        found[hashed(shaped, n, BITS, salt=1)] = True
    words = word_hashes((text or "").encode("utf-8", "surrogatepass"))
    again = (words[1:] == words[:-1]).astype(np.uint32)
    for n in REPEAT_ORDERS:
        found[hashed(again, n, BITS, salt=2)] = True
    return np.flatnonzero(found)


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / (np.sqrt(x @ x) + 1e-9)


@dataclass(frozen=True)
class Model:
    ratio: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        """Chance of class 1, from the margin."""
        row = indicators(text)
        margin = float(self.weights[row] @ _scaled(self.ratio[row])) + self.bias
        return float(1 / (1 + np.exp(-2 * np.clip(margin, -300, 300))))


def fit_model(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """Dual coordinate descent over rows of indicators with labels 0 and 1. Rows of one class
    alone, or none, give that class to every text (no rows: 1)."""
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(1 << BITS), np.zeros(1 << BITS), 1.0 if labels.all() else -1.0)
    y = np.where(labels == 1, 1.0, -1.0)
    count = np.full((2, 1 << BITS), SMOOTHING)
    for row, label in zip(rows, labels):
        count[int(label), row] += 1
    shares = count / count.sum(axis=1, keepdims=True)
    ratio = np.log(shares[1] / shares[0])
    # Rows are scaled to length 1, so that long texts weigh no more than short ones.
    scaled = [_scaled(ratio[row]) for row in rows]
    w, bias, alpha = np.zeros(1 << BITS), 0.0, np.zeros(len(rows))
    cost = COST / np.where(y > 0, (y > 0).mean(), (y < 0).mean())
    order = np.random.default_rng(0)
    for _ in range(EPOCHS):
        moved = 0.0
        for i in order.permutation(len(rows)).tolist():
            x, row = scaled[i], rows[i]
            gradient = y[i] * (float(w[row] @ x) + bias) - 1
            new = min(max(alpha[i] - gradient / 2, 0.0), cost[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[row] += step * x
                bias += step
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return Model(ratio, w, bias)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """A model from the ``per_class`` least labelled ids of each class by a hash (that bound holds
    for what is broadcast and what reaches the driver). Null ids and labels other than 0 and 1
    teach nothing; of rows that share an id the smallest text stands."""
    usable = labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")
    )
    draw = F.xxhash64(F.lit(9), "doc_id")
    first, second = (usable.filter(F.col("quality") == c).distinct().orderBy(draw, "doc_id").limit(per_class) for c in (0, 1))
    chosen = first.unionByName(second)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("text IS NOT NULL")
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [indicators(t.as_py()).astype(np.uint16).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("quality"), pa.array(found, pa.binary())], ["doc_id", "quality", "found"]
            )

    kept = rows.mapInArrow(features, "doc_id long, quality int, found binary").collect()
    kept.sort(key=lambda r: (r["doc_id"], r["quality"]))
    return fit_model([np.frombuffer(r["found"], dtype=np.uint16).astype(np.int64) for r in kept], np.array([r["quality"] for r in kept]))


def scored(docs: DataFrame, model: Model, into: str = "score") -> DataFrame:
    """The rows with the chance of class 1 in ``into``. A null text counts as empty, and gets a
    score as any other; a column already named ``into`` is replaced."""

    def score(texts: pa.Array) -> pa.Array:
        return pa.array([model.score(t.as_py()) for t in texts], pa.float64())

    return with_computed(docs, "text", into, T.DoubleType(), score)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learns from labels whose remainder by 3 is not 1, and scores all rows. A row without id is
    not held out."""
    model = fit(docs, labels.filter(remainder(3) != 1))
    out = scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    held_out = F.coalesce(remainder(3) == 1, F.lit(False)).alias("held_out")
    return out.select("doc_id", held_out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_rejected(docs: DataFrame, model: Model) -> DataFrame:
    """The rows that the model gives class 1, with their columns as they came."""
    into = "score"
    while into in docs.columns:
        into += "_"
    return scored(docs, model, into).filter(F.col(into) >= 0.5).drop(into)
