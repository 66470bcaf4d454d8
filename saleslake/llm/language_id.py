"""Language identification by the nearest of several centroids per language.

Texts are vectors of hashed letter n-grams, weighted by TF-IDF and normalised. Spherical k-means
gives each language several centroids; a text gets the language of the centroid with the largest
cosine, and is marked as rejected where it lies farther from it than that centroid's own texts do.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from saleslake.llm.ngrams import code_points, hashed, letters
from saleslake.llm.tables import slices, small_side

BITS = 12
ORDERS = (1, 2, 3)
CENTROIDS = 4
#: Texts per language that the centroids are fitted on; document frequencies count all.
SAMPLE = 500
ROUNDS = 10
#: A text is rejected below its centroid's mean cosine less so many standard deviations.
DEVIATIONS = 4.0
NO_LANGUAGE = "und"


def counts(text: str | None) -> np.ndarray:
    """Counts of hashed n-grams of the lower-case letters, words set apart by one space."""
    points = code_points((text or "").lower())
    points = np.where(letters()[points], points, np.uint32(32))
    space = points == 32
    points = points[~(space & np.concatenate([[False], space[:-1]]))]
    if not (points != 32).any():
        return np.zeros(1 << BITS, dtype=np.int64)
    return np.bincount(np.concatenate([hashed(points, n, BITS) for n in ORDERS]), minlength=1 << BITS)


def _weighted(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    vectors = np.log1p(found.astype(np.float32)) * idf
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(norms > 0, norms, 1)


@dataclass(frozen=True)
class Model:
    idf: np.ndarray
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    limits: np.ndarray  # cosine below which a text is rejected

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """(language, cosine, rejected); without letters or languages (und, 0, True)."""
        out = []
        for at in range(0, len(texts), 256):
            found = np.array([counts(t) for t in texts[at : at + 256]])
            if not self.languages:
                out += [(NO_LANGUAGE, 0.0, True)] * len(found)
                continue
            cosines = _weighted(found, self.idf) @ self.centroids.T
            best = cosines.argmax(axis=1)
            near = np.clip(cosines[np.arange(len(best)), best], 0, 1)
            for some, b, c in zip(found.any(axis=1), best.tolist(), near.tolist()):
                out.append((self.languages[b], c, c < self.limits[b]) if some else (NO_LANGUAGE, 0.0, True))
        return out


def _clusters(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from spread-out starts: centroids and rejection limits."""
    centroids = [vectors.mean(axis=0)]
    for _ in range(min(CENTROIDS, len(vectors)) - 1):
        centroids.append(vectors[np.max(vectors @ np.array(centroids).T, axis=1).argmin()])
    c = np.array(centroids)
    for _ in range(ROUNDS):
        nearest = (vectors @ c.T).argmax(axis=1)
        c = np.array([vectors[nearest == k].sum(axis=0) if (nearest == k).any() else c[k] for k in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    cosines = vectors @ c.T
    nearest, own = cosines.argmax(axis=1), cosines.max(axis=1)
    spread = own.std()
    limits = [own[nearest == k].mean() - DEVIATIONS * spread if (nearest == k).any() else 1.0 for k in range(len(c))]
    return c.astype(np.float32), np.array(limits)


def fit(rows: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from ``text, lang``; null languages and texts without letters teach nothing.

    Document frequencies count all rows, in one partial sum per task. Per language about
    ``sample`` different texts, drawn by their hash, go to one task for its centroids. What reaches the driver is
    the frequencies (4,096 numbers) and the centroids.
    """
    rows = rows.filter("lang IS NOT NULL AND text IS NOT NULL").select("text", F.col("lang").cast("string").alias("lang"))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, texts = np.zeros(1 << BITS, dtype=np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                found = counts(text.as_py())
                total += found > 0
                texts += bool(found.any())
        yield pa.RecordBatch.from_arrays([pa.array([*range(1 << BITS), -1]), pa.array([*total.tolist(), texts])], ["gram", "n"])

    counted = rows.select("text").mapInArrow(frequencies, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    of_gram = {r["gram"]: r["n"] for r in counted}
    texts = of_gram.get(-1, 0)
    idf = np.log((1 + texts) / (1 + np.array([of_gram.get(g, 0) for g in range(1 << BITS)]))).astype(np.float32) + np.float32(1)

    # Drawn by the hash of the text alone, so the same rows in other files give the same model. Copies
    # are one text, and the number of different texts (a sketch, the same for any order) sets the rate.
    draw = F.xxhash64(F.lit(3), "text")
    drawn = rows.withColumn("draw", draw)
    rate = drawn.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(2.0 * sample) / F.approx_count_distinct("draw")).alias("rate"))
    drawn = drawn.join(small_side(rate, "rates"), "lang")
    drawn = drawn.filter(F.pmod("draw", F.lit(1 << 30)) < F.col("rate") * (1 << 30)).drop("rate").dropDuplicates(["lang", "draw", "text"])

    def cluster(table: pa.Table) -> pa.Table:
        table = table.sort_by([("draw", "ascending"), ("text", "ascending")])
        found = np.array([counts(t.as_py()) for t in table["text"].slice(0, sample)])
        vectors = _weighted(found[found.any(axis=1)], idf)
        c, limits = _clusters(vectors) if len(vectors) else (np.zeros((0, 1 << BITS), np.float32), np.zeros(0))
        return pa.table(
            {
                "lang": [table["lang"][0].as_py()] * len(c),
                "k": list(range(len(c))),
                "centroid": pa.array([x.tobytes() for x in c], pa.binary()),
                "limit": limits.astype(np.float64),
            },
            schema=pa.schema([("lang", pa.string()), ("k", pa.int64()), ("centroid", pa.binary()), ("limit", pa.float64())]),
        )

    found = drawn.groupBy("lang").applyInArrow(cluster, "lang string, k long, centroid binary, limit double").collect()
    found.sort(key=lambda r: (r["lang"], r["k"]))
    centroids = np.array([np.frombuffer(r["centroid"], dtype=np.float32) for r in found]).reshape(len(found), 1 << BITS)
    return Model(idf, [r["lang"] for r in found], centroids, np.array([r["limit"] for r in found]))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` of every row; a text without letters, or null, is
    ``und`` with score 0. Of centroids equally near the first by language, then number, is taken.
    Rows that repeat are rows of their own. Other columns play no part, whatever their names."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            lang, score, rejected = zip(*model.predict(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        predict, "doc_id long, lang_pred string, score double, rejected boolean"
    )


def remainder(modulus: int):
    """crc32 of the id as text, by modulus; null for a null id."""
    return F.crc32(F.col("doc_id").cast("long").cast("string")) % modulus


def language_predictions(docs: DataFrame) -> DataFrame:
    """Learns from rows whose remainder by 4 is not 2, and predicts all. A row without id is not
    held out and teaches nothing."""
    model = fit(docs.filter(remainder(4) != 2))
    held_out = F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out")
    return identify(docs, model).select("doc_id", held_out, "lang_pred", "score", "rejected")
