"""Packing documents into sequences: first-fit decreasing in randomised groups.

The first bin with room is found by a tournament tree over the bins' free space: every node holds
the larger space of its two children, so one walk from the root finds the leftmost bin that fits.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from saleslake.llm.tables import slices, written
from saleslake.llm.tokens import BYTE_BPE, encode

CAPACITY = 2048
END_ID = 1
GROUP = 4096


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset in the bin) of every piece. Equal lengths are placed in the order given."""
    leaves = 1 << max(0, len(lengths) - 1).bit_length()
    space = [capacity] * (2 * leaves)
    bins, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        size, node = int(lengths[i]), 1
        while node < leaves:
            node *= 2
            if space[node] < size:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - space[node]
        space[node] -= size
        while node > 1:
            node //= 2
            left, right = space[2 * node], space[2 * node + 1]
            larger = left if left > right else right
            if space[node] == larger:
                break
            space[node] = larger
    return bins, offsets


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, path: str = BYTE_BPE) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens`` of pieces of at most ``capacity`` ids.

    A document is its text's ids and ``end_id``; a null or empty text has that id alone. Every
    row counts as a document, repeated rows and null ids too. Other columns are ignored.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, rows = batch.column("doc_id").to_pylist(), []
            for doc_id, text in zip(ids, batch.column("text")):
                tokens = np.append(encode(text.as_py(), path), np.uint32(end_id)).astype("<u4")
                for start in range(0, len(tokens), capacity):
                    piece = tokens[start : start + capacity]
                    rows.append((doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(tokens)))
            columns = zip(*rows)
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; no sequence holds more than ``capacity`` ids.

    A full piece is a sequence of its own. The others are dealt by a hash into groups of about
    ``group`` pieces, so that no key gathers in one task; each group is packed alone.
    """
    pieces = written(pieces, "pieces").withColumn("row", F.monotonically_increasing_id())
    full = F.col("length") >= capacity
    parts = pieces.filter(~full)
    groups = max(1, -(-parts.count() // group))
    names = [*pieces.columns[:-1], "sequence_id", "offset"]

    def place(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("row", "ascending")])
        bins, offsets = first_fit_decreasing(np.asarray(table["length"]), capacity)
        sequence = (np.asarray(table["g"]) << 20 | bins) << 1
        return pa.table([*(table[c] for c in names[:-2]), sequence, offsets], names)

    schema = ", ".join(f"{c} long" for c in names)
    dealt = parts.withColumn("g", F.pmod(F.xxhash64(F.lit(11), "doc_id", "row"), F.lit(groups)))
    own = pieces.filter(full).withColumns({"sequence_id": F.col("row") * 2 + 1, "offset": F.lit(0).cast("long")})
    return own.select(*names).unionByName(dealt.groupBy("g").applyInArrow(place, schema))
