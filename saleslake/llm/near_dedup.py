"""Near-duplicates by HyperMinHash: compressed registers, banding, verification on full sets.

A register keeps, of the least hash in its bucket, the number of leading zeros and ten mantissa
bits: 16 bits. Each bucket sees all shingles under a mix of its own, so that short texts leave
no bucket empty. Four registers make a band key of 64 bits. Texts that share a band are
candidates; the share of equal registers, corrected for chance collisions, drops the hopeless
ones; the rest is verified on the full sets.

No group is expanded into all its pairs. Equal sets are one class from the start. In each band
group all members are verified against one pivot. Where a group still holds several components,
its members are compared in blocks of bounded size that give only the links needed to join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from saleslake.llm.components import components
from saleslake.llm.tables import quoted, slices, written
from saleslake.llm.texts import mix, word_hashes

ROWS = 4  # registers in a band
MANTISSA_BITS = 10
#: Chance that a pair just at the wanted similarity meets in no band.
MISSED = 1e-6
#: Estimates may lie so many standard deviations below the wanted similarity.
DEVIATIONS = 5.5
#: Words of 64 bits in a filter of ids, at most: what is broadcast has that many short rows at any size.
FILTER_WORDS = 1 << 20
BLOCK_ROWS = 1024
BLOCK_SHINGLES = 1 << 20
SLICE = 2048  # shared shingles that one matrix product takes


def bands_for(percent: int) -> int:
    """Bands enough to find pairs of that similarity: 19 at 85 percent, 27 at 80."""
    return max(1, math.ceil(math.log(MISSED) / math.log(max(1 - (percent / 100) ** ROWS, 1e-9))))


def least_estimate(percent: int) -> float:
    """Pairs estimated below are not verified."""
    share = percent / 100
    return share - DEVIATIONS * math.sqrt(share * (1 - share) / (bands_for(percent) * ROWS))


@cache
def _mixes(count: int) -> np.ndarray:
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word windows; with fewer words the whole sequence is
    one; no words, none."""
    words = word_hashes((text or "").encode("utf-8", "surrogatepass"))
    if not len(words):
        return words
    width = min(width, len(words))
    total = np.full(len(words) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        total = mix(total) + words[i : len(words) - width + 1 + i]
    return np.unique(mix(total))


def registers(hashes: np.ndarray, count: int) -> np.ndarray:
    """Leading zeros and mantissa of the least hash per bucket, 16 bits each."""
    least = np.full(count, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), 2048):
        part = hashes[at : at + 2048]
        np.minimum(least, (part[None, :] * _mixes(count)[:, None]).min(axis=1), out=least)
    fraction, exponent = np.frexp(least.astype(np.float64))
    mantissa = np.minimum((fraction * 2 - 1) * (1 << MANTISSA_BITS), (1 << MANTISSA_BITS) - 1)
    zeros = np.clip(64 - exponent, 0, 63)
    return (zeros.astype(np.uint16) << np.uint16(MANTISSA_BITS)) | np.clip(mantissa, 0, None).astype(np.uint16)


def _chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Chance that registers of disjoint sets of sizes n and m are equal."""
    total = np.zeros(np.broadcast(n, m).shape)
    for zeros in range(40):
        low, high = 2.0 ** -(zeros + 1), 2.0**-zeros
        total += ((1 - low) ** n - (1 - high) ** n) * ((1 - low) ** m - (1 - high) ** m)
    return total / (1 << MANTISSA_BITS)


def estimates(share: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Similarity from the share of equal registers."""
    c = _chance(n, m)
    return (share - c) / (1 - c)


def sketches(docs: DataFrame, width: int, bands_of: int) -> DataFrame:
    """``doc_id, n, digest_a, digest_b, bands`` of every row. The digests are sums over the set."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n, a, b, bands = [], [], [], []
            for text in batch.column("text"):
                found = shingles(text.as_py(), width)
                n.append(len(found))
                a.append(int(mix(found ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64)))
                b.append(int(mix(found ^ np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64).astype(np.int64)))
                bands.append(registers(found, bands_of * ROWS).view(np.int64) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "n", "digest_a", "digest_b", "bands"],
            )

    schema = "doc_id long, n long, digest_a long, digest_b long, bands array<long>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(sketch, schema)


def _id_filter(ids: DataFrame) -> DataFrame:
    """``word, bits``: a bitmap of the hashes of ids (column ``doc_id``). It has at most FILTER_WORDS rows,
    however many ids there are; more ids only set more bits."""
    place = F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(FILTER_WORDS * 64))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
    words = ids.select(F.floor(place / 64).cast("int").alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    return written(words, "filter")


def _filtered(docs: DataFrame, words: DataFrame, how: str) -> DataFrame:
    """The rows of documents whose id may be in the filter (``left_semi``: all that are, and a few
    more), or those whose id is not (``left_anti``). Texts stay where they are."""
    place = F.pmod(F.xxhash64(F.lit(3), docs["doc_id"].cast("long")), F.lit(FILTER_WORDS * 64))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
    there = (F.floor(place / 64).cast("int") == words["word"]) & (words["bits"].bitwiseAND(bit) != 0)
    return docs.join(F.broadcast(words), there & docs["doc_id"].isNotNull(), how)


def _sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """``doc_id, shingles`` of the documents named in ``ids``, from their texts, and of the few more
    that the filter of ids lets pass; joins by id leave those aside."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [shingles(t.as_py(), width).view(np.int64) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(pa.int64()))], ["doc_id", "shingles"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _filtered(texts, _id_filter(ids), "left_semi").mapInArrow(gather, "doc_id long, shingles array<long>")


def _registers_of(column) -> np.ndarray:
    flat = np.asarray(column.flatten() if isinstance(column, pa.Array) else column.combine_chunks().flatten(), dtype=np.int64)
    return flat.view(np.uint16).reshape(len(column), -1)


def _hopeful(pairs: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) whose registers don't rule them out; those come as ``a_bands, b_bands``."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                share = (_registers_of(batch.column("a_bands")) == _registers_of(batch.column("b_bands"))).mean(axis=1)
                n, m = (np.asarray(batch.column(c), dtype=np.float64) for c in ("a_n", "b_n"))
                yield batch.filter(pa.array(estimates(share, n, m) >= least)).select(["a", "b"])

    return pairs.mapInArrow(keep, "a long, b long")


def _intersections(sets: list[np.ndarray], rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Exact intersection sizes of rows against columns (both index ``sets``). Only shingles in two
    sets or more matter; each slice of them is a product of 0/1 matrices."""
    used = np.unique(np.concatenate([rows, columns]))
    owner = np.repeat(np.arange(len(used)), [len(sets[i]) for i in used])
    _, shingle, count = np.unique(np.concatenate([sets[i] for i in used]), return_inverse=True, return_counts=True)
    shared = count[shingle] > 1
    owner, place = owner[shared], (np.cumsum(count > 1) - 1)[shingle[shared]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    out = np.zeros((len(rows), len(columns)), dtype=np.int64)
    r, c = np.searchsorted(used, rows), np.searchsorted(used, columns)
    total = int(place[-1]) + 1 if len(place) else 0
    for at in range(0, total, SLICE):
        low, high = np.searchsorted(place, [at, at + SLICE])
        held = np.zeros((len(used), SLICE), dtype=np.float32)
        held[owner[low:high], place[low:high] - at] = 1
        out += (held[r] @ held[c].T).astype(np.int64)  # below 2**24, so exact
    return out


def _block_links(table: pa.Table, percent: int, least: float) -> pa.Table:
    """Links between components within one pair of blocks of a band group, no more than join them."""
    ids, comp, band = (np.asarray(table[c]) for c in ("id", "component", "band"))
    n = np.asarray(table["n"], dtype=np.float64)
    block, one, two = (np.asarray(table[c]) for c in ("block", "one", "two"))
    regs = _registers_of(table["bands"])
    keys = regs.view(np.int64)
    rows = np.flatnonzero(block == one[0])
    columns = np.flatnonzero(block == two[0])
    equal = np.zeros((len(rows), len(columns)), dtype=np.int32)
    for i in range(regs.shape[1]):
        equal += regs[rows, i][:, None] == regs[columns, i][None, :]
    open_pairs = comp[rows][:, None] != comp[columns][None, :]
    for b in range(int(band[0])):  # pairs that share an earlier band are compared there
        open_pairs &= keys[rows, b][:, None] != keys[columns, b][None, :]
    open_pairs &= estimates(equal / regs.shape[1], n[rows][:, None], n[columns][None, :]) >= least
    links: list[tuple[int, int]] = []
    if open_pairs.any():
        rows, columns = rows[open_pairs.any(axis=1)], columns[open_pairs.any(axis=0)]
        flat = table["shingles"].combine_chunks()
        offsets, values = np.asarray(flat.offsets), np.asarray(flat.values)
        sets = [values[offsets[i] : offsets[i + 1]] for i in range(len(ids))]
        common = _intersections(sets, rows, columns)
        # Where an id has several texts, n and registers of one meet the set of another.
        sizes = np.diff(offsets).astype(np.int64)
        union = sizes[rows][:, None] + sizes[columns][None, :] - common
        linked = (100 * common >= percent * union) & (comp[rows][:, None] != comp[columns][None, :])
        above: dict[int, int] = {}

        def root(x: int) -> int:
            while x in above:
                x = above[x]
            return x

        for i, j in zip(*np.nonzero(linked)):
            x, y = root(int(comp[rows[i]])), root(int(comp[columns[j]]))
            if x != y:
                above[max(x, y)] = min(x, y)
                links.append((int(ids[rows[i]]), int(ids[columns[j]])))
    a, b = zip(*links) if links else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def band_members(classes: DataFrame) -> DataFrame:
    """``band, key, id, pivot, size`` of groups of two classes or more (``id, bands``) in one band.

    The sizes of the groups are written first, so that both sides of the join are plain shuffles
    and adaptive execution can split a key that very many classes share."""
    banded = classes.select("id", F.posexplode("bands").alias("band", "key"))
    sizes = banded.groupBy("band", "key").agg(F.min("id").alias("pivot"), F.count("*").alias("size"), F.max("id").alias("last"))
    return banded.join(written(sizes.filter("pivot < last").drop("last"), "sizes"), ["band", "key"])


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of documents.

    Texts are linked when ``100 * intersection >= percent * union`` of their sets of word
    shingles; ``component_id`` is the least id reachable, ``kept`` marks that document. A null or
    empty text, or one without words, is linked with nothing. Rows that share an id are one node:
    a link of one is a link of all. A row without id has no component and null ``kept``.
    """
    least = least_estimate(percent)
    sketch = written(sketches(docs, width, bands_for(percent)), "sketches")
    classes = written(
        sketch.filter("n > 0 AND doc_id IS NOT NULL")
        .groupBy("n", "digest_a", "digest_b")
        .agg(F.min("doc_id").alias("id"), F.first("bands").alias("bands")),
        "classes",
    )
    members = written(band_members(classes), "members")
    nodes = classes.select("id", "n", "bands")

    def side(name: str) -> DataFrame:
        return nodes.select(F.col("id").alias(name), F.col("n").alias(f"{name}_n"), F.col("bands").alias(f"{name}_bands"))

    pairs = members.filter("id <> pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()
    hopeful = written(_hopeful(pairs.join(side("a"), "a").join(side("b"), "b"), least).distinct(), "pairs")
    ids = members.select(F.col("id").alias("doc_id")).distinct()
    full = written(_sets(docs, ids, width), "sets")

    def set_of(name: str) -> DataFrame:
        return full.select(F.col("doc_id").alias(name), F.col("shingles").alias(f"{name}_set"))

    verified = hopeful.join(set_of("b"), "b").join(set_of("a"), "a")
    common = F.size(F.array_intersect("a_set", "b_set"))
    union = F.size("a_set") + F.size("b_set") - common
    near = written(verified.filter(100 * common >= percent * union).select("a", "b").distinct(), "links")
    first = components(near)

    # What the pivots left open: groups that still hold several components.
    labelled = members.filter("size > 2").join(first, "id", "left").withColumn("component", F.coalesce("component", "id"))
    labelled = written(labelled.join(nodes.select("id", "n").groupBy("id").agg(F.max("n").alias("n")), "id"), "labelled")
    still = labelled.groupBy("band", "key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.sum("n").alias("shingles_in"), F.count("*").alias("rows_in")
    )
    blocks = F.greatest(F.ceil(F.col("rows_in") / BLOCK_ROWS), F.ceil(F.col("shingles_in") / BLOCK_SHINGLES)).cast("int")
    still = written(still.filter("low < high").select("band", "key", blocks.alias("blocks")), "still")
    # Block i meets every block j >= i: each member goes to the pairs that hold its block.
    own = F.pmod(F.xxhash64(F.lit(5), "id"), F.col("blocks")).cast("int").alias("block")
    opened = labelled.filter("id <> pivot").join(still, ["band", "key"]).select("band", "key", "id", "component", "blocks", own)
    met = opened.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "band", "key", "id", "component", "block", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two")
    )
    rich = met.join(nodes, "id").join(full.withColumnRenamed("doc_id", "id"), "id")

    def links(table: pa.Table) -> pa.Table:
        return _block_links(table, percent, least)

    rest = rich.groupBy("band", "key", "one", "two").applyInArrow(links, "a long, b long")
    label = first.withColumnRenamed("id", "of")
    joined = written(rest.distinct(), "more_links")
    contracted = joined.join(label.select(F.col("of").alias("a"), F.col("component").alias("ca")), "a", "left").join(
        label.select(F.col("of").alias("b"), F.col("component").alias("cb")), "b", "left"
    )
    second = components(contracted.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
    merged = first.join(second.select(F.col("id").alias("component"), F.col("component").alias("to")), "component", "left").select(
        "id", F.coalesce("to", "component").alias("component")
    )
    alone = second.join(first, "id", "left_anti")
    of_class = merged.unionByName(alone.select("id", "component"))

    # Documents of a class share the component of its least id; rows that share an id join theirs.
    found = classes.join(of_class, "id", "left").select(
        "n", "digest_a", "digest_b", F.coalesce("component", "id").alias("component")
    )
    placed = written(sketch.drop("bands").join(found, ["n", "digest_a", "digest_b"], "left"), "placed")
    return _per_document(placed)


def _per_document(placed: DataFrame) -> DataFrame:
    """Ids that occur with several sets tie their components together; then one row per row."""
    several = placed.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("rows")
    )
    several = written(several.filter("rows > 1"), "repeated")
    ties = several.filter("low IS NOT NULL").select(F.col("doc_id").alias("a"), F.explode(F.array("low", "high")).alias("b"))
    ties = ties.unionByName(several.filter("low < high").select(F.col("low").alias("a"), F.col("high").alias("b")))
    component = F.coalesce("component", "doc_id")
    if ties.take(1):
        tied = components(ties)
        placed = placed.withColumn("component", component).join(
            tied.select(F.col("id").alias("component"), F.col("component").alias("to")), "component", "left"
        )
        component = F.coalesce("to", "component")
    component = F.when(F.col("doc_id").isNotNull(), component)
    return placed.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), (F.col("doc_id") == component).alias("kept")
    )


def keep_one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of documents, one of each group of near-duplicates, with their columns as they came.

    The document with the least id stays. Of rows that share that id the one with the smallest
    text stays; rows without id all stay.
    """
    found = written(near_duplicates(docs, width, percent), "groups")
    found = found.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.bool_or("kept").alias("kept"), F.count("*").alias("rows"))
    found = written(found.filter("NOT kept OR rows > 1"), "not_alone")
    repeated = found.filter("kept").select("doc_id")
    # Most rows are told to stay by a filter, where they are; those that may go meet the list of ids.
    words, columns = _id_filter(found.select("doc_id")), quoted(docs.columns)
    packed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.struct(*columns).alias("row"))
    gone = found.select("doc_id").hint("merge")
    stay = _filtered(packed, words, "left_anti").select("row.*")
    rest = stay.unionByName(_filtered(packed, words, "left_semi").join(gone, "doc_id", "left_anti").select("row.*"))
    if not repeated.take(1):
        return rest
    of_repeated = packed.join(repeated, "doc_id", "left_semi")
    one = of_repeated.groupBy("doc_id").agg(F.min_by("row", F.coalesce("row.text", F.lit(""))).alias("row"))
    return rest.unionByName(one.select("row.*"))
