"""Sharding by extendible hashing, in DataFrame functions only.

A shard is a prefix of hash bits. The directory starts with one shard; a shard that exceeds the
byte limit splits on its next bit, and only that one, until every shard fits. Sizes are summed
once per round over cells of 16 more bits, so a round settles 16 splits at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from saleslake.llm.tables import quoted, written

LIMIT = 64 << 20
CELL_BITS = 16
KEY_BITS = 64
#: Bits that tell rows with equal keys apart, used where a key alone exceeds the limit.
ROW_BITS = 64


def key_bits(key: Column) -> Column:
    """64 hash bits of a key as a string of 0 and 1; a null key hashes as the empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.lpad(F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 2), KEY_BITS, "0")


def directory(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``shard, shard_bytes, shard_rows`` from ``bits, bytes`` of every row.

    All shards are at most ``limit`` bytes, but for one that holds a single larger row. It is the
    least directory: a shard's parent would exceed the limit. No rows, no shards.
    """
    todo = rows.select("bits", "bytes", F.lit(1).cast("long").alias("rows"))
    done, depth = None, 0
    while True:
        deepest = min(depth + CELL_BITS, KEY_BITS + ROW_BITS)
        sums = written(
            todo.groupBy(F.substring("bits", 1, deepest).alias("cell")).agg(
                F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")
            ),
            "sums",
        )
        # Every prefix of a cell with its size; a cell's shard is its shortest prefix that fits.
        depths = F.explode(F.sequence(F.lit(depth), F.lit(deepest))).alias("depth")
        prefixes = sums.select("cell", "bytes", "rows", depths).withColumn("prefix", F.expr("substring(cell, 1, depth)"))
        sizes = prefixes.groupBy("prefix").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
        last = deepest == KEY_BITS + ROW_BITS
        fits = (F.col("bytes") <= limit) | (F.col("rows") == 1) | (F.lit(last) & (F.length("prefix") == deepest))
        fitting = sizes.filter(fits)
        # A prefix within another that fits is no shard.
        parents = sizes.filter(~fits).select(F.col("prefix").alias("parent"))
        parent = F.expr("substring(prefix, 1, length(prefix) - 1)")
        root = fitting.filter(F.length("prefix") == depth)
        shards = fitting.filter(F.length("prefix") > depth).withColumn("parent", parent).join(parents, "parent", "left_semi")
        shards = root.unionByName(shards.select("prefix", "bytes", "rows"))
        found = written(
            shards.select(F.col("prefix").alias("shard"), F.col("bytes").alias("shard_bytes"), F.col("rows").alias("shard_rows")),
            "shards",
        )
        done = found if done is None else done.unionByName(found)
        open_cells = written(sizes.filter(~fits & (F.length("prefix") == deepest)).select(F.col("prefix").alias("open")), "open")
        if not open_cells.take(1):
            return done
        todo = written(
            todo.withColumn("open", F.substring("bits", 1, deepest)).join(open_cells, "open", "left_semi").drop("open"), "cells"
        )
        depth = deepest


def shard(rows: DataFrame, key: str, size: Column, carry: list[str], limit: int = LIMIT) -> DataFrame:
    """``kept_columns`` (a struct of those carried), ``shard`` (hash bits), ``n_bytes``,
    ``shard_bytes``, ``shard_rows`` of every row.

    A null size is 0. Rows with equal or null keys stay together unless they exceed the limit;
    then bits of their place in the written table tell them apart, so that a key with a third of
    all rows splits like any other. The carried columns are written once; their names may be any.
    """
    place = F.monotonically_increasing_id().cast("string")
    table = written(
        rows.select(
            F.struct(*quoted(carry)).alias("kept_columns"),
            key_bits(F.col(key)).alias("key"),
            F.coalesce(size.cast("long"), F.lit(0).cast("long")).alias("bytes"),
            place.alias("place"),
        ),
        "rows",
    ).select("kept_columns", F.concat("key", key_bits(F.col("place"))).alias("bits"), "bytes")
    shards = written(directory(table, limit), "directory")
    depths = [r[0] for r in shards.select(F.length("shard")).distinct().collect()]  # at most 129 numbers
    prefixes = F.explode(F.array(*(F.substring("bits", 1, d) for d in sorted(depths)))) if depths else F.lit("")
    placed = table.select("kept_columns", F.col("bytes").alias("n_bytes"), prefixes.alias("shard"))
    return placed.join(shards, "shard").select("kept_columns", "shard", "n_bytes", "shard_bytes", "shard_rows")


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT) -> None:
    """The documents as one folder of Parquet files per shard, ``path/shard=<bits>``."""
    sharded = shard(docs, "doc_id", F.octet_length("text"), docs.columns, limit)
    named = sharded.select("kept_columns.*", F.concat(F.lit("b"), "shard").alias("shard"))
    named.repartition("shard").write.partitionBy("shard").parquet(path)


def document_shards(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``doc_id, shard, n_bytes, shard_bytes, shard_docs`` of every row; a null text has 0 bytes."""
    sharded = shard(docs, "doc_id", F.octet_length("text"), ["doc_id"], limit)
    return sharded.select("kept_columns.doc_id", "shard", "n_bytes", "shard_bytes", F.col("shard_rows").alias("shard_docs"))
