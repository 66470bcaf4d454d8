"""Lines that many documents share are dropped, in DataFrame functions only.

Every text is split into lines; a line's key is the line stripped and lower-cased. Distinct keys of
each document are hashed and counted over all documents; a line whose key is found in enough of
them goes, everywhere. What stays is put together again by position.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from saleslake.llm.tables import quoted, written

SPACE = " \t\n\x0b\x0c\r"
MIN_DOCS = 10
MIN_CHARS = 1


def lines(text: Column) -> Column:
    """The lines of a text; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_keys(text: Column, min_chars: int = MIN_CHARS) -> Column:
    """Per line a hash of its key, null where the key has fewer than ``min_chars`` code points.

    A-Z alone are lowered, once for the whole text. The hash has 128 bits, so that no two keys of
    any corpus are taken for one."""
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    keys = F.transform(lines(lowered), lambda line: F.btrim(line, F.lit(SPACE)))
    return F.transform(keys, lambda key: F.when(F.length(key) >= min_chars, F.md5(key)))


def frequent_keys(hashed: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``key`` of those found in at least ``min_docs`` rows of ``hashed`` (column ``keys``).

    A document counts once for a key, however often it has the line. Counts are combined in each
    task before the shuffle, so a line of every document is a few rows."""
    found = hashed.select(F.explode(F.array_distinct("keys")).alias("key")).filter("key IS NOT NULL")
    return found.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_docs).select("key")


def drop_shared_lines(docs: DataFrame, text: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``kept_columns`` (a struct of all columns as they came), ``n_lines``, ``n_dropped`` (long)
    and ``kept`` (the lines that stay, joined by line feeds) of every row.

    A row is a document: rows that repeat an id, or whole rows that occur twice, count each. Null
    and empty texts are one empty line, which has no key and stays, as do other blank lines while
    ``min_chars`` is at least 1. A text that loses all lines is empty. An empty table stays empty.

    Texts and hashes are written once, under a row number that this table fixes. Hashes meet the
    frequent keys, which are a table too, so that both sides of that join are plain shuffles and
    adaptive execution splits a line with a third of all rows; only row numbers and positions of
    dropped lines are grouped, one group a document, and meet the texts in a sorted merge at every
    size, which moves each text once.
    """
    numbered = written(
        docs.select(
            F.struct(*quoted(docs.columns)).alias("kept_columns"),
            F.col(f"`{text}`").alias("text"),
            line_keys(F.col(f"`{text}`"), min_chars).alias("keys"),
            F.monotonically_increasing_id().alias("row"),
        ).drop("text"),
        "lines",
    )
    frequent = written(frequent_keys(numbered, min_docs), "frequent")
    placed = numbered.select("row", F.posexplode("keys").alias("at", "key")).filter("key IS NOT NULL")
    gone = placed.join(frequent, "key").groupBy("row").agg(F.collect_list("at").alias("gone"))
    gone = written(gone, "gone")
    whole = F.col(f"kept_columns.`{text}`")
    found = lines(whole)
    at = F.sequence(F.lit(0), F.size(found) - 1)
    # Places that stay come from a set difference, so a text of very many lines takes linear time.
    kept = F.transform(F.array(F.struct(found.alias("lines"), F.array_except(at, F.col("gone")).alias("at"))), _joined)[0]
    return numbered.drop("keys").join(gone.hint("merge"), "row", "left").select(
        "kept_columns",
        F.size(found).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.coalesce(whole, F.lit(""))).otherwise(kept).alias("kept"),
    )


def _joined(found: Column) -> Column:
    return F.array_join(F.transform(found["at"], lambda i: F.get(found["lines"], i)), "\n")


def line_digests(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` of every row of documents."""
    out = drop_shared_lines(docs.select("doc_id", "text"))
    return out.select("kept_columns.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def without_shared_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents with what stays of their texts (a null text becomes empty); other columns as they came."""
    out = drop_shared_lines(docs, "text", min_docs, min_chars)
    return out.select(*[(F.col("kept") if n == "text" else F.col("kept_columns").getField(n)).alias(n) for n in docs.columns])
