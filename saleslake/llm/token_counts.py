"""Token counts of documents in flat, unindexed token files, by scanning for separators.

A file is a row of 16-bit ids, read as blocks; each document ends with the separator id. Blocks
are scanned by themselves with vectorised searches; a prefix scan over what they found then
stitches the documents that run across block boundaries.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from saleslake.llm.tables import work_path, written
from saleslake.llm.tokens import BYTE_BPE, encode

SEPARATOR = 50256
BLOCK_IDS = 1 << 16
SEGMENT = 1024  # blocks that one step of the prefix scan adds up
#: Bytes of a file that one task reads in a row, and the most tasks that ranges are dealt to.
RANGE_BYTES = 16 << 20
RANGE_TASKS = 20_000
BLOCKS = "file string, block long, data binary"
LINES = "ISO-8859-1"  # any two bytes are a line separator


def _opened(path: str) -> pa.NativeFile:
    """A file by the path that Spark lists it under, for reads at any place."""
    scheme, rest = path.split(":", 1)
    if scheme == "file":
        return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    store, at = fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}:{quote(rest, safe='/:@')}")
    return store.open_input_file(at)


def flat_blocks(spark: SparkSession, path: str, block_ids: int = BLOCK_IDS) -> DataFrame:
    """``file, block, data`` of the flat files in a folder, by any path that Spark reads."""
    return _blocks_of(spark.read.format("binaryFile").load(path).select("path", "length"), block_ids)


def _blocks_of(files: DataFrame, block_ids: int = BLOCK_IDS) -> DataFrame:
    """``file, block, data`` of the files listed as ``path, length``, of any length: tasks read byte
    ranges. A store that only Spark opens is read by Spark."""
    first, step = files.filter("length > 0").first(), 2 * block_ids
    if first:
        try:
            _opened(first.path).close()
        except (OSError, pa.ArrowException):
            return _blocks_by_spark(files, step)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, length, begin, end in zip(*(c.to_pylist() for c in batch.columns)):
                with _opened(path) as file:
                    for block in range(begin, end):
                        size = min(step, length - block * step)
                        file.seek(block * step)
                        data = file.read(size)
                        if len(data) < size:
                            raise OSError(f"{path} ends within block {block}, before its {length} bytes")
                        row = [pa.array([path]), pa.array([block]), pa.array([data], pa.binary())]
                        yield pa.RecordBatch.from_arrays(row, ["file", "block", "data"])

    n, each = F.ceil(F.col("length") / step), max(1, RANGE_BYTES // step)
    begin = F.explode(F.sequence(F.lit(0).cast("long"), n - 1, F.lit(each).cast("long"))).alias("begin")
    ranges = files.filter("length > 0").select("path", "length", begin, n.alias("n"))
    ranges = ranges.select("path", "length", "begin", F.least(F.col("begin") + each, "n").alias("end"))
    tasks = min(max(ranges.count(), 1), RANGE_TASKS)  # a number, or Spark merges the short rows into few tasks
    return ranges.repartition(tasks).mapInArrow(read, BLOCKS)


def _blocks_by_spark(files: DataFrame, step: int) -> DataFrame:
    """The same by Spark's readers alone: short files whole, each long one as records of the largest
    even size that divides its length, as Spark reads no shorter last record."""
    spark = files.sparkSession

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path"), batch.column("content")):
                data = memoryview(content.as_buffer())
                for at in range(0, len(data), step):
                    row = [pa.array([file.as_py()]), pa.array([at // step]), pa.array([bytes(data[at : at + step])], pa.binary())]
                    yield pa.RecordBatch.from_arrays(row, ["file", "block", "data"])

    def escaped(path: str) -> str:
        return re.sub(r"([\\{}\[\]*?])", r"\\\1", path).replace(",", "{\\,}")

    # Listed anew with their content, which Spark reads of files that pass the filter on length only.
    short = files.filter(F.col("length").between(1, RANGE_BYTES))
    folders = [r[0] for r in short.select(F.regexp_replace("path", "/[^/]*$", "")).distinct().collect()]
    found = spark.createDataFrame([], BLOCKS)
    if folders:
        whole = spark.read.format("binaryFile").load([escaped(f) for f in folders]).filter(F.col("length").between(1, RANGE_BYTES))
        whole = whole.select("path", "content").join(short.select("path"), "path", "left_semi")
        found = found.unionByName(whole.mapInArrow(cut, BLOCKS))
    for path, length in files.filter(F.col("length") > RANGE_BYTES).collect():
        if length % 2:
            raise ValueError(f"{path} holds {length} bytes, no row of 16-bit ids")
        size = max(d for d in range(2, step + 1, 2) if length % d == 0)
        records = spark.sparkContext.newAPIHadoopFile(
            escaped(path), "org.apache.spark.input.FixedLengthBinaryInputFormat",
            "org.apache.hadoop.io.LongWritable", "org.apache.hadoop.io.BytesWritable",
            conf={"org.apache.spark.input.FixedLengthBinaryInputFormat.recordLength": str(size)},
        )
        found = found.unionByName(spark.createDataFrame(records.map(lambda r, path=path: (path, r[0], bytes(r[1]))), BLOCKS))
    return found


def write_token_files(docs: DataFrame, folder: str, path: str = BYTE_BPE, separator: int = SEPARATOR) -> None:
    """Flat files ``kind=0/part-...`` of every task's documents, each document ended by the separator;
    and under the same name in ``kind=1`` the ``ordinal,doc_id`` of each. A null text has no ids."""
    ends = int(separator).to_bytes(2, "little")
    if not set(ends) - set(b"0123456789,-"):
        raise ValueError("the separator may not be in the list of documents")

    def flatten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ordinal = 0
        for batch in batches:
            for part in (batch.slice(at, 256) for at in range(0, batch.num_rows, 256)):
                # Special tokens are text here, so no document holds the separator.
                data = [encode(text.as_py(), path, special_as_text=True).astype("<u2").tobytes() for text in part.column("text")]
                ids, numbers = part.column("doc_id").to_pylist(), range(ordinal, ordinal + len(data))
                lines = [f"{n},{'' if i is None else i}".encode() for n, i in zip(numbers, ids)]
                for kind, values in enumerate([data, lines]):
                    row = [pa.array([kind] * len(data), pa.int32()), pa.array(numbers, pa.int64()), pa.array(values, pa.binary())]
                    yield pa.RecordBatch.from_arrays(row, ["kind", "ordinal", "value"])
                ordinal += len(data)

    made = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(flatten, "kind int, ordinal long, value binary")
    # The order of each task's rows as they are; Spark's writer of lines ends each by the two bytes.
    made = made.sortWithinPartitions("kind", "ordinal").select(F.col("value").cast("string").alias("value"), "kind")
    lines = made.write.partitionBy("kind").option("maxRecordsPerFile", 0).option("compression", "none")
    lines.option("encoding", LINES).option("lineSep", ends.decode(LINES)).text(folder)


def count_tokens(blocks: DataFrame, separator: int = SEPARATOR) -> DataFrame:
    """``file, ordinal, start, n_tokens, ended`` of every document in blocks of flat files.

    ``start`` counts ids from the file's first; the separator itself is not counted. What follows
    the last separator of a file is a document with ``ended`` false; nothing there, no document.
    Blocks may be of any length, empty ones too; a null block is empty.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, ends = [], []
            for data in batch.column("data"):
                ids = np.frombuffer(data.as_buffer(), dtype="<u2") if data.is_valid else np.zeros(0, dtype="<u2")
                n.append(len(ids))
                ends.append(np.flatnonzero(ids == separator))
            columns = [batch.column("file"), batch.column("block"), pa.array(n, pa.int64()), pa.array(ends, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["file", "block", "n", "ends"])

    found = blocks.select("file", "block", "data").mapInArrow(search, "file string, block long, n long, ends array<long>")
    found = written(found.withColumn("segment", F.floor(F.col("block") / SEGMENT)), "ends")

    # Prefix scan: over the sums of segments first, then over the blocks of each.
    last = F.col("before") + F.element_at("ends", -1)
    within = Window.partitionBy("file", "segment").orderBy("block")
    earlier = within.rowsBetween(Window.unboundedPreceding, -1)
    size = F.size("ends").cast("long")
    local = found.withColumns({"before": F.coalesce(F.sum("n").over(earlier), F.lit(0)), "ends_before": F.coalesce(F.sum(size).over(earlier), F.lit(0))})
    local = local.withColumn("last", F.when(size > 0, last)).withColumn("last_before", F.max("last").over(earlier))
    segments = local.groupBy("file", "segment").agg(F.sum("n").alias("n"), F.sum(size).alias("docs"), F.max("last").alias("last"))
    upto = Window.partitionBy("file").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("n").over(upto), F.lit(0))
    segments = segments.withColumns({"base": base, "docs_base": F.coalesce(F.sum("docs").over(upto), F.lit(0))})
    segments = segments.withColumn("last_base", F.max(F.col("base") + F.col("last")).over(upto))
    stitched = local.join(segments.select("file", "segment", "base", "docs_base", "last_base"), ["file", "segment"])

    first = F.col("base") + F.col("before")
    previous = F.coalesce(F.col("base") + F.col("last_before"), F.col("last_base"), F.lit(-1).cast("long"))
    ends = stitched.select("file", (F.col("docs_base") + F.col("ends_before")).alias("docs"), first.alias("first"), previous.alias("previous"), "ends")
    each = ends.select("file", "docs", "first", "previous", "ends", F.posexplode("ends").alias("i", "end"))
    start = F.when(F.col("i") == 0, F.col("previous") + 1).otherwise(F.col("first") + F.element_at("ends", F.greatest(F.col("i"), F.lit(1))) + 1)
    ended = each.select(
        "file", (F.col("docs") + F.col("i")).alias("ordinal"), start.alias("start"),
        (F.col("first") + F.col("end") - start).alias("n_tokens"), F.lit(True).alias("ended"),
    )
    whole = segments.groupBy("file").agg(
        F.sum("docs").alias("ordinal"), F.sum("n").alias("n"), (F.coalesce(F.max(F.col("base") + F.col("last")), F.lit(-1)) + 1).alias("start")
    )
    open_ended = whole.filter("n > start").select("file", "ordinal", "start", (F.col("n") - F.col("start")).alias("n_tokens"), F.lit(False).alias("ended"))
    return ended.unionByName(open_ended)


def document_token_counts(docs: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, file, ordinal, start`` of every row: the documents' flat token files,
    counted by separator scan. A null or empty text has 0 tokens; repeated rows count each."""
    spark, path = docs.sparkSession, work_path(docs.sparkSession, "tokens")
    write_token_files(docs, path)
    files = spark.read.format("binaryFile").load(path)
    if "kind" not in files.columns:  # no documents, no files
        return spark.createDataFrame([], "doc_id long, n_tokens long, file string, ordinal long, start long")

    def part(name: str):
        return F.concat(F.lit("part-"), F.lpad(F.regexp_extract(name, r"part-(\d+)-[^/]*$", 1), 6, "0")).alias("file")

    blocks = _blocks_of(files.filter("kind = 0").select("path", "length")).select(part("file"), "block", "data")
    counted = count_tokens(blocks).select("file", "ordinal", "start", "n_tokens")
    listed = spark.read.option("encoding", LINES).option("lineSep", SEPARATOR.to_bytes(2, "little").decode(LINES)).text(path)
    listed = listed.filter("kind = 1").select(part("_metadata.file_name"), F.split("value", ",").alias("place"))
    places = listed.select("file", F.expr("CAST(place[0] AS long)").alias("ordinal"), F.expr("CAST(nullif(place[1], '') AS long)").alias("doc_id"))
    return places.join(counted, ["file", "ordinal"]).select("doc_id", "n_tokens", "file", "ordinal", "start")
