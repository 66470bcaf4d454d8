"""Work tables: written once into the folder that driver and executors share, then read back."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

#: Tables of at most so many short rows are broadcast.
BROADCAST_ROWS = 50_000
_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Only a session that runs in one local process
    and names no folder (as in tests) gets a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return _LOCAL.setdefault(context.applicationId, tempfile.mkdtemp(prefix="llm-"))


def work_path(spark: SparkSession, name: str) -> str:
    """A path never used before."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows from a table: later plans start at files, and a lost executor costs a read."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def quoted(names: list[str]) -> list[Column]:
    """Columns by their whole names, which may hold dots."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in names]


def small_side(df: DataFrame, name: str, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A table of short rows, written and counted: few are broadcast, so that the rows they are
    joined to stay where they are; else Spark joins them as it sees fit, splitting hot keys."""
    table = written(df, name)
    return F.broadcast(table) if table.count() <= rows else table


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in short batches, so that a task holds few texts as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def with_computed(df: DataFrame, source: str, into: str, kind: T.DataType, compute: Callable[[pa.Array], pa.Array]) -> DataFrame:
    """The rows with ``into`` computed from ``source``, batch by batch: in its place, or at the end.

    The other columns ride along in a struct that no step touches, so their names may be any.
    """
    packed = df.select(F.struct(*quoted(df.columns)).alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = batch.column("row")
            yield pa.RecordBatch.from_arrays([rows, compute(rows.field(source))], ["row", "made"])

    made = packed.mapInArrow(run, T.StructType([*packed.schema.fields, T.StructField("made", kind)]))
    names = df.columns if into in df.columns else [*df.columns, into]
    return made.select(*[(F.col("made") if n == into else F.col("row").getField(n)).alias(n) for n in names])
