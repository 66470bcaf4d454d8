"""Work tables: they cut lineage, and lie in a folder that every executor reaches."""

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def file_system(spark: SparkSession, path: str) -> tuple:
    """The file system a path lies on, whatever it is, and the path as that takes it."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder on whatever file system it lies."""
    files, folder = file_system(spark, path)
    files.delete(folder, True)


@contextmanager
def work_folder(spark: SparkSession, base: str) -> Iterator[str]:
    """A new folder under the caller's base path, removed at the end."""
    path = f"{base}/work/{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        remove(spark, path)


def written(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Write the rows once and read them back: later plans start from files, lost
    executors cost a read, and the planner knows the size."""
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
