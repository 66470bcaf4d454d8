"""Queries of this subpackage and their SQL."""

import tempfile
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once per application: their tasks import it, and their
    path need not hold it. Spark distributes the archive itself."""
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    package = Path(__file__).parents[1]
    archive = Path(tempfile.mkdtemp(prefix="saleslake-")) / "saleslake.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(application)


def query(name: str, sql: str | None = None):
    """Register a query; SQL only where it can express the result over whole tables."""

    def add(build):
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return build(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
