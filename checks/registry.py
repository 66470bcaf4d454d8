"""Registry of checks: each pairs a Spark query with SQL for the same result."""

import re
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from checks.lake import Lake, check_folder, raw_feed
from checks.tables_sql import TABLES
from saleslake.operators.cleaning import clean, valid_rows
from saleslake.operators.silver import drop_copies, golden_records, nullify_aliases
from saleslake.sources.layers import Gold
from saleslake.sources.scratch import written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# A range with history before it and facts after it.
START, END = "2016-01-01", "2020-12-31"


class Context:
    """What a query may start from at one scale."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def raw(self) -> DataFrame:
        return raw_feed(self.spark, self.sf_dir)

    @cached_property
    def tagged(self) -> DataFrame:
        return clean(self.raw)

    @cached_property
    def valid(self) -> DataFrame:
        return valid_rows(self.tagged)

    @cached_property
    def aliased(self) -> DataFrame:
        return nullify_aliases(drop_copies(self.valid))

    @cached_property
    def golden(self) -> DataFrame:
        return written(golden_records(self.valid), self.folder("golden"))

    def folder(self, name: str) -> str:
        return check_folder(self.spark, name)

    @cached_property
    def lake(self) -> Lake:
        return Lake.of(self.spark, self.sf_dir)

    @cached_property
    def silver(self) -> DataFrame:
        return self.lake.silver

    @cached_property
    def gold(self) -> Gold:
        return self.lake.gold


def with_tables(sql: str) -> str:
    """Put the table definitions the text refers to, and theirs in turn, in front."""

    def mentioned(text: str) -> set[str]:
        return {t for t in TABLES if re.search(rf"\b{t}\b", text)}

    needed, todo = set(), mentioned(sql)
    while todo:
        needed |= todo
        todo = set().union(*(mentioned(TABLES[t]) for t in todo)) - needed
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{t} AS ({TABLES[t]})" for t in TABLES if t in needed) + "\n" + sql


def check(name: str, sql: str):
    """Register a query under its name together with its SQL."""

    def add(build: Callable[[Context], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: build(Context(spark, sf_dir))
        ORACLE[name] = with_tables(sql)
        return build

    return add
