"""Intermediate tables in the folder that the whole cluster shares.

Tables written there replace lineage, so lost executors cost at most the work since the last table.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.sources.shared import delete, work_folder

#: Spark's own setting: shuffle files go when the query that wrote them has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WITHIN: ContextVar[str | None] = ContextVar("within", default=None)


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Queries run inside leave no shuffle files behind."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before) if before else spark.conf.unset(_CLEANUP)


@contextmanager
def temporary(spark: SparkSession, name: str) -> Iterator[None]:
    """Tables of every ``Scratch`` made inside are deleted at the end."""
    root = work_folder(spark, name)
    token = _WITHIN.set(root)
    try:
        yield
    finally:
        _WITHIN.reset(token)
        delete(spark, root)


class Scratch:
    """Parquet tables of one run, each readable by every executor and by a later retry."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = work_folder(spark, name)
        within = _WITHIN.get()
        if within:
            self.root = f"{within}/{self.root.rsplit('/', 1)[1]}"
        self.names: list[str] = []
        self.made = 0

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str | None = None) -> DataFrame:
        """Write ``df``, read it back, and let Spark remove the shuffle files that made it."""
        self.made += 1
        name = name or f"t{self.made}"
        self.names.append(name)
        with tidy(self.spark):
            df.write.parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Delete a table that no later step reads."""
        self.names.remove(name)
        delete(self.spark, self.path(name))

    def keep(self, *names: str) -> None:
        """Delete all tables but these, which the result still reads."""
        for name in [n for n in self.names if n not in names]:
            self.drop(name)
