"""Registered queries: a Spark plan over the given tables and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import emptied, new_folder, swept
from . import fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Bank:
    """The banking views over one folder of tables, each built when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._views: dict[str, DataFrame] = {}
        self._paths: dict[str, str] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._views:
            self._views[name] = self._build(name)
        return self._views[name]

    def once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A costly frame that several steps of one query need: computed once and written below the shared folder.

        Spark knows the size of a written table, so small ones are broadcast, and a step reads only the columns it needs.
        """
        if f"once {name}" not in self._views:
            rows, path = build(), new_folder(self.spark, f"once-{name.replace(' ', '-')}")
            with swept(self.spark):
                rows.write.option("compression", "zstd").parquet(path)
            self._views[f"once {name}"] = self.spark.read.schema(rows.schema).parquet(path)
            self._paths[name] = path
        return self._views[f"once {name}"]

    def take(self, name: str, rows: DataFrame) -> None:
        """``rows`` of a written table stand for what :meth:`once` would make under ``name``."""
        self._views.setdefault(f"once {name}", rows)

    def done(self, *names: str) -> None:
        """Frames of :meth:`once` that no step reads any more, nor a frame that is still to be computed: their files go."""
        for name in names:
            self._views.pop(f"once {name}", None)
            if name in self._paths:
                emptied(self.spark, self._paths.pop(name))

    def _build(self, name: str) -> DataFrame:
        if name not in fixtures.VIEWS:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        needs, text = fixtures.VIEWS[name]
        return self.spark.sql(text, **{n: getattr(self, n) for n in needs})


def query(name: str, sql: str | None = None):
    """Register ``fn(bank) -> DataFrame`` under ``name`` with its SQL twin."""

    def add(fn):
        QUERIES[name] = lambda spark, folder: fn(Bank(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def sql_over(views: str, body: str) -> str:
    """A SQL text that starts from the banking views; ``body`` goes on with more CTEs or a SELECT."""
    parts = [f"{n} AS ({fixtures.plain_sql(n)})" for n in fixtures.with_needs(views.split())]
    body = body.strip()
    joint = "\n" if body[:6].upper() == "SELECT" else ",\n"
    return "WITH RECURSIVE " + ",\n".join(parts) + joint + body


def dbl(column: str | Column, name: str | None = None) -> Column:
    """Decimals leave the registered queries as doubles, so both engines show one type."""
    c = F.col(column) if isinstance(column, str) else column
    return c.cast("double").alias(name or column)
