"""Named queries with their SQL, collected by module."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siltstone.sources.tables import instant_table


class Tables:
    """The tables of one data folder, read on demand with instants in UTC."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return instant_table(self.spark, self.folder, name)


class Registry:
    """Queries by name; each takes (spark, folder) and has SQL where SQL can say it."""

    def __init__(self) -> None:
        self.found: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def query(self, sql: str | None = None, name: str | None = None):
        def add(f: Callable[[Tables], DataFrame]):
            key = name or f.__name__
            self.found[key] = lambda spark, folder: f(Tables(spark, folder))
            if sql:
                self.sql[key] = sql
            return f

        return add

    def queries(self) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
        return dict(self.found)

    def oracle_sql(self) -> dict[str, str]:
        return dict(self.sql)
