"""A query and its SQL twin are declared together."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomwright.session import table

Tables = Callable[[str], DataFrame]


class Registry:
    """Queries by name, and the SQL of those that SQL can say."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def query(self, sql: str | None = None):
        """Register a function of a table reader under its name; it may take the session as a second argument."""

        def add(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
            def run(spark: SparkSession, folder: str) -> DataFrame:
                read: Tables = lambda name: table(spark, folder, name)
                return function(read, spark) if function.__code__.co_argcount > 1 else function(read)

            self.queries[function.__name__] = run
            if sql:
                self.sql[function.__name__] = sql
            return function

        return add
