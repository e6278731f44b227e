"""Named queries and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

Query = Callable[[SparkSession, str], DataFrame]


class Catalogue:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        """Registers the decorated function under a name.

        The registered query gives dates as text, which every client of Spark and
        of the SQL database shows alike.
        """

        def add(run: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"query {name!r} exists")

            @wraps(run)
            def with_plain_dates(spark: SparkSession, folder: str) -> DataFrame:
                result = run(spark, folder)
                dates = [f.name for f in result.schema if isinstance(f.dataType, DateType)]
                texts = {c: F.col(c).cast("string") for c in dates}
                return result.withColumns(texts) if texts else result

            self.queries[name] = with_plain_dates
            if sql is not None:
                self.sql[name] = sql
            return run

        return add
