"""Registration of queries with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixtures import with_views
from ..sources.tables import written as written  # noqa: PLC0414

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, query: Query, sql: str | None = None, *views: str) -> None:
        """views: the fixtures that the SQL reads."""
        assert name not in self.queries, name
        self.queries[name] = query
        if sql is not None:
            self.sql[name] = with_views(sql.strip(), *views) if views else sql


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to so many digits: sums over a shuffle depend on the order of their rows in the last ones."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
