"""Named queries over a folder of Parquet tables, each with SQL for a second engine where it can be said there."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with the SQL of the same result."""

    def put(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return put


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.tag_filter_size(spark, sf_dir)


from . import corpus, dedupes, inputs, scalars, streams, tables  # noqa: E402, F401  the modules register their queries
