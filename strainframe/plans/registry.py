"""Where queries are registered under their names, with DuckDB SQL where there is some."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .views import sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame; ``oracle`` may name views as ``@view``."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = sql(oracle)
        return f

    return add
