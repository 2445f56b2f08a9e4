"""Registry of named queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from helixspan.registry.views import Tables, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Register a function of the tables under its name, with its oracle SQL."""

    def register(build: Callable[[Tables], DataFrame]):
        @wraps(build)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(spark, folder))

        QUERIES[build.__name__] = run
        if oracle:
            ORACLES[build.__name__] = with_views(oracle)
        return build

    return register
