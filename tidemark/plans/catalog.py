"""The registry: a decorated function per query, beside its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.views import Views, sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None):
    """Register a function of Views under its own name, with the body of its SQL."""

    def add(f: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(Views(spark, sf_dir))

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        QUERIES[f.__name__] = run
        if oracle:
            ORACLES[f.__name__] = sql(oracle)
        return f

    return add
