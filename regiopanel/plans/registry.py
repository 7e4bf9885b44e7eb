"""Registered queries with the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from regiopanel.plans.standins import Standins
from regiopanel.session import tune


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    covers: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def register(covers: str, sql: str | None = None, name: str | None = None, store: str = ""):
    """Register a function of the stand-in feeds under its own name.

    ``store`` names the intermediates the query reads several times.
    """

    def add(build: Callable[[Standins], DataFrame]) -> Callable[[Standins], DataFrame]:
        key = name or build.__name__
        if key in REGISTRY:
            raise ValueError(f"query {key} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Standins(tune(spark), folder, store.split()))

        REGISTRY[key] = Query(run, sql, tuple(covers.split()))
        return build

    return add
