"""Registry of named queries with the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from sightline.plans.bindings import Inputs, oracle, plain
from sightline.session import configure


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Inputs], DataFrame]
    sql: str | None


CATALOG: dict[str, Query] = {}
STEPS: dict[str, str] = {}


def step(name: str, sql: str) -> None:
    """Name a checking-SQL result so that later queries can refer to it."""
    if name in STEPS:
        raise ValueError(f"step {name} exists")
    STEPS[name] = sql


def query(name: str, sql: str | None = None) -> Callable:
    def register(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        if name in CATALOG:
            raise ValueError(f"query {name} exists")
        CATALOG[name] = Query(name, build, sql)
        return build
    return register


def runner(q: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain(q.build(Inputs(configure(spark), folder)))
    return run


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: runner(q) for name, q in CATALOG.items()}


@cache
def all_oracles() -> dict[str, str]:
    return {name: oracle(q.sql, STEPS) for name, q in CATALOG.items() if q.sql}
