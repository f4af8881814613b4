"""Small helpers shared by the column functions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def case(branches: list[tuple[Column, Column | str]], default: Column | str | None = None) -> Column:
    """``CASE WHEN`` from a list of (condition, value); plain strings are literals."""
    def value(v: Column | str | None) -> Column:
        return v if isinstance(v, Column) else F.lit(v)

    first, *rest = branches
    chain = F.when(first[0], value(first[1]))
    for condition, result in rest:
        chain = chain.when(condition, value(result))
    return chain.otherwise(value(default))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is evaluated once, however often the body mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def all_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def lookup(key: ColumnLike, table: dict[str, str], default: str | None = None) -> Column:
    """Literal lookup table as a ``CASE`` expression (tables of a dozen entries)."""
    return case([(col(key) == k, v) for k, v in table.items()], default)


def flag(condition: Column) -> Column:
    """Boolean as 0/1 (null stays null)."""
    return condition.cast("int")


def rate(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """Ratio as double; null when the denominator is zero or null."""
    n, d = col(numerator).cast("double"), col(denominator).cast("double")
    return F.when(d != 0, n / d)
