"""Registry of checked queries: a Spark callable and, where SQL can express
it, the equivalent DuckDB SQL over the raw test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    note: str = ""


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, note: str = ""):
    def deco(fn):
        REGISTRY[name] = Query(name, fn, sql, note)
        return fn
    return deco
