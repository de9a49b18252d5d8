"""Registry of named, runnable queries with their DuckDB oracle SQL.

Each module that defines queries calls :func:`register`; ``__spark_entry__``
exposes the collected callables and SQL strings.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkloom.sources.files import load_parquet

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@dataclass(frozen=True)
class Registered:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None


_REGISTRY: dict[str, Registered] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        if name in _REGISTRY:
            raise KeyError(f"query {name!r} registered twice")
        _REGISTRY[name] = Registered(name, fn, sql)
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def all_queries() -> dict[str, Registered]:
    # import for side effects: each module registers its queries
    from sparkloom.plans import table_queries  # noqa: F401
    from sparkloom.plans import feature_queries  # noqa: F401

    return dict(_REGISTRY)
