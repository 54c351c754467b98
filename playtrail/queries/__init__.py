"""Query registry: every operator of the inventory as a (Spark query, DuckDB oracle) pair.

Names are the inventory ID and the operator name in lower case
(``j10_label_by_next``). Each query takes the :class:`Tables` of one scale
factor and returns a DataFrame whose columns carry the same names as the
oracle's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from playtrail.oracles import with_fixtures
from playtrail.sources.fixtures import Tables

REGISTRY: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, ctes: str = ""):
    def deco(fn: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = fn
        if sql is not None:
            ORACLES[name] = with_fixtures(sql, ctes)
        return fn
    return deco


def _load() -> None:
    # Importing the modules fills the registry.
    from playtrail.queries import (q_base, q_features, q_models, q_relational,  # noqa: F401
                                   q_sequences)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {name: (lambda spark, sf_dir, _f=fn: _f(Tables(spark, sf_dir))) for name, fn in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(ORACLES)
