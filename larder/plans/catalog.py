"""All registered queries and their SQL oracles, gathered from the plan modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import connectors, layers, quality, registry, sketches  # noqa: F401  (registration side effects)
    return dict(registry.QUERIES)


def all_oracles() -> dict[str, str]:
    from . import oracle, oracle_layers, oracle_quality  # noqa: F401
    return dict(oracle.ORACLE)
