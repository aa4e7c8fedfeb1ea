"""Registry of named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from refrain.plans.warehouse import Warehouse

Query = Callable[..., DataFrame]  # (spark, root), and as_of by name
REGISTRY: dict[str, Query] = {}


def query(name: str) -> Callable[[Callable[[Warehouse], DataFrame]], Callable[[Warehouse], DataFrame]]:
    """Register ``fn(warehouse)`` as the query ``name(spark, sf_dir)``; ``as_of`` fixes its reporting day."""

    def register(fn: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = lambda spark, root, as_of=None: fn(Warehouse(spark, root, as_of=as_of))
        return fn

    return register
