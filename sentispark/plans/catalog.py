"""Registry of named queries: a Spark builder plus, where SQL can say the same
thing, the DuckDB oracle text.  ``__spark_entry__`` exposes this registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class QuerySpec:
    name: str
    build: Builder
    sql: str | None
    ops: tuple[str, ...] = field(default_factory=tuple)


REGISTRY: dict[str, QuerySpec] = {}


def register(name: str, sql: str | None = None, ops: tuple[str, ...] = ()):
    """Decorator: add ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    if name in REGISTRY:
        raise ValueError(f"duplicate query {name!r}")

    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = QuerySpec(name, fn, sql, tuple(ops))
        return fn
    return deco


PLAN_MODULES = ("q_text", "q_terms", "q_features", "q_evaluate", "q_phrases", "q_models", "q_sources")


def load_all() -> dict[str, QuerySpec]:
    """Import every plan module; importing registers its queries."""
    import importlib
    for m in PLAN_MODULES:
        importlib.import_module(f"sentispark.plans.{m}")
    return REGISTRY
