"""Key -> (Spark plan builder, oracle SQL) registry."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class QuerySpec:
    key: str
    build: Builder
    sql: str | None
    section: str

    @property
    def check(self) -> str:
        return "E" if self.sql else "R"


REGISTRY: dict[str, QuerySpec] = {}

_MODULES = [
    "fundlens.plans.q_dashboard",
    "fundlens.plans.q_clean",
    "fundlens.plans.q_profile",
    "fundlens.plans.q_io",
    "fundlens.plans.q_sampling",
    "fundlens.plans.q_features",
    "fundlens.plans.q_models",
]


def register(key: str, sql: str | None = None, section: str = ""):
    def deco(fn: Builder) -> Builder:
        if key in REGISTRY:
            raise KeyError(f"duplicate query key {key}")
        REGISTRY[key] = QuerySpec(key, fn, sql, section)
        return fn
    return deco


def load_all() -> dict[str, QuerySpec]:
    for mod in _MODULES:
        try:
            importlib.import_module(mod)
        except ModuleNotFoundError as e:  # modules land one by one
            if e.name != mod:
                raise
    return REGISTRY


def queries() -> dict[str, Builder]:
    return {k: v.build for k, v in load_all().items()}


def oracle_sql() -> dict[str, str]:
    return {k: v.sql for k, v in load_all().items() if v.sql}
