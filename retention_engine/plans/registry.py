"""Query registry: ``@query(name, sql=..., ops=...)`` records the Spark builder and its SQL oracle."""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ops: tuple[str, ...] = field(default_factory=tuple)
    doc: str = ""


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, ops: tuple[str, ...] = ()):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql.strip() if sql else None, tuple(ops), (fn.__doc__ or "").strip())
        return fn
    return deco


def load_all() -> dict[str, Query]:
    import importlib
    import importlib.util
    for m in MODULES:
        if importlib.util.find_spec(f"{__package__}.{m}") is not None:
            importlib.import_module(f"{__package__}.{m}")
    return REGISTRY


MODULES = ("q_ranking", "q_drift", "q_monitor", "q_fairness", "q_quality", "q_split", "q_prep",
           "q_profile", "q_selection", "q_gate", "q_models", "q_stream", "q_alerts")
