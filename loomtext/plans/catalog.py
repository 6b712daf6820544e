"""Registry of the catalogue queries: name -> (builder, reference SQL)."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

_BUILDERS: dict[str, Builder] = {}
_SQL: dict[str, str] = {}

MODULES = ["queries_text", "queries_guard", "queries_retrieval", "queries_history", "queries_flows", "queries_streams", "queries_sources"]


def query(name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    def register(fn: Builder) -> Builder:
        if name in _BUILDERS:
            raise ValueError(f"duplicate query: {name}")
        _BUILDERS[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn

    return register


def _load() -> None:
    for m in MODULES:
        importlib.import_module(f"loomtext.plans.{m}")


def builders() -> dict[str, Builder]:
    _load()
    return dict(_BUILDERS)


def sql_texts() -> dict[str, str]:
    _load()
    return dict(_SQL)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
