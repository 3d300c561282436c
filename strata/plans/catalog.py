"""Registry of named queries: each maps (spark, sf_dir) -> DataFrame, with an optional
DuckDB oracle SQL over the same parquet tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ids: str


REGISTRY: dict[str, Query] = {}


def query(name: str, ids: str = "", sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with its oracle SQL."""

    def deco(fn):
        if name in REGISTRY:
            raise KeyError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql.strip() if sql else None, ids)
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from ..sources.io import read_table
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column (comparison hygiene; both engines do the same)."""
    return df.select(*[
        F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
        for f in df.schema.fields])


def load_all() -> dict[str, Query]:
    # importing the plan modules fills the registry
    from . import (evaluation, features, imaging, retrieval, sources_q, tabular,  # noqa: F401
                   text_q)
    return REGISTRY
