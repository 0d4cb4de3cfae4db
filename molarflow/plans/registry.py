"""Registry of named queries: each has a Spark builder and (usually) a DuckDB oracle."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from molarflow.sources import testdata


@dataclass
class QuerySpec:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    covers: str


REGISTRY: dict[str, QuerySpec] = {}


def register(name: str, sql: str | None, covers: str = ""):
    def deco(fn):
        REGISTRY[name] = QuerySpec(name, fn, sql, covers)
        return fn
    return deco


_FRAMES: dict[tuple, DataFrame] = {}


class Tables:
    """Lazy access to the domain tables derived from one test-data folder.

    DataFrames are immutable plans, so one adapter plan per (session, folder) is
    built once and shared by every query: no data is cached, only the analysed
    plan, which saves the driver from re-analysing wide adapter projections."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in testdata.ADAPTERS and name not in testdata.TABLES:
            raise AttributeError(name)
        key = (self.spark.sparkContext.applicationId, id(self.spark._jsparkSession), self.sf_dir, name)
        df = _FRAMES.get(key)
        if df is None:
            df = (testdata.domain(self.spark, self.sf_dir, name) if name in testdata.ADAPTERS
                  else testdata.raw(self.spark, self.sf_dir, name))
            _FRAMES[key] = df
        return df
