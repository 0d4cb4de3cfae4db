"""Feed tables, the allowlisted generic scan and extraction work lists (SRC1, SRC3, SRC4, SRC5, SRC6)."""

from __future__ import annotations

import datetime as dt
import os
from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from molarflow import schemas
from molarflow.sinks.versioned import VersionedTable


class UnknownTable(KeyError):
    """SRC3: a table outside the allowlist (the reference answers 403)."""


def read_feed(spark: SparkSession, root: str, feed: str) -> DataFrame:
    """SRC1: a feed table stored as Parquet under `root/feed`, read with its explicit
    schema (never inferred). Month partitions, when present, are discovered and
    pruned by filters on the partition column."""
    if feed not in schemas.FEEDS:
        raise UnknownTable(feed)
    schema, _, _ = schemas.FEEDS[feed]
    return spark.read.schema(schema).option("mergeSchema", "false").parquet(os.path.join(root, feed))


_OPS = {
    "eq": lambda c, v: c == v,
    "neq": lambda c, v: c != v,
    "gt": lambda c, v: c > v,
    "gte": lambda c, v: c >= v,
    "lt": lambda c, v: c < v,
    "lte": lambda c, v: c <= v,
    "in": lambda c, v: c.isin(list(v)),
    "is": lambda c, v: c.isNull() if v is None else (c == v),
    "not_null": lambda c, v: c.isNotNull(),
    "contains": lambda c, v: F.instr(c, str(v)) > 0,
    "cs": lambda c, v: F.array_contains(c, v),
}


def scan(tables: Mapping[str, DataFrame], table: str, select: Sequence[str] | None = None,
         filters: Iterable[tuple[str, str, object]] = (), order: Iterable[tuple[str, str]] = (),
         offset: int = 0, limit: int | None = None) -> DataFrame:
    """SRC3: filtered scan over allowlisted tables. `filters` are (column, op, value)
    triples ANDed together; `order` is (column, 'asc'|'desc') with Postgres null
    order. Everything becomes Column predicates, so filters reach the Parquet scan."""
    if table not in tables:
        raise UnknownTable(table)
    df = tables[table]
    for col, op, val in filters:
        if op not in _OPS:
            raise ValueError(f"unknown operator {op}")
        df = df.where(_OPS[op](F.col(col), val))
    if select:
        df = df.select(*select)
    ords: list[Column] = []
    for col, direction in order:
        ords.append(F.col(col).asc_nulls_last() if direction == "asc" else F.col(col).desc_nulls_first())
    if ords:
        df = df.orderBy(*ords)
    if offset:
        df = df.offset(offset)
    if limit is not None:
        df = df.limit(limit)
    return df


def active_units(units: DataFrame, regional: str | None = None, clinic_id: str | None = None,
                 require_account: bool = False) -> DataFrame:
    """SRC4: units with a clinic id (and a CRM account when required), optionally one
    regional or a single unit. A dimension: a few hundred rows at most."""
    df = units.where(F.col("clinic_id").isNotNull())
    if require_account:
        df = df.where(F.col("account_id").isNotNull())
    if regional:
        df = df.where(F.col("regional") == regional)
    if clinic_id:
        df = df.where(F.col("clinic_id") == clinic_id)
    return df


def nightly_window(today: dt.date, days: int = 29) -> tuple[dt.date, dt.date]:
    """SRC5: nightly catch-up = max(month start, today - days) .. today (<= 31 days)."""
    return max(today.replace(day=1), today - dt.timedelta(days=days)), today


def work_list(units: DataFrame, feeds: Sequence[str], start: dt.datetime, end: dt.datetime,
              period_days: int = 15) -> DataFrame:
    """SRC5: one row per (feed, clinic, period) with periods of at most
    `period_days` days covering [start, end). Built with `sequence` + `explode`
    on the executors; its size is units x feeds x periods."""
    last = end - dt.timedelta(days=1)
    periods = F.sequence(F.lit(start).cast("timestamp_ntz"), F.lit(last).cast("timestamp_ntz"),
                         F.expr(f"INTERVAL {period_days} DAYS"))
    w = (units.where(F.col("clinic_id").isNotNull())
         .select("clinic_id", F.explode(F.array(*[F.lit(f) for f in feeds])).alias("feed"))
         .select("feed", "clinic_id", F.explode(periods).alias("period_start")))
    return w.withColumn("period_end", F.least(F.col("period_start") + F.make_dt_interval(F.lit(period_days)),
                                              F.lit(end).cast("timestamp_ntz")))


def pending_work(work: DataFrame, done: DataFrame, keys=("feed", "clinic_id", "period_start")) -> DataFrame:
    """SRC6: skip units of work the state says are done (anti-join, never a collect)."""
    return work.join(done.select(*keys).distinct(), list(keys), "left_anti")


class LakeTables:
    """Domain tables stored under one root, read with their explicit schemas: the current version of a
    table that an ingest writes (at `root/name`, or `root/name/table` as the feed jobs lay it out), or a plain
    Parquet folder. Same attribute surface as the test adapters, so every operator and API
    function runs on either. A version is fixed when the attribute is read."""

    _SCHEMAS = {"leads": schemas.LEADS, "units": schemas.UNITS, "users": schemas.USERS,
                "sync_state": schemas.SYNC_STATE, "campaign_contacts": schemas.CAMPAIGN_CONTACTS}

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def __getattr__(self, name: str) -> DataFrame:
        schema = schemas.FEEDS[name][0] if name in schemas.FEEDS else self._SCHEMAS.get(name)
        if schema is None:
            raise AttributeError(name)
        for path in (os.path.join(self.root, name), os.path.join(self.root, name, "table")):
            table = VersionedTable(self.spark, path, schema, [])
            if table.versions():
                return table.read()
        return self.spark.read.schema(schema).option("mergeSchema", "false").parquet(os.path.join(self.root, name))
