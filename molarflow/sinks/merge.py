"""Keyed merges without a lakehouse format (SNK1-3, SNK5-7, WIN3, WIN4).

`MERGE INTO` is not available on plain Parquet, so an upsert is a union of the
stored rows and the batch followed by one aggregation per key that keeps the
winning row: `max_by(struct(payload), struct(batch, -ordinal))` = last batch
wins, first row wins inside a batch. It is an aggregation (partial, map-side)
rather than a window, and keys are ids, so no group is large.
"""

from __future__ import annotations

import datetime as dt
from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from molarflow.config import ERROR_TEXT_MAX
from molarflow.functions.text import truncate


def upsert(stored: DataFrame, batch: DataFrame, keys: Iterable[str], preserve: Iterable[str] = (),
           batch_col: str | None = None, ordinal_col: str | None = None, order: Column | None = None) -> DataFrame:
    """SNK1 (+ SNK3 `preserve`, WIN3, WIN4): insert new keys, overwrite every payload
    column of existing keys with the batch's row. Columns in `preserve` keep the
    stored value when the key already existed (insert-only columns).

    `batch_col` orders several batches inside `batch` (higher = later);
    `ordinal_col` orders rows inside one batch (lower = first, and first wins);
    `order` replaces both by any sortable expression over the batch (largest wins).
    Rows with a null key are dropped, as the backfill paths do.
    """
    keys, preserve = list(keys), list(preserve)
    payload = [c for c in stored.columns if c not in keys]
    if order is None:
        order = F.struct((F.col(batch_col) if batch_col else F.lit(0)).cast("bigint").alias("b"),
                         (-F.col(ordinal_col) if ordinal_col else F.lit(0)).cast("bigint").alias("o"))
    none = F.lit(None).cast(batch.select(order.alias("_o")).schema["_o"].dataType)
    s = stored.select(*keys, *payload, F.lit(False).alias("_new"), none.alias("_o"))
    b = batch.select(
        *keys, *[F.col(c) if c in batch.columns else F.lit(None).cast(stored.schema[c].dataType).alias(c)
                 for c in payload],
        F.lit(True).alias("_new"), order.alias("_o"))
    u = s.unionByName(b)
    for k in keys:
        u = u.where(F.col(k).isNotNull())
    rank = F.struct("_new", "_o")  # a stored row loses to any new one
    aggs = [F.max_by(F.struct(*payload), rank).alias("_w")]
    for c in preserve:
        aggs.append(F.min_by(F.struct(F.col(c).alias("v")), rank).alias(f"_p_{c}"))
    g = u.groupBy(*keys).agg(*aggs)
    cols = [F.col(k) for k in keys]
    for c in payload:
        cols.append(F.col(f"_p_{c}.v").alias(c) if c in preserve else F.col(f"_w.{c}").alias(c))
    return g.select(*cols)


def partial_merge(stored: DataFrame, batch: DataFrame, keys: Iterable[str], provided: Column | None = None,
                  provided_col: str = "_provided") -> DataFrame:
    """SNK2: per row of `batch`, only the columns listed in its `_provided`
    array<string> overwrite the stored row; an explicitly provided null still
    overwrites. Keys only in `batch` are inserted; keys only stored are kept."""
    keys = list(keys)
    payload = [c for c in stored.columns if c not in keys]
    n = batch.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in payload],
                     (provided if provided is not None else F.col(provided_col)).alias("_prov"),
                     F.lit(True).alias("_hit"))
    j = stored.join(n, keys, "full")
    cols = [F.col(k) for k in keys]
    for c in payload:
        take_new = F.coalesce(F.col("_hit"), F.lit(False)) & F.coalesce(F.array_contains("_prov", c), F.lit(False))
        cols.append(F.when(take_new, F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c))
    return j.select(*cols)


def sync_state_merge(state: DataFrame, run: DataFrame, run_at: dt.datetime) -> DataFrame:
    """SNK7 + SNK2: fold one run's per-(feed, clinic) outcome into the state table.

    `run` has feed, clinic_id, rows (delta), max_updated_at, error (null = ok).
    ok  -> every column: watermark advances to the max row timestamp (never back),
           status ok, error cleared (explicit null), total += rows;
    err -> only last_run_at / last_run_status / last_run_error (cut to 500 chars).
    """
    keys = ["feed", "clinic_id"]
    old = state.select(*keys, F.col("last_updated_at").alias("_old_wm"),
                       F.col("rows_synced_total").alias("_old_total"))
    r = run.join(old, keys, "left")
    ok = F.col("error").isNull()
    new = r.select(
        *keys,
        F.greatest(F.col("_old_wm"), F.col("max_updated_at")).alias("last_updated_at"),
        F.lit(run_at).cast("timestamp_ntz").alias("last_run_at"),
        F.when(ok, F.lit("ok")).otherwise(F.lit("error")).alias("last_run_status"),
        F.when(ok, F.lit(None).cast("string")).otherwise(truncate("error", ERROR_TEXT_MAX)).alias("last_run_error"),
        (F.coalesce(F.col("_old_total"), F.lit(0)) + F.coalesce(F.col("rows"), F.lit(0))).cast("bigint")
        .alias("rows_synced_total"),
        F.when(ok, F.array(*[F.lit(c) for c in ("last_updated_at", "last_run_at", "last_run_status",
                                                  "last_run_error", "rows_synced_total")]))
        .otherwise(F.array(F.lit("last_run_at"), F.lit("last_run_status"), F.lit("last_run_error")))
        .alias("_provided"),
    )
    return partial_merge(state, new, keys)


def retention_cutoff(now: dt.datetime, months: int = 2) -> dt.datetime:
    """SNK6: first instant of (current month - months)."""
    y, m = now.year, now.month - months
    while m <= 0:
        y, m = y - 1, m + 12
    return dt.datetime(y, m, 1)


def retention_keep(df: DataFrame, date_col: str, now: dt.datetime, months: int = 2) -> DataFrame:
    """SNK6: keep the current month and the `months` before it; null dates are kept."""
    cut = retention_cutoff(now, months)
    c = F.col(date_col)
    return df.where(c.isNull() | (c >= F.lit(cut).cast("timestamp_ntz")))


def retention_split(df: DataFrame, date_col: str, now: dt.datetime, months: int = 2) -> DataFrame:
    """Kept / dropped counts of a retention run."""
    cut = F.lit(retention_cutoff(now, months)).cast("timestamp_ntz")
    c = F.col(date_col)
    return df.agg(F.count_if(c.isNull() | (c >= cut)).alias("kept"), F.count_if(c < cut).alias("dropped"))


def state_listing(state: DataFrame, n: int | None = None) -> DataFrame:
    """SRT3: sync state ordered by cumulative rows (largest first), optional top-n."""
    df = state.orderBy(F.col("rows_synced_total").desc_nulls_first(), "feed", "clinic_id")
    return df.limit(n) if n else df


def sync_totals(run: DataFrame) -> DataFrame:
    """AGG14: rows, units and failed units per feed of one run (feed, clinic_id, rows, error), and in total."""
    return run.rollup("feed").agg(F.sum("rows").alias("rows"), F.count_distinct("clinic_id").alias("clinics"),
                                  F.count("error").alias("errors"))
