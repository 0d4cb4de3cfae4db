"""A keyed Parquet table with versions: upserts, moves, deletes and retention that survive a crash.

    root/data/v=N-ATTEMPT/month=yyyy-MM/slice=K/   rows written for version N
    root/keys/v=N-ATTEMPT/bucket=B/                keys of a hash bucket that version N placed, with month and slice
    root/manifest/N.json                           the folders that make up version N

`month` is the month of the row's date (`none` without a date), `slice` a hash of its unit
(or key) modulo the number of slices, which the first commit chooses by size, so there are at most months x slices folders, however many units;
only that list reaches the driver. An upsert writes the places of its keys into folders of their own, one
a hash bucket, looks up in the key locator where the keys were, reading only the buckets they fall into, and
rewrites the folders that hold them now and those its rows belong to into folders of its own. A row meets its
stored version inside its folder; where a key leaves a folder, a mark without a row ends it there. So rows are dealt
once, by folder. The change is committed by creating the manifest of the version after the one it read. A bucket is a
list of such folders of which the latest place of a key counts; after MAX_PIECES of them it is written as one.
A reader sees the version before or the one after; a run that dies in between leaves folders that no manifest names.

Two writers cannot lose each other's rows: only one can create a version's manifest. The other one
finds it there, and merges its batch again into what is now the current version.

Nothing is deleted before `vacuum`, which has to run without writers.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass, replace
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from molarflow.functions.misc import year_month
from molarflow.session import ensure_checkpoint_dir, join_side, passing
from molarflow.sinks.files import _fs
from molarflow.sinks.merge import retention_cutoff, upsert

#: Without a stated number, the first commit cuts each month into slices of at most so many rows, and the key
#: locator into hash buckets of at most so many keys; a small batch reads as many buckets as it has keys.
SLICE_ROWS = BUCKET_KEYS = 1_000_000
MAX_SLICES, MIN_BUCKETS, MAX_BUCKETS = 1024, 4, 4096
#: Folders of a key bucket before it is written as one; tasks that write a bucket; compression of what is stored.
MAX_PIECES, BUCKET_TASKS, CODEC = 8, 4, "zstd"
NO_MONTH = "none"
RETRIES = 10
ROWS, KEYS = "rows", "keys"

#: (kind, v, month, slice): a folder of rows, or (month "") of a bucket of keys.
Entry = tuple[str, str, str, int]


class CommitConflict(RuntimeError):
    """Another writer committed the version first."""


@dataclass
class Kept:
    """What a commit builds on: the version it read, the folders that stay, the name of its own folders, and whether
    its rows come with month and slice, dealt by them."""

    version: int
    entries: list[Entry]
    slices: int | None = None
    key_buckets: int | None = None
    v: str | None = None
    dealt: bool = False


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, schema: str, keys: Sequence[str], date_col: str | None = None,
                 unit_col: str | None = None, slices: int | None = None, key_buckets: int | None = None):
        self.spark, self.root, self.schema, self.keys = spark, root.rstrip("/"), schema, list(keys)
        self.date_col, self.unit_col, self.slices, self.key_buckets = date_col, unit_col, slices, key_buckets
        if taken := {"v", "month", "slice", "bucket"} & {f.name for f in StructType.fromDDL(schema)}:
            raise ValueError(f"columns {sorted(taken)} are those of the table's folders")

    # ---- reading ----

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        fs, p = _fs(self.spark, f"{self.root}/manifest/*.json")
        return sorted(int(st.getPath().getName()[:-5]) for st in (fs.globStatus(p) or []))

    def snapshot(self) -> Kept:
        """The current version and its folders; at most months x slices, and the key buckets."""
        known = self.versions()
        if not known:
            return Kept(0, [], self.slices, self.key_buckets)
        fs, p = _fs(self.spark, f"{self.root}/manifest/{known[-1]}.json")
        stream = fs.open(p)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        found = json.loads(text)
        self.slices, self.key_buckets = found["slices"], found["key_buckets"]
        return Kept(known[-1], [tuple(e) for e in found["entries"]], self.slices, self.key_buckets)

    def _load(self, entries: Sequence[Entry]) -> DataFrame:
        full = self.schema + ", v string, month string, slice int"
        if not entries:
            return self.spark.createDataFrame([], full).drop("v")
        paths = [f"{self.root}/data/v={v}/month={m}/slice={s}" for _, v, m, s in entries]
        return self.spark.read.schema(full).option("basePath", f"{self.root}/data").parquet(*paths).drop("v")

    def read(self) -> DataFrame:
        return self._load([e for e in self.snapshot().entries if e[0] == ROWS]).drop("month", "slice")

    # ---- where keys are ----

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.key_buckets)).cast("int")

    def locator(self, entries: Sequence[Entry], buckets: set[int] | None = None) -> DataFrame:
        """The keys in the given hash buckets (None: all) and their month and slice."""
        mine = [(v, b) for kind, v, _, b in entries if kind == KEYS and (buckets is None or b in buckets)]
        fields = [f for f in StructType.fromDDL(self.schema) if f.name in self.keys] + list(StructType.fromDDL("month string, slice int"))
        if not mine:
            return self.spark.createDataFrame([], StructType(fields))
        paths, schema = [f"{self.root}/keys/v={v}/bucket={b}" for v, b in mine], StructType([*fields, *StructType.fromDDL("v string, bucket int")])
        found = self.spark.read.schema(schema).option("basePath", f"{self.root}/keys").parquet(*paths)
        if len({b for _, b in mine}) < len(mine):
            latest = F.max_by(F.struct("month", "slice"), F.substring_index("v", "-", 1).cast("int")).alias("place")
            found = found.groupBy(*self.keys).agg(latest).select(*self.keys, "place.*")
        return found.where("month IS NOT NULL").select(*[f.name for f in fields])

    def _held(self, now: Kept, keys: DataFrame, buckets: set[int]) -> set[tuple[str, int]]:
        """Folders that hold one of the keys now."""
        if not now.entries:
            return set()
        found = self.locator(now.entries, buckets).join(keys.select(*self.keys), self.keys, "left_semi").select("month", "slice").distinct()
        return {(r.month, r.slice) for r in found.collect()}

    def rows_of(self, keys: DataFrame) -> DataFrame:
        """The stored rows of the given keys, from the folders that hold them."""
        keys = keys.select(*self.keys).distinct()
        now = self.snapshot()
        if not now.entries:
            return self._load([]).drop("month", "slice")
        buckets = {r.b: r["count"] for r in keys.groupBy(self._bucket().alias("b")).count().collect()}
        keys = join_side(keys, sum(buckets.values()))
        held = self._held(now, keys, set(buckets))
        return self._load([e for e in now.entries if e[0] == ROWS and e[2:] in held]).drop("month", "slice").join(keys, self.keys, "left_semi")

    def rows_of_units(self, units: DataFrame) -> DataFrame:
        """The stored rows of the given units (column `unit_col`), from their slices."""
        units = units.select(self.unit_col).distinct()
        now = self.snapshot()
        if not now.entries:
            return self._load([]).drop("month", "slice")
        slices = {r.s: r["count"] for r in units.groupBy(self._slice(F.xxhash64(self.unit_col)).alias("s")).count().collect()}
        rows = self._load([e for e in now.entries if e[0] == ROWS and e[3] in slices]).drop("month", "slice")
        return rows.join(join_side(units, sum(slices.values())), self.unit_col, "left_semi")

    # ---- writing ----

    def _place(self) -> tuple[Column, Column]:
        """Month, and the hash that the slice comes from."""
        month = F.coalesce(year_month(self.date_col), F.lit(NO_MONTH)) if self.date_col else F.lit("all")
        return month, F.xxhash64(*([self.unit_col] if self.unit_col else self.keys))

    def _slice(self, h: Column) -> Column:
        return F.pmod(h, F.lit(self.slices)).cast("int")

    def _placed(self, df: DataFrame) -> DataFrame:
        month, h = self._place()
        return df.withColumn("month", month).withColumn("slice", self._slice(h))

    def _shape(self, places: DataFrame) -> None:
        """The number of slices and buckets, from the months of the first commit's rows."""
        if self.slices is None or self.key_buckets is None:
            by_month = places.groupBy("month").count().agg(F.max("count"), F.sum("count")).first()
            largest, total = by_month[0] or 0, by_month[1] or 0
            self.slices = self.slices or min(MAX_SLICES, -(-largest // SLICE_ROWS) or 1)
            self.key_buckets = self.key_buckets or min(MAX_BUCKETS, max(MIN_BUCKETS, -(-total // BUCKET_KEYS)))

    def _folders(self, pattern: str) -> list[list[str]]:
        """Names of the folders that match, from `v=` on."""
        fs, p = _fs(self.spark, f"{self.root}/{pattern}")
        out = []
        for st in fs.globStatus(p) or []:
            parts = str(st.getPath()).split("/")
            out.append([x.split("=", 1)[1] for x in parts[-pattern.count("/"):]])
        return out

    def _publish(self, version: int, entries: Sequence[Entry]) -> None:
        """Create the manifest of `version`; CommitConflict if there is one."""
        text = json.dumps({"slices": self.slices, "key_buckets": self.key_buckets, "entries": list(entries)})
        jvm, gateway = self.spark.sparkContext._jvm, self.spark.sparkContext._gateway
        name = f"{self.root}/manifest/{version}.json"
        fs, tmp = _fs(self.spark, f"{self.root}/manifest/.{version}-{uuid.uuid4().hex}")
        out = fs.create(tmp)
        out.write(bytearray(text.encode()))
        out.close()
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        only_new = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
        only_new[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").NONE
        try:
            files.rename(tmp, _fs(self.spark, name)[1], only_new)
        except Exception as e:
            fs.delete(tmp, False)
            if "FileAlreadyExistsException" in str(e):
                raise CommitConflict(f"version {version} of {self.root} exists") from e
            raise

    def _attempt(self, now: Kept) -> str:
        return f"{now.version + 1}-{uuid.uuid4().hex[:12]}"

    def _commit(self, kept: Kept, rows: DataFrame | None) -> None:
        entries = list(kept.entries)
        if rows is not None:
            placed = rows if kept.dealt else self._placed(rows).hint("rebalance", "month", "slice")
            placed.write.option("compression", CODEC).partitionBy("month", "slice").parquet(f"{self.root}/data/v={kept.v}")
            entries += [(ROWS, kept.v, m, int(s)) for _, m, s in self._folders(f"data/v={kept.v}/month=*/slice=*")]
        self._publish(kept.version + 1, self._compacted(entries, kept))

    def _places(self, v: str, keyed: DataFrame, order: Column) -> DataFrame:
        """Write the places (keys, month, slice) of the largest `order` of each key as the key folders of `v`, and
        whether the key came with several places (`mixed`); the stored rows."""
        place = F.struct("month", "slice")
        by = ["bucket", "part"]
        dealt = (keyed.select(*self.keys, place.alias("place"), order.alias("order"), self._bucket().alias("bucket"),
                              F.pmod(F.xxhash64(F.lit(1), *self.keys), F.lit(BUCKET_TASKS)).alias("part")).repartition(*by))
        (dealt.groupBy(*by, *self.keys).agg(F.max_by("place", "order").alias("place"), (F.min("place") != F.max("place")).alias("mixed"))
         .select(*self.keys, "place.*", "mixed", "bucket").write.option("compression", CODEC).partitionBy("bucket").parquet(f"{self.root}/keys/v={v}"))
        fields = [f for f in StructType.fromDDL(self.schema) if f.name in self.keys]
        schema = StructType([*fields, *StructType.fromDDL("month string, slice int, mixed boolean, bucket int")])
        return self.spark.read.schema(schema).parquet(f"{self.root}/keys/v={v}").drop("bucket")

    def _key_entries(self, v: str) -> list[Entry]:
        return [(KEYS, v, "", int(b)) for _, b in self._folders(f"keys/v={v}/bucket=*")]

    def _compacted(self, entries: list[Entry], kept: Kept) -> list[Entry]:
        """`entries`, with every bucket of too many folders written as one."""
        pieces: dict[int, int] = {}
        for e in entries:
            if e[0] == KEYS:
                pieces[e[3]] = pieces.get(e[3], 0) + 1
        long = {b for b, n in pieces.items() if n > MAX_PIECES}
        if not long:
            return entries
        v = self._attempt(kept)
        part = F.pmod(F.xxhash64(F.lit(1), *self.keys), F.lit(BUCKET_TASKS))
        (self.locator(entries, long).withColumn("bucket", self._bucket()).repartition("bucket", part)
         .write.option("compression", CODEC).partitionBy("bucket").parquet(f"{self.root}/keys/v={v}"))
        return [e for e in entries if e[0] == ROWS or e[3] not in long] + self._key_entries(v)

    def _until_committed(self, change: Callable[[Kept], None]) -> None:
        for _ in range(RETRIES):
            try:
                return change(self.snapshot())
            except CommitConflict:
                continue
        raise CommitConflict(f"{RETRIES} attempts to write {self.root} met other writers")

    def _changed(self, now: Kept, touched: set[tuple[str, int]], v: str) -> tuple[Kept, DataFrame]:
        """What stays beside the touched folders, with the key folders of `v`; the touched folders' rows."""
        stored = self._load([e for e in now.entries if e[0] == ROWS and e[2:] in touched])
        stay = [e for e in now.entries if e[0] == KEYS or e[2:] not in touched]
        return replace(now, entries=stay + self._key_entries(v), v=v), stored

    def upsert(self, batch: DataFrame, order: Column | None = None, preserve: Sequence[str] = ()) -> None:
        """Merge `batch`; of several rows of a key the one with the largest `order` wins. `preserve` cannot
        name the date or unit column, as a row lies where its batch row says."""
        if {self.date_col, self.unit_col} & set(preserve):
            raise ValueError("the date and unit columns cannot be preserved")
        for k in self.keys:
            batch = batch.where(F.col(k).isNotNull())
        ensure_checkpoint_dir(self.spark)
        order = order if order is not None else F.lit(0)

        def change(now: Kept) -> None:
            self._shape(batch.select(self._place()[0].alias("month")))
            v, came = self._attempt(now), self._placed(batch)
            places = self._places(v, came, order)
            sizes = {(r.month, r.slice): (r.n, r.mixed) for r in places.groupBy("month", "slice").agg(
                F.count("*").alias("n"), F.count_if("mixed").alias("mixed")).collect()}
            buckets = {b for _, _, _, b in self._key_entries(v)}
            with passing(self.spark) as keep:
                left = self._left(now, join_side(places, sum(n for n, _ in sizes.values())), buckets, keep)
                held = {(r.month, r.slice) for r in left.select("month", "slice").distinct().collect()} if left else set()
                kept, stored = self._changed(now, set(sizes) | held, v)
                if preserve:  # the stored row may lie in another folder
                    rows = upsert(stored.drop("month", "slice"), batch, self.keys, preserve, order=order)
                    return self._commit(kept, rows)
                if mixed := sum(m for _, m in sizes.values()):
                    lost = self._elsewhere(came.select(*self.keys, "month", "slice"), join_side(places.where("mixed"), mixed)).distinct()
                    left = left.where("NOT here").drop("here").unionByName(lost) if left else lost
                elif left:
                    left = left.where("NOT here").drop("here")
                self._commit(replace(kept, dealt=True), self._merged(stored, came, order, left, {p: n for p, (n, _) in sizes.items()}))

        self._until_committed(change)

    def _elsewhere(self, rows: DataFrame, places: DataFrame) -> DataFrame:
        """(keys, month, slice) of `rows` whose place is not their key's in `places`."""
        new = places.select(*self.keys, F.struct("month", "slice").alias("new"))
        return rows.join(new, self.keys).where(F.struct("month", "slice") != F.col("new")).drop("new")

    def _left(self, now: Kept, places: DataFrame, buckets: set[int], keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame | None:
        """Where the keys of `places` lie now, and whether they stay there (`here`); None if the table is empty."""
        if not now.entries:
            return None
        new = places.select(*self.keys, F.struct("month", "slice").alias("new"))
        found = self.locator(now.entries, buckets).join(new, self.keys)
        return keep(found.withColumn("here", F.struct("month", "slice") == F.col("new")).drop("new"), "left")

    def _merged(self, stored: DataFrame, came: DataFrame, order: Column, left: DataFrame | None,
                sizes: dict[tuple[str, int], int]) -> DataFrame:
        """The rows of the touched folders, dealt once by folder (a large one in parts): per key the new row with the
        largest `order`, else the stored one, and none where the key has left the folder."""
        payload = [f for f in StructType.fromDDL(self.schema) if f.name not in self.keys]
        at = ["month", "slice"]

        def ranked(rows: DataFrame, kind: int, o: Column, row: Column) -> DataFrame:
            return rows.select(*at, *self.keys, F.struct(F.lit(kind).alias("kind"), o.alias("o")).alias("rank"), row.alias("row"))

        def row_of(rows: DataFrame) -> Column:
            return F.struct(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in payload])

        none = F.lit(None).cast(came.select(order.alias("o")).schema["o"].dataType)
        rows = ranked(came, 1, order, row_of(came))
        empty = F.lit(None).cast(rows.schema["row"].dataType)
        rows = ranked(stored, 0, none, row_of(stored)).unionByName(rows)
        if left is not None:
            rows = rows.unionByName(ranked(left, 2, none, empty))
        for r in stored.groupBy(*at).count().collect():  # one row a folder
            sizes[r.month, r.slice] = sizes.get((r.month, r.slice), 0) + r["count"]
        large = [(m, s, -(-n // SLICE_ROWS)) for (m, s), n in sizes.items() if n > SLICE_ROWS]
        if large:
            parts = self.spark.createDataFrame(large, "month string, slice int, parts bigint")
            rows = (rows.join(F.broadcast(parts), at, "left")
                    .withColumn("part", F.pmod(F.xxhash64(F.lit(1), *self.keys), F.coalesce("parts", F.lit(1)))).drop("parts"))
        by = [*at, "part"] if large else at
        won = rows.repartition(*by).groupBy(*by, *self.keys).agg(F.max_by("row", "rank").alias("row")).where("row IS NOT NULL")
        return won.select(*[F.col(f.name if f.name in self.keys else f"row.{f.name}") for f in StructType.fromDDL(self.schema)], *at)

    def delete(self, keys: DataFrame) -> None:
        """Remove the listed keys; only the folders that hold them are rewritten."""
        ensure_checkpoint_dir(self.spark)
        gone = keys.select(*self.keys).withColumns({"month": F.lit(None).cast("string"), "slice": F.lit(None).cast("int")})

        def change(now: Kept) -> None:
            self._shape(gone)
            v = self._attempt(now)
            places = self._places(v, gone, F.lit(1))
            places = join_side(places, places.count())
            held = self._held(now, places, {b for _, _, _, b in self._key_entries(v)})
            kept, stored = self._changed(now, held, v)
            self._commit(kept, stored.drop("month", "slice").join(places.select(*self.keys), self.keys, "left_anti"))

        self._until_committed(change)

    def retain(self, now: dt.datetime, months: int = 2) -> None:
        """SNK6: drop every month before the cutoff month; rows without a date stay. Places of dropped
        rows stay in the locator until their bucket is written again, and name folders that are gone."""
        cut = retention_cutoff(now, months).strftime("%Y-%m")
        self._until_committed(lambda s: self._commit(
            replace(s, entries=[e for e in s.entries if e[0] == KEYS or e[2] == NO_MONTH or e[2] >= cut]), None))

    def reslice(self, slices: int | None = None, key_buckets: int | None = None) -> None:
        """Write the whole table anew for its size now (or with the given numbers)."""
        def change(now: Kept) -> None:
            rows = self._load([e for e in now.entries if e[0] == ROWS]).drop("month", "slice")
            self.slices, self.key_buckets = slices, key_buckets
            month = self._place()[0]
            self._shape(rows.select(month.alias("month")))
            v = self._attempt(now)
            self._places(v, self._placed(rows), F.lit(1))
            self._commit(Kept(now.version, self._key_entries(v), self.slices, self.key_buckets, v), rows)

        self._until_committed(change)

    def vacuum(self) -> int:
        """Delete folders and manifests that the current version does not use; the number of row folders removed."""
        current = self.snapshot()
        rows = {(v, m, str(s)) for kind, v, m, s in current.entries if kind == ROWS}
        keys = {(v, str(b)) for kind, v, _, b in current.entries if kind == KEYS}
        removed = 0
        for v, m, s in self._folders("data/v=*/month=*/slice=*"):
            if (v, m, s) not in rows:
                fs, p = _fs(self.spark, f"{self.root}/data/v={v}/month={m}/slice={s}")
                removed += bool(fs.delete(p, True))
        for v, b in self._folders("keys/v=*/bucket=*"):
            if (v, b) not in keys:
                fs, p = _fs(self.spark, f"{self.root}/keys/v={v}/bucket={b}")
                fs.delete(p, True)
        for n in self.versions():
            if n < current.version:
                fs, p = _fs(self.spark, f"{self.root}/manifest/{n}.json")
                fs.delete(p, False)
        return removed
