"""Trigram index for the free-text search (FLT7, STR2, STR5, STR6).

For every row the distinct three-character pieces of its folded name and of its phone digits are
stored as (field, gram, id), cut by a hash of the gram and sorted, with the number of ids per
gram. A search looks up the counts of its pieces, equi-joins the ids of the rarest ones, takes the
rows of the ids that have them all, and confirms each with the very predicate of the full
scan. So both give the same rows; the index only keeps rows from being read.

Merges add a segment with the rows they wrote. Entries of rows that changed since stay behind and are
harmless, as every hit is confirmed; `rebuild` leaves them out.

Fallbacks to the scan, with the same rows: a search text (or phone variant) under three characters, and
one whose rarest piece is in more than SHARE of all rows, where reading the ids costs more than it saves.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from molarflow.functions.phone import phone_variants
from molarflow.functions.text import search_text
from molarflow.operators.filters import search_filter
from molarflow.sinks.files import _fs

GRAM = 3
#: Pieces of a search text that are joined, rarest first.
RAREST = 3
SHARE = 0.1
NAME, PHONE = "patient_name_norm", "phone_norm"
_POSTINGS = "field string, gram string, id bigint, bucket int"
_COUNTS = "field string, gram string, n bigint"


def grams_of(text: str) -> list[str]:
    return sorted({text[i:i + GRAM] for i in range(len(text) - GRAM + 1)})


def _grams(c: Column) -> Column:
    pieces = F.transform(F.sequence(F.lit(1), F.length(c) - (GRAM - 1)), lambda i: F.substring(c, i, F.lit(GRAM)))
    return F.when(F.length(c) >= GRAM, F.array_distinct(pieces))


def search_patterns(raw: str, name_col: str = NAME, phone_col: str = PHONE) -> list[tuple[str, str]]:
    """(column, text) of which one has to be contained: what `search_filter` looks for."""
    raw = (raw or "").strip()
    name = search_text(raw)
    digits = "".join(ch for ch in raw if ch.isdigit() and ch.isascii())
    return ([(name_col, name)] if name else []) + [(phone_col, v) for v in phone_variants(digits)]


class SearchIndex:
    def __init__(self, spark: SparkSession, root: str, name_col: str = NAME, phone_col: str = PHONE, id_col: str = "id", buckets: int = 16):
        self.spark, self.root, self.buckets, self.id_col = spark, root.rstrip("/"), buckets, id_col
        self.name_col, self.phone_col = name_col, phone_col

    def _segments(self) -> list[str]:
        """Names of the segments whose counts are complete."""
        fs, p = _fs(self.spark, f"{self.root}/counts/*/_SUCCESS")
        return sorted(st.getPath().getParent().getName() for st in (fs.globStatus(p) or []))

    def add(self, rows: DataFrame) -> None:
        """A segment for rows that were written: all of a new table, or those of a merge. Counts are written last; a
        segment without them is not read."""
        fields = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("text")) for c in (self.name_col, self.phone_col)])
        postings = (rows.select(F.col(self.id_col).cast("bigint").alias("id"), F.explode(fields).alias("f"))
                    .select("id", "f.field", F.explode(_grams(F.col("f.text"))).alias("gram")))
        name = f"segment={uuid.uuid4().hex}"
        path = f"{self.root}/postings/{name}"
        (postings.withColumn("bucket", F.pmod(F.xxhash64("gram"), F.lit(self.buckets)).cast("int"))
         .repartition("bucket", F.pmod(F.xxhash64("id"), F.lit(8))).sortWithinPartitions("bucket", "field", "gram")
         .write.partitionBy("bucket").parquet(path))
        stored = self.spark.read.schema(_POSTINGS).parquet(path)
        counts = stored.groupBy("field", "gram").agg(F.count("*").alias("n"))
        total = rows.agg(F.count("*").alias("n")).select(F.lit("").alias("field"), F.lit("").alias("gram"), "n")
        counts.unionByName(total).repartitionByRange("field", "gram").sortWithinPartitions("field", "gram")\
            .write.parquet(f"{self.root}/counts/{name}")

    def rebuild(self, rows: DataFrame) -> None:
        """One segment with the rows as they are now, in place of all others."""
        old = self._segments()
        self.add(rows)
        for name in old:
            for kind in ("counts", "postings"):
                fs, p = _fs(self.spark, f"{self.root}/{kind}/{name}")
                fs.delete(p, True)

    def _counts(self, patterns: list[tuple[str, str]]) -> tuple[dict[tuple[str, str], int], int]:
        """Ids per gram of the patterns, and rows in all; as many rows as the patterns have grams."""
        wanted = sorted({g for _, text in patterns for g in grams_of(text)})
        rows = (self.spark.read.schema(_COUNTS).parquet(*[f"{self.root}/counts/{s}" for s in self._segments()]).where(F.col("gram").isin([*wanted, ""]))
                .groupBy("field", "gram").agg(F.sum("n").alias("n")).collect())
        known = {(r.field, r.gram): r.n for r in rows}
        return known, known.pop(("", ""), 0)

    def candidates(self, raw: str) -> DataFrame | None:
        """(id) of rows that may match; None where the scan has to do."""
        patterns = search_patterns(raw, self.name_col, self.phone_col)
        if not patterns or any(len(text) < GRAM for _, text in patterns) or not self._segments():
            return None
        known, total = self._counts(patterns)
        chosen = []
        for field, text in patterns:
            rare = sorted((known.get((field, g), 0), g) for g in grams_of(text))[:RAREST]
            if rare[0][0] > total * SHARE:
                return None
            if rare[0][0]:  # else no row has this piece
                chosen.append((field, [g for _, g in rare]))
        if not chosen:
            return self.spark.createDataFrame([], "id bigint")
        postings = (self.spark.read.schema(_POSTINGS).option("basePath", f"{self.root}/postings")
                    .parquet(*[f"{self.root}/postings/{s}" for s in self._segments()]))
        found = []
        for field, grams in chosen:
            buckets = [F.pmod(F.xxhash64(F.lit(g)), F.lit(self.buckets)).cast("int") for g in grams]  # folded: they prune folders
            rows = postings.where(F.col("bucket").isin(buckets) & (F.col("field") == field) & F.col("gram").isin(grams))
            found.append(rows.groupBy("id").agg(F.count_distinct("gram").alias("n")).where(F.col("n") == len(grams)).select("id"))
        out = found[0]
        for f in found[1:]:
            out = out.union(f)
        return out.distinct()

    def search(self, rows: DataFrame, raw: str) -> DataFrame:
        """The rows that the scan `rows.where(search_filter(raw))` gives."""
        wanted = search_filter(raw, self.name_col, self.phone_col)
        if wanted is None:
            return rows
        ids = self.candidates(raw)
        if ids is None:
            return rows.where(wanted)
        return rows.join(ids.withColumnRenamed("id", self.id_col), self.id_col, "left_semi").where(wanted)
