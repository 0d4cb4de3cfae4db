"""Importance resampling towards a target distribution.

Each text is a bag of hashed features: its words (ASCII lower-cased runs of digits, letters and
non-ASCII characters) and, if asked for, runs of several words joined by a space; a feature's bucket
is the CRC-32 of its UTF-8 bytes modulo `buckets`. A bucket's gain is the scaled log ratio of
its smoothed share in the target texts to its share in the documents; a document's weight is
the sum of its features' gains. Gumbel noise from a hash of doc_id makes the score, and the
rows with the highest scores are a draw without replacement in proportion to the weights.

Weights are taken from an array: the gains are one array of `buckets` integers that every task
gets, and a document's stored buckets index it. The cut is found by bisection: over the stored
(score, doc_id) each job counts exactly how many rows lie at or before each of WAYS - 1
thresholds, and the range between two of them is searched on; rows that tie on the score are
cut the same way by doc_id, then by place in the table. The rows before the cut are range-partitioned
and sorted; a row's rank is its place in its partition plus the rows of the partitions before it.

Scale: the texts are read once; what is stored is two bytes a feature, then a few numbers a
document. Only `buckets` counts, the thresholds' counts and one number a partition reach
the driver. No key is grouped on but the bucket (summed in each task first), so no word, source
or score can make a hot task. Every step is a deterministic job over stored input.

Edge cases: null and empty texts have no features and weight 0; very long texts are hashed
whole; equal (score, doc_id) rows are drawn in table order; a null doc_id comes last among ties
and is hashed as no digits; with no rows, or none long enough, nothing is drawn; further
columns are not read by `resample`, and come back untouched from `drawn`.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from molarflow.llm.common import free_name, stable_rows, stored, whole_row

BUCKETS = 10_000
#: Of 100 documents with MIN_WORDS or more, so many are drawn.
PERCENT, MIN_WORDS = 10, 20
SCALE = 1000
SEED = "2024"
#: Parts into which each counting job cuts the range of the cutoff.
WAYS = 16
#: As UTF-8: digits, lower-case letters and all bytes of non-ASCII characters.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
LAST_ID = (1 << 63) - 1
#: monotonically_increasing_id has the partition above these bits and the place in it below.
PART_BITS = 33


def features(text: bytes, orders: tuple[int, int]) -> tuple[int, Iterable[bytes]]:
    """The number of words, and all runs of orders[0] to orders[1] words."""
    words = WORD.findall(text.lower())
    if orders == (1, 1):
        return len(words), words
    return len(words), [b" ".join(words[i:i + n]) for n in range(orders[0], orders[1] + 1) for i in range(len(words) - n + 1)]


def _width(buckets: int) -> np.dtype:
    return np.dtype("<u2") if buckets <= 1 << 16 else np.dtype("<u4")


def hashed(texts: DataFrame, buckets: int, orders: tuple[int, int]) -> DataFrame:
    """(row, doc_id, n_words, n_features, buckets) of (row, doc_id, text as bytes)."""
    kind = _width(buckets)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, n_features, out = [], [], []
            for text in b.column(2):
                n, found = features(text.as_py() or b"", orders)
                at = np.fromiter(map(crc32, found), np.uint32) % np.uint32(buckets)
                n_words.append(n)
                n_features.append(len(at))
                out.append(at.astype(kind).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n_words, pa.int64()), pa.array(n_features, pa.int64()),
                                              pa.array(out, pa.binary())], ["row", "doc_id", "n_words", "n_features", "buckets"])

    return texts.mapInArrow(run, "row bigint, doc_id bigint, n_words bigint, n_features bigint, buckets binary")


def bucket_counts(rows: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket; a task sends one row a bucket."""
    kind = _width(buckets)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            total += np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), kind), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in rows.select("buckets").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Scaled log ratio of the smoothed shares, rounded down."""
    s_all, t_all, buckets = int(source.sum()), int(target.sum()), len(source)
    return np.array([math.floor(SCALE * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def noise(doc_id: int | None, seed: str) -> int:
    h = int(sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-SCALE * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(rows: DataFrame, gain: np.ndarray, seed: str) -> DataFrame:
    """(row, doc_id, n_words, n_features, weight, score) of `hashed` rows."""
    kind = _width(len(gain))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            weight = [int(gain[np.frombuffer(x, kind)].sum()) for x in b.column(4).to_pylist()]
            score = [w + noise(i, seed) for w, i in zip(weight, b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(weight, pa.int64()), pa.array(score, pa.int64())],
                                             [*b.schema.names[:4], "weight", "score"])

    return rows.select("row", "doc_id", "n_words", "n_features", "buckets") \
        .mapInArrow(run, "row bigint, doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint")


def first_rows(rows: DataFrame, keys: list[Column], k: int) -> Column:
    """The condition that holds for exactly the first k rows in ascending order of `keys` (bigints,
    without nulls, together unique), found by bisection of one key after the other."""
    if k <= 0:
        return F.lit(False)
    before, tied = F.lit(False), F.lit(True)
    for key in keys:
        ties = rows.where(tied)
        low, high = ties.agg(F.min(key), F.max(key)).first()
        under = 0  # tied rows below `low`
        while low < high:
            cuts = sorted({low + (high - low) * i // WAYS for i in range(WAYS)} - {high})
            counts = ties.agg(*[F.count_if(key <= F.lit(c).cast("bigint")).alias(str(i)) for i, c in enumerate(cuts)]).first()
            at = next((i for i, n in enumerate(counts) if n >= k), len(cuts))
            if at:
                low, under = cuts[at - 1] + 1, counts[at - 1]
            if at < len(cuts):
                high = cuts[at]
        bound = F.lit(low).cast("bigint")
        before, tied, k = before | (tied & (key < bound)), tied & (key == bound), k - under
        if rows.where(tied).count() == k:
            break
    return before | tied


def ranked(rows: DataFrame, keys: list[Column]) -> DataFrame:
    """`rows` with column `rank`: 1, 2, 3, ... in ascending order of `keys`."""
    ordered = stored(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("place", F.monotonically_increasing_id()),
                     "drawn")
    part = F.shiftright("place", PART_BITS)
    sizes = sorted(map(tuple, ordered.groupBy(part).count().collect()))  # one row a partition
    starts = np.concatenate([[0], np.cumsum([n for _, n in sizes])]).tolist()
    offsets = rows.sparkSession.createDataFrame([(p, s) for (p, _), s in zip(sizes, starts)], "part bigint, start bigint")
    place = F.col("place").bitwiseAND(F.lit((1 << PART_BITS) - 1))
    return (ordered.withColumn("part", part).join(F.broadcast(offsets), "part")
            .withColumn("rank", F.col("start") + place + 1).drop("part", "start", "place"))


def _draw(docs: DataFrame, target: DataFrame, text_col: str, id_col: str, target_text: str, percent: int, min_words: int,
          buckets: int, orders: tuple[int, int], seed: str) -> DataFrame:
    """(row, doc_id, n_words, n_features, weight, score, rank) of all rows."""
    def texts(df: DataFrame, text: str, doc_id: Column) -> DataFrame:
        return df.select(F.monotonically_increasing_id().alias("row"), doc_id.cast("bigint").alias("doc_id"),
                         F.col(f"`{text}`").cast("string").cast("binary").alias("text"))

    rows = stored(hashed(texts(docs, text_col, F.col(f"`{id_col}`")), buckets, orders), "features")
    aim = hashed(texts(target, target_text, F.lit(None)), buckets, orders)
    gain = gains(bucket_counts(rows, buckets), bucket_counts(aim, buckets))
    scores = stored(scored(rows, gain, seed), "scores")
    able = F.col("n_words") >= min_words
    keys = [-F.col("score"), F.coalesce("doc_id", F.lit(LAST_ID)), F.col("row")]
    wanted = scores.where(able).count() * percent // 100
    taken = able & first_rows(scores.where(able).select("score", "doc_id", "row"), keys, wanted)
    first = ranked(scores.where(taken), keys) if wanted else scores.where(F.lit(False)).withColumn("rank", F.lit(None).cast("bigint"))
    return first.unionByName(scores.where(~taken).withColumn("rank", F.lit(None).cast("bigint")))


def resample(docs: DataFrame, target: DataFrame, text_col: str = "text", id_col: str = "doc_id", target_text: str = "text",
             percent: int = PERCENT, min_words: int = MIN_WORDS, buckets: int = BUCKETS, orders: tuple[int, int] = (1, 1),
             seed: str = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; rank is null where it is not drawn."""
    return _draw(docs, target, text_col, id_col, target_text, percent, min_words, buckets, orders, seed) \
        .select("doc_id", "n_features", "weight", "score", "rank")


def drawn(docs: DataFrame, target: DataFrame, rank: str = "rank", **options) -> DataFrame:
    """The drawn rows of `docs` with all their columns, and their rank in column `rank`."""
    docs = stable_rows(docs, "documents")
    given = {"text_col": "text", "id_col": "doc_id", "target_text": "text", "percent": PERCENT, "min_words": MIN_WORDS,
             "buckets": BUCKETS, "orders": (1, 1), "seed": SEED} | options
    ranks = _draw(docs, target, **given).where("rank IS NOT NULL").select("row", F.col("rank").alias("__rank"))
    rows = docs.select(whole_row(docs).alias("doc"), F.monotonically_increasing_id().alias("row"))
    return rows.join(ranks, "row").select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns],
                                          F.col("__rank").alias(free_name(docs, rank)))
