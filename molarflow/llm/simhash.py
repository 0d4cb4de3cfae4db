"""SimHash near-duplicates: exact links within a bit distance, by bit-sliced comparison.

Fingerprints: XXH64 (seed 42) of each word shingle, repeats included; a bit is set
if it is set in more than half of the hashes.

Candidates, exact for distances up to RADIUS = 2: a fingerprint is four blocks of
16 bits; two fingerprints that differ in two bits agree on at least two blocks, so
they meet in one of six tables keyed by a pair of blocks. A key held by more than
HOT distinct fingerprints is dealt again, by pairs of bytes of its two free blocks;
with 48 bits fixed such a group has at most 65,536 distinct fingerprints. So no task
holds an unbounded group, and no candidate is dropped.

Comparison: a run of whole groups is stored as 64 bit planes; planes are added into
carry-save counters (ones, twos, over), which update the distances of 64 fingerprints
per word operation, and queries whose candidates all exceed the radius are abandoned.
A run yields a star per connected part (at most one link per fingerprint), never all pairs.

Edge cases: null or blank text has fingerprint zero, linked like any other; a text with
fewer words than a shingle is one shingle; a very long text is hashed whole; repeated rows share a fingerprint and so a
component; a null doc_id is no component's smallest id unless all are null; an empty
table gives an empty result; other columns pass through `keep_one`.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from molarflow.llm.common import checkpointed, stable_rows, whole_row
from molarflow.llm.components import components

SEED = 42
SHINGLE = 3
RADIUS = 2
HOT = 4096
RUN = 512
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
BYTE_OFFSETS = (np.arange(8) * 256).astype(np.int64)


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text."""
    words = data.translate(LOWER).split()  # bytes.split() splits on exactly \x20 and \x09-\x0D
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths) + np.arange(len(words))
    starts = ends - lengths
    n = len(words) - shingle + 1
    digest = xxhash.xxh64_intdigest
    counts = np.zeros((8, 256), np.int64)
    for at in range(0, n, 1 << 16):  # bounded memory for very long texts
        stop = min(n, at + (1 << 16))
        hashes = np.array([digest(joined[s:e], SEED) for s, e in
                           zip(starts[at:stop].tolist(), ends[at + shingle - 1:stop + shingle - 1].tolist())],
                          dtype="<u8")
        flat = hashes.view(np.uint8).reshape(-1, 8) + BYTE_OFFSETS
        counts += np.bincount(flat.ravel(), minlength=2048).reshape(8, 256)
    set_bits = (counts @ BITS).ravel() * 2 > n
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, row, fp): row is a unique number of the input row, fp the signed 64-bit fingerprint."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = b.column(2).cast(pa.binary())
            fps = np.array([fingerprint(x.as_buffer().to_pybytes() if x.is_valid else b"", shingle) for x in text],
                           dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps, pa.int64())], ["doc_id", "row", "fp"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                       F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, row bigint, fp bigint")


def _unions(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest label over each connected part after adding the pairs (i, j)."""
    while True:
        a, b = labels[i], labels[j]
        differ = a != b
        if not differ.any():
            return labels
        low, high = np.minimum(a, b)[differ], np.maximum(a, b)[differ]
        np.minimum.at(labels, high, low)
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels = up


def links_of_run(fps: np.ndarray, radius: int = RADIUS, chunk_words: int = 1 << 17) -> tuple[np.ndarray, np.ndarray]:
    """Star links (a, b) of the parts of `fps` (distinct uint64) connected within the radius (0 to 2)."""
    m = len(fps)
    words = -(-m // 64)
    bits = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(m, 8), axis=1, bitorder="little")
    padded = np.zeros((64, words * 64), np.uint8)
    padded[:, :m] = bits.T
    planes = np.packbits(padded, axis=1, bitorder="little").view("<u8")
    masks = np.where(bits.astype(bool), np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))  # row, bit
    labels = np.arange(m)
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    step = max(1, chunk_words // words)
    for at in range(0, m, step):
        query = np.arange(at, min(m, at + step))
        off = np.arange(words * 64)[None, :] <= query[:, None]  # itself and those compared before
        off[:, m:] = True
        over = np.packbits(off, axis=1, bitorder="little").view("<u8")
        ones, twos = np.zeros_like(over), np.zeros_like(over)
        for bit in range(64):
            x = planes[bit][None, :] ^ masks[query, bit][:, None]
            carry = ones & x
            ones = ones ^ x
            over = over | (twos & carry)
            twos = twos ^ carry
            if bit % 4 == 3:
                gone = over | _beyond(ones, twos, radius)
                live = (gone != full).any(axis=1)
                if not live.all():
                    query, ones, twos, over = query[live], ones[live], twos[live], over[live]
                    if not len(query):
                        break
        if not len(query):
            continue
        near = ~(over | _beyond(ones, twos, radius))
        for sub in range(0, len(query), 64):
            hit = np.unpackbits(near[sub:sub + 64].view(np.uint8), axis=1, bitorder="little")
            i, j = np.nonzero(hit)
            labels = _unions(labels, query[sub + i], j)
    child = np.nonzero(labels != np.arange(m))[0]
    return fps[child], fps[labels[child]]


def _beyond(ones: np.ndarray, twos: np.ndarray, radius: int) -> np.ndarray:
    """Counters (twos, ones) above the radius; four and more are in `over`."""
    return {0: ones | twos, 1: twos, 2: ones & twos}[radius]


def _compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (part, key): star links of each run of whole groups."""
    def emit(fps: list[np.ndarray]) -> pa.RecordBatch:
        a, b = links_of_run(np.unique(np.concatenate(fps)))
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    rest = np.zeros((0, 3), np.int64)
    run: list[np.ndarray] = []
    size = 0
    for last, batch in _marked_last(batches):
        rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1)
        rows = np.concatenate([rest, rows])
        if not len(rows):
            continue
        edge = np.nonzero((rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1]))[0] + 1
        starts = np.concatenate([[0], edge])
        ends = np.concatenate([edge, [len(rows)]])
        whole = len(starts) if last else len(starts) - 1
        for s, e in zip(starts[:whole].tolist(), ends[:whole].tolist()):
            if e - s > 1:
                run.append(rows[s:e, 2].copy().view(np.uint64))
                size += e - s
                if size >= RUN:
                    yield emit(run)
                    run, size = [], 0
        rest = rows[starts[-1]:].copy() if not last else rows[:0]
    if run:
        yield emit(run)


def _marked_last(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch]]:
    held = None
    for b in batches:
        if held is not None:
            yield False, held
        held = b
    if held is not None:
        yield True, held


def _field(fp, block: int, width: int):
    return F.shiftrightunsigned(fp, block * width).bitwiseAND((1 << width) - 1)


def links(fps: DataFrame) -> DataFrame:
    """Star links (a, b) between the distinct fingerprints `fp` within RADIUS bits."""
    fp = F.col("fp")
    tables = F.array(*[F.struct(F.lit(t).alias("part"), F.shiftleft(_field(fp, i, 16), 16).bitwiseOR(_field(fp, j, 16))
                                .alias("key")) for t, (i, j) in enumerate(combinations(range(4), 2))])
    dealt = fps.select("fp", F.explode(tables).alias("t")).select("t.part", "t.key", "fp")
    hot = dealt.groupBy("part", "key").agg(F.count("*").alias("n")).where(F.col("n") > HOT)
    marked = dealt.join(hot, ["part", "key"], "left")
    finer = []
    for t, (i, j) in enumerate(combinations(range(4), 2)):
        free = [2 * b + h for b in range(4) if b not in (i, j) for h in (0, 1)]
        for s, (x, y) in enumerate(combinations(free, 2)):
            sub = F.shiftleft(_field(fp, x, 8), 8).bitwiseOR(_field(fp, y, 8))
            finer.append((t, F.struct(F.lit(6 + 6 * t + s).alias("part"), F.shiftleft(F.col("key"), 16).bitwiseOR(sub).alias("key"))))
    same = F.array(F.struct("part", "key"))
    choice = F.when(F.col("n").isNull(), same)
    for t in range(6):
        choice = choice.when(F.col("part") == t, F.array(*[s for u, s in finer if u == t]))
    groups = (marked.select("fp", F.explode(choice).alias("g")).select("g.part", "g.key", "fp")
              .repartition("part", "key").sortWithinPartitions("part", "key"))
    return groups.mapInArrow(_compare, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, row, fp, component_id, component_row): component_id is the smallest doc_id reachable
    over links, component_row the smallest row number among that document's rows."""
    fps = checkpointed(fingerprints(docs, text_col, id_col, shingle))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first")
    nodes = checkpointed(fps.groupBy("fp").agg(first))
    roots = components(links(nodes.select("fp")))
    part = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    part = checkpointed(part)
    best = part.groupBy("root").agg(F.min("first").alias("best"))
    classes = part.join(best, "root").select("fp", F.col("best.doc_id").alias("component_id"),
                                             F.col("best.row").alias("component_row"))
    return fps.join(checkpointed(classes), "fp").select("doc_id", "row", "fp", "component_id", "component_row")


def keep_one(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """One document of each component, with its own columns: that of the smallest id."""
    docs = stable_rows(docs, "documents")
    found = near_duplicates(docs, text_col, id_col, shingle)
    kept = found.where(F.col("row") == F.col("component_row")).select(F.col("row").alias("__row"))
    numbered = docs.select(whole_row(docs).alias("doc"), F.monotonically_increasing_id().alias("__row"))
    return numbered.join(kept, "__row", "left_semi").select("doc.*")


def hex_fingerprint(fp) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
