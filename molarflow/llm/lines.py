"""Line dedup by a log-template tree.

A line is routed through a tree of fixed depth: by its number of tokens, then by its
first DEPTH tokens, a token with a digit counting as the variable field `<*>` (unless most
tokens have one: rows of numbers are no template). Lines of one leaf are grouped into templates: a line joins the most similar template of its leaf
if at least SIMILAR of the tokens after the leading ones are equal, and tokens that differ then
become variable fields of that template. All tokens are compared, however long the line is.

A template seen in two or more documents recurs. Its lines are dropped from every
document but the first (by row order of the table), so no text is lost altogether.
Lines of one to four tokens match only exactly (after masking). Left alone are lines of a
single token and lines under five tokens without a letter or digit (rules, brackets).

Tokens are the pieces between white space; a character of a script written without spaces
(UNSPACED: Chinese, Japanese, Thai, ...) is a token by itself, so such lines are measured
in characters.

Scale: equal masked lines are pre-aggregated to one row before any shuffle, so a line
that fills a third of the table is one row per map task. Only leaves with two or more
distinct lines are compared: these lines are read again from the document that has them
first, with a 32-bit hash of every token. A leaf is streamed in order of first occurrence;
templates are found by exact match on one of (allowed differences + 1) segments, which cover
all tokens, so no template at SIMILAR is missed. One task holds a leaf. Otherwise only row
numbers and hashes are shuffled until the documents are rewritten by one join.

Edge cases: null text stays null; an empty text stays empty; a text that loses all its
lines becomes empty, its row stays; repeated rows count as separate documents, so the
later ones lose their recurring lines; an empty table gives an empty result; of several
templates that are equally similar a line joins the oldest; other columns pass through untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from molarflow.llm.common import checkpointed, stable_rows, stored, whole_row

DEPTH = 3
MIN_TOKENS = 2
MIN_WORDLESS = 5
SIMILAR = 0.8
VARIABLE = "<*>"
WILD = -1
DIGIT = re.compile(r"\d")
WORD = re.compile(r"[^\W_]")
#: Thai, Lao, Tibetan, Myanmar, Khmer, kana and Han letters.
UNSPACED = "\u0e00-\u0eff\u0f40-\u0fbc\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff" \
           "\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
HAS_UNSPACED = re.compile(f"[{UNSPACED}]")
TOKEN = re.compile(f"[{UNSPACED}]|[^\\s{UNSPACED}]+")


def allowed_differences(n: int) -> int:
    """Of n compared tokens."""
    return int(n * (1 - SIMILAR) + 1e-9)


def tokens_of(line: str) -> list[str] | None:
    """The tokens of a line, variable fields masked; None if it is left alone."""
    tokens = line.split() if line.isascii() or not HAS_UNSPACED.search(line) else TOKEN.findall(line)
    n = len(tokens)
    if n < MIN_TOKENS or (n < MIN_WORDLESS and not WORD.search(line)):
        return None
    if DIGIT.search(line):
        masked = [VARIABLE if DIGIT.search(t) else t for t in tokens]
        if 2 * masked.count(VARIABLE) <= n:
            return masked
    return tokens


def line_key(tokens: list[str]) -> tuple[int, int]:
    """(leaf, template hash); a line too short for any difference is a leaf by itself."""
    whole, n = " ".join(tokens), len(tokens)
    near = allowed_differences(n - DEPTH) > 0
    leaf = xxhash.xxh64_intdigest(" ".join((str(n), *tokens[:DEPTH]))) if near else xxhash.xxh64_intdigest(whole, 1)
    return leaf, xxhash.xxh64_intdigest(whole)


def signature(tokens: list[str]) -> bytes:
    """32-bit hashes of all compared tokens."""
    return np.array([crc32(t.encode("utf-8", "surrogatepass")) for t in tokens[DEPTH:]], "<u4").tobytes()


def _i64(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def numbered(docs: DataFrame, text_col: str) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col(text_col).cast("string").alias("text"))


def line_table(docs: DataFrame, text_col: str) -> DataFrame:
    """(row, line, leaf, template): one row per line that is not left alone."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(out):
            return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()),
                                               _i64(out[2]), _i64(out[3])], ["row", "line", "leaf", "template"])

        for b in batches:
            out = [[], [], [], []]
            for row, text in zip(b.column(0).to_pylist(), b.column(1)):
                if not text.is_valid:
                    continue
                for i, line in enumerate(text.as_py().split("\n")):
                    tokens = tokens_of(line)
                    if tokens:
                        for o, v in zip(out, (row, i, *line_key(tokens))):
                            o.append(v)
                if len(out[0]) > 20000:
                    yield flush(out)
                    out = [[], [], [], []]
            if out[0]:
                yield flush(out)

    return numbered(docs, text_col).mapInArrow(run, "row bigint, line int, leaf bigint, template bigint")


def signed_lines(docs: DataFrame, wanted: DataFrame, text_col: str) -> DataFrame:
    """(leaf, template, sig, low, high, line) of the distinct lines `wanted` (leaf, template, low, high),
    read from document `low`."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(b.num_rows):
                row, text, left = b.column(0)[at].as_py(), b.column(1)[at].as_py(), b.column(2)[at].as_py()
                left = {(x["leaf"], x["template"]): x["high"] for x in left}
                out = [[], [], [], [], []]
                for i, line in enumerate(text.split("\n")):
                    tokens = tokens_of(line)
                    if tokens:
                        key = tuple(np.array(line_key(tokens), np.uint64).view(np.int64).tolist())
                        if key in left:
                            for o, v in zip(out, (*key, signature(tokens), left.pop(key), i)):
                                o.append(v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary()),
                     pa.array([row] * len(out[0]), pa.int64()), pa.array(out[3], pa.int64()), pa.array(out[4], pa.int32())],
                    ["leaf", "template", "sig", "low", "high", "line"])

    by_row = wanted.groupBy(F.col("low").alias("row")).agg(F.collect_list(F.struct("leaf", "template", "high")).alias("left"))
    return numbered(docs, text_col).join(by_row, "row").select("row", "text", "left") \
        .mapInArrow(run, "leaf bigint, template bigint, sig binary, low bigint, high bigint, line int")


class Leaf:
    """The templates of one leaf, fed in order of first occurrence."""

    def __init__(self, n: int):
        self.n = n
        self.allowed = allowed_differences(n)
        cuts = [i * n // (self.allowed + 1) for i in range(self.allowed + 2)]
        self.segments = list(zip(cuts, cuts[1:]))
        self.tokens: list[list[int]] = []
        self.index: dict[tuple, list[int]] = {}
        self.members: list[list[int]] = []
        self.first: list[int] = []
        self.last: list[int] = []

    def add(self, template: int, sig: list[int], low: int, high: int) -> None:
        sig = sig[:self.n]
        keys = [(s, *sig[s:e]) for s, e in self.segments]
        best, score = -1, self.n - self.allowed - 1
        for c in {c for k in keys for c in self.index.get(k, ())}:
            equal = sum(a == b for a, b in zip(sig, self.tokens[c]))
            if equal > score or (equal == score and 0 <= best and c < best):
                best, score = c, equal
        if best < 0:
            for k in keys:
                self.index.setdefault(k, []).append(len(self.tokens))
            self.tokens.append(sig)
            self.members.append([template])
            self.first.append(low)
            self.last.append(high)
            return
        mine = self.tokens[best]
        if score < self.n:
            for (s, e), k in zip(self.segments, [(s, *mine[s:e]) for s, e in self.segments]):
                if mine[s:e] != sig[s:e] and WILD not in k:
                    self.index[k].remove(best)
            self.tokens[best] = [a if a == b else WILD for a, b in zip(sig, mine)]
        self.members[best].append(template)
        self.first[best] = min(self.first[best], low)
        self.last[best] = max(self.last[best], high)

    def recurring(self) -> Iterator[tuple[int, int]]:
        """(template hash, row of the first document) of each template seen in two documents or more."""
        for members, first, last in zip(self.members, self.first, self.last):
            if first != last:
                for t in members:
                    yield t, first


def _grow(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (leaf, template, sig, low, high) sorted by leaf and first occurrence: recurring templates."""
    def emit(leaf_id: int, leaf: Leaf) -> Iterator[pa.RecordBatch]:
        found = list(leaf.recurring())
        if found:
            t, f = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array([leaf_id] * len(t), pa.int64()), pa.array(t, pa.int64()),
                                              pa.array(f, pa.int64())], ["leaf", "template", "first"])

    now, leaf = None, None
    for b in batches:
        for key, template, sig, low, high in zip(*(c.to_pylist() for c in b.columns)):
            sig = np.frombuffer(sig, "<u4").tolist()
            if key != now:
                if leaf is not None:
                    yield from emit(now, leaf)
                now, leaf = key, Leaf(len(sig))
            leaf.add(template, sig, low, high)
    if leaf is not None:
        yield from emit(now, leaf)


def _small(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive batches of `_grow` joined to batches of a useful size."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.num_rows
        if size >= 10000:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def recurring_templates(docs: DataFrame, lines: DataFrame, text_col: str) -> DataFrame:
    """(leaf, template, first): the templates seen in two documents or more, first the row that keeps them."""
    distinct = stored(lines.groupBy("leaf", "template").agg(F.min("row").alias("low"), F.max("row").alias("high")),
                      "distinct-lines")
    shared = distinct.groupBy("leaf").agg(F.count("*").alias("n")).where("n > 1").select("leaf")
    exact = distinct.where("low <> high").join(shared, "leaf", "left_anti").select("leaf", "template", "low")
    ordered = (signed_lines(docs, distinct.join(shared, "leaf"), text_col).repartition("leaf")
               .sortWithinPartitions("leaf", "low", "line").select("leaf", "template", "sig", "low", "high"))
    return exact.union(ordered.mapInArrow(lambda batches: _small(_grow(batches)),
                                          "leaf bigint, template bigint, first bigint")).toDF("leaf", "template", "first")


def dropped_lines(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(row, dropped): per row number of `docs` the places of its lines that go."""
    lines = stored(line_table(docs, text_col), "lines")
    repeated = checkpointed(recurring_templates(docs, lines, text_col))
    return (lines.join(repeated, ["leaf", "template"]).where("row <> first")
            .groupBy("row").agg(F.collect_list("line").alias("dropped")))


def drop_recurring(docs: DataFrame, text_col: str = "text", n_dropped: str | None = None) -> DataFrame:
    """`docs` with the recurring lines of `text_col` taken out, and their number in column `n_dropped` if named."""
    docs = stable_rows(docs, "documents")
    drops = dropped_lines(docs, text_col).withColumnRenamed("row", "__row")
    rows = docs.select(whole_row(docs).alias("doc"), F.monotonically_increasing_id().alias("__row"))
    parts = F.split(F.col(f"doc.`{text_col}`"), "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("dropped"))
    text = F.when(F.col("dropped").isNull(), F.col(f"doc.`{text_col}`")) \
        .otherwise(F.array_join(F.transform(kept, lambda i: F.get(F.col("parts"), i)), "\n"))
    joined = rows.join(drops, "__row", "left").withColumn("parts", F.when(F.col("dropped").isNotNull(), parts))
    out = [text.alias(c) if c == text_col else F.col(f"doc.`{c}`").alias(c) for c in docs.columns]
    if n_dropped:
        out.append(F.when(F.col("dropped").isNull(), 0).otherwise(F.size("dropped")).cast("bigint").alias(n_dropped))
    return joined.select(*out)
