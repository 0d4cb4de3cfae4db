"""Sequence packing by minimum bin slack.

Documents become token ids with an end token, and are cut into pieces of at most
`capacity` ids. Full pieces are sequences of their own. The others are packed by
minimum bin slack over their length histogram: a bitset holds which sums of the
remaining lengths can be reached (bounded subset sum, counts in binary portions); the
largest sum within the capacity is taken, and backtracking through the saved bitsets
gives how many pieces of each length make it up. That multiset is used as often as the
counts allow, which uses up at least one length; so there are at most about as many
patterns as lengths, and the plan takes no longer for more documents.

Only the histogram (at most `capacity` rows) reaches the driver. Pieces get their rank
among the pieces of their length from running sums over (partition, length) counts of a
checkpointed table, so no length, however common, is collected in one place; rank and
plan give sequence and offset.

Edge cases: null text counts as empty (only the end token); repeated rows are packed once
each; very long texts are cut; documents of one length are told apart by row order;
further columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType
from pyspark.sql.window import Window

from molarflow.llm.common import checkpointed

CAPACITY = 4096
END_ID = 2
END_OF_WORD = "</w>"
TOKENIZE_BYTES = 8 << 20
CACHED_WORDS = 1 << 19
SET_APART = r"([^\PL\x{130}])([!-&(-/:-@\[-`{-~]+)( |\n|$)"
PUNCTUATION = re.compile(r"[!-&(-/:-@\[-`{-~]+")


class WordTokenizer:
    """Ids of texts by a word-end BPE of the tokenizers library, each distinct space-separated word encoded once.

    Spaces and line feeds always end a word in such a vocabulary's pre-tokenizer, so ids of a
    text are those of its words in order. New words are encoded together, joined by spaces; a
    word's ids end where as many end-of-word tokens have passed as it has pre-tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith(END_OF_WORD)]] = True
        self.known: dict[str, bytes] = {}

    def _pre_tokens(self, word: str) -> int:
        # letters make one pre-token (the dotted capital I is lower-cased to a letter and a mark)
        if word.isalpha() and "\u0130" not in word:
            return 1
        if PUNCTUATION.fullmatch(word):
            return 1
        normal = self.tokenizer.normalizer.normalize_str(word) if self.tokenizer.normalizer else word
        return len(self.tokenizer.pre_tokenizer.pre_tokenize_str(normal))

    def _encode(self, words: list[str]) -> list[bytes]:
        counts = [self._pre_tokens(w) for w in words]
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, dtype="<u4")
        stops = np.nonzero(self.ends[ids])[0] + 1
        total = np.cumsum([0, *counts])
        if total[-1] == len(stops):
            at = np.concatenate([[0], stops])[total]
            return [ids[s:e].tobytes() for s, e in zip(at[:-1].tolist(), at[1:].tolist())]
        return [np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, dtype="<u4").tobytes() for w in words]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text starts (one more at the end)."""
        # A-Z are lower-cased and punctuation at the end of a word is set apart: the
        # tokenizer does both, and doing it here leaves far fewer distinct words
        plain = pc.replace_substring_regex(pc.ascii_lower(pc.fill_null(texts, "")), SET_APART, r"\1 \2\3")
        lists = pc.split_pattern_regex(plain, "[ \n]+")
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        if len(self.known) + len(words) > CACHED_WORDS:
            self.known = {}
        known = self.known
        new = [w for w in words if w not in known]
        for at in range(0, len(new), 1000):
            part = new[at:at + 1000]
            known.update(zip(part, self._encode(part)))
        pieces = [known[w] for w in words]
        flat = np.frombuffer(b"".join(pieces), dtype="<u4")
        lengths = np.fromiter(map(len, pieces), np.int32, len(pieces)) >> 2
        begins = (np.cumsum(lengths) - lengths).astype(np.int32)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        n = lengths[codes] if len(codes) else np.zeros(0, np.int32)
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        source = np.arange(total, dtype=np.int32)
        if total:
            source += np.repeat(begins[codes] - (ends - n).astype(np.int32), n)
        bounds = np.asarray(lists.offsets.to_numpy(), np.int64) - lists.offsets[0].as_py()
        return flat[source], np.concatenate([[0], ends])[bounds]


def pieces(docs: DataFrame, tokenizer_path: str, text_col: str = "text", id_col: str = "doc_id",
           capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): the documents cut into pieces of at most `capacity` ids."""
    def slices(text: pa.Array) -> Iterator[tuple[int, int]]:
        size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False), np.int64))
        at = 0
        while at < len(text):
            done = size[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(size, done + TOKENIZE_BYTES, "right")))
            yield at, stop
            at = stop

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer(tokenizer_path)
        end = np.array([end_id], "<u4")
        for b in batches:
            for at, stop in slices(b.column(1)):
                ids, bounds = tokenizer.encode(b.column(1).slice(at, stop - at))
                out: list[tuple] = []
                for r, (s, e) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                    doc = np.concatenate([ids[s:e], end])
                    out += [(at + r, i, min(capacity, len(doc) - i), crc32(doc[i:i + capacity].tobytes()), len(doc))
                            for i in range(0, len(doc), capacity)]
                row, start, length, crc, n = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(row)), *[pa.array(v, pa.int64()) for v in (start, length, crc, n)]],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, start bigint, length bigint, ids_crc32 bigint, "
                                "doc_tokens bigint")


@dataclass
class Plan:
    """Use i of the plan: pieces of `length[i]` with ranks from `rank[i]`, `per[i]` of them in each sequence from
    `sequence[i]` on, the first at `offset[i]`."""
    length: np.ndarray
    rank: np.ndarray
    per: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How many pieces of each length fill one sequence closest to the capacity."""
    reach, saved = 1, []
    limit = (1 << (capacity + 1)) - 1
    for length in sorted(counts, reverse=True):
        left, portion = min(counts[length], capacity // length), 1
        while left:
            take = min(portion, left)
            saved.append((reach, length, take))
            reach |= (reach << (length * take)) & limit
            left -= take
            portion *= 2
            if reach >> capacity & 1:
                break
        if reach >> capacity & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for before, length, take in reversed(saved):
        if not before >> total & 1:
            total -= length * take
            chosen[length] = chosen.get(length, 0) + take
    return chosen


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    left = {k: n for k, n in histogram.items() if n > 0}
    used = dict.fromkeys(left, 0)
    rows, sequence = [], 0
    while left:
        chosen = fullest(left, capacity)
        times = min(left[k] // n for k, n in chosen.items())
        offset = 0
        for length, n in sorted(chosen.items(), reverse=True):
            rows.append((length, used[length], n, sequence, offset))
            offset += length * n
            used[length] += n * times
            left[length] -= n * times
            if not left[length]:
                del left[length]
        sequence += times
    rows.sort()
    return Plan(*np.array(rows, np.int64).reshape(-1, 5).T)


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`cut` (any columns, with `length`) and the columns sequence_id and offset."""
    cut = checkpointed(cut.withColumn("__part", F.spark_partition_id()))
    cut = cut.withColumn("__row", F.monotonically_increasing_id())
    counts = checkpointed(cut.groupBy("__part", "length").agg(F.count("*").alias("n")))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    p = plan(histogram, capacity)
    before = (F.sum("n").over(Window.partitionBy("length").orderBy("__part")) - F.col("n")).alias("__before")
    base = counts.select("__part", "length", before)
    local = F.row_number().over(Window.partitionBy("__part", "length").orderBy("__row")) - 1
    ranked = (cut.withColumn("__local", local).join(base, ["__part", "length"])
              .withColumn("__rank", F.col("__before") + F.col("__local")).drop("__before", "__local", "__part", "__row"))
    columns = [c for c in ranked.columns if c != "__rank"]

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = np.searchsorted(p.length, np.arange(capacity + 2))  # where each length's uses start
        span = (int(p.rank.max()) + 1 if len(p.rank) else 1)
        key = p.length * span + p.rank if (capacity + 1) * span < 1 << 62 else None
        for b in batches:
            length, rank = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "__rank"))
            if key is not None:
                use = np.searchsorted(key, length * span + np.minimum(rank, span - 1), "right") - 1
            else:
                use = np.array([first[n] + np.searchsorted(p.rank[first[n]:first[n + 1]], r, "right") - 1
                                for n, r in zip(length, rank)], np.int64)
            slot = rank - p.rank[use]
            sequence = p.sequence[use] + slot // p.per[use]
            offset = p.offset[use] + slot % p.per[use] * length
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index(c)) for c in columns] + [pa.array(sequence), pa.array(offset)],
                [*columns, "sequence_id", "offset"])

    schema = ranked.drop("__rank").schema.add("sequence_id", LongType()).add("offset", LongType())
    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row per piece."""
    cut = pieces(docs, tokenizer_path, capacity=capacity, end_id=end_id)
    return pack(cut, capacity).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
