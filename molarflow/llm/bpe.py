"""Byte-level BPE by a global shuffle of distinct words.

Encoding. Each task cuts its texts into pre-tokens and groups documents into blocks of
about BLOCK_BYTES; a block is its distinct pre-tokens (words) and, per document, the word
codes in order of position. Words travel in packed rows, one per block and bucket (a hash
of the word), and are shuffled by bucket: there each distinct word is encoded once for the
whole corpus and its ids go back to every block that holds it. Documents and ids meet by
block, and each document is reassembled by position.

A word is at most once in a block, so a word that fills a third of all positions is still
only one entry per block; blocks and buckets are bounded, so are the tasks. Blocks are
formed twice, for words and for documents, from the same input partition in the same order;
their numbers of words are compared when they meet.

Decoding takes each id's bytes from the token-byte table (as long as the vocabulary, so it
is sent along) and joins them by position.

Edge cases: null text counts as empty and has no ids; repeated rows are encoded each; very
long texts make a block of their own; bytes that are no valid UTF-8 together are kept, as
decoding returns bytes; ids outside the table raise; an empty table gives an empty result;
columns other than the named id are not carried.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 8 << 20
BUCKETS_PER_PARTITION = 2


@dataclass
class Vocabulary:
    """Token bytes by id, and the pattern that cuts texts into pre-tokens."""
    tokens: list[bytes]
    pattern: str

    @classmethod
    def load(cls, path: str, pattern: str) -> Vocabulary:
        ranks = {int(rank): base64.b64decode(token) for token, rank in (x.split() for x in open(path, "rb") if x.strip())}
        return cls([ranks.get(i, b"") for i in range(max(ranks) + 1)], pattern)


def pre_tokenize(texts: pa.Array, pattern: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(words, codes, bounds): the pre-tokens of all texts as codes into their distinct words;
    text i has codes[bounds[i]:bounds[i + 1]].

    A space before a non-space starts a new pre-token whatever stands before it, so the
    pieces between single spaces are cut once each; texts where white space meets such a
    place are matched as a whole."""
    import regex
    match, bare = regex.compile(pattern).findall, regex.compile(r"^\s|\s$|^$").search
    words: dict[str, int] = {}

    def cut(text: str) -> list[int]:
        return [words.setdefault(w, len(words)) for w in match(text)]

    lists = pc.split_pattern(pc.fill_null(texts, ""), " ")
    coded = lists.flatten().dictionary_encode()
    pieces = coded.dictionary.to_pylist()
    key = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * 2 + 1  # odd: after a space
    bounds = np.asarray(lists.offsets.to_numpy(), np.int64) - lists.offsets[0].as_py()
    key[bounds[:-1]] -= 1
    used = np.nonzero(np.bincount(key, minlength=2 * len(pieces)))[0]
    flat: list[int] = []
    length = np.zeros(2 * len(pieces), np.int64)
    odd = np.zeros(2 * len(pieces), bool)
    for k in used.tolist():
        piece = pieces[k >> 1]
        spaced = " " + piece if k & 1 else piece
        if piece.isalpha():
            flat.append(words.setdefault(spaced, len(words)))
            length[k] = 1
        elif bare(piece) or piece[0].isspace() or piece[-1].isspace():
            odd[k] = True
        else:
            found = cut(spaced)
            flat += found
            length[k] = len(found)
    begin = np.cumsum(length) - length
    n = length[key]
    ends = np.cumsum(n)
    codes = np.array(flat, np.int32)[np.arange(int(n.sum())) + np.repeat(begin[key] - (ends - n), n)]
    at = np.concatenate([[0], ends])[bounds]
    whole = np.nonzero(np.add.reduceat(odd[key], bounds[:-1]) > 0)[0] if len(texts) else []
    if len(whole):
        parts = [codes[s:e] for s, e in zip(at[:-1].tolist(), at[1:].tolist())]
        for i in whole.tolist():
            parts[i] = np.array(cut(texts[i].as_py() or ""), np.int32)
        codes = np.concatenate(parts)
        at = np.concatenate([[0], np.cumsum([len(x) for x in parts])])
    return list(words), codes, at


def varints(values: np.ndarray) -> bytes:
    """Little-endian groups of seven bits, the last of a value without the high bit."""
    values = values.astype(np.int64)
    size = 1 + (values >= 1 << 7) + (values >= 1 << 14) + (values >= 1 << 21) + (values >= 1 << 28)
    at = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    for k in range(5):
        has = size > k
        out[at[has] + k] = (values[has] >> 7 * k & 0x7F) | ((size[has] > k + 1) << 7)
    return out.tobytes()


def from_varints(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).astype(np.int64)
    if not len(raw):
        return raw
    first = np.concatenate([[0], np.nonzero(raw < 128)[0][:-1] + 1])
    place = np.arange(len(raw)) - np.repeat(first, np.diff(np.concatenate([first, [len(raw)]])))
    return np.add.reduceat((raw & 0x7F) << 7 * place, first)


def pack_words(words: list[bytes]) -> bytes:
    lengths = varints(np.array([len(w) for w in words], np.int64))
    return zlib.compress(len(lengths).to_bytes(4, "little") + lengths + b"".join(words), 1)


def unpack_words(data: bytes) -> list[bytes]:
    data = zlib.decompress(data)
    n = int.from_bytes(data[:4], "little")
    ends = np.cumsum(from_varints(data[4:4 + n])) + 4 + n
    starts = np.concatenate([[4 + n], ends[:-1]])
    return [data[s:e] for s, e in zip(starts.tolist(), ends.tolist())]


def _blocks(batches: Iterable[pa.RecordBatch], pattern: str) -> Iterator[tuple[int, pa.Array, list[np.ndarray], list[bytes]]]:
    """(block, document ids, codes by document, words), codes in order of falling frequency; rows are (id, text)."""
    part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0

    def done():
        ids = pa.concat_arrays([b.column(0) for b in held])
        words, codes, at = pre_tokenize(pa.concat_arrays([b.column(1).cast(pa.large_string()) for b in held]), pattern)
        order = np.argsort(-np.bincount(codes, minlength=len(words)), kind="stable")
        rank = np.empty(len(words), np.int32)
        rank[order] = np.arange(len(words))
        codes = rank[codes]
        return (part << 24 | seq, ids, [codes[s:e] for s, e in zip(at[:-1].tolist(), at[1:].tolist())],
                [words[i].encode("utf-8", "surrogatepass") for i in order.tolist()])

    for b in batches:
        sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False), np.int64))
        at = 0
        while at < b.num_rows:
            before = int(sizes[at - 1]) if at else 0
            stop = max(at + 1, int(np.searchsorted(sizes, before + BLOCK_BYTES - size, "right")))
            held.append(b.slice(at, stop - at))
            size += int(sizes[stop - 1]) - before
            at = stop
            if size >= BLOCK_BYTES or at < b.num_rows:
                yield done()
                seq, held, size = seq + 1, [], 0
    if held:
        yield done()


def _bucket(words: list[bytes], buckets: int) -> np.ndarray:
    return np.array([zlib.crc32(w) % buckets for w in words], np.int64)


def encode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, ids): the token ids of each text."""
    pattern, tokens = vocabulary.pattern, vocabulary.tokens
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = partitions * BUCKETS_PER_PARTITION
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = dict(rows.dtypes)["doc_id"]

    def word_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, _, words in _blocks(batches, pattern):
            bucket = _bucket(words, buckets)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            used = [k for k in range(buckets) if cuts[k + 1] > cuts[k]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()), pa.array([block] * len(used), pa.int64()),
                 pa.array([pack_words([words[i] for i in order[cuts[k]:cuts[k + 1]].tolist()]) for k in used], pa.binary())],
                ["bucket", "block", "words"])

    def encode_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken
        encoding = tiktoken.Encoding("words", pat_str=pattern, special_tokens={},
                                     mergeable_ranks={t: i for i, t in enumerate(tokens) if t})
        now, known = -1, {}
        for b in batches:
            out = []
            for bucket, packed in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if bucket != now:
                    now, known = bucket, {}
                words = unpack_words(packed)
                for w in words:
                    if w not in known:
                        known[w] = encoding.encode_ordinary(w.decode("utf-8", "surrogatepass"))
                ids = [known[w] for w in words]
                lengths = varints(np.array([len(i) for i in ids], np.int64))
                flat = varints(np.array([x for i in ids for x in i], np.int64))
                out.append(len(lengths).to_bytes(4, "little") + lengths + flat)
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(0), pa.array(out, pa.binary())], ["block", "bucket", "ids"])

    def document_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ids, docs_, words in _blocks(batches, pattern):
            deal = zlib.compress(_bucket(words, buckets).astype("<u4").tobytes(), 1)
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.nulls(1, ids.type), pa.array([deal], pa.binary()),
                                              pa.array([True])], ["block", "doc_id", "codes", "deal"])
            for at in range(0, len(ids), 1000):
                codes = [varints(c) for c in docs_[at:at + 1000]]
                yield pa.RecordBatch.from_arrays([pa.array([block] * len(codes), pa.int64()), ids.slice(at, 1000),
                                                  pa.array(codes, pa.binary()), pa.array([False] * len(codes))],
                                                 ["block", "doc_id", "codes", "deal"])

    def assemble(left: pa.Table, right: pa.Table) -> pa.Table:
        deal = left.filter(left["deal"])["codes"].to_pylist()
        left = left.filter(pc.invert(left["deal"]))
        bucket = np.frombuffer(zlib.decompress(deal[0]), "<u4")
        lengths, parts = np.zeros(len(bucket), np.int64), {}
        for k, data in zip(right["bucket"].to_pylist(), right["ids"].to_pylist()):
            n = int.from_bytes(data[:4], "little")
            parts[k] = (from_varints(data[4:4 + n]), from_varints(data[4 + n:]))
        order = np.argsort(bucket, kind="stable")
        found = [parts[k] for k in sorted(parts)]
        sizes = np.concatenate([np.zeros(0, np.int64), *[p[0] for p in found]])
        if len(deal) != 1 or len(sizes) != len(bucket):
            raise RuntimeError("words and documents of a block do not belong together")
        flat = np.concatenate([np.zeros(0, np.int64), *[p[1] for p in found]])
        lengths[order] = sizes
        begin = np.zeros(len(bucket), np.int64)
        begin[order] = np.cumsum(sizes) - sizes
        ids, ends = [], []
        for data in left["codes"].to_pylist():
            codes = from_varints(data)
            n = lengths[codes]
            end = np.cumsum(n)
            ids.append(flat[np.arange(int(n.sum())) + np.repeat(begin[codes] - (end - n), n)].astype(np.int32))
            ends.append(len(ids[-1]))
        offsets = pa.array(np.concatenate([[0], np.cumsum(ends)]), pa.int32())
        values = pa.array(np.concatenate([np.zeros(0, np.int32), *ids]), pa.int32())
        return pa.table({"doc_id": left["doc_id"], "ids": pa.ListArray.from_arrays(offsets, values)})

    words = rows.mapInArrow(word_rows, "bucket int, block bigint, words binary")
    coded = (words.repartition(partitions, "bucket").sortWithinPartitions("bucket")
             .mapInArrow(encode_words, "block bigint, bucket int, ids binary"))
    texts = rows.mapInArrow(document_rows, f"block bigint, doc_id {kind}, codes binary, deal boolean")
    return texts.groupBy("block").cogroup(coded.groupBy("block")).applyInArrow(assemble, f"doc_id {kind}, ids array<int>")


def _token_table(tokens: list[bytes]) -> pa.Array:
    return pa.array([t or None for t in tokens], pa.large_binary())


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """`encoded` and the bytes its ids stand for."""
    tokens = vocabulary.tokens
    names = encoded.columns
    at = names.index(ids_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _token_table(tokens)
        for b in batches:
            for s in range(0, b.num_rows, 1000):
                part = b.slice(s, 1000)
                data = token_bytes(part.column(at), table)
                yield pa.RecordBatch.from_arrays([*part.columns, data.cast(pa.binary())], [*names, out])

    fields = ", ".join(f"`{n}` {t}" for n, t in encoded.dtypes)
    return encoded.mapInArrow(run, f"{fields}, `{out}` binary")


def token_bytes(ids: pa.ListArray, table: pa.Array) -> pa.Array:
    """The token bytes of each list of ids, joined."""
    found = table.take(ids.flatten())
    if found.null_count:
        raise ValueError("an id that the vocabulary does not have")
    offsets = pc.subtract(ids.offsets, ids.offsets[0]).cast(pa.int64())
    return pc.binary_join(pa.LargeListArray.from_arrays(offsets, found), pa.scalar(b"", pa.large_binary()))


def digests(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of (doc_id, ids, decoded)."""
    text = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(text, 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))
