"""Fill-in-middle transformation over unit borders found by SWAR words.

A text is cut into units (a run of ASCII letters, or one other code point). Two of a
document's hash numbers choose two unit borders; what lies between them is the middle.
Form `psm` is `<P>`prefix`<S>`suffix`<M>`middle, form `spm` is `<S>`suffix`<P>`prefix`<M>`middle,
form `plain` is the text as it is: for an empty text, a text that holds one of the three
sentinels, and the share of documents that another hash number leaves alone.

Borders are found without cutting any text: the UTF-8 bytes of a batch of texts are viewed
as little-endian 64-bit words, eight bytes at a time. Arithmetic on whole words marks the last
byte of every unit (in its top bit): a byte whose successor is no continuation byte,
unless both are ASCII letters. `bitwise_count` counts the marks of each word; their running sum
is searched for the word that holds the k-th border, and the k-th mark inside that word is found
by clearing lower marks.

Scale: one pass over the rows, no shuffle. A task works on slices of SLICE_BYTES of text (one
text at least), with about six words of memory per eight bytes; equal inputs give equal rows, so a
lost task is simply run again.

Edge cases: a null text counts as empty (form plain, no units); a very long text is a slice by
itself and is worked on whole; repeated rows give repeated rows; a null doc_id is hashed as
no digits; an empty table gives an empty result; further columns are not read or returned.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Of 100: documents that are transformed, and of these the ones in form spm.
RATE, SPM_RATE = 90, 20
SEED = "1"
SLICE_BYTES = 4 << 20

_WORD = np.dtype("<u8")


def _every(byte: int) -> np.uint64:
    return np.uint64(int.from_bytes(bytes([byte]) * 8, "little"))


_TOP, _LOW7, _CASE = _every(0x80), _every(0x7F), _every(0x20)
_FROM_A, _AFTER_Z = _every(0x80 - ord("a")), _every(0x80 - ord("z") - 1)
_ONE, _BYTE = np.uint64(1), np.uint64(8)
_LAST = np.uint64(56)


def words_of(data: np.ndarray) -> np.ndarray:
    """The bytes as 64-bit words, filled up with zero bytes, and one word of zeros after them."""
    out = np.zeros(len(data) // 8 + 2, _WORD)
    out.view(np.uint8)[:len(data)] = data
    return out


def letters(words: np.ndarray) -> np.ndarray:
    """Top bit of each byte that is an ASCII letter."""
    low = (words | _CASE) & _LOW7
    return (low + _FROM_A) & ~(low + _AFTER_Z) & ~words & _TOP


def continuations(words: np.ndarray) -> np.ndarray:
    """Top bit of each byte that continues a code point (10xxxxxx)."""
    return words & ~(words << _ONE) & _TOP


def following(marks: np.ndarray) -> np.ndarray:
    """The marks of the byte after each byte."""
    out = marks >> _BYTE
    out[:-1] |= marks[1:] << _LAST
    return out


class Borders:
    """Rank and select over marked bytes."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.upto = np.cumsum(np.bitwise_count(marks), dtype=np.int64)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marks in the bytes before each place."""
        word, byte = at >> 3, (at & 7).astype(np.uint64)
        inside = self.marks[word] & ((_ONE << (byte * _BYTE)) - _ONE)
        return np.where(word > 0, self.upto[word - 1], 0) + np.bitwise_count(inside)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The place after the k-th marked byte, counted from 1."""
        word = np.searchsorted(self.upto, k, "left")
        left = k - np.where(word > 0, self.upto[word - 1], 0) - 1
        inside = self.marks[word].copy()
        for i in range(7):  # clear the marks before the wanted one
            more = left > i
            if not more.any():
                break
            inside[more] &= inside[more] - _ONE
        lowest = inside & (~inside + _ONE)
        return word * 8 + (np.bitwise_count(lowest - _ONE).astype(np.int64) >> 3) + 1


def unit_borders(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Borders:
    """Borders of the units of texts that lie one after the other in `data`."""
    words = words_of(data)
    letter = letters(words)
    marks = ~(following(continuations(words)) | (letter & following(letter))) & _TOP
    by_byte = marks.view(np.uint8)
    by_byte[len(data):] = 0
    by_byte[ends[ends > starts] - 1] = 0x80  # a unit ends with its text
    return Borders(marks)


def draws(doc_id: int | None, seed: str = SEED) -> tuple[int, int, int, int]:
    digest = sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i:i + 4], "big") for i in range(0, 16, 4))


def restore(output: bytes, form: str) -> bytes:
    """The text that `output` was made from. A sentinel is found at its first place, as no part
    holds one and none overlaps itself."""
    if form == PLAIN:
        return output
    first, second = (PREFIX, SUFFIX) if form == PSM else (SUFFIX, PREFIX)
    head, _, rest = output[len(first):].partition(second)
    tail, _, middle = rest.partition(MIDDLE)
    prefix, suffix = (head, tail) if form == PSM else (tail, head)
    return prefix + middle + suffix


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most SLICE_BYTES of text, or one row."""
    at = 0
    ends = np.cumsum(sizes)
    while at < len(sizes):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + SLICE_BYTES, "right")))
        yield at, to
        at = to


def _transform(rows: pa.RecordBatch, seed: str) -> pa.RecordBatch:
    """(doc_id, text) to (doc_id, n, form, prefix_chars, middle_chars, output)."""
    ids = rows.column(0).to_pylist()
    texts = rows.column(1)
    texts = texts.cast(pa.binary()) if pa.types.is_string(texts.type) else texts.cast(pa.large_string()).cast(pa.large_binary())
    texts = [x or b"" for x in texts.to_pylist()]
    data = b"".join(texts)
    ends = np.cumsum(np.array([len(x) for x in texts], np.int64))
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    borders = unit_borders(np.frombuffer(data, np.uint8), starts, ends)
    before = borders.rank(starts)
    n = borders.rank(ends) - before
    h = np.array([draws(i, seed) for i in ids], np.int64).reshape(len(ids), 4)
    cut = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
    place, inner = np.zeros(cut.shape, np.int64), cut > 0
    place[inner] = borders.select((before[:, None] + cut)[inner]) - np.broadcast_to(starts[:, None], cut.shape)[inner]
    kept = h[:, 2] % 100 >= RATE
    spm = h[:, 3] % 100 < SPM_RATE
    out = [[], [], [], []]
    for i, text in enumerate(texts):
        if not text or kept[i] or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
            row = (PLAIN, None, None, text)
        else:
            a, b = place[i]
            prefix, middle, suffix = text[:a], text[a:b], text[b:]
            parts = (SUFFIX, suffix, PREFIX, prefix) if spm[i] else (PREFIX, prefix, SUFFIX, suffix)
            row = (SPM if spm[i] else PSM, len(prefix.decode()), len(middle.decode()), b"".join((*parts, MIDDLE, middle)))
        for o, v in zip(out, row):
            o.append(v)
    return pa.RecordBatch.from_arrays(
        [rows.column(0), pa.array(n, pa.int64()), pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()),
         pa.array(out[2], pa.int64()), pa.array(out[3], pa.binary())],
        ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def _each_slice(batches: Iterable[pa.RecordBatch], seed: str) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            sizes = np.array([x or 0 for x in pc.binary_length(b.column(1)).to_pylist()], np.int64)
            for at, to in _slices(sizes):
                yield _transform(b.slice(at, to - at), seed)


def _input(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def fill_in_middle(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", seed: str = SEED) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output): one row per document, output the text to train on."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _each_slice(batches, seed):
            columns = [c if i < 5 else c.cast(pa.string()) for i, c in enumerate(b.columns)]
            yield pa.RecordBatch.from_arrays(columns, b.schema.names)

    return _input(docs, text_col, id_col).mapInArrow(
        run, "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restored(transformed: DataFrame) -> DataFrame:
    """`fill_in_middle` rows with column `text`, rebuilt from output and form alone."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            form, output = b.schema.get_field_index("form"), b.schema.get_field_index("output")
            texts = [restore(o.encode(), f).decode() for o, f in zip(b.column(output).to_pylist(), b.column(form).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*b.schema.names, "text"])

    fields = ", ".join(f"{n} {t}" for n, t in transformed.dtypes)
    return transformed.mapInArrow(run, fields + ", text string")


def digests(transformed: DataFrame) -> DataFrame:
    """The rows of `restored`, with SHA-256 digests in place of the texts."""
    def sha(c: str):
        return F.sha2(F.col(c).cast("binary"), 256)

    return restored(transformed).select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                                        sha("output").alias("output_sha256"), sha("text").alias("restored_sha256"))
