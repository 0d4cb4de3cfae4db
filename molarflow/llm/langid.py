"""Language identification by cross-parsing entropy.

Per language, labelled text is learned as a suffix automaton, which accepts exactly the
substrings of that text. A new text is parsed greedily into phrases, each the longest match
in the automaton; a text of the same language needs fewer, longer phrases. The number of
phrases times log2 of the training length, per byte, estimates the cross entropy; the
language with the lowest wins. The score is its share when phrase counts are turned into
likelihoods, 2^-(excess bits per byte * SHARPNESS), so it lies between 0 and 1.

Training uses a bounded sample: per language the texts (with a letter) of the smallest hash
of doc_id, whole texts of at most a quarter of the language's budget first, then slices of
longer ones, until `train_bytes` / (number of languages) bytes, but at least MIN_LANGUAGE,
are reached. So every language that has a text is learned. The driver gets at most some
eight times these bytes: rows stop where a language's texts, each cut to its budget, reach
SURPLUS times the budget. The automata are dense tables of (state, byte class) over the byte
classes that occur in the training text, so their memory is bounded too.

Parsing streams over whole texts: lower-cased, runs of anything but letters as one space,
cut into segments of SEGMENT bytes that are parsed side by side in numpy; a text's count is
the sum over its segments, so a cut adds at most one phrase per language alike.

Edge cases: null text or text without a letter is `und` with score 0; rows with null lang
or null doc_id are not learned from; ties go to the language that sorts first; nothing to
learn from makes every text `und`; repeated rows get equal results; an empty table gives
an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from molarflow.llm.common import checkpointed, crc_bucket

TRAIN_BYTES = 160_000
MIN_LANGUAGE = 1000
MIN_SLICE = 64
SURPLUS = 4
SAMPLE_ROWS = 400
#: Rows of a language that are ranked for its sample, as a multiple of the sample.
MARGIN = 4
SEGMENT = 256
LANES = 8192
SHARPNESS = 10.0
UNDETERMINED = "und"
NO_LETTER = r"[^\p{L}\p{M}]+"


class SuffixAutomaton:
    """Of a byte string over classes 1..k: next state by [state * (k + 1) + class], 0 is the dead state, 1 the start."""

    def __init__(self, data: bytes, classes: int):
        width = classes + 1
        moves: list[dict[int, int]] = [{}, {}]
        link, length, last = [0, 0], [0, 0], 1
        for c in data:
            state = len(moves)
            moves.append({})
            length.append(length[last] + 1)
            link.append(1)
            p = last
            while p and c not in moves[p]:
                moves[p][c] = state
                p = link[p]
            if p:
                q = moves[p][c]
                if length[p] + 1 == length[q]:
                    link[state] = q
                else:
                    clone = len(moves)
                    moves.append(dict(moves[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p and moves[p].get(c) == q:
                        moves[p][c] = clone
                        p = link[p]
                    link[q] = link[state] = clone
            last = state
        self.next = np.zeros((len(moves), width), np.int32)
        for s, m in enumerate(moves):
            for c, t in m.items():
                self.next[s, c] = t


@dataclass
class Model:
    """Per language a table of packed moves: next state * 4 + phrases that end with the move."""
    languages: list[str]
    classes: np.ndarray  # byte -> class; 0 unknown
    width: int  # classes + 2: the last one is padding
    tables: list[np.ndarray]
    bits: list[float]  # log2 of the training length


def packed(automaton: SuffixAutomaton, width: int) -> np.ndarray:
    """Greedy parsing as one table: on a dead move the phrase ends and the byte starts the next one;
    a byte unknown at the start is a phrase by itself; padding ends the open phrase."""
    move = automaton.next
    states = len(move)
    start = move[1]
    table = np.zeros((states, width), np.int64)
    for c in range(width - 1):
        again = np.where(start[c] > 0, start[c] * 4 + 1, 1 * 4 + 2)
        table[:, c] = np.where(move[:, c] > 0, move[:, c] * 4, again)
    table[1, :width - 1] = np.where(start > 0, start * 4, 1 * 4 + 1)
    table[:, width - 1] = 1 * 4 + 1
    table[1, width - 1] = 1 * 4
    table = table.astype(np.int32)
    table[:] = (table >> 2) * width << 2 | table & 3  # states premultiplied by the width
    return table.ravel()


def clean(texts: pa.Array) -> pa.Array:
    """Lower case, one space between words of letters (and marks), none at the ends."""
    return pc.utf8_trim(pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), NO_LETTER, " "), " ")


def budget_of(train_bytes: int, languages: int) -> int:
    """Training bytes of each language."""
    return max(MIN_LANGUAGE, train_bytes // max(1, languages))


def head(raw: bytes, size: int) -> bytes:
    """The first words of `raw` within `size` bytes, or its first characters where no word fits."""
    cut = raw[:size].decode("utf-8", "ignore").encode()
    return cut[:cut.rfind(b" ") + 1] or cut


def train(samples: dict[str, list[str]], train_bytes: int = TRAIN_BYTES) -> Model:
    languages = sorted(samples)
    budget = budget_of(train_bytes, len(languages))
    data = {}
    for lang in languages:
        texts, longer, left = [], [], budget
        for t in clean(pa.array(samples[lang], pa.string())).to_pylist():
            raw = t.encode("utf-8", "surrogatepass") + b" "
            if 1 < len(raw) <= min(left, max(1, budget // 4)):
                texts.append(raw)
                left -= len(raw)
            elif len(raw) > 1:
                longer.append(raw)
        for i, raw in enumerate(longer):  # what is left is dealt over them
            texts.append(head(raw, min(left, max(MIN_SLICE, left // (len(longer) - i)))))
            left -= len(texts[-1])
        data[lang] = b"".join(texts)
    languages = [x for x in languages if data[x]]
    used = sorted(set(b"".join(data.values())))
    classes = np.zeros(256, np.uint8)
    classes[used] = np.arange(1, len(used) + 1)
    tables = [packed(SuffixAutomaton(classes[np.frombuffer(data[x], np.uint8)].tobytes(), len(used)), len(used) + 2)
              for x in languages]
    return Model(languages, classes, len(used) + 2, tables, [float(np.log2(len(data[x]) + 1)) for x in languages])


def phrases(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(phrase counts by text and language, bytes by text) of cleaned texts."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    sizes = np.diff(offsets)
    per_text = -(-sizes // SEGMENT)
    owner = np.repeat(np.arange(len(sizes)), per_text)
    rank = np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    begin = offsets[owner] + rank * SEGMENT
    stop = np.minimum(begin + SEGMENT, offsets[owner + 1])
    counts = np.zeros((len(sizes), len(model.languages)), np.int64)
    order = np.argsort(stop - begin, kind="stable")  # lanes of like length together
    for at in range(0, len(order), LANES):
        lanes = order[at:at + LANES]
        steps = int((stop[lanes] - begin[lanes]).max()) + 1  # one more closes the open phrase
        place = begin[lanes][None, :] + np.arange(steps)[:, None]
        inside = place < stop[lanes][None, :]
        code = np.where(inside, model.classes[data[np.minimum(place, len(data) - 1)]], model.width - 1).astype(np.int32)
        for k, table in enumerate(model.tables):
            state = np.full(len(lanes), model.width, np.int32)  # state 1
            total = np.zeros(len(lanes), np.int32)
            for row in code:
                move = table[state + row]
                total += move & 3
                state = move >> 2
            counts[:, k] += np.bincount(owner[lanes], total, minlength=len(sizes)).astype(np.int64)
    return counts, sizes


def predict(model: Model, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """(language, score) of raw texts."""
    texts = clean(texts)
    lettered = np.asarray(pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False), bool)
    counts, sizes = phrases(model, texts)
    if not model.languages:
        return [UNDETERMINED] * len(sizes), np.zeros(len(sizes))
    entropy = counts * np.array(model.bits)[None, :] / np.maximum(sizes, 1)[:, None]
    best = entropy.argmin(axis=1)
    share = 2.0 ** (-SHARPNESS * (entropy - entropy.min(axis=1, keepdims=True)))
    score = np.where(lettered, 1 / share.sum(axis=1), 0.0)
    return [model.languages[b] if ok else UNDETERMINED for b, ok in zip(best.tolist(), lettered.tolist())], score


def learn(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, train_bytes: int = TRAIN_BYTES) -> Model:
    """Model from labelled rows (doc_id, text, lang): at most `sample_rows` rows of each language are read."""
    known = docs.where("doc_id IS NOT NULL AND lang IS NOT NULL").where(F.col("text").rlike(r"\p{L}"))
    h = F.xxhash64("doc_id")
    first = Window.partitionBy("lang").orderBy("h", "doc_id")
    # of a language with many rows only those below a hash bound that keeps some times the sample are ranked
    sizes = known.groupBy("lang").agg(F.count("*").alias("n"))
    low = F.col("h").cast("double") < F.lit(-2.0 ** 63) + F.lit(2.0 ** 64 * MARGIN * sample_rows) / F.col("n")
    ranked = known.select("doc_id", "lang", h.alias("h")).join(F.broadcast(checkpointed(sizes)), "lang").where(low)  # a row per language
    ids = checkpointed(ranked.withColumn("k", F.row_number().over(first))
                       .where(F.col("k") <= sample_rows).select("doc_id", "lang", "k"))
    budget = budget_of(train_bytes, ids.select("lang").distinct().count())
    words = F.trim(F.regexp_replace(F.lower("text"), NO_LETTER, " "))
    before = F.sum(F.octet_length("text")).over(Window.partitionBy("lang").orderBy("k").rowsBetween(Window.unboundedPreceding, -1))
    texts = (known.select("doc_id", "lang", "text").join(F.broadcast(ids), ["doc_id", "lang"])  # sample_rows per language
             .groupBy("lang", "k").agg(F.max("text").alias("text"))
             .select("lang", "k", F.substring(words, 1, budget).alias("text"))
             .withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < SURPLUS * budget)
             .select("lang", "text").orderBy("lang", "k"))
    samples: dict[str, list[str]] = {}
    for r in texts.collect():
        samples.setdefault(r.lang, []).append(r.text)
    return train(samples, train_bytes)


def identify(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """Columns `keep` of `docs`, lang_pred and score."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                lang, score = predict(model, part.column(len(keep)))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(lang, pa.string()), pa.array(score)],
                                                 [*keep, "lang_pred", "score"])

    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias("__text"))
    fields = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes[:-1])
    return rows.mapInArrow(run, f"{fields}, lang_pred string, score double")


def label_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned outside the held-out fifth only."""
    fold = crc_bucket("doc_id", 5)
    model = learn(docs.where(fold != 0))
    return identify(docs, model, ["doc_id"]).select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"),
                                                    "lang_pred", "score")
