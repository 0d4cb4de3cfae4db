"""Toxicity by non-negative positive-unlabelled learning.

Training data are confirmed toxic documents (positives) and all learning rows, whatever their
label says (unlabelled, toxic or not). A linear classifier over character n-grams is fitted in numpy
by full-batch gradient steps on the non-negative risk

    prior * E_pos[loss(+)] + max(0, E_unl[loss(-)] - prior * E_pos[loss(-)])

with the logistic loss: the second term is the risk on negatives, corrected by the class
prior, and kept from going below zero, where the model would fit the unlabelled toxic
documents as negatives. The prior is the toxic share among labelled learning rows; where these
are all toxic, it is estimated from the unlabelled rows: an n-gram's share among them is at
least prior times its share among positives, so the smallest ratio bounds the prior.

Fitting uses a bounded sample: at most `max_positive` and `max_unlabelled` documents,
those with the smallest hash of doc_id, as far as POSITIVE_BYTES and UNLABELLED_BYTES of text go
(of a text its first TEXT_CHARS characters; the driver gets no more), near copies (same smallest hash of 5-word windows)
once. Features are the n-grams whose share among positives exceeds that among the other rows by
Z standard errors, and by a likelihood ratio as strong, which holds for few documents too, and
is LIFT times that among negatives (the unlabelled share less the positives' part in it, by the
prior); at most MAX_FEATURES. What marks a document is then a few hundred strings. Scoring streams over all documents: one Aho-Corasick pass over the
lower-cased text marks the n-grams present, and one matrix product per batch scores them.

Edge cases: null and empty texts score the model's intercept; no positives, or no n-gram that
marks them, fit nothing, and every score is the prior, 0.5 at most, so no document goes; a very long text is marked whole when scored
(only the sample is cut, at TEXT_CHARS); further columns pass through `drop_toxic`; repeated rows score alike; several labels of
a document count as toxic if one is; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType
from pyspark.sql.window import Window

from molarflow.llm.common import crc_bucket, whole_row

MAX_POSITIVE = 1500
MAX_UNLABELLED = 4500
POSITIVE_BYTES = 12_000_000
UNLABELLED_BYTES = 36_000_000
TEXT_CHARS = 200_000
MAX_FEATURES = 2048
HASHES = 1 << 23
CHUNK = 1 << 16
LIFT = 2.5
Z = 5.0
PRIOR_Z = 3.0
STEPS = 1000
RATE = 0.1
DECAY = 1e-5
TOXIC_FROM = 0.7
NO_LETTER = re.compile(r"[\W\d_]+")


@dataclass
class Model:
    ngrams: list[str]
    weights: np.ndarray
    intercept: float


def plain(text: str | None) -> str:
    """Lower-case words of letters, one space before, between and after them."""
    return f" {NO_LETTER.sub(' ', (text or '').lower()).strip()} "


def ngrams_of(word: str) -> set[str]:
    """The word with its ends marked, and its pieces of four to six characters."""
    w = f" {word} "
    return {w} | {w[i:i + n] for n in (4, 5, 6) for i in range(len(w) - n + 1)}


def _collapse(texts: list[str]) -> list[str]:
    """One text of each set with the same smallest 5-word window hash."""
    seen: dict[int, str] = {}
    for t in texts:
        w = t.split()
        key = min((crc32(" ".join(w[i:i + 5]).encode()) for i in range(max(1, len(w) - 4))))
        seen.setdefault(key, t)
    return list(seen.values())


def _share_marks(count: np.ndarray, others: np.ndarray, n: int, n_others: int, own: int, prior: float) -> np.ndarray:
    """Z scores of the n-grams whose share exceeds that among the others (without the `own` positives they
    hold), with a number of documents too high for chance, and is LIFT times the share among negatives;
    -inf for the rest."""
    p, rest = count / n, max(1, n_others - own)
    negative = np.maximum(0, others / n_others - prior * p) / (1 - prior)
    others = np.clip(others - p * own, 0, rest)
    u = others / rest
    mean = np.minimum(1, (count + others) / (n + rest))
    error = np.sqrt(mean * (1 - mean) * (1 / n + 1 / rest)) + 1e-12
    q = np.minimum(p, (others + 1) / (rest + 2))
    ratio = p * np.log(np.maximum(p, 1e-12) / np.maximum(q, 1e-12)) + (1 - p) * np.log(np.maximum(1 - p, 1e-12) / (1 - q + 1e-12))
    return np.where((2 * n * ratio >= Z * Z) & (p >= LIFT * negative), (p - u) / error, -np.inf)


def _prior_bound(count: np.ndarray, others: np.ndarray, n: int, n_others: int) -> float:
    """The smallest ratio of an n-gram's share among the others and among positives, with PRIOR_Z errors on both."""
    p = count / n
    low = p - PRIOR_Z * np.sqrt(p * (1 - p) / n + 1 / n ** 2)
    high = (others + PRIOR_Z * np.sqrt(others + 1.0)) / n_others
    return float(np.min(np.where(low > 0, high / np.maximum(low, 1e-12), 1.0)))


def clamped(prior: float) -> float:
    return min(0.9, max(0.001, prior))


def select_ngrams(positive: list[str], unlabelled: list[str], prior: float | None) -> tuple[list[str], float]:
    """The n-grams that mark the positives, strongest first, and the prior, estimated if it is None.

    Documents are counted by n-gram hash in two arrays of fixed size; only n-grams whose hash
    stands out are then kept as strings and counted exactly."""
    def hashed(word: str) -> list[int]:
        return [crc32(g.encode("utf-8", "surrogatepass")) % HASHES for g in ngrams_of(word)]

    def count(texts: list[str]) -> np.ndarray:
        c = np.zeros(HASHES, np.uint16)
        for t in texts:
            c[list({h for w in set(t.split()) for h in hashed(w)})] += 1
        return c

    pos, unl = count(positive), count(unlabelled)
    sizes, chunks = (len(positive), len(unlabelled)), range(0, HASHES, CHUNK)
    own = len(set(positive) & set(unlabelled))
    if prior is None:
        prior = clamped(min(_prior_bound(pos[i:i + CHUNK], unl[i:i + CHUNK], *sizes) for i in chunks))
    marked = np.concatenate([_share_marks(pos[i:i + CHUNK], unl[i:i + CHUNK], *sizes, own, prior) >= Z for i in chunks])
    del pos, unl
    found: set[str] = set()
    for t in positive:
        for w in set(t.split()):
            found.update(g for g in ngrams_of(w) if marked[crc32(g.encode("utf-8", "surrogatepass")) % HASHES])
    del marked
    grams = sorted(found)
    mark = Marker(grams)
    exact = [sum((mark(texts[i:i + 256]).sum(axis=0) for i in range(0, len(texts), 256)), np.zeros(len(grams)))
             for texts in (positive, unlabelled)]
    z = _share_marks(*exact, *sizes, own, prior)
    best = sorted((-z[i], g) for i, g in enumerate(grams) if z[i] >= Z)
    return [g for _, g in best[:MAX_FEATURES]], prior


class Marker:
    """Marks which n-grams a text contains."""

    def __init__(self, ngrams: list[str]):
        self.size = len(ngrams)
        self.tree = ahocorasick.Automaton()
        for i, g in enumerate(ngrams):
            self.tree.add_word(g, i)
        if ngrams:
            self.tree.make_automaton()

    def __call__(self, texts: list[str]) -> np.ndarray:
        x = np.zeros((len(texts), self.size), np.float32)
        if self.size:
            for r, t in enumerate(texts):
                x[r, list({i for _, i in self.tree.iter(t)})] = 1
        return x


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def risk_gradient(w: np.ndarray, x_pos: np.ndarray, x_unl: np.ndarray, prior: float) -> tuple[np.ndarray, bool]:
    """Gradient of the non-negative PU risk at weights and intercept `w`, and whether the risk on negatives is not
    below zero; where it is, the gradient of its negative, which steps back out of the region where
    unlabelled positives are fitted as negatives."""
    def grad(x, slope):  # mean of slope * (x, 1)
        return np.append(x.T @ slope, slope.sum()) / len(x)

    w32 = w[:-1].astype(np.float32)
    p, u = (_sigmoid(x @ w32 + w[-1]) for x in (x_pos, x_unl))
    on_negatives = -np.log(1 - u + 1e-12).mean() + prior * np.log(1 - p + 1e-12).mean()
    negative = grad(x_unl, u.astype(np.float32)) - prior * grad(x_pos, p.astype(np.float32))
    if on_negatives < 0:
        return -negative, False
    return prior * grad(x_pos, (p - 1).astype(np.float32)) + negative, True


def fit_nnpu(x_pos: np.ndarray, x_unl: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Weights and intercept that minimise the non-negative PU risk (Adam, full batch).

    n-grams that occur in the same documents get equal weights, so they are fitted as one column."""
    alike: dict[bytes, int] = {}
    packed = np.packbits(np.concatenate([x_pos, x_unl]).T > 0, axis=1)
    of = np.array([alike.setdefault(c.tobytes(), len(alike)) for c in packed], np.int64)
    first = np.unique(of, return_index=True)[1]
    many = np.bincount(of, minlength=len(alike)).astype(np.float32)
    x_pos, x_unl = x_pos[:, first] * many, x_unl[:, first] * many
    w = np.zeros(x_pos.shape[1] + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    w[-1] = np.log(prior / (1 - prior))

    for step in range(1, STEPS + 1):
        g, _ = risk_gradient(w, x_pos, x_unl, prior)
        g[:-1] += DECAY * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return w[:-1][of], float(w[-1])


def within_bytes(sample: DataFrame, positive_bytes: int, unlabelled_bytes: int) -> DataFrame:
    """The rows (doc_id, positive, only, text) as (doc_id, positive, unlabelled, text), texts cut to TEXT_CHARS;
    a role ends, in order of the hash of doc_id, where its texts reach its bytes."""
    cut = sample.withColumn("text", F.substring("text", 1, TEXT_CHARS)).withColumn("h", F.xxhash64("doc_id"))

    def before(role: str):  # a window over the bounded sample
        w = Window.partitionBy(role).orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(F.octet_length("text")).over(w), F.lit(0))

    return cut.select("doc_id", ((F.col("positive") == 1) & (before("positive") < positive_bytes)).alias("positive"),
                      ((F.col("only") == 0) & (before("only") < unlabelled_bytes)).alias("unlabelled"), "text") \
        .where("positive OR unlabelled")


def fit(docs: DataFrame, labels: DataFrame, text_col: str = "text", max_positive: int = MAX_POSITIVE,
        max_unlabelled: int = MAX_UNLABELLED) -> Model:
    """Fit on `docs` (doc_id, text) with the confirmed positives of `labels` (doc_id, toxic)."""
    marks = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    keyed = (docs.where("doc_id IS NOT NULL").select("doc_id").distinct().join(marks, "doc_id", "left")
             .select("doc_id", "toxic", F.xxhash64("doc_id").alias("h")))
    n = keyed.groupBy("toxic").count().collect()  # at most three rows
    n_of = {r.toxic: r["count"] for r in n}
    prior = clamped(n_of.get(1, 0) / max(1, n_of.get(0, 0) + n_of.get(1, 0))) if n_of.get(0) or not n_of.get(1) else None
    if not n_of.get(1):
        return Model([], np.zeros(0), float(np.log(prior / (1 - prior))))
    pos, unl = F.lit(1).alias("part"), F.lit(0).alias("part")
    chosen = (keyed.where("toxic = 1").orderBy("h", "doc_id").limit(max_positive).select("doc_id", pos)
              .union(keyed.orderBy("h", "doc_id").limit(max_unlabelled).select("doc_id", unl))
              .groupBy("doc_id").agg(F.max("part").alias("positive"), F.min("part").alias("only")))
    sample = (docs.select("doc_id", F.col(text_col).alias("text"))
              .join(F.broadcast(chosen), "doc_id")  # at most max_positive + max_unlabelled ids
              .groupBy("doc_id", "positive", "only").agg(F.max("text").alias("text")))
    sample = within_bytes(sample, POSITIVE_BYTES, UNLABELLED_BYTES).orderBy("doc_id").collect()
    positive = _collapse([plain(r.text) for r in sample if r.positive])
    unlabelled = _collapse([plain(r.text) for r in sample if r.unlabelled])
    del sample
    ngrams, prior = select_ngrams(positive, unlabelled, prior)
    if not ngrams:
        return Model([], np.zeros(0), min(0.0, float(np.log(prior / (1 - prior)))))
    mark = Marker(ngrams)
    weights, intercept = fit_nnpu(mark(positive), mark(unlabelled), prior)
    return Model(ngrams, weights, intercept)


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns `keep` (all by default) of `docs` as struct `doc`, and the toxicity `score` (0 to 1)."""
    weights, intercept, ngrams = model.weights, model.intercept, model.ngrams

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = Marker(ngrams)
        for b in batches:
            scores = np.zeros(b.num_rows)
            for at in range(0, b.num_rows, 256):
                texts = [plain(t) for t in b.column(1).slice(at, 256).to_pylist()]
                scores[at:at + 256] = _sigmoid(mark(texts) @ weights + intercept)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores)], ["doc", "score"])

    rows = docs.select(whole_row(docs.select(*keep) if keep else docs).alias("doc"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(run, StructType([rows.schema["doc"], StructField("score", DoubleType())]))


def learn_rows(docs: DataFrame) -> DataFrame:
    """Rows the classifier may learn from: crc32(doc_id as text) mod 3 is not 1."""
    return docs.where(crc_bucket("doc_id", 3) != 1)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted; labels are learned outside the held-out third only."""
    model = fit(learn_rows(docs), labels)
    held_out = F.coalesce(crc_bucket("doc_id", 3) == 1, F.lit(False))
    return (score(docs, model, keep=["doc_id"]).select(F.col("doc.doc_id").alias("doc_id"), "score")
            .select("doc_id", held_out.alias("held_out"), "score",
                    (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted")))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents with a score below TOXIC_FROM, with their own columns."""
    model = fit(learn_rows(docs), labels)
    return score(docs, model).where(F.col("score") < TOXIC_FROM).select("doc.*")
