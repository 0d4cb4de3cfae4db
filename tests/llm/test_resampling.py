import math
import random
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from molarflow.llm import resampling as R

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def grams(w, lo, hi):
    return [" ".join(w[i:i + n]) for n in range(lo, hi + 1) for i in range(len(w) - n + 1)]


def brute(rows, target, percent=10, min_words=20, buckets=10000, orders=(1, 1)):
    """Ranked and unranked rows, as a sorted list of tuples; rows in table order."""
    def bag(text):
        return [crc32(g.encode()) % buckets for g in grams(words(text), *orders)]

    s, t = Counter(), Counter()
    for _, x in rows:
        s.update(bag(x))
    for x in target:
        t.update(bag(x))
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    out = []
    for at, (i, x) in enumerate(rows):
        b = bag(x)
        h = int(sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[k] for k in b)
        out.append((i, len(b), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), at, len(words(x))))
    able = [r for r in out if r[5] >= min_words]
    order = sorted(able, key=lambda r: (-r[3], 1 << 63 if r[0] is None else r[0], r[4]))[:len(able) * percent // 100]
    rank = {r[4]: n for n, r in enumerate(order, 1)}
    return sorted(((*r[:4], rank.get(r[4])) for r in out), key=repr)


def corpus(n, seed):
    r = random.Random(seed)
    parts = ["the", "The", "a", "data", "é", "ÉTÉ", "日本語", "x9", "9", "don't", "A-B", "model", "zeta", "\x7f", "\u0080", "[", "{"]
    out = [(None, None), (1, ""), (2, "one"), (None, "word " * 30), (2, "word " * 30), (3, "w " * 19), (3, "w " * 20)]
    return out + [(i, " ".join(r.choices(parts, k=r.randint(0, 60)))) for i in range(10, n)]


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture()
def aim(spark):
    texts = ["the model data", None, "", "été zeta " * 20]
    return spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "item_id int, text string"), texts


@pytest.mark.parametrize("options", [{}, {"percent": 100}, {"percent": 0}, {"percent": 37, "min_words": 0, "orders": (1, 3), "buckets": 97}])
def test_every_document_against_brute_force(spark, docs_of, aim, options):
    rows = corpus(300, 1)
    out = R.resample(docs_of(rows).repartition(1), aim[0], **options)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert got(out) == brute(rows, aim[1], **options)


def test_ties_on_score_and_doc_id(spark, docs_of, aim):
    rows = [(7, "tie " * 25)] * 40 + [(8, "tie " * 25)] * 40 + [(9, "other " * 25)] * 20
    for percent in (1, 20, 40, 55, 99):
        out = R.resample(docs_of(rows), aim[0], percent=percent)
        assert got(out) == brute(rows, aim[1], percent=percent)


def test_bisection_finds_every_cut(spark):
    values = [(int(v),) for v in [-5, -5, 0, 3, 3, 3, 3, 8, -(1 << 62), 1 << 62]]
    df = spark.createDataFrame(values, "a bigint").withColumn("row", F.monotonically_increasing_id()).repartition(3).checkpoint()
    order = [tuple(r) for r in sorted(df.collect(), key=lambda r: (r.a, r.row))]
    for k in range(len(values) + 1):
        cut = R.first_rows(df, [F.col("a"), F.col("row")], k)
        assert sorted(tuple(r) for r in df.where(cut).collect()) == sorted(order[:k])


def test_drawn_rows_keep_their_columns(spark, docs_of, aim):
    docs = docs_of(corpus(200, 2)).withColumnRenamed("score", "rank")
    out = R.drawn(docs, aim[0])
    assert out.columns == [*docs.columns, "rank_"]
    ranks = {r.rank: r.doc_id for r in R.resample(docs, aim[0]).collect() if r.rank}
    assert {r.rank_: r.doc_id for r in out.collect()} == ranks and sorted(ranks) == list(range(1, len(ranks) + 1))


def test_very_long_text_and_empty_tables(spark, docs_of, aim):
    rows = [(i, "word é " * (400_000 if i == 3 else 30)) for i in range(12)]
    assert got(R.resample(docs_of(rows), aim[0])) == brute(rows, aim[1])
    assert got(R.resample(docs_of(rows), aim[0].where("false"))) == brute(rows, [])
    assert R.resample(docs_of(rows).where("false"), aim[0]).collect() == []
