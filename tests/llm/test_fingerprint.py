import hashlib
import random
import re

from pyspark.sql import functions as F

from molarflow.llm import fingerprint as K


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def check(rows, pairs, tolerance):
    order = sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0))
    got = {r.doc_id: r for r in rows}
    for i, (k, t) in enumerate(order):
        t, following = t or "", order[(i + 1) % len(order)][1] or ""
        q = len(t) // 4
        edited = t[:len(t) - q] + following[:q]
        r = got[k]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r.near_edited - jaccard(shingles(t), shingles(edited))) <= tolerance
        assert abs(r.near_next - jaccard(shingles(t), shingles(following))) <= tolerance


def test_against_exact_likeness(docs_of):
    r = random.Random(4)
    pairs = [(i * 3, " ".join(f"é{r.randrange(500)}" for _ in range(r.choice([0, 1, 4, 5, 40, 600, 4000])))) for i in range(60)]
    pairs += [(None, "a b c d e f"), (1, None), (2, "  ")]
    check(K.compare_neighbours(docs_of(pairs).repartition(5)).collect(), pairs, 0.15)


def test_short_texts_are_exact(docs_of):
    pairs = [(i, " ".join(f"w{j % (i + 2)}" for j in range(i))) for i in range(40)]
    check(K.compare_neighbours(docs_of(pairs)).collect(), pairs, 1e-9)


def test_repeats_single_row_and_empty_table(docs_of):
    out = K.compare_neighbours(docs_of([(5, "same words in both of these rows")] * 3)).collect()
    assert len(out) == 3 and len({r.fingerprint for r in out}) == 1 and all(r.near_next == 1.0 for r in out)
    one = K.compare_neighbours(docs_of(["only one"])).first()
    assert one.near_next == 1.0 and one.fingerprint != ""
    assert K.compare_neighbours(docs_of([])).count() == 0


def test_merge_and_containment(spark):
    long = " ".join(f"w{i}" for i in range(20000))
    part = " ".join(f"w{i}" for i in range(3000, 3400))
    d = spark.createDataFrame([(long, part, "zz " * 9)], "a string, b string, c string")
    for c in "abc":
        d = K.with_sketch(d, F.col(c), f"s{c}")
    d = K.with_sketch(d.withColumn("abtext", F.concat_ws(" ", "a", "b")), F.col("abtext"), "sab")
    r = d.select(K.containment(F.col("sb"), F.col("sa")).alias("inside"), K.containment(F.col("sa"), F.col("sb")).alias("outside"),
                 K.containment(F.col("sc"), F.col("sa")).alias("none"), F.size("sa.hashes").alias("n"),
                 K.containment(K.merge(F.col("sa"), F.col("sb")), F.col("sab")).alias("merged")).first()
    assert r.inside == 1.0 and r.outside < 0.1 and r.none == 0.0 and r.merged > 0.99
    assert abs(r.n / 20000 - K.FRACTION) < 0.02
