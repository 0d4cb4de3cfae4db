import random

import pyarrow as pa

from molarflow.llm import langid as L


def corpus(alphabets, n, seed):
    r = random.Random(seed)
    return {k: [" ".join("".join(r.choice(a) for _ in range(r.randint(1, 6))) for _ in range(60)) for _ in range(n)]
            for k, a in alphabets.items()}


ALPHABETS = {"x": "abc", "y": "bcdé"}


def greedy_phrases(train, text):
    n = i = 0
    while i < len(text):
        j = i + 1
        while j <= len(text) and text[i:j] in train:
            j += 1
        i += max(1, j - 1 - i)
        n += 1
    return n


def test_phrase_counts_equal_brute_force():
    samples = corpus(ALPHABETS, 6, 3)
    model = L.train(samples, 4000)
    data = {}
    for k in model.languages:
        left, out = 2000, b""
        for t in L.clean(pa.array(samples[k])).to_pylist():
            raw = t.encode() + b" "
            if 1 < len(raw) <= min(left, 500):
                out, left = out + raw, left - len(raw)
        data[k] = out
    r = random.Random(9)
    texts = [" ".join("".join(r.choice("abcdéz") for _ in range(r.randint(1, 6))) for _ in range(r.randint(0, 150)))
             for _ in range(80)] + [None, "123", "É"]
    cleaned = L.clean(pa.array(texts))
    counts, sizes = L.phrases(model, cleaned)
    for i, t in enumerate(cleaned.to_pylist()):
        raw = t.encode()
        parts = [raw[s:s + L.SEGMENT] for s in range(0, len(raw), L.SEGMENT)]
        assert sizes[i] == len(raw)
        assert counts[i].tolist() == [sum(greedy_phrases(data[k], p) for p in parts) for k in model.languages]


def test_held_out_accuracy(spark):
    rows = []
    for k, texts in corpus({"x": "abcde", "y": "abfgé", "z": "klmno"}, 80, 1).items():
        rows += [(k, t) for t in texts]
    d = spark.createDataFrame([(i, t, k) for i, (k, t) in enumerate(rows)], "doc_id bigint, text string, lang string")
    out = L.label_documents(d).collect()
    held = [r for r in out if r.held_out]
    assert len(out) == 240 and 20 < len(held) < 80
    assert sum(rows[r.doc_id][0] == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in out)


def test_undetermined_nulls_repeats_and_empty_table(spark, docs_of):
    d = docs_of([(1, None), (2, ""), (3, "123 ,."), (4, "abc abc"), (4, "abc abc"), (None, "abc")], lang="q")
    out = sorted((r.doc_id or 0, r.lang_pred, r.score) for r in L.label_documents(d).collect())
    assert [x[1] for x in out] == ["q", "und", "und", "und", "q", "q"] and out[4] == out[5]
    none = L.label_documents(docs_of(["abc"], lang=None)).collect()
    assert [(r.lang_pred, r.score) for r in none] == [("und", 0.0)]
    assert L.label_documents(docs_of([])).count() == 0


def test_every_language_with_a_text_is_learned(spark):
    """Long texts only, one of them over TRAIN_BYTES, and many languages: none is lost."""
    r = random.Random(4)
    text = lambda a, n: " ".join("".join(r.choice(a) for _ in range(4)) for _ in range(n))
    samples = {"x": ["abcd " * 50], "long": [text("klmn", 9000)], "huge": ["1 " * 90000 + text("pqrs", 40000)]}
    model = L.train({k: v for k, v in samples.items() if k != "huge"}, 4000)
    assert model.languages == ["long", "x"]
    many = {f"l{i:03}": [text("abcdefgh", 400)] for i in range(200)}
    assert L.train(many, 20000).languages == sorted(many)
    rows = [(i, v[0], k) for i, (k, v) in enumerate(samples.items())] + [(9, "123", "digits"), (10, None, "none")]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = L.learn(d)
    assert model.languages == ["huge", "long", "x"]
    assert L.predict(model, pa.array(["pqrs srqp qqrr", "klmn nmlk mmkk"]))[0] == ["huge", "long"]
