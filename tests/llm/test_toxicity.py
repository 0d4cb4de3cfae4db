import random
import zlib

import numpy as np

from molarflow.llm import toxicity as X


def corpus(n, seed=0):
    r = random.Random(seed)
    vocab = ["".join(r.choice("aeioulmnrst") for _ in range(r.randint(2, 7))) for _ in range(900)]
    rows = []
    for i in range(n):
        words = [r.choice(vocab) for _ in range(r.randint(20, 120))]
        toxic = r.random() < 0.15
        if toxic:
            for _ in range(r.randint(2, 6)):
                words.insert(r.randrange(len(words)), r.choice(["vilewort", "gruxling", "brakzod"]))
        rows.append((i, " ".join(words), int(toxic), r.random() < 0.4))
    return rows


def frames(spark, rows):
    docs = spark.createDataFrame([(i, t, "e") for i, t, _, _ in rows], "doc_id bigint, text string, score string")
    labels = spark.createDataFrame([(i, 1, x) for i, _, x, known in rows if known], "doc_id bigint, quality int, toxic int")
    return docs, labels


def test_held_out_documents(spark):
    rows = corpus(1500)
    docs, labels = frames(spark, rows)
    out = X.score_documents(docs, labels).collect()
    assert len(out) == len(rows)
    held = [r for r in out if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    truth = {i: x for i, _, x, _ in rows}
    caught = [r.predicted for r in held if truth[r.doc_id]]
    wrong = [r.predicted for r in held if not truth[r.doc_id]]
    assert sum(caught) >= 0.95 * len(caught) and sum(wrong) <= 0.01 * len(wrong)
    kept = X.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == len(rows) - sum(r.predicted for r in out)


def test_edge_cases(spark, docs_of):
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 1), (2, 1, 0)], "doc_id bigint, quality int, toxic int")
    d = docs_of([(1, None), (1, None), (2, ""), (None, "x"), (4, "a " * 60000)])
    out = X.score_documents(d, labels).collect()
    assert len(out) == 5 and all(0 <= r.score <= 1 for r in out)
    assert X.score_documents(docs_of([]), labels.where("false")).count() == 0
    same = {r.score for r in X.score_documents(d, labels.where("false")).collect()}
    assert len(same) == 1  # nothing to learn from: the prior


def test_risk_gradient_by_differences():
    """One step from the start moves against the gradient of the PU risk."""
    r = np.random.default_rng(0)
    xp, xu = (r.random((n, 3)) < 0.4 for n in (30, 80))
    xp, xu = xp.astype(np.float32), xu.astype(np.float32)
    prior = 0.2
    w0 = np.array([0, 0, 0, np.log(prior / (1 - prior))])

    def risk(w):
        p, u = (X._sigmoid(x @ w[:-1] + w[-1]) for x in (xp, xu))
        return prior * -np.log(p).mean() + max(0, -np.log(1 - u).mean() + prior * np.log(1 - p).mean())

    w, b = X.fit_nnpu(xp, xu, prior)
    assert risk(np.append(w, b)) < risk(w0)


def test_gradient_equals_finite_differences():
    """On both branches of the non-negative risk: the risk itself, and the way back where negatives' risk is below zero."""
    r = np.random.default_rng(3)
    xp, xu = ((r.random((n, 4)) < 0.4).astype(np.float64) for n in (40, 90))
    xp[:, 0], xu[:, 0] = 1, xu[:, 0] * (r.random(90) < 0.1)
    prior, seen = 0.4, set()
    for scale in (0.1, 1.0, 3.0, -4.0):
        for apart in (0, 6):
            w = r.normal(size=5) * abs(scale) / 4
            w[0], w[-1] = w[0] + apart, -scale

            def parts(w):
                p, u = (1 / (1 + np.exp(-(x @ w[:-1] + w[-1]))) for x in (xp, xu))
                return prior * -np.log(p).mean(), -np.log(1 - u).mean() + prior * np.log(1 - p).mean()

            def objective(w):
                on_positives, on_negatives = parts(w)
                return on_positives + on_negatives if branch else -on_negatives

            g, branch = X.risk_gradient(w, xp, xu, prior)
            assert branch == (parts(w)[1] >= 0)
            seen.add(branch)
            for i in range(5):
                e = np.zeros(5)
                e[i] = 1e-5
                assert abs(g[i] - (objective(w + e) - objective(w - e)) / 2e-5) < 1e-4
    assert seen == {True, False}


def test_marks_and_scores_equal_a_plain_count(spark):
    rows = corpus(400, 5)
    docs, labels = frames(spark, rows)
    model = X.fit(X.learn_rows(docs), labels)
    assert model.ngrams and len(set(model.ngrams)) == len(model.ngrams)
    got = {r.doc.doc_id: r.score for r in X.score(docs, model).collect()}
    for i, text, _, _ in rows:
        z = model.intercept + sum(w for g, w in zip(model.ngrams, model.weights) if g in X.plain(text))
        assert abs(got[i] - 1 / (1 + np.exp(-np.clip(z, -30, 30)))) < 1e-5
    positive = [X.plain(t) for _, t, x, _ in rows if x]
    for g in model.ngrams[:20]:
        assert any(g in t for t in positive)


def held_out_rates(spark, rows):
    """(share of toxic rows caught, of clean rows caught) outside the learning rows."""
    truth = {i: x for i, _, x, _ in rows}
    held = [r for r in X.score_documents(*frames(spark, rows)).collect() if r.held_out]
    return tuple(np.mean([r.predicted for r in held if truth[r.doc_id] == k]) for k in (1, 0))


def test_labels_of_any_kind(spark):
    """Everything labelled, positives only, mostly toxic text, and few positives."""
    rows = corpus(900, 2)
    clean = [r for r in rows if not r[2]]
    cases = {"all labelled": [(i, t, x, True) for i, t, x, _ in rows],
             "positives only": [(i, t, x, x and known) for i, t, x, known in rows],
             "mostly toxic": [r for r in corpus(2500, 3) if r[2] or r[0] % 8 == 0],
             "few positives": clean + [(10 ** 6 + i, f"{t} vilewort", 1, True) for i, t, _, _ in clean[:12]]}
    for name, case in cases.items():
        caught, wrong = held_out_rates(spark, case)
        assert caught >= 0.9 and wrong <= 0.02, (name, caught, wrong)


def test_sample_ends_at_its_bytes(spark):
    """Forty texts of 300 kB do not reach the driver whole."""
    rows = [(i, int(i % 4 == 0), int(i % 2 == 0 and i % 8 > 0), "w " * 150_000) for i in range(40)]
    d = spark.createDataFrame(rows, "doc_id bigint, positive int, only int, text string")
    out = X.within_bytes(d, 300_000, 500_000).collect()
    assert all(len(r.text) == X.TEXT_CHARS for r in out)
    assert sum(r.positive for r in out) == 2 and sum(r.unlabelled for r in out) == 3
