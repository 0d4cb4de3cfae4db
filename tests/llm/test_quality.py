import collections
import re

from molarflow.llm import quality as Q

NON_SPACE = r"[^\x20\x09-\x0D]"


def brute(text):
    t = text or ""
    w = re.findall(NON_SPACE + "+", t)
    windows = list(zip(w, w[1:], w[2:]))
    n = collections.Counter(windows)
    covered = {p for i, x in enumerate(windows) if n[x] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if re.search(NON_SPACE, x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines), len(lines) - len(set(lines)), len(covered))


TEXTS = [None, "", "  \n\t ", "a", "a b", "a b c", "a b c a b c a", "x x x x x", "l1\nl1\n\nl1\nl2", "# * $ % & | < >",
         "é ü z", "w " * 3000, "\x0b\x0c\r a"]


def test_metrics_equal_brute_force(docs_of):
    got = Q.with_metrics(docs_of(TEXTS), out="m").select("doc_id", "text", "m").collect()
    assert len(got) == len(TEXTS)
    for r in got:
        assert tuple(r.m) == brute(r.text), r.text


def test_adaptive_thresholds_reject_outliers_only(spark, docs_of):
    good = [f"doc {i} " + " ".join(f"word{(i * 7 + j) % 997}x" for j in range(80)) for i in range(300)]
    bad = [t.replace("x", "#*") for t in good[:20]]
    out = {r.doc_id: r for r in Q.score_documents(docs_of(good + bad)).collect()}
    assert all(out[i].kept for i in range(300)) and not any(out[300 + i].kept for i in range(20))
    kept = Q.keep_good(docs_of(good + bad))
    assert kept.columns == docs_of([]).columns and kept.count() == 300


def test_null_groups_repeats_and_empty_table(spark, docs_of):
    d = docs_of([(1, None), (1, None), (None, "a b"), (2, "a b")], lang=None, source=None)
    out = Q.score_documents(d).collect()
    assert len(out) == 4 and not any(r.kept for r in out) and all(r.base_failed for r in out)
    assert Q.score_documents(docs_of([])).count() == 0
    assert Q.keep_good(docs_of([])).count() == 0


def test_sketches_merge(spark, docs_of):
    texts = [" ".join(f"w{'y' * (i % 9)}{j}" for j in range(60)) for i in range(90)]
    m = Q.with_metrics(docs_of(texts))
    whole = Q.quantiles(Q.merge(Q.sketch(m), "lang"), "lang").orderBy("metric").collect()
    halves = Q.sketch(m.where("doc_id < 40")).union(Q.sketch(m.where("doc_id >= 40")))
    assert Q.quantiles(Q.merge(halves, "lang"), "lang").orderBy("metric").collect() == whole


def test_no_python_in_the_plan(docs_of):
    plan = Q.with_metrics(docs_of(["a"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
