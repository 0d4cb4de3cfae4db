import random
import re
from hashlib import sha256

import numpy as np
import pytest

from molarflow.llm import fim

UNIT = re.compile("[A-Za-z]+|[^A-Za-z]", re.S)


def brute(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    d = sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[i:i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


CASES = [None, "", " ", "a", "é", "ab", "A1b", "\x00", "\x00a\x00", "日本語 text", "🙂🙂a🙂", "<P>", "a<S>b", "<M", "<P<S", "<", "zZ[`{@", "x" * 9,
         "\n\r\n", "áb", "\x7f\x80߿ࠀ￿\U00010000\U0010ffff", "ab cd\nef  gh."]


def texts(n, seed):
    r = random.Random(seed)
    parts = ["a", "Z", "the", " ", "\n", "é", "日", "🙂", "1", "@", "[", "`", "{", "<", "P>", "S>", "\x7f", "\u0080", "\x00"]
    return ["".join(r.choices(parts, k=r.randint(0, 40))) for _ in range(n)]


def test_every_border_of_a_text():
    for text in [c for c in CASES if c] + texts(300, 1):
        data = text.encode()
        if not data:
            continue
        b = fim.unit_borders(np.frombuffer(data, np.uint8), np.array([0]), np.array([len(data)]))
        units = [u.encode() for u in UNIT.findall(text)]
        assert b.rank(np.array([len(data)]))[0] == len(units)
        assert b.select(np.arange(1, len(units) + 1)).tolist() == np.cumsum([len(u) for u in units]).tolist()


@pytest.mark.parametrize("size", [1, 50, 1 << 22])
def test_every_document_against_brute_force(spark, docs_of, monkeypatch, size):
    monkeypatch.setattr(fim, "SLICE_BYTES", size)
    rows = list(enumerate(CASES + texts(500, 2), -5)) + [(None, "null id, here"), (3, "repeated"), (3, "repeated")]
    got = fim.restored(fim.fill_in_middle(docs_of(rows))).collect()
    want = [(i, *brute(i, t), t or "") for i, t in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_very_long_text_empty_table_and_plan(spark, docs_of):
    r = random.Random(3)
    long = " ".join(r.choices(["word", "é", "日本", "x9", "\n"], k=700_000))
    rows = [(i, t) for i, t in enumerate([long, "short", long[1:]])]
    out = fim.fill_in_middle(docs_of(rows))
    got = {x.doc_id: x for x in fim.digests(out).collect()}
    for i, t in rows:
        n, form, p, m, o = brute(i, t)
        x = got[i]
        assert (x.n, x.form, x.prefix_chars, x.middle_chars) == (n, form, p, m)
        assert (x.output_sha256, x.restored_sha256) == (sha256(o.encode()).hexdigest(), sha256(t.encode()).hexdigest())
    assert fim.fill_in_middle(docs_of(rows).where("false")).count() == 0
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
