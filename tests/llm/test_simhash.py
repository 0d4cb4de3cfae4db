import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from molarflow.llm import simhash as S


def brute_fingerprint(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(S.LOWER))
    if not w:
        return 0
    shingles = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def brute_components(fps):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 2:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("text", ["", "  \n", "a", "A b", "a b c", "The quick Brown fox " * 9, "É x ÀB c d", "x " * 70000])
def test_fingerprint(text):
    assert S.fingerprint(text.encode()) == (brute_fingerprint(text) if len(text) < 9999 else S.fingerprint(b"x x x x"))


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 10 ** 9), st.integers(1, 200))
def test_bit_sliced_links_equal_brute_force(seed, n):
    r = random.Random(seed)
    base = [r.getrandbits(64) for _ in range(max(1, n // 4))]
    fps = sorted({b ^ sum(1 << k for k in r.sample(range(64), r.randint(0, 4))) for b in base for _ in range(4)})
    a, b = S.links_of_run(np.array(fps, np.uint64), chunk_words=1 << 5)
    at = {f: i for i, f in enumerate(fps)}
    label = list(range(len(fps)))
    for x, y in zip(a.tolist(), b.tolist()):
        label[at[x]] = at[y]
    assert label == brute_components(fps)


def near_copies():
    r = random.Random(5)
    texts = []
    for _ in range(12):
        w = [f"w{r.randrange(400)}" for _ in range(300)]
        texts.append(" ".join(w))
        for _ in range(4):
            w = list(w)
            w[r.randrange(300)] = "changed"
            texts.append(" ".join(w))
    return texts + texts[:7] + [None, "", " ", "one", "one"]


@pytest.mark.parametrize("hot", [4096, 2])
def test_components_equal_brute_force(docs_of, monkeypatch, hot):
    monkeypatch.setattr(S, "HOT", hot)
    texts = near_copies()
    fps = [brute_fingerprint(t) for t in texts]
    expected = brute_components(fps)
    got = S.near_duplicates(docs_of(texts)).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.fp % 2 ** 64 == fps[r.doc_id] and r.component_id == expected[r.doc_id]
    kept = S.keep_one(docs_of(texts))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(expected)) and kept.columns == docs_of([]).columns


def test_repeated_rows_null_ids_and_empty_table(docs_of):
    d = docs_of([(3, "a b c d"), (3, "a b c d"), (None, "a b c d"), (1, "x y z q")])
    assert sorted((r.doc_id is None, r.component_id) for r in S.near_duplicates(d).collect()) == [
        (False, 1), (False, 3), (False, 3), (True, 3)]
    assert S.keep_one(d).count() == 2
    assert S.keep_one(docs_of([])).count() == 0


def test_large_group_of_near_copies_gives_stars_not_pairs():
    rng = np.random.default_rng(0)
    base = np.uint64(rng.integers(0, 2 ** 63))
    fps = np.unique(base ^ (np.uint64(1) << rng.integers(0, 64, 3000).astype(np.uint64)))
    a, _ = S.links_of_run(fps)
    assert len(a) == len(fps) - 1
