import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from molarflow.llm import packing as K

PATH = public_tokenizers.path("word_bpe_49k.json")


def brute_ids(text):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids + [2]


def check(rows, texts):
    ids = {k: brute_ids(t) for k, t in texts.items()}
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        doc = ids[r.doc_id]
        assert r.doc_tokens == len(doc)
        assert r.ids_crc32 == zlib.crc32(np.array(doc[r.start:r.start + r.length], "<u4").tobytes())
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for k, doc in ids.items():
        at = 0
        for start, length in sorted(pieces[k]):
            assert start == at
            at += length
        assert at == len(doc)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 4096
    return sequences


TEXTS = ["The quick brown fox's 12 jumps", None, "", " ", "Été naïve ﬁn 日本語 'll\tx\r\ny", "a" * 3000, "it's  " * 40,
         "é combining ​ zero", "word " * 9000, "<|endoftext|> plain",
         "É.\u0301 a=\u0338 b<= c!! d's. 't. İ. ﬁ. 漢字。x. end.\n.start A,B ,c. e\u0301. 9. x9. don't, it'll. --"]


def test_pieces_and_sequences(docs_of):
    rows = K.pack_documents(docs_of(TEXTS), PATH).collect()
    sequences = check(rows, dict(enumerate(TEXTS)))
    assert len(sequences) == 3  # 9001 ids take two full sequences; all the rest fits one


def test_many_documents_pad_little(docs_of):
    r = random.Random(0)
    texts = ["tok " * int(r.expovariate(1 / 900)) for _ in range(400)]
    rows = K.pack_documents(docs_of(texts), PATH).collect()
    sequences = check(rows, dict(enumerate(texts)))
    total = sum(x.length for x in rows)
    assert len(sequences) == -(-total // 4096)


def test_repeated_rows_and_empty_table(docs_of):
    rows = K.pack_documents(docs_of([(7, "same text")] * 50 + [(None, "x")]), PATH).collect()
    assert len(rows) == 51 and len({(r.sequence_id, r.offset) for r in rows}) == 51
    assert K.pack_documents(docs_of([]), PATH).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 6), min_size=1, max_size=8), st.integers(40, 64))
def test_fullest_is_the_best_subset_sum(counts, capacity):
    sums = {0}
    for length, n in counts.items():
        sums = {s + k * length for s in sums for k in range(n + 1) if s + k * length <= capacity}
    chosen = K.fullest(counts, capacity)
    assert sum(k * n for k, n in chosen.items()) == max(sums)
    assert all(0 < n <= counts[k] for k, n in chosen.items())


def test_plan_uses_every_piece_once():
    r = random.Random(2)
    histogram = {k: r.randint(1, 30) for k in r.sample(range(1, 100), 40)}
    p = K.plan(histogram, 100)
    ranks = collections.Counter()
    for i in range(len(p.length)):
        until = [p.rank[j] for j in range(len(p.length)) if p.length[j] == p.length[i] and p.rank[j] > p.rank[i]]
        stop = min(until, default=histogram[p.length[i]])
        assert (stop - p.rank[i]) % p.per[i] == 0
        ranks[int(p.length[i])] += stop - p.rank[i]
    assert ranks == histogram


@pytest.mark.parametrize("text", TEXTS)
def test_tokenizer_by_words(text):
    import pyarrow as pa
    ids, bounds = K.WordTokenizer(PATH).encode(pa.array([text, "x", text], pa.string()))
    for i in (0, 2):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == brute_ids(text)[:-1]
