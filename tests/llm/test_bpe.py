import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from molarflow.llm import bpe as B

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
REFERENCE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
TEXTS = ["", None, "  a  b \n\n c\t d ", "it's  I'll x 123 ,,, \x1c z", "a" * 5000 + " " * 50, "日本語 テスト é é ", " ",
         "x\n", "\n\nA \n", "same same same", "　wide space", "a b   c"]


@pytest.fixture(scope="module")
def vocabulary():
    return B.Vocabulary.load(PATH, public_tokenizers.PATTERN)


def check(docs, vocabulary):
    encoded = B.encode(docs, vocabulary)
    key = lambda r: -1 if r.doc_id is None else r.doc_id
    expected = sorted((key(r), REFERENCE.encode_ordinary(r.text or ""), (r.text or "").encode()) for r in docs.collect())
    assert sorted((key(r), r.ids, bytes(r.decoded)) for r in B.decode(encoded, vocabulary).collect()) == expected


def test_round_trip_equals_the_library(docs_of, vocabulary):
    check(docs_of(TEXTS), vocabulary)


def test_several_blocks_repeats_and_null_ids(docs_of, vocabulary, monkeypatch):
    monkeypatch.setattr(B, "BLOCK_BYTES", 40)
    check(docs_of([(i % 5 if i % 7 else None, t) for i, t in enumerate(TEXTS * 3)]), vocabulary)


def test_digests_and_empty_table(docs_of, vocabulary):
    d = B.digests(B.decode(B.encode(docs_of(["Hello there"]), vocabulary), vocabulary)).first()
    ids = REFERENCE.encode_ordinary("Hello there")
    assert (d.n_tokens, d.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
    assert d.decoded_sha256 == hashlib.sha256(b"Hello there").hexdigest()
    assert B.encode(docs_of([]), vocabulary).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2 ** 31), max_size=60))
def test_varints(values):
    assert B.from_varints(B.varints(np.array(values, np.int64))).tolist() == values


@given(st.lists(st.binary(max_size=9), max_size=40))
def test_packed_words(words):
    assert B.unpack_words(B.pack_words(words)) == words


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab'S1é \n\t,　\x1c", max_size=14), min_size=1, max_size=4))
def test_pre_tokens_equal_the_pattern(texts):
    import pyarrow as pa
    import regex
    words, codes, at = B.pre_tokenize(pa.array(texts, pa.large_string()), public_tokenizers.PATTERN)
    got = [[words[c] for c in codes[s:e]] for s, e in zip(at[:-1], at[1:])]
    assert got == [regex.findall(public_tokenizers.PATTERN, t) for t in texts]
