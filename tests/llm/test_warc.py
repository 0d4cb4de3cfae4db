import gzip
import hashlib
import os

import pytest

from molarflow.llm import warc as A

BIG = "payload é " * 300
PAGES = [(1, "http://a/", BIG), (2, "http://b/", BIG), (3, None, BIG), (4, "http://c/", "small"), (5, "http://d/", "small"),
         (6, "http://e/\r\nX: y", None), (7, "http://f/", ""), (8, "u", BIG + "x" * 70000), (None, "n", "y" * 2000), (2, "again", "z" * 1000),
         (2, "again", "z" * 1000)]
DDL = "page_id bigint, url string, html string, digest string, file string"


@pytest.fixture()
def pages(spark):
    return spark.createDataFrame([(*p, "x", "y") for p in PAGES], DDL).repartition(3)


def test_round_trip(spark, pages):
    out = A.round_trip(spark, pages).collect()
    assert len(out) == len(PAGES)
    expected = sorted(((p or -1), len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest()) for p, _, h in PAGES)
    assert sorted(((r.page_id or -1), r.payload_bytes, r.payload_digest) for r in out) == expected
    kinds = {r.page_id: (r.record_type, r.refers_to) for r in out if r.page_id in (1, 3, 4, 5, 6, 7, 8, None)}
    assert kinds == {1: ("revisit", 3), 3: ("response", None), 4: ("response", None), 5: ("response", None), 6: ("response", None),
                     7: ("response", None), 8: ("response", None), None: ("response", None)}
    twos = sorted((r.record_type, r.refers_to) for r in out if r.page_id == 2 and r.payload_bytes == 1000)
    assert twos == [("response", None), ("revisit", 2)] or twos == [("response", None), ("revisit", 2)][::-1]
    assert A.round_trip(spark, pages.where("false")).count() == 0


def test_archive_is_valid_and_selected_records_are_read(spark, pages, tmp_dir):
    folder = f"file://{tmp_dir}/warc"
    index = A.write(pages, folder)
    for name in {r.file for r in index.collect()}:
        data = open(os.path.join(tmp_dir, "warc", name), "rb").read()
        spans = sorted((r.offset, r.length) for r in index.where(index.file == name).collect())
        assert sum(n for _, n in spans) == len(data) and spans[0][0] == 0
        assert gzip.decompress(data).count(b"WARC/1.1\r\n") == len(spans)
    some = A.read(index.where("record_type = 'response' AND page_id IN ('3', '8')"), folder)
    assert {r.page_id: bytes(r.payload).decode() for r in some.collect()} == {"3": BIG, "8": BIG + "x" * 70000}


def test_damage_is_noticed():
    raw = A.record("1", 0, "u", b"payload", None, "d")
    assert A.parse(raw)[-1] == b"payload"
    with pytest.raises(ValueError):
        A.parse(raw.replace(b"\r\n\r\npayload", b"\r\n\r\npaYload"))
