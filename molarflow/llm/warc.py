"""WARC archives with an index, read back by coalesced byte ranges.

Writing: every task writes its rows as WARC/1.1 records, one gzip member per record, into
files of its own in the shared folder, and returns an index row for each (file, offset,
length, URL, digest, type). A file name holds a random part, so a retried task writes new
files and the index only names those of the attempt that counted; the index is stored
before anything is read. Of equal payloads of at least MIN_REVISIT bytes the record with the
largest page id (then row) is the response and the others refer to it; which one that is
comes from an aggregation over digests, joined back, so a payload that fills a third of the
table is pre-aggregated and then a skewed join that AQE splits.

Reading: the selected index rows are range-partitioned and sorted by (file, offset); each
task merges neighbouring records into one read, as long as the gap is at most GAP and the
read at most READ bytes, and checks each payload against its digest.

Edge cases: null html is an empty payload; payloads under MIN_REVISIT bytes are always
responses; a very long payload is a record and a read by
itself; repeated rows: one is the response, the others refer to its page id; a null
page id or URL leaves its header out and reads back as null; line breaks in a URL are
written percent-encoded; an empty table gives an empty index and result; other columns are
not archived.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from molarflow.llm.common import scratch_path, stable_rows, stored

MIN_REVISIT = 1000
GAP = 64 << 10
READ = 8 << 20
FILE_BYTES = 1 << 30
#: Archive bytes that one reading task is given, about.
PART_BYTES = 32 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "file string, offset bigint, length bigint, url string, digest string, record_type string, page_id string"
RECORD = ("page_id string, url string, record_type string, refers_to string, payload_bytes bigint, payload_digest string, "
          "payload binary")


def record(page_id: str | None, row: int, url: str | None, payload: bytes, refers_to: str | None, date: str) -> bytes:
    """One WARC record, uncompressed. refers_to: `page:row` of the response that holds the payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    kind = "response" if refers_to is None else "revisit"
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page_id or ''}:{row}>", f"WARC-Date: {date}",
            f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple:
    """(page_id, url, record_type, refers_to, payload_bytes, payload_digest hex, payload) of one record, checked."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    declared = int(http.rpartition(b"Content-Length: ")[2].split(b"\r\n")[0])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:"))
    page = lambda name: fields[name][10:-1].rpartition(":")[0] or None
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (hashlib.sha1(payload).digest() != digest or len(payload) != declared):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    return (page("WARC-Record-ID"), fields.get("WARC-Target-URI"), fields["WARC-Type"],
            page("WARC-Refers-To") if revisit else None, declared, digest.hex(), None if revisit else payload)


def write(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Archive `pages` (page_id, url, html) in `folder`; returns the stored index."""
    pages = stable_rows(pages, "pages")
    rows = pages.select(F.col("page_id").cast("string").alias("page_id"), F.col("page_id").alias("order"),
                        F.col("url").cast("string").alias("url"), F.monotonically_increasing_id().alias("row"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("key", F.when(F.octet_length("payload") >= MIN_REVISIT, F.sha1("payload")))
    groups = (rows.where("key IS NOT NULL").groupBy("key")
              .agg(F.count("*").alias("n"), F.max(F.struct("order", "row")).alias("last")).where("n > 1")
              .select("key", F.col("last.row").alias("kept"),
                      F.concat(F.coalesce(F.col("last.order").cast("string"), F.lit("")), F.lit(":"), F.col("last.row")).alias("at")))
    marked = rows.join(groups, "key", "left").select(
        "page_id", "row", "url", "payload", F.when(F.col("row") != F.col("kept"), F.col("at")).alias("refers_to"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(folder)
        out, name, at, index = None, "", 0, []

        def flush() -> pa.RecordBatch:
            columns = zip(*index)
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                              ["file", "offset", "length", "url", "digest", "record_type", "page_id"])

        for b in batches:
            page, row, url, refers = (b.column(i).to_pylist() for i in (0, 1, 2, 4))
            for i in range(b.num_rows):
                if out is None or at >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    store.create_dir(base, recursive=True)
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                payload = b.column(3)[i].as_py()
                data = gzip.compress(record(page[i], row[i], url[i], payload, refers[i], date), compresslevel=1, mtime=0)
                out.write(data)
                index.append((name, at, len(data), url[i], hashlib.sha1(payload).hexdigest(),
                              "response" if refers[i] is None else "revisit", page[i]))
                at += len(data)
            if len(index) >= 10000:
                yield flush()
                index = []
        if out is not None:
            out.close()
        if index:
            yield flush()

    return stored(marked.mapInArrow(run, INDEX), "warc-index")


def read(selected: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of `selected` index rows (file, offset, length): page_id, url, record_type,
    refers_to, payload_bytes, payload_digest, and payload (null for revisits) if asked for."""
    total = selected.agg(F.sum("length")).first()[0] or 0
    ordered = (selected.select("file", "offset", "length").repartitionByRange(max(1, -(-total // PART_BYTES)), "file", "offset")
               .sortWithinPartitions("file", "offset"))

    def ranges(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
        now, spans = "", []
        for b in batches:
            for file, offset, length in zip(*(c.to_pylist() for c in b.columns)):
                if spans and (file != now or offset - sum(spans[-1]) > GAP or offset + length - spans[0][0] > READ):
                    yield now, spans
                    spans = []
                now = file
                spans.append((offset, length))
        if spans:
            yield now, spans

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(folder)
        kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
        names = [x.split()[0] for x in RECORD.split(", ")]
        opened, source = None, None
        for file, spans in ranges(batches):
            if file != opened:
                if source is not None:
                    source.close()
                opened, source = file, store.open_input_file(f"{base}/{file}")
            start = spans[0][0]
            source.seek(start)
            data = memoryview(source.read(sum(spans[-1]) - start))
            found = [parse(zlib.decompress(data[o - start:o - start + n], wbits=31)) for o, n in spans]
            columns = list(zip(*found))
            if not with_payload:
                columns[6] = [None] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
        if source is not None:
            source.close()

    return ordered.mapInArrow(run, RECORD)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Archive all pages in a new shared folder and read every record back."""
    folder = scratch_path(spark, "warc")
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    index = write(pages, folder)
    kind = dict(pages.dtypes)["page_id"]
    back = read(index, folder, with_payload=False)
    return back.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       F.col("refers_to").cast(kind).alias("refers_to"))
