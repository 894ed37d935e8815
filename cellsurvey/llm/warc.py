"""WARC archives, index first: write records and their index, then read selected records by byte range.

Writing: every task streams its rows into one compressed archive (one gzip member per record) in the shared folder and
returns an index row per record: file, offset, length, url, digest. File names are unique per attempt and the index is
committed by Spark, so an attempt that is lost leaves at most an archive that no index row names.

Reading: index rows are sorted by (file, offset); neighbours closer than ``gap`` become one read of at most ``most``
bytes, out of which the members are cut.

Of records with equal payloads of at least ``min_revisit`` bytes the one with the smallest id is a response and the others
revisit it. NULL html is an empty payload, a NULL url leaves its header out, a NULL id sorts last and is never referred
to while a numbered record has the payload; repeated rows of the response are responses too.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsurvey.llm.common import own_columns
from cellsurvey.session import durable, scratch_path
from cellsurvey.sources import files

_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_DATE = b"2000-01-01T00:00:00Z"  # pages carry no date, and equal input shall give equal archives
_INDEX = "page_id bigint, url string, payload_digest string, record_type string, file string, offset bigint, length bigint"
_RECORD = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"


def _uri(page_id: int | None) -> bytes:
    return b"<urn:page:%s>" % (b"none" if page_id is None else b"%d" % page_id)


def _number(uri: bytes | None) -> int | None:
    return None if uri is None or uri == b"<urn:page:none>" else int(uri[10:-1])


def record(page_id, url, digest: str, refers_to, size: int, payload: bytes | None) -> bytes:
    """One uncompressed record; a revisit has no payload of its own, but states its size."""
    kind = b"revisit" if payload is None else b"response"
    head = [b"WARC/1.1", b"WARC-Type: " + kind, b"WARC-Record-ID: " + _uri(page_id), b"WARC-Date: " + _DATE]
    if url is not None:
        head.append(b"WARC-Target-URI: " + "".join(c if c > " " and c != "\x7f" else "%%%02X" % ord(c) for c in url).encode())
    head += [b"WARC-Payload-Digest: sha256:" + digest.encode(), b"Payload-Length: %d" % size]
    if payload is None:
        head += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", b"WARC-Refers-To: " + _uri(refers_to)]
    block = _HTTP + (payload or b"")
    head += [b"Content-Type: application/http;msgtype=response", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Header fields and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
    block = rest[: int(fields[b"Content-Length"])]
    return {"fields": fields, "payload": block.partition(b"\r\n\r\n")[2]}


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, at = None, f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
        for batch in batches:
            if out is None and batch.num_rows:
                store, path = files.store_of(name)
                out = store.open_output_stream(path, compression=None)
            rows = {k: [] for k in ("id", "url", "digest", "kind", "at", "size")}
            for page_id, url, html, digest, refers in zip(*[batch.column(i).to_pylist() for i in range(5)]):
                payload = b"" if html is None else html.encode()
                data = _member(record(page_id, url, digest, refers, len(payload), None if refers is not None else payload))
                out.write(data)
                for k, v in zip(rows, (page_id, url, digest, "response" if refers is None else "revisit", at, len(data))):
                    rows[k].append(v)
                at += len(data)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["id"], pa.int64()), pa.array(rows["url"], pa.string()), pa.array(rows["digest"], pa.string()),
                 pa.array(rows["kind"], pa.string()), pa.array([name] * batch.num_rows, pa.string()),
                 pa.array(rows["at"], pa.int64()), pa.array(rows["size"], pa.int64())],
                names=[c.split()[0] for c in _INDEX.split(", ")])
        if out is not None:
            out.close()

    return write


def write_archives(pages: DataFrame, min_revisit: int = 100) -> DataFrame:
    """Write one archive per task and return the index (a table in the shared folder)."""
    read = own_columns(pages, "page_id", "url", "html")
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    keyed = read.select("*", F.sha2(payload, 256).alias("digest"), F.octet_length(payload).alias("size"))
    # only payloads that occur twice: few and narrow rows, so the pages themselves need not be moved in general
    twice = durable(
        keyed.filter(F.col("size") >= min_revisit).groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first"))
        .filter("n > 1 and first is not null").select("digest", "first"))
    placed = keyed.join(twice, "digest", "left").select(
        "page_id", "url", "html", "digest",
        F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))
    folder = scratch_path(pages.sparkSession, "warc")
    folder = files.qualified(pages.sparkSession, folder)  # the same store for every task
    make_folder(pages, folder)
    return durable(placed.mapInArrow(_writer(folder), _INDEX))


def make_folder(df: DataFrame, folder: str) -> None:
    jvm = df.sparkSession._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).mkdirs(path)


def _reader(gap: int, most: int):
    def fetch(run: list[tuple]) -> pa.RecordBatch:
        with files.open_file(run[0][0]) as source:
            start = run[0][1]
            data = source.read_at(run[-1][1] + run[-1][2] - start, start)
        rows = []
        for _, at, size, url in run:
            parsed = parse(zlib.decompress(data[at - start : at - start + size], 31))
            fields, payload = parsed["fields"], parsed["payload"]
            kind = fields[b"WARC-Type"].decode()
            digest = fields[b"WARC-Payload-Digest"].decode().removeprefix("sha256:")
            if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                raise ValueError(f"damaged record at {at} of {run[0][0]}")
            rows.append((
                _number(fields[b"WARC-Record-ID"]), url, int(fields[b"Payload-Length"]), digest, kind,
                _number(fields.get(b"WARC-Refers-To")), payload if kind == "response" else None))
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[c.split()[0] for c in _RECORD.split(", ")])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run: list[tuple] = []
        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                if run and not (
                    row[0] == run[0][0] and row[1] - (run[-1][1] + run[-1][2]) <= gap and row[1] + row[2] - run[0][1] <= most):
                    yield fetch(run)
                    run = []
                run.append(row)
        if run:
            yield fetch(run)

    return read


def read_records(selected: DataFrame, gap: int = 64 << 10, most: int = 8 << 20) -> DataFrame:
    """Records of the selected index rows, by coalesced reads of sorted byte ranges. Revisits have a NULL payload."""
    ordered = (
        selected.select("file", "offset", "length", "url")
        .repartitionByRange("file", "offset").sortWithinPartitions("file", "offset"))
    return ordered.mapInArrow(_reader(gap, most), _RECORD)
