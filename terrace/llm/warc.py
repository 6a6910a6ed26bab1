"""WARC archives with the index first.

Pages are written by the tasks that hold them, one gzip member per record, into files that
are named by task and attempt. The same task returns the index of what it wrote: file,
offset, length, URL and digest per record. A repeated or speculative attempt writes other
files, and only the rows of the attempt that counted name any.

Reading starts from the index: selected records are sorted by file and offset, neighbours
are coalesced into one byte range, and each range is read at once. A large file is read by
several tasks. Files are opened through the file system of the shared folder's own scheme.
"""

from __future__ import annotations

import base64
import hashlib
import sys
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import keep, parts
from terrace.sources.places import new_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FILE_BYTES = 1 << 30
RANGE_BYTES = 8 << 20
GAP_BYTES = 64 << 10
TASK_BYTES = 64 << 20
DATE = "1970-01-01T00:00:00Z"  # the pages carry no capture time
INDEX = "file string, offset long, length long, url string, digest string"


def _line(value: str) -> str:
    """A header value without line ends."""
    return quote(value, safe="".join(chr(i) for i in range(0x20, 0x7F) if chr(i) != "%"))


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: str | None, url: str | None, payload: bytes, refers_to: str | None, digest: str) -> bytes:
    """One WARC record as a gzip member; with ``refers_to`` a revisit without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_line(url)}")
    if page is not None:
        lines.append(f"Page-ID: {_line(page)}")
    if refers_to is not None:
        lines += [
            f"Refers-To-Page-ID: {_line(refers_to)}",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    member = zlib.compressobj(6, zlib.DEFLATED, 31)
    head = "\r\n".join(lines).encode() + b"\r\n\r\n"
    return member.compress(head + block + b"\r\n\r\n") + member.flush()


def parse(member: bytes) -> dict:
    """Headers, payload and declared payload length of one gzip member."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = [x for x in http.decode().split("\r\n") if x.startswith("Content-Length: ")]
    return {"fields": fields, "payload": payload, "bytes": int(sizes[0].split(": ")[1])}


def _writer(folder: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pa.fs.FileSystem.from_uri(folder)
        out, name, at = None, "", 0
        rows: list[tuple] = []
        for batch in batches:
            for page, url, html, refers in zip(*[batch.column(c).to_pylist() for c in ("page", "url", "html", "refers_to")], strict=True):
                if out is not None and at >= file_bytes:
                    out.close()
                    out = None
                if out is None:
                    fs.create_dir(root, recursive=True)
                    name, at = f"pages-{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                payload = html or b""
                digest = payload_digest(payload)
                member = record(page, url, payload, refers, digest)
                out.write(member)
                rows.append((name, at, len(member), url, digest))
                at += len(member)
        if out is not None:
            out.close()
        for i in range(0, len(rows), 10_000):
            yield pa.RecordBatch.from_pydict(dict(zip(("file", "offset", "length", "url", "digest"), zip(*rows[i : i + 10_000], strict=True), strict=True)))

    return run


def write_archives(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write ``pages (page_id, url, html)`` to WARC files in ``folder``; returns the kept
    index, one row per record.

    Of pages with equal payloads the one with the largest page_id becomes the response and
    the others revisit it. Null html is an empty payload. A null page_id is smaller than any
    other; rows that repeat the largest page_id of a payload are all responses.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("html"))
    rows = rows.withColumn("sha1", F.sha1("html"))
    seen = keep(rows.select("page_id", "sha1"), "warc-digests")
    most = seen.groupBy("sha1").agg(F.max("page_id").alias("refers_to"))
    revisits = (
        seen.join(most, "sha1").filter("NOT page_id <=> refers_to")
        .select(F.col("page_id").alias("r_page"), F.col("sha1").alias("r_sha1"), "refers_to").distinct()
    )
    marked = rows.join(
        keep(revisits, "warc-revisits"),
        F.col("page_id").eqNullSafe(F.col("r_page")) & (F.col("sha1") == F.col("r_sha1")),
        "left",
    ).select(F.col("page_id").cast("string").alias("page"), "url", "html", F.col("refers_to").cast("string").alias("refers_to"))
    return keep(marked.mapInArrow(_writer(folder, file_bytes), INDEX), "warc-index")


def _reader(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pa.fs.FileSystem.from_uri(folder)
        for batch in batches:
            rows = list(zip(*[batch.column(c).to_pylist() for c in ("file", "offset", "length", "digest")], strict=True))
            found: dict[str, list] = {k: [] for k in ("page", "payload_bytes", "payload_digest", "record_type", "refers_to")}
            i, name, source = 0, None, None
            while i < len(rows):
                file, start = rows[i][:2]
                if file != name:
                    if source is not None:
                        source.close()
                    name, source = file, fs.open_input_file(f"{root}/{file}")
                j, end = i, start
                while j < len(rows) and rows[j][0] == file and rows[j][1] - end <= GAP_BYTES and (j == i or rows[j][1] + rows[j][2] - start <= RANGE_BYTES):
                    end = rows[j][1] + rows[j][2]
                    j += 1
                data = source.read_at(end - start, start)
                for _, offset, length, digest in rows[i:j]:
                    got = parse(data[offset - start : offset - start + length])
                    fields = got["fields"]
                    told = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    whole = fields["WARC-Type"] == "response"
                    if told != digest or whole and (payload_digest(got["payload"]) != digest or len(got["payload"]) != got["bytes"]):
                        raise ValueError(f"{file} at {offset}: the record does not have the digest of its index entry")
                    page, refers = fields.get("Page-ID"), fields.get("Refers-To-Page-ID")
                    found["page"].append(None if page is None else unquote(page))
                    found["payload_bytes"].append(got["bytes"])
                    found["payload_digest"].append(told)
                    found["record_type"].append(fields["WARC-Type"])
                    found["refers_to"].append(None if refers is None else unquote(refers))
                i = j
            if source is not None:
                source.close()
            kinds = {"payload_bytes": pa.int64()}
            yield pa.RecordBatch.from_pydict({k: pa.array(v, kinds.get(k, pa.string())) for k, v in found.items()})

    return run


def read_archives(index: DataFrame, folder: str, page_type: str) -> DataFrame:
    """Records that ``index`` (or a selection of its rows) names: ``page_id, payload_bytes,
    payload_digest, record_type, refers_to``. Every payload is checked against its digest."""
    piece = F.floor(F.col("offset") / TASK_BYTES)
    dealt = (
        index.select("file", "offset", "length", "digest")
        .repartition(parts(index.sparkSession), "file", piece)
        .sortWithinPartitions("file", "offset")
    )
    read = dealt.mapInArrow(
        _reader(folder), "page string, payload_bytes long, payload_digest string, record_type string, refers_to string"
    )
    return read.select(
        F.col("page").cast(page_type).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(page_type).alias("refers_to"),
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read every record back.

    One row per page; an empty table gives no rows and no files. Other columns are not read.
    """
    folder = new_dir(pages.sparkSession, "warc")
    if "://" not in folder and not folder.startswith("/"):
        folder = folder.removeprefix("file:")
    index = write_archives(pages, folder)
    return read_archives(index, folder, pages.schema["page_id"].dataType.simpleString())


# Base 32 of the digest, five hexadecimal digits (20 bits) to four letters.
SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
b AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM p),
d AS (SELECT *, list_aggregate(list_transform(range(0, 8), lambda i: (
        list_aggregate(list_transform([15, 10, 5, 0], lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
          CAST(((CAST('0x' || substr(h, CAST(5 * i + 1 AS BIGINT), 5) AS BIGINT) >> s) & 31) + 1 AS BIGINT), 1)), 'string_agg', ''))), 'string_agg', '') AS digest
      FROM b)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM d
"""
