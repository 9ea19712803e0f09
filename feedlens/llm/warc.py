"""WARC archives: write with an index, read selected records by byte range.

Each write task streams its records into gzip-per-record archives and returns
one index row per record: archive, offset, length, URL, digest, type.  Archive
names are unique to the task attempt, and only the index of attempts that
succeeded is kept, so what a lost executor left behind is never read.  A
reader selects records in the index first; the selected records of an archive
are sorted by offset and neighbouring ones are fetched with one range read.
Files are reached through ``pyarrow.fs``, in the folder given by its URI.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import save

#: An archive is closed at this size; one range read takes at most RANGE bytes
#: (or one record), and bridges gaps of unselected records up to GAP bytes.
ARCHIVE_BYTES, RANGE_BYTES, GAP_BYTES = 256 << 20, 4 << 20, 64 << 10
DATE = "2024-01-01T00:00:00Z"

INDEX = ("archive string, offset long, length long, id long, url string, digest string, "
         "record_type string, refers_to long, payload_bytes long")


def file_system(uri: str):
    """pyarrow file system and path of a URI or an absolute path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!//)/*", "file:///", uri))


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(row_id: int | None) -> str:
    return f"<urn:record:{'none' if row_id is None else row_id}>"


def _clean(url: str) -> str:
    """A URL on one header line: control characters percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(row_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
           refers_url: str | None = None) -> bytes:
    """One WARC/1.1 record: a response with an HTTP head and the payload, or a
    revisit with the HTTP head only."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
            + str(len(payload)).encode() + b"\r\n\r\n")
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(row_id)}",
            f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    head += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}",
             f"WARC-Block-Digest: sha1:{base32_sha1(block)}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_id(refers_to)}"]
        if refers_url is not None:
            head.append(f"WARC-Refers-To-Target-URI: {_clean(refers_url)}")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and HTTP body of one record; the block digest
    is checked, and of a response the payload digest."""
    head, rest = data.split(b"\r\n\r\n", 1)
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:])}
    block = rest[:int(fields["content-length"])]
    if "sha1:" + base32_sha1(block) != fields["warc-block-digest"]:
        raise ValueError(f"damaged record {fields['warc-record-id']}")
    body = block.split(b"\r\n\r\n", 1)[1]
    if fields["warc-type"] == "response" and "sha1:" + base32_sha1(body) != fields["warc-payload-digest"]:
        raise ValueError(f"wrong payload digest in {fields['warc-record-id']}")
    return fields, body


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        out = name = None
        offset = 0
        try:
            for batch in batches:
                rows = []
                for r in batch.to_pylist():
                    if out is None:
                        name, offset = f"archive-{uuid.uuid4().hex}.warc.gz", 0
                        fs.create_dir(base, recursive=True)
                        out = fs.open_output_stream(f"{base}/{name}", compression=None)
                    payload = (r["html"] or "").encode("utf-8", "surrogatepass")
                    digest = base32_sha1(payload)
                    gz = zlib.compressobj(6, zlib.DEFLATED, 31)
                    data = record(r["id"], r["url"], payload, digest, r["refers_to"], r["refers_url"])
                    data = gz.compress(data) + gz.flush()
                    out.write(data)
                    rows.append((name, offset, len(data), r["id"], r["url"], digest,
                                 "response" if r["refers_to"] is None else "revisit", r["refers_to"], len(payload)))
                    offset += len(data)
                    if offset >= ARCHIVE_BYTES:
                        out.close()
                        out = None
                yield pa.RecordBatch.from_pydict(
                    dict(zip(SCHEMA.names, map(list, zip(*rows)) if rows else [[]] * len(SCHEMA))), schema=SCHEMA)
        finally:
            if out is not None:
                out.close()
    return run


SCHEMA = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("id", pa.int64()),
                    ("url", pa.string()), ("digest", pa.string()), ("record_type", pa.string()),
                    ("refers_to", pa.int64()), ("payload_bytes", pa.int64())])


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", *, min_revisit: int = 0) -> DataFrame:
    """Writes a record per row into ``folder`` and returns the saved index.

    Of records with equal payloads of at least ``min_revisit`` bytes the one
    with the largest id is the response, the others are revisits that refer to
    it; rows that repeat the largest id are responses too.  A NULL html is an
    empty payload, a NULL url leaves out the target header, a row with a NULL
    id is written (as a revisit, if its payload has another record with an
    id).  Other columns are not written; very long pages are one record;
    an empty table gives an empty index.
    """
    src = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                       F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    src = src.withColumns({"sha": F.sha1(F.col("html").cast("binary")), "bytes": F.octet_length("html")})
    # one row per payload that occurs more than once
    again = (src.filter(F.col("bytes") >= min_revisit).groupBy("sha", "bytes")
             .agg(F.max("id").alias("first"), F.max_by("url", "id").alias("first_url"), F.count("*").alias("n")).filter("n > 1")
             .select(F.col("sha").alias("s"), F.col("bytes").alias("b"), "first", "first_url"))
    rows = (src.join(again, (F.col("sha") == F.col("s")) & (F.col("bytes") == F.col("b")), "left")
            .withColumn("again", F.col("first").isNotNull() & (F.col("id").isNull() | (F.col("id") != F.col("first"))))
            .select("id", "url", "html", *[F.when(F.col("again"), F.col(c)).alias(name) for c, name in
                                           (("first", "refers_to"), ("first_url", "refers_url"))]))
    return save(rows.mapInArrow(_write(folder), INDEX), "warc-index")


def ranges(index: DataFrame) -> DataFrame:
    """``archive, start, end, records``: selected index rows, sorted by offset
    and joined into range reads."""
    order = Window.partitionBy("archive").orderBy("offset")
    cell = F.floor(F.col("offset") / RANGE_BYTES)
    gap = F.col("offset") - F.lag(F.col("offset") + F.col("length")).over(order)
    cut = (gap.isNull() | (gap > GAP_BYTES) | (F.lag(cell).over(order) != cell)).cast("int")
    return (index.select("archive", "offset", "length").distinct().withColumn("cut", cut)
            .withColumn("range", F.sum("cut").over(order))
            .groupBy("archive", "range").agg(
                F.min("offset").alias("start"), F.max(F.col("offset") + F.col("length")).alias("end"),
                F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("records")))


def _read(folder: str):
    schema = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("record_id", pa.string()), ("url", pa.string()),
                        ("record_type", pa.string()), ("digest", pa.string()), ("refers_to", pa.string()),
                        ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        for batch in batches:
            for r in batch.to_pylist():
                with fs.open_input_file(f"{base}/{r['archive']}") as f:
                    data = f.read_at(r["end"] - r["start"], r["start"])
                rows = []
                for x in r["records"]:
                    at = x["offset"] - r["start"]
                    fields, body = parse(zlib.decompress(data[at:at + x["length"]], 31))
                    rows.append((r["archive"], x["offset"], fields["warc-record-id"], fields.get("warc-target-uri"),
                                 fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:"),
                                 fields.get("warc-refers-to"), body))
                yield pa.RecordBatch.from_pydict(dict(zip(schema.names, map(list, zip(*rows)))), schema=schema)
    return run


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records of the given index rows (all or a selection), one row each:
    ``archive, offset, record_id, url, record_type, digest, refers_to, payload`` (of a
    revisit: empty)."""
    r = ranges(index)
    r = r.repartition(F.col("archive"), F.col("start"))
    return r.mapInArrow(_read(folder), "archive string, offset long, record_id string, url string, record_type string, "
                        "digest string, refers_to string, payload binary")


def archive_folder(spark) -> str:
    from ..session import shared_path
    return shared_path(spark, os.path.join("llm", f"warc-{uuid.uuid4().hex}"))
