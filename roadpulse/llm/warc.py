"""WARC archives: a writer, and a sequential reader of one gzip member per record.

Writing: payload digests decide which record is the response and which revisit it;
only digests and ids are shuffled for that.  Each task then writes archives of bounded
size into the shared folder and reports their paths; the report is written as a table,
so a task that runs again leaves at most an archive that nobody reads.

Reading: a task walks through an archive from the start, decompresses a block at a time
with one decompressor per gzip member, takes header lines up to the blank one, the
content length's bytes, and the closing blank lines, and verifies the block and payload
digests that the record has.  A payload is counted and digested from the block, an HTTP
message's after its own headers; a length that the writer noted must agree.  A revisit holds no
payload: its size and digest are those of its headers, null where it has none.  Digests, target
and page id are optional, so archives of other writers, with warcinfo, request or metadata records,
are read as well.  Memory is bounded by one record, whatever the archive's size.

Defined results: a null html is an empty payload; a null page id makes a record without
page id, which is the response of its payload only if no page id shares it; rows that
repeat the smallest page id are all responses; an empty table gives no archive and an
empty result.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import materialize, prepare, table
from roadpulse.session import checkpoint_dir

MIN_REVISIT_BYTES = 0
ARCHIVE_BYTES = 64 << 20  # an archive is closed at the first record end beyond this
BLOCK = 1 << 20
DATE = "2024-01-01T00:00:00Z"  # records are dated alike, so equal pages give equal archives
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id, url: str) -> str:
    name = f"page:{page_id}" if page_id is not None else f"url:{url}"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def record(page_id, url: str | None, payload: bytes, refers_to) -> bytes:
    """One record as a gzip member; ``refers_to``: the response's page id for a revisit, else None."""
    digest = f"sha1:{sha1_base32(payload)}"
    revisit = refers_to is not None
    block = HTTP if revisit else HTTP + payload
    uri = quote(url or "", safe=":/?#[]@!$&'()*+,;=%~")
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, url or "")),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", uri),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", digest),
        ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Length", str(len(block))),
    ]
    if url is None or uri != url:  # what the URI does not tell of the column
        head.append(("X-URL", "null" if url is None else f"={quote(url)}"))
    if page_id is not None:
        head.append(("X-Page-ID", str(page_id)))
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, "")), ("X-Refers-To-Page", str(refers_to))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(text.encode() + block + b"\r\n\r\n") + packer.flush()


class BadRecord(ValueError):
    """An archive does not hold what its records declare."""


class Headers(dict):
    """Header fields by their usual spelling, whatever the case of the record's own."""

    KNOWN = {
        k.lower(): k for k in (
            "WARC-Type", "WARC-Record-ID", "WARC-Date", "WARC-Target-URI", "Content-Type", "WARC-Payload-Digest", "WARC-Block-Digest",
            "Content-Length", "X-Payload-Length", "X-URL", "X-Page-ID", "X-Refers-To-Page",
        )
    }

    def __init__(self, lines: list[str]):
        for line in lines:
            name, colon, value = line.partition(":")
            if not colon:
                raise BadRecord(f"no header field: {line[:40]!r}")
            self[self.KNOWN.get(name.strip().lower(), name.strip())] = value.strip()


def payload_of(head: dict[str, str], block: bytes) -> bytes | None:
    """The payload that a record holds: an HTTP message's body, another record's block; a revisit holds none."""
    if head["WARC-Type"] == "revisit":
        return None
    if head.get("Content-Type", "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


def members(stream, block: int = BLOCK) -> Iterator[Iterator[bytes]]:
    """For each gzip member of a byte stream, its decompressed bytes in pieces of at most ``block``."""
    held = stream.read(block)

    def pieces():
        nonlocal held
        unpacker = zlib.decompressobj(31)
        while not unpacker.eof:
            if not held and not (held := stream.read(block)):
                raise BadRecord("archive ends within a gzip member")
            piece = unpacker.decompress(held, block)
            held = unpacker.unconsumed_tail
            if piece:
                yield piece
        held = unpacker.unused_data + held

    while held or (held := stream.read(block)):
        own = pieces()
        yield own
        for _ in own:  # what the caller left unread
            pass


def read_record(pieces: Iterator[bytes]) -> tuple[dict[str, str], bytes]:
    """Headers and block of one member, framed by its content length, digests verified."""
    data = bytearray()
    while (end := data.find(b"\r\n\r\n")) < 0:
        piece = next(pieces, None)
        if piece is None:
            raise BadRecord("record without an end of headers")
        data += piece
    lines = bytes(data[:end]).decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise BadRecord(f"no WARC version line: {lines[0][:40]!r}")
    head = Headers(lines[1:])
    del data[: end + 4]
    if "WARC-Type" not in head or not head.get("Content-Length", "").isdecimal():
        raise BadRecord("record without a type or a content length")
    size = int(head["Content-Length"])
    name = head.get("WARC-Record-ID")
    for piece in pieces:
        data += piece
        if len(data) > size + 4:
            break
    if len(data) != size + 4 or data[size:] != b"\r\n\r\n":
        raise BadRecord(f"content length {size} does not frame the record {name}")
    block = bytes(data[:size])
    payload = payload_of(head, block)
    for field, held in (("WARC-Block-Digest", block), ("WARC-Payload-Digest", payload)):
        if held is not None and head.get(field, "").startswith("sha1:") and head[field] != f"sha1:{sha1_base32(held)}":
            raise BadRecord(f"{field} differs in {name}")
    if payload is not None and head.get("X-Payload-Length", str(len(payload))) != str(len(payload)):
        raise BadRecord(f"payload length differs in {name}")
    return head, block


def file_system(path: str):
    """File system and its own path for a folder URI; local paths have none."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def roles(pages: DataFrame, id_col: str, html_col: str, min_bytes: int) -> DataFrame:
    """Rows (id, digest, refers_to) of pages that revisit another; the digests are of whole payloads."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    marked = materialize(
        pages.select(F.col(id_col).alias("id"), F.unhex(F.sha1(payload)).alias("digest"), F.length(payload).alias("size")),
        "warc-digests",
    ).where(F.col("size") >= min_bytes)
    # Written, so that the join is between plain exchanges and a hot payload's rows can be split.
    first = materialize(
        marked.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first"),
        "warc-firsts",
    )
    return (
        marked.join(first, "digest").where(~F.col("id").eqNullSafe(F.col("first")))
        .select("id", "digest", F.col("first").alias("refers_to")).distinct()
    )


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   min_revisit_bytes: int = MIN_REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes a record per row into archives under ``folder``; rows (path, records, bytes), one per archive."""
    prepare(pages.sparkSession)
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    own = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"),
                       F.unhex(F.sha1(payload)).alias("digest"))
    r = roles(pages, id_col, html_col, min_revisit_bytes).alias("r")
    o = own.alias("o")
    rows = o.join(r, F.col("o.id").eqNullSafe(F.col("r.id")) & (F.col("o.digest") == F.col("r.digest")), "left").select(
        "o.id", "o.url", "o.payload", "r.refers_to"
    )
    schema = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])

    def run(batches):
        fs, top = file_system(folder)
        out = path = None
        n = size = 0

        def closed():
            out.close()
            return pa.record_batch([[path], [n], [size]], schema=schema)

        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, data, refers_to = (batch.column(c)[i].as_py() for c in range(4))
                if out is None:
                    path, n, size = f"{top}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(path, compression=None)
                member = record(page_id, url, data, refers_to)
                out.write(member)
                n, size = n + 1, size + len(member)
                if size >= archive_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    file_system(folder)[0].create_dir(file_system(folder)[1], recursive=True)
    return materialize(rows.mapInArrow(run, "path string, records long, bytes long"), "warc-archives")


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Rows of all records: record type, headers' values, block bytes and payload bytes' length and digest.

    ``archives`` has a column ``path``; each archive is one task's work, read in sequence.
    """
    spark = archives.sparkSession
    fields = "path string, record_type string, page_id long, url string, payload_digest string, payload_bytes long, refers_to long, block binary"
    schema = pa.schema([
        ("path", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
        ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("block", pa.binary()),
    ])

    def number(text):
        return None if text is None else int(text)

    def run(batches):
        fs, _ = file_system(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                with fs.open_input_stream(path, compression=None) as stream:
                    for pieces in members(stream):
                        head, block = read_record(pieces)
                        url = head.get("WARC-Target-URI")
                        if "X-URL" in head:
                            url = None if head["X-URL"] == "null" else unquote(head["X-URL"][1:])
                        payload = payload_of(head, block)
                        if payload is None:
                            digest, length = head.get("WARC-Payload-Digest"), number(head.get("X-Payload-Length"))
                            digest = digest and digest.removeprefix("sha1:")
                        else:
                            digest, length = sha1_base32(payload), len(payload)
                        rows.append((path, head["WARC-Type"], number(head.get("X-Page-ID")), url, digest, length, number(head.get("X-Refers-To-Page")), block))
                        held += len(block)
                        if held > 4 * BLOCK:
                            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                            rows, held = [], 0
                if rows:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    n = archives.count()
    return archives.select("path").repartition(max(1, n), "path").mapInArrow(run, fields)


def archive_folder(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark)}/roadpulse/warc-{uuid.uuid4().hex}"


def op7_warc_round_trip(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    folder = archive_folder(spark)
    found = read_archives(write_archives(pages, folder), folder)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
