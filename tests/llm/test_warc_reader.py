"""The reader counts payloads itself and takes records of other writers."""

import io
import os
import zlib

import pytest

from roadpulse.llm import warc


def _member(head: str, block: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    text = f"WARC/1.0\r\n{head}Content-length:{len(block)}\r\n\r\n".encode()
    return packer.compress(text + block + b"\r\n\r\n") + packer.flush()


def test_other_writers_records(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nabc"
    members = [
        _member("WARC-Type: warcinfo\r\nContent-Type: application/warc-fields\r\n", b"software: x\r\n"),
        _member("warc-type: response\r\nContent-Type: application/http; msgtype=response\r\nWARC-Target-URI: http://e.org/\r\n", http),
        _member("WARC-Type: resource\r\nContent-Type: text/plain\r\nWARC-Payload-Digest: md5:1\r\n", b"plain"),
        _member("WARC-Type: revisit\r\nContent-Type: application/http\r\n", b"HTTP/1.1 304 x\r\n\r\n"),
        _member("WARC-Type: metadata\r\n", b""),
    ]
    path = f"{tmp_path}/a.warc.gz"
    with open(path, "wb") as f:
        f.write(b"".join(members))
    got = warc.read_archives(spark.createDataFrame([(path,)], "path string"), str(tmp_path)).collect()
    assert [(r.record_type, r.payload_bytes, r.url) for r in got] == [
        ("warcinfo", 13, None), ("response", 3, "http://e.org/"), ("resource", 5, None), ("revisit", None, None), ("metadata", 0, None),
    ]
    assert got[1].payload_digest == warc.sha1_base32(b"abc") and got[3].payload_digest is None
    assert os.path.getsize(path) > 0


@pytest.mark.parametrize("head,block", [
    ("WARC-Type: response\r\nContent-Type: application/http\r\nX-Payload-Length: 999\r\n", b"HTTP/1.1 200 OK\r\n\r\nabc"),
    ("WARC-Type: resource\r\nWARC-Payload-Digest: sha1:AAAA\r\n", b"abc"),
    ("WARC-Type: resource\r\nWARC-Block-Digest: sha1:AAAA\r\n", b"abc"),
    ("no field\r\n", b""),
    ("Content-Type: text/plain\r\n", b""),
])
def test_wrong_declarations_are_errors(head, block):
    for m in warc.members(io.BytesIO(_member(head, block))):
        with pytest.raises(warc.BadRecord):
            warc.read_record(m)
