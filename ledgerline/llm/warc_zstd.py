"""WARC archives compressed with Zstandard: writer, and a reader that validates.

An archive begins with a skippable frame that holds the dictionary (plain, or itself compressed) and goes on with one
frame per record. The reader takes one frame at a time, so its memory is bounded by the largest record, checks version
line, mandatory headers, lengths and digests, and raises ``BadArchive`` with the place of a bad frame.

Null payload is empty. A record without an identifier gets a random URN and reads back with a null one; a null URL is
written as the record's own URN and reads back as null. Rows with the largest identifier of their payload are all
responses, if such rows repeat. An empty table makes no archives. Columns beside identifier, URL and payload are not
read. Archives lie in the shared folder; their paths come from the tasks that succeeded, so leftovers of lost tasks are
never read. The folder must be one that pyarrow's file systems open (local or mounted, HDFS, object stores).
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from contextlib import suppress

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import map_batches, stored, utf8
from ledgerline.session import work_dir

SKIPPABLE, FRAME = 0x184D2A5D, 0xFD2FB528
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2020-01-01T00:00:00Z"
_MANDATORY = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
_URN = "urn:page:"
_READ = 1 << 20


class BadArchive(ValueError):
    """An archive that breaks the format."""


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _urn(identifier) -> str:
    return f"{_URN}{identifier}" if identifier is not None else f"urn:uuid:{uuid.uuid4()}"


def _identifier(uri: str | None) -> int | None:
    inner = (uri or "").strip("<>")
    return int(inner[len(_URN) :]) if inner.startswith(_URN) else None


def _header_text(value: str) -> str:
    """A header value on one line."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value)


def record(identifier, url: str | None, payload: bytes, sha1: bytes, response: bool, refers_to) -> bytes:
    """One WARC/1.1 record; a revisit has the HTTP headers only."""
    urn = _urn(identifier)
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block += payload if response else b""
    headers = [
        ("WARC-Type", "response" if response else "revisit"), ("WARC-Record-ID", f"<{urn}>"), ("WARC-Date", DATE),
        ("WARC-Target-URI", urn if url is None else _header_text(url)),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(sha1).decode()),
        ("WARC-Block-Digest", "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()),
        ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block))),
    ]
    if not response:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{_urn(refers_to)}>")]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parsed(data: bytes, where: str) -> tuple[dict[str, str], bytes]:
    """Headers and block of a frame's content, which must be one whole record."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not gap or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise BadArchive(f"{where}: no WARC version line and header")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise BadArchive(f"{where}: bad header line {line[:80]!r}")
        headers[name.strip()] = value.strip()
    if missing := [h for h in _MANDATORY if h not in headers]:
        raise BadArchive(f"{where}: headers {missing} are missing")
    if not headers["Content-Length"].isdigit():
        raise BadArchive(f"{where}: Content-Length is no number")
    size = int(headers["Content-Length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise BadArchive(f"{where}: Content-Length is {size}, the frame has {len(rest) - 4}")
    block = rest[:size]
    _check(headers.get("WARC-Block-Digest"), block, f"{where}: block")
    return headers, block


def _check(digest: str | None, data: bytes, where: str) -> None:
    if digest and digest.startswith("sha1:") and base64.b32decode(digest[5:]) != hashlib.sha1(data).digest():
        raise BadArchive(f"{where} digest differs")


def _frames(stream, path: str) -> Iterator[tuple[int, bytes]]:
    """Offset and content of each frame after the dictionary."""
    buffer, offset = stream.read(_READ), 0

    def more(wanted: int) -> bytes:
        nonlocal buffer
        while len(buffer) < wanted and (data := stream.read(_READ)):
            buffer += data
        if len(buffer) < wanted:
            raise BadArchive(f"{path} at {offset}: ends within a frame")
        return buffer
    options = {}
    if not buffer:
        return
    if len(buffer) >= 8 and struct.unpack_from("<I", buffer)[0] == SKIPPABLE:
        size = struct.unpack_from("<I", buffer, 4)[0]
        content = bytes(more(8 + size)[8 : 8 + size])
        if content[:4] == struct.pack("<I", FRAME):
            content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
        options = {"dict_data": zstandard.ZstdCompressionDict(content)}
        buffer, offset = buffer[8 + size :], 8 + size
    decompressor = zstandard.ZstdDecompressor(**options)
    while True:
        if not buffer:
            buffer = stream.read(_READ)
            if not buffer:
                return
        if struct.unpack_from("<I", more(4))[0] != FRAME:
            raise BadArchive(f"{path} at {offset}: no frame begins here")
        one, parts, used = decompressor.decompressobj(), [], 0
        try:
            while True:
                parts.append(one.decompress(buffer))
                used += len(buffer)
                if one.eof:
                    buffer = one.unused_data
                    used -= len(buffer)
                    break
                buffer = stream.read(_READ)
                if not buffer:
                    raise BadArchive(f"{path} at {offset}: ends within a frame")
        except zstandard.ZstdError as error:
            raise BadArchive(f"{path} at {offset}: {error}") from error
        yield offset, b"".join(parts)
        offset += used


def read_archive(path: str) -> Iterator[dict]:
    """Validated records of one archive, in order."""
    files, inner = _opened(path)
    with files.open_input_stream(inner, compression=None) as stream:
        for offset, data in _frames(stream, path):
            where = f"{path} at {offset}"
            headers, block = parsed(data, where)
            http, gap, payload = block.partition(b"\r\n\r\n")
            if not gap:
                raise BadArchive(f"{where}: no HTTP header")
            fields = dict(line.split(": ", 1) for line in http.decode("latin-1").split("\r\n")[1:])
            kind, size = headers["WARC-Type"], int(fields.get("Content-Length", len(payload)))
            digest = headers.get("WARC-Payload-Digest")
            if kind == "response":
                if size != len(payload):
                    raise BadArchive(f"{where}: payload of {len(payload)} bytes, Content-Length says {size}")
                _check(digest, payload, f"{where}: payload")
            url, urn = headers.get("WARC-Target-URI"), headers["WARC-Record-ID"].strip("<>")
            yield {
                "page_id": _identifier(urn), "url": None if url == urn else url, "record_type": kind,
                "payload_bytes": size, "payload_digest": base64.b32decode(digest[5:]).hex() if digest else None,
                "refers_to": _identifier(headers.get("WARC-Refers-To")), "path": path, "offset": offset,
                "payload": payload if kind == "response" else None,
            }


def trained_dictionary(pages: DataFrame, payload: str, pages_sampled: int = 400, size: int = 1 << 15) -> bytes:
    """A dictionary from the beginnings (8 KiB) of ``pages_sampled`` payloads, those with the smallest hash. Empty if
    they are too few."""
    rows = pages.where(F.length(payload) > 0).select(F.xxhash64(payload).alias("h"), F.substring(payload, 1, 8192).alias("b"))
    chosen = rows.select("h").distinct().orderBy("h").limit(pages_sampled)
    sample = rows.join(F.broadcast(chosen), "h").groupBy("h").agg(F.min("b").alias("b")).orderBy("h").collect()
    with suppress(zstandard.ZstdError):
        return zstandard.train_dictionary(size, [r["b"].encode() for r in sample]).as_bytes()
    return b""


def _write(folder: str, dictionary: bytes, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, inner = _opened(folder)
        files.create_dir(inner, recursive=True)
        dict_data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        compressor = zstandard.ZstdCompressor(level=3, dict_data=dict_data)
        out, name, written, records, done = None, "", 0, 0, []
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    out, written, records = files.open_output_stream(f"{inner}/{name}", compression=None), 0, 0
                    if dictionary:
                        out.write(struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary)
                frame = compressor.compress(record(
                    row["page_id"], row["url"], row["b"], bytes.fromhex(row["digest"]), row["refers_to"] is None, row["refers_to"]))
                out.write(frame)
                written, records = written + len(frame), records + 1
                if written >= most:
                    out.close()
                    done.append((f"{folder}/{name}", records))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", records))
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())], ["path", "records"])
    return run


def write_archives(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html",
                   dedup_bytes: int = 1000, archive_bytes: int = 1 << 25) -> DataFrame:
    """Write a record per row; returns the archives: path, records.

    Of rows with equal payloads of ``dedup_bytes`` or more, the one with the largest key has it and the others revisit.
    Payloads are equal if length, SHA-1 and SHA-256 are; the records hold SHA-1.
    """
    rows = pages.select(
        F.col(key).cast("bigint").alias("page_id"), F.col(url).alias("url"), utf8(F.col(payload)).alias("b")).withColumn(
        "digest", F.sha1("b")).withColumn("sha256", F.sha2("b", 256)).withColumn("size", F.octet_length("b"))
    same = ["digest", "sha256", "size"]
    several = rows.where(F.col("size") >= dedup_bytes).groupBy(*same).agg(
        F.max("page_id").alias("top"), F.count("*").alias("rows")).where("rows > 1 AND top IS NOT NULL").drop("rows")
    joined = rows.join(several.hint("merge"), same, "left").select(
        "page_id", "url", "b", "digest",
        F.when(~F.col("page_id").eqNullSafe(F.col("top")), F.col("top")).alias("refers_to"))
    folder = work_dir(pages.sparkSession, "warc")
    dictionary = trained_dictionary(pages, payload)
    return stored(map_batches(joined, _write(folder, dictionary, archive_bytes), "path string, records bigint"), "archives")


def _read(with_payload: bool):
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "path", "offset"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    if with_payload:
        names, kinds = [*names, "payload"], [*kinds, pa.binary()]

    def made(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, held = [], 0
                for row in read_archive(path):
                    rows.append(row)
                    held += len(row["payload"] or b"") if with_payload else 0
                    if len(rows) == 1000 or held > 1 << 24:
                        yield made(rows)
                        rows, held = [], 0
                if rows:
                    yield made(rows)
    return run


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records of the archives whose paths are in ``path``: an archive is one task's work at most."""
    schema = ("page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, "
              "refers_to bigint, path string, offset bigint") + ", payload binary" * with_payload
    # a number that is given is not lowered however small the paths are, and no other exchange takes its place
    spread = archives.select("path").repartition(max(archives.count(), 1), "path").distinct()
    return map_batches(spread, _read(with_payload), schema)
