"""Zstandard web archives with a dictionary in front, written and read back (operator 3).

An archive starts with a skippable frame that holds its dictionary (itself a zstd frame); every
record after it is one frame. A record whose payload equals that of another record of at least
`min_bytes` bytes refers to the one with the largest page id and leaves its payload out.

A null html is an empty payload; a null page id stays null and is never the one referred to, unless
no record of a group has an id: then all are responses. Of rows that repeat a page id with equal html all
those with the largest id are responses. Urls may be null. Tables without rows give no archive.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwright.llm.common import load, materialise, save, scratch_path, tidy

# The frame that carries a dictionary, and the ordinary frame's first bytes.
SKIPPABLE_DICTIONARY = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_BYTES = 32 << 20  # of payloads
DICTIONARY_BYTES = 32 << 10
DICTIONARY_SAMPLE = 4 << 20  # at most so many bytes of an archive's own records train its dictionary
LEVEL = 3
FEED = 1 << 14


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_uri(page_id: int | None) -> str:
    return "<urn:x-page:none>" if page_id is None else f"<urn:x-page:{page_id}>"


def _page_of(uri: str) -> int | None:
    number = uri.removeprefix("<urn:x-page:").removesuffix(">")
    return None if number == "none" else int(number)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One record with its headers, block and end."""
    kind = "response" if refers_to is None else "revisit"
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    headers = [("WARC-Type", kind), ("WARC-Record-ID", _record_uri(page_id)), ("WARC-Date", date)]
    if url is not None:
        headers.append(("WARC-Target-URI", "".join(c if c > " " else "%%%02X" % ord(c) for c in url)))
    if refers_to is None:
        block += payload
    else:
        headers += [("WARC-Refers-To", _record_uri(refers_to)), ("WARC-Profile", REVISIT_PROFILE), ("WARC-Truncated", "length")]
    headers += [
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"), ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block))),
    ]
    lines = "".join(f"{name}: {value}\r\n" for name, value in headers).encode()
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Headers and payload of one record; raises where version, headers, lengths or digest are wrong."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or lines[0] != VERSION:
        raise ValueError("not a record of this version")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.decode().partition(":")
        if not colon:
            raise ValueError(f"header without a colon: {line!r}")
        headers[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest", "x-payload-length"):
        if name not in headers:
            raise ValueError(f"header {name} is missing")
    size = int(headers["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"block of {len(rest) - 4} bytes, {size} announced")
    http, found, payload = rest[:size].partition(b"\r\n\r\n")
    if not found or not http.startswith(b"HTTP/"):
        raise ValueError("no HTTP header in the block")
    kind, length = headers["warc-type"], int(headers["x-payload-length"])
    if kind == "response":
        if len(payload) != length or "sha1:" + digest(payload) != headers["warc-payload-digest"]:
            raise ValueError("payload differs from its length or digest")
    elif kind != "revisit" or payload or "warc-refers-to" not in headers:
        raise ValueError("neither a response nor a revisit without payload")
    return {
        "page_id": _page_of(headers["warc-record-id"]), "url": headers.get("warc-target-uri"), "payload_bytes": length,
        "payload_digest": headers["warc-payload-digest"].removeprefix("sha1:"), "record_type": kind,
        "refers_to": _page_of(headers["warc-refers-to"]) if kind == "revisit" else None,
        "payload": payload if kind == "response" else None,
    }


def archive(records: list[bytes]) -> list[bytes]:
    """File parts: the dictionary's frame, then a frame per record."""
    sample, size = [], 0
    for item in records:
        if size + len(item) > DICTIONARY_SAMPLE:
            break
        sample.append(item)
        size += len(item)
    try:
        trained = zstandard.train_dictionary(DICTIONARY_BYTES, sample, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too few records to train on: their own bytes serve
        trained = b"".join(sample)[-DICTIONARY_BYTES:].ljust(8, b"\n")
    packed = zstandard.ZstdCompressor(level=LEVEL).compress(trained)
    parts = [struct.pack("<II", SKIPPABLE_DICTIONARY, len(packed)), packed]
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(trained), write_checksum=True)
    return parts + [compressor.compress(item) for item in records]


def records_of(data: bytes) -> Iterator[dict]:
    """Records of an archive; each must be exactly one frame."""
    view, at, dictionary = memoryview(data), 0, None
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == SKIPPABLE_DICTIONARY:
        size = struct.unpack_from("<I", data, 4)[0]
        if 8 + size > len(data):
            raise ValueError("the dictionary's frame is cut off")
        raw = bytes(view[8 : 8 + size])
        if raw[:4] == ZSTD_MAGIC:
            raw = zstandard.ZstdDecompressor().decompress(raw)
        dictionary, at = zstandard.ZstdCompressionDict(raw), 8 + size
    reader = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    while at < len(data):
        if bytes(view[at : at + 4]) != ZSTD_MAGIC:
            raise ValueError(f"no frame at byte {at}")
        one, parts = reader.decompressobj(), []
        while not one.eof:  # fed piece by piece: the frame's end is where it says so
            if at >= len(data):
                raise ValueError("the last frame is cut off")
            parts.append(one.decompress(view[at : at + FEED]))
            at = min(at + FEED, len(data))
        at -= len(one.unused_data)
        yield parse(b"".join(parts))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write every page as a record; gives one row per archive: file, n_records."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
    )
    keyed = rows.withColumn("key", F.sha1(F.encode("html", "utf-8"))).withColumn("size", F.octet_length("html"))
    repeated = (
        keyed.filter(F.col("size") >= min_bytes).groupBy("key").agg(F.count("*").alias("n"), F.max("page_id").alias("first"))
        .filter("n > 1").select("key", "first")
    )
    # One row per digest on the right: a digest of very many pages is split by adaptive execution.
    referring = keyed.join(repeated, "key", "left").select(
        "page_id", "url", "html", F.expr("CASE WHEN first IS NOT NULL AND NOT page_id <=> first THEN first END").alias("refers_to")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held, records = TaskContext.get().partitionId(), 0, 0, []

        def flush() -> pa.RecordBatch:
            name = save(folder, f"pages-{part:06d}-{seq:05d}.warc.zst", archive(records))
            return pa.RecordBatch.from_pydict({"file": [name], "n_records": [len(records)]})

        for batch in batches:
            columns = [batch.column(i) for i in range(4)]
            for i in range(batch.num_rows):
                page_id, url, html, refers_to = (c[i].as_py() for c in columns)
                payload = html.encode()
                if records and held + len(payload) > ARCHIVE_BYTES:
                    yield flush()
                    records, held, seq = [], 0, seq + 1
                records.append(record(page_id, url, payload, refers_to, date))
                held += len(payload) if refers_to is None else 0
        if records:
            yield flush()

    return materialise(referring.mapInArrow(tidy(write), "file string, n_records long"), "archives")


def read_archives(files: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """One row per record of the archives, validated: page_id, url, payload_bytes, payload_digest, record_type, refers_to
    and, where asked for, payload (null for revisits)."""
    schema = {
        "page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
        "record_type": pa.string(), "refers_to": pa.int64(),
    } | ({"payload": pa.binary()} if payloads else {})

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found, n = [], 0
                for item in records_of(load(folder, row["file"])):
                    found.append({k: item[k] for k in schema})
                    n += 1
                    if len(found) == 500:
                        yield pa.RecordBatch.from_pylist(found, schema=pa.schema(schema))
                        found = []
                if found:
                    yield pa.RecordBatch.from_pylist(found, schema=pa.schema(schema))
                if n != row["n_records"]:
                    raise ValueError(f"{row['file']} has {n} records, {row['n_records']} were written")

    spread = files.repartition(max(1, min(files.count(), 100_000)))
    kinds = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    return spread.mapInArrow(tidy(read), ", ".join(f"{k} {kinds[v]}" for k, v in schema.items()))


def page_records(pages: DataFrame) -> DataFrame:
    folder = scratch_path(pages.sparkSession, "warc")
    back = read_archives(write_archives(pages, folder), folder)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
