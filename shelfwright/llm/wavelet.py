"""Token ids as wavelet matrices, one compressed file per shard (operator 1).

A shard holds the ids of consecutive documents as bit planes, highest bit first; each plane
orders the ids of the one before by its bit, zeros first, keeping their order. Counts of ones per
block give rank, and from it token access, counting and the places of a token, all without
decoding the shard. Sections are zstd frames behind a JSON header, so a file needs nothing else.

Documents are range partitioned by id, so a task writes a run of ids in order and holds one
shard at a time. A null text is an empty document; a document with equal id stays next to its
like, ordered by text; an empty table gives no file. Other columns are not read.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwright.llm.common import load, materialise, save, scratch_path, tidy
from shelfwright.llm.tokens import default_tokenizer, encoder

MAGIC = b"WVMSHRD1"
SHARD_TOKENS = 1 << 20
BLOCK_WORDS = 8  # of 64 bits: a stored count of ones per 512 bits


def build(ids: np.ndarray, doc_ids: np.ndarray, known: np.ndarray, lengths: np.ndarray) -> list[bytes]:
    """File parts of one shard: ids of all documents in a row, document ids (known: not null), lengths."""
    kind = np.uint16 if len(ids) == 0 or int(ids.max()) < 1 << 16 else np.uint32
    current = ids.astype(kind)
    bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    sections = {"doc_ids": doc_ids.astype("<i8").tobytes(), "known": np.packbits(known).tobytes(), "lengths": lengths.astype("<u8").tobytes()}
    zeros = []
    for level in range(bits - 1, -1, -1):
        ones = (current & kind(1 << level)).astype(bool)
        words = _pack(ones)
        sections[f"plane{level}"] = words.tobytes()
        counts = np.bitwise_count(words).reshape(-1, BLOCK_WORDS).sum(axis=1, dtype=np.uint64)
        sections[f"rank{level}"] = np.cumsum(counts).astype("<u4").tobytes()
        following, low = np.empty_like(current), len(current) - int(counts.sum())
        following[:low], following[low:] = current[np.flatnonzero(~ones)], current[np.flatnonzero(ones)]
        zeros.append(low)
        current = following
    packer = zstandard.ZstdCompressor(level=1, write_checksum=True)
    stored = {name: packer.compress(data) for name, data in sections.items()}
    head = {"n": len(ids), "docs": len(doc_ids), "bits": bits, "zeros": zeros, "sections": {k: len(v) for k, v in stored.items()}}
    text = json.dumps(head).encode()
    return [MAGIC, struct.pack("<I", len(text)), text, *stored.values()]


def _pack(flags: np.ndarray) -> np.ndarray:
    """Bits as 64-bit words, filled up to whole blocks with at least one spare word."""
    data = np.packbits(flags, bitorder="little")
    size = (len(flags) // (64 * BLOCK_WORDS) + 1) * BLOCK_WORDS * 8
    return np.concatenate((data, np.zeros(size - len(data), np.uint8))).view("<u8")


class Shard:
    """Reader of one shard file."""

    def __init__(self, data: bytes) -> None:
        if data[:8] != MAGIC:
            raise ValueError("not a shard file")
        size = struct.unpack_from("<I", data, 8)[0]
        head = json.loads(data[12 : 12 + size])
        self.n, self.bits, self.zeros = head["n"], head["bits"], head["zeros"]
        at, view, sections, unpacker = 12 + size, memoryview(data), {}, zstandard.ZstdDecompressor()
        for name, length in head["sections"].items():
            sections[name] = unpacker.decompress(view[at : at + length])
            at += length
        if at != len(data):
            raise ValueError(f"{len(data) - at} bytes after the last section")
        self.doc_ids = np.frombuffer(sections["doc_ids"], "<i8")
        self.known = np.unpackbits(np.frombuffer(sections["known"], np.uint8), count=head["docs"]).astype(bool)
        self.starts = np.concatenate(([0], np.cumsum(np.frombuffer(sections["lengths"], "<u8").astype(np.int64))))
        if int(self.starts[-1]) != self.n:
            raise ValueError("document lengths do not add up to the ids")
        order = range(self.bits - 1, -1, -1)
        self.planes = [np.frombuffer(sections[f"plane{level}"], "<u8") for level in order]
        self.blocks = [np.concatenate(([0], np.frombuffer(sections[f"rank{level}"], "<u4")[:-1])).astype(np.int64) for level in order]

    def _ones_before(self, plane: int, at: np.ndarray) -> np.ndarray:
        words, word = self.planes[plane], at >> 6
        found = self.blocks[plane][word // BLOCK_WORDS].copy()
        first = word // BLOCK_WORDS * BLOCK_WORDS
        for step in range(BLOCK_WORDS - 1):
            inside = first + step < word
            found[inside] += np.bitwise_count(words[first[inside] + step])
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return found + np.bitwise_count(words[word] & mask)

    def access(self, positions) -> np.ndarray:
        """Ids at the positions."""
        at = np.asarray(positions, dtype=np.int64)
        out = np.zeros(len(at), dtype=np.uint32)
        for plane in range(self.bits):
            one = (self.planes[plane][at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
            before = self._ones_before(plane, at)
            at = np.where(one, self.zeros[plane] + before, at - before)
            out = (out << np.uint32(1)) | one.astype(np.uint32)
        return out

    def _range(self, token: int, end: int) -> tuple[int, int]:
        """Where the token's occurrences before `end` lie after the last plane."""
        if token < 0 or token >> self.bits:
            return 0, 0
        span = np.array([0, end], dtype=np.int64)
        for plane in range(self.bits):
            before = self._ones_before(plane, span)
            span = self.zeros[plane] + before if token >> (self.bits - 1 - plane) & 1 else span - before
        return int(span[0]), int(span[1])

    def rank(self, token: int, end: int) -> int:
        """Occurrences of the token before position `end`."""
        begin, stop = self._range(token, end)
        return stop - begin

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, numbers) -> np.ndarray:
        """Positions of the token's occurrences with these numbers, from 0."""
        begin, stop = self._range(token, self.n)
        at = begin + np.asarray(numbers, dtype=np.int64)
        if len(at) and (at.min() < begin or at.max() >= stop):
            raise IndexError("no such occurrence")
        for plane in range(self.bits - 1, -1, -1):
            one = bool(token >> (self.bits - 1 - plane) & 1)
            at = self._place(plane, at - self.zeros[plane] if one else at, one)
        return at

    def _place(self, plane: int, number: np.ndarray, one: bool) -> np.ndarray:
        """Position of the numbered one or zero of a plane: the last position with so many before it."""
        low, high = np.zeros(len(number), np.int64), np.full(len(number), self.n, np.int64)
        while (high - low > 1).any():
            middle = (low + high) // 2
            before = self._ones_before(plane, middle)
            few = (before if one else middle - before) <= number
            low, high = np.where(few, middle, low), np.where(few, high, middle)
        return low

    def occurrences(self, token: int) -> np.ndarray:
        return self.select(token, np.arange(self.count(token)))

    def decode(self) -> np.ndarray:
        """All ids in order, by undoing the planes from the last to the first."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        values = np.zeros(self.n, dtype=kind)
        for plane in range(self.bits - 1, -1, -1):
            ones = np.unpackbits(self.planes[plane].view(np.uint8), count=self.n, bitorder="little").view(bool)
            before, zeros = np.empty_like(values), self.zeros[plane]
            before[np.flatnonzero(~ones)] = values[:zeros]
            before[np.flatnonzero(ones)] = values[zeros:] | kind(1 << (self.bits - 1 - plane))
            values = before
        return values


def write_shards(
    docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
    end_id: int = 0, shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """Encode every whole text, end it with `end_id` and write shards into `folder`.

    Gives one row per file, read from a written table: file, part and seq (both ascending with
    the document id), n_docs, n_tokens, start (ids in all files before).
    """
    path = tokenizer or default_tokenizer()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(path), np.array([end_id], "<u4").tobytes()
        part = TaskContext.get().partitionId()
        ids: list[bytes] = []
        docs_in: list[int | None] = []
        held = seq = 0

        def flush() -> pa.RecordBatch:
            lengths = np.fromiter((len(x) // 4 for x in ids), np.int64, len(ids))
            tokens = np.frombuffer(b"".join(ids), "<u4")
            known = np.array([x is not None for x in docs_in])
            numbers = np.array([0 if x is None else x for x in docs_in], dtype=np.int64)
            name = save(folder, f"shard-{part:06d}-{seq:05d}.wvm", build(tokens, numbers, known, lengths))
            row = {"file": [name], "part": [part], "seq": [seq], "n_docs": [len(ids)], "n_tokens": [len(tokens)]}
            return pa.RecordBatch.from_pydict(row, schema=pa.schema(MANIFEST))

        for batch in batches:
            for number, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = encode(text.as_py()) + end
                if ids and held + len(found) // 4 > shard_tokens:
                    yield flush()
                    ids, docs_in, held, seq = [], [], 0, seq + 1
                ids.append(found)
                docs_in.append(number)
                held += len(found) // 4
        if ids:
            yield flush()

    columns = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = columns.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    files = materialise(ordered.mapInArrow(tidy(write), "file string, part long, seq long, n_docs long, n_tokens long"), "shards")
    # Starts: sums over the parts (one row per task), then over the files of a part.
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    numbered = files.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return materialise(
        numbered.join(offsets, "part").select(*MANIFEST, (F.col("part_start") + F.col("inside")).alias("start")), "manifest"
    )


MANIFEST = {"file": pa.string(), "part": pa.int64(), "seq": pa.int64(), "n_docs": pa.int64(), "n_tokens": pa.int64()}


def slices(data: memoryview, at: np.ndarray) -> pa.Array:
    """The bytes between consecutive positions, not copied. (`pa.array` never lets go of memoryviews that it is given.)"""
    places = pa.py_buffer((at - at[0]).astype("<i4"))
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, places, pa.py_buffer(data[at[0] : at[-1]])])


def read_shards(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids (packed 32-bit), in parallel over files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(load(folder, row["file"]))
                if (shard.n, len(shard.doc_ids)) != (row["n_tokens"], row["n_docs"]):
                    raise ValueError(f"{row['file']} does not hold what was written")
                packed = memoryview(shard.decode().astype("<u4").tobytes())
                for begin in range(0, len(shard.doc_ids), 1000):
                    end = min(begin + 1000, len(shard.doc_ids))
                    at = shard.starts[begin : end + 1]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(shard.doc_ids[begin:end], pa.int64(), mask=~shard.known[begin:end]),
                            pa.array(at[:-1] + row["start"], pa.int64()),
                            pa.array(np.diff(at), pa.int64()),
                            slices(packed, 4 * at),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )

    count = manifest.count()
    spread = manifest.repartition(max(1, min(count, 100_000)))
    return spread.mapInArrow(tidy(read), "doc_id long, start long, n_tokens long, ids binary")


def token_shards(docs: DataFrame) -> DataFrame:
    """Write the shards, read them back: doc_id, start, n_tokens, ids_crc32 of each document."""
    folder = scratch_path(docs.sparkSession, "wavelet")
    back = read_shards(write_shards(docs, folder), folder)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
