"""Best-fit decreasing packing of token sequences (operator 6).

Documents longer than a sequence are cut into full pieces after a first, shorter one. Pieces are then
placed longest first, each into the open sequence with the least room that holds it. Only lengths
matter for that, and there are at most `capacity` of them: their counts, summed on the executors, are all
the driver sees. It keeps the open sequences by remaining room in a segment tree, finds the tightest room in
logarithmic time and places all pieces of a length that this sequence and its equals take in one step, with
the outcome of placing them one by one. The plan is a table of runs: pieces a..b of a length go to
sequences from s on, so many each, from an offset on. Pieces are numbered within their length in two
steps (counts per chunk, then numbers inside a chunk), so that a very common length is no single group.

A null text is empty; each document ends with `end_id`. A document with equal id and text is a document of its
own; null ids are allowed. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwright.llm.common import materialise, tidy
from shelfwright.llm.tokens import default_tokenizer, encoder

CAPACITY = 1024
CHUNKS = 1024  # of pieces of a length, numbered on their own


class RoomTree:
    """Open sequences by remaining room: which room of at least so much occurs, in logarithmic time."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.total = [0] * (2 * self.size)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, first: int, count: int) -> None:
        """`count` sequences numbered from `first` now have this room."""
        self.runs[room].append((first, count))
        self._change(room, count)

    def take(self, room: int, most: int) -> tuple[int, int]:
        """Remove a run of at most `most` sequences with this room."""
        first, count = self.runs[room].pop()
        used = min(count, most)
        if used < count:
            self.runs[room].append((first + used, count - used))
        self._change(room, -used)
        return first, used

    def _change(self, room: int, by: int) -> None:
        node = self.size + room
        while node:
            self.total[node] += by
            node >>= 1

    def tightest(self, least: int) -> int | None:
        """The smallest room of at least `least` that a sequence has."""
        node = self.size + least
        if self.total[node]:
            return least
        while node > 1:
            if node % 2 == 0 and self.total[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.total[2 * node] else 2 * node + 1
                return node - self.size
            node >>= 1
        return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing for `counts` pieces by length.

    Rows (length, first piece, pieces, first sequence, per sequence, offset): piece first + i of the length goes
    to sequence first sequence + i // per sequence, at offset + length * (i % per sequence).
    """
    tree, opened, out = RoomTree(capacity), 0, []
    for length in sorted(counts, reverse=True):
        placed, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first = capacity, opened
                used = -(-left // (room // length))
                opened += used
            else:
                first, used = tree.take(room, -(-left // (room // length)))
            # A sequence stays the tightest while the next piece still fits, so it takes all it holds.
            each = room // length
            pieces = min(left, used * each)
            out.append((length, placed, pieces, first, each, capacity - room))
            full, rest = divmod(pieces, each)
            if full:
                tree.add(room - each * length, first, full)
            if rest:
                tree.add(room - rest * length, first + full, 1)
            placed, left = placed + pieces, left - pieces
    return out


def pieces_of(
    docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = 2, with_ids: bool = False,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, where asked for, ids (packed little-endian 32-bit) of every piece."""
    path = tokenizer or default_tokenizer()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(path), np.array([end_id], "<u4").tobytes()
        fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
        schema = pa.schema(fields + ([("ids", pa.binary())] if with_ids else []))
        for batch in batches:
            for begin in range(0, batch.num_rows, 1000):
                rows: list[tuple] = []
                part = batch.slice(begin, 1000)
                for number, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    ids = encode(text.as_py()) + end
                    n = len(ids) // 4
                    cuts = [0, n] if n <= capacity else [0, *range(n % capacity or capacity, n + 1, capacity)]
                    for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                        held = ids[4 * a : 4 * b]
                        rows.append((number, piece, a, b - a, zlib.crc32(held), held)[: len(schema)])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    columns = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return source.mapInArrow(tidy(cut), columns)


def pack(pieces: DataFrame, capacity: int = CAPACITY, chunks: int = CHUNKS) -> DataFrame:
    """The pieces with sequence_id and offset; `length` is 1 to `capacity` in every row."""
    spread = pieces.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "start"), F.lit(chunks)))
    numbered = materialise(
        spread.withColumn(
            "inner", F.row_number().over(Window.partitionBy("length", "chunk").orderBy("doc_id", "start")) - 1
        ),
        "pieces",
    )
    counts = numbered.groupBy("length", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).select("length", "chunk", "before")
    # At most `capacity` rows, whatever the number of pieces.
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    if totals and (min(totals) < 1 or max(totals) > capacity):
        raise ValueError(f"lengths must be 1 to {capacity}")
    runs: dict[int, list] = {}
    for length, first, n, sequence, each, offset in plan(totals, capacity):
        runs.setdefault(length, []).append((first, n, sequence, each, offset))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {k: np.array(v, dtype=np.int64) for k, v in runs.items()}
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            rank = batch.column(batch.schema.get_field_index("rank")).to_numpy()
            sequence, offset = np.zeros_like(rank), np.zeros_like(rank)
            for size in np.unique(length):
                at = np.flatnonzero(length == size)
                table = tables[int(size)]
                row = table[np.searchsorted(table[:, 0], rank[at], side="right") - 1]
                inside = rank[at] - row[:, 0]
                sequence[at] = row[:, 2] + inside // row[:, 3]
                offset[at] = row[:, 4] + size * (inside % row[:, 3])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequence), pa.array(offset)], names=[*batch.schema.names, "sequence_id", "offset"])

    ranked = numbered.join(offsets, ["length", "chunk"]).withColumn("rank", F.col("inner") + F.col("before"))
    columns = [c for c in pieces.columns if c != "length"]
    shape = ranked.select(*columns, "length", "rank")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in shape.schema)
    return shape.mapInArrow(tidy(place), f"{schema}, sequence_id long, offset long").drop("rank")


def packed_documents(docs: DataFrame) -> DataFrame:
    """Every piece of every document and its place."""
    return pack(pieces_of(docs)).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
