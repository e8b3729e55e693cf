"""Hierarchical packing into several context sizes (operator 11).

A document is cut into full pieces of the longest tier; what is left is routed to the shortest tier that holds it whole.
Tiers are packed from long to short, best fit decreasing: an item goes to the fullest open sequence that holds it, of its own tier
or a longer one, so gaps in long sequences fill with whole items of shorter tiers before those open sequences of their own.
The gaps that remain are filled to the last token: the sequences opened last, of the shortest items, are
taken apart until their items make up all gaps before them, and those items are cut where gaps end. What is left over after
the last gap, less than one sequence, is cut at powers of two. So every sequence is full, and only items of the
sequences taken apart are cut below the longest tier. Finally sequences are dealt to training steps, longest first, each to the step
with the fewest tokens; steps differ by at most one longest sequence.

Lengths decide all of this, and there are at most as many as the longest tier has tokens: their counts, summed on the
executors, are all that the driver sees, and the plan is a table of runs (items a..b of a length go to sequences from s on).
Items are numbered within their length by the task that writes them; counts of tasks turn that into a rank.

A null text is empty; each document ends with `end_id`. A document with equal id and text is a document of its own; null
ids are allowed. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwright.llm.common import materialise, tidy
from shelfwright.llm.tokens import default_tokenizer, encoder

TIERS = (2048, 1024, 512, 256)
STEP_TOKENS = 16 * 2048
DOCS_AT_ONCE = 500


@dataclass
class Plan:
    """Where items go, by length and rank, and what sequences and steps there are."""

    # length: [first rank, first sequence, items per sequence, offset], in order of rank
    whole: dict[int, list[tuple[int, int, int, int]]] = field(default_factory=dict)
    # length: [first rank, place on the tape]; these items are cut where gaps end
    tape: dict[int, list[tuple[int, int]]] = field(default_factory=dict)
    gaps: list[tuple[int, int, int, int]] = field(default_factory=list)  # place on the tape, room, first sequence, offset
    sequences: list[tuple[int, int, int]] = field(default_factory=list)  # first sequence, number of sequences, size
    steps: list[tuple[int, int]] = field(default_factory=list)  # first sequence, its step; following sequences go to following steps


def _best_fit(counts: dict[int, int], tiers: tuple[int, ...]):
    """Runs (length, first rank, items, first sequence, per sequence, offset) and sequences (first, number, size, room)."""
    rooms: dict[int, list[tuple[int, int, int]]] = {}
    open_rooms: list[int] = []
    runs, opened = [], 0

    def add(room: int, first: int, number: int, size: int) -> None:
        if not rooms.setdefault(room, []):
            insort(open_rooms, room)
        rooms[room].append((first, number, size))

    for length in sorted(counts, reverse=True):
        placed, left = 0, counts[length]
        while left:
            at = bisect_left(open_rooms, length)
            if at < len(open_rooms):
                room = open_rooms[at]
                first, number, size = rooms[room].pop()
                if not rooms[room]:
                    open_rooms.pop(at)
                used = min(number, -(-left // (room // length)))
                if used < number:
                    add(room, first + used, number - used, size)
            else:
                room = size = min(t for t in tiers if t >= length)
                first, used = opened, -(-left // (room // length))
                opened += used
            each = room // length  # the sequence stays the fullest while the next item still fits
            items = min(left, used * each)
            runs.append((length, placed, items, first, each, size - room))
            full, rest = divmod(items, each)
            if full:
                add(room - each * length, first, full, size)
            if rest:
                add(room - rest * length, first + full, 1, size)
            placed, left = placed + items, left - items
    return runs, sorted((first, number, size, room) for room, held in rooms.items() for first, number, size in held)


def _kept(sequences: list[tuple[int, int, int, int]]) -> int:
    """Sequences to keep: the rest, taken apart, holds at least the room of those before it, with as few as possible."""
    room = sum(number * left for _, number, _, left in sequences)
    kept = sum(number for _, number, _, _ in sequences)
    for _, number, size, _ in reversed(sequences):
        # A sequence taken apart gives its content and takes its own room away: its size in all.
        apart = min(number, -(-room // size))
        kept, room = kept - apart, room - apart * size
        if room <= 0:
            break
    return kept


def plan(counts: dict[int, int], tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS) -> Plan:
    """Places for `counts` items by length; `tiers` are powers of two, falling."""
    runs, sequences = _best_fit(counts, tiers)
    kept, out, tape = _kept(sequences), Plan(), 0
    for length, rank, items, first, each, offset in runs:
        stay = min(items, max(0, kept - first) * each)
        if stay:
            out.whole.setdefault(length, []).append((rank, first, each, offset))
        if stay < items:
            out.tape.setdefault(length, []).append((rank + stay, tape))
            tape += (items - stay) * length
    filled = 0
    for first, number, size, room in sequences:
        number = min(number, kept - first)
        if number > 0:
            out.sequences.append((first, number, size))
            if room:
                out.gaps.append((filled, room, first, size - room))
                filled += number * room
    for bit in range(tiers[0].bit_length() - 1, -1, -1):
        if (tape - filled) >> bit:
            out.gaps.append((filled, 1 << bit, kept, 0))
            out.sequences.append((kept, 1, 1 << bit))
            filled, kept = filled + (1 << bit), kept + 1
    total = sum(number * size for _, number, size in out.sequences)
    loads = [(0, 0, max(1, round(total / step_tokens)))]  # tokens, first step, number of steps
    for first, number, size in sorted(out.sequences, key=lambda s: (-s[2], s[0])):
        while number:
            load, step, steps = heapq.heappop(loads)
            used = min(number, steps)
            out.steps.append((first, step))
            heapq.heappush(loads, (load + size, step, used))
            if used < steps:
                heapq.heappush(loads, (load, step + used, steps - used))
            first, number = first + used, number - used
    out.steps.sort()
    return out


class Places:
    """A plan as arrays, for looking up many items."""

    def __init__(self, made: Plan) -> None:
        self.whole = {k: np.array(v, dtype=np.int64) for k, v in made.whole.items()}
        self.tape = {k: np.array(v, dtype=np.int64) for k, v in made.tape.items()}
        self.gaps = np.array(made.gaps, dtype=np.int64).reshape(-1, 4)
        self.sequences = np.array(made.sequences, dtype=np.int64).reshape(-1, 3)
        self.steps = np.array(made.steps, dtype=np.int64).reshape(-1, 2)

    def of(self, length: int, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sequence and offset of each item of a length, or its place on the tape (else -1)."""
        sequence, offset, tape = (np.full(len(ranks), -1) for _ in range(3))
        whole, cut = self.whole.get(length), self.tape.get(length)
        none = np.full(len(ranks), -1)
        at = none if whole is None else np.searchsorted(whole[:, 0], ranks, side="right") - 1
        on = none if cut is None else np.searchsorted(cut[:, 0], ranks, side="right") - 1
        start = none if whole is None else np.where(at >= 0, whole[at, 0], -1)
        begin = none if cut is None else np.where(on >= 0, cut[on, 0], -1)
        here = start > begin  # runs of both kinds take turns; the later one holds the item
        if whole is not None:
            row = whole[at[here]]
            inside = ranks[here] - row[:, 0]
            sequence[here] = row[:, 1] + inside // row[:, 2]
            offset[here] = row[:, 3] + length * (inside % row[:, 2])
        if cut is not None:
            row = cut[on[~here]]
            tape[~here] = row[:, 1] + (ranks[~here] - row[:, 0]) * length
        return sequence, offset, tape

    def cuts(self, place: int, length: int) -> Iterator[tuple[int, int, int, int]]:
        """Pieces (start, length, sequence, offset) of an item at a place on the tape."""
        done, at = 0, int(np.searchsorted(self.gaps[:, 0], place, side="right")) - 1
        while done < length:
            filled, room, first, offset = map(int, self.gaps[at])
            end = int(self.gaps[at + 1, 0]) if at + 1 < len(self.gaps) else None
            while done < length and (end is None or place + done < end):
                number, inside = divmod(place + done - filled, room)
                size = min(room - inside, length - done)
                yield done, size, first + number, offset + inside
                done += size
            at += 1

    def tier_and_step(self, sequence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = self.steps[np.searchsorted(self.steps[:, 0], sequence, side="right") - 1]
        sizes = self.sequences[np.searchsorted(self.sequences[:, 0], sequence, side="right") - 1, 2]
        return sizes, row[:, 1] + sequence - row[:, 0]


ITEMS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, inner long, ids binary"


def items_of(docs: DataFrame, tokenizer: str | None, longest: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """Full pieces and the rest of every document; `inner` numbers the items of a task with equal length.

    `ids` holds the rest's ids, packed in 16 bits if they fit, else in 32.
    """
    path = tokenizer or default_tokenizer()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(path), np.array([end_id], "<u4").tobytes()
        part, seen = TaskContext.get().partitionId(), Counter()
        kinds = [pa.int64()] * 5 + [pa.int32(), pa.int64(), pa.binary()]
        names = [f.split(" ")[0] for f in ITEMS.split(", ")]
        for batch in batches:
            for begin in range(0, batch.num_rows, DOCS_AT_ONCE):
                rows: list[tuple] = []
                some = batch.slice(begin, DOCS_AT_ONCE)
                for number, text in zip(some.column(0).to_pylist(), some.column(1), strict=True):
                    ids = encode(text.as_py()) + end
                    total = len(ids) // 4
                    for start in range(0, total, longest):
                        held = ids[4 * start : 4 * (start + longest)]
                        length, packed = len(held) // 4, None
                        if length < longest:
                            values = np.frombuffer(held, "<u4")
                            packed = values.astype("<u2").tobytes() if values.max() < 1 << 16 else held
                        rows.append((number, start, length, zlib.crc32(held), total, part, seen[length], packed))
                        seen[length] += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(tidy(cut), ITEMS)


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier long, step long"


def _placed(made: Plan):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = Places(made)
        names = [f.split(" ")[0] for f in PIECES.split(", ")]
        for batch in batches:
            if batch.num_rows == 0:
                continue
            column = lambda name: batch.column(batch.schema.get_field_index(name))  # noqa: B023, E731
            start, length, crc, tokens, rank = (column(c).to_numpy().astype(np.int64) for c in ("start", "length", "ids_crc32", "doc_tokens", "rank"))
            sequence, offset, tape = (np.full(len(rank), -1) for _ in range(3))
            for size in np.unique(length):
                at = np.flatnonzero(length == size)
                sequence[at], offset[at], tape[at] = places.of(int(size), rank[at])
            stay, go = np.flatnonzero(tape < 0), np.flatnonzero(tape >= 0)
            source, more = [], []
            for i, held in zip(go, column("ids").take(pa.array(go)), strict=True):
                packed, n = held.as_buffer(), int(length[i])
                ids = np.frombuffer(packed, "<u2" if packed.size == 2 * n else "<u4").astype("<u4")
                for begin, size, own, inside in places.cuts(int(tape[i]), n):
                    source.append(i)
                    more.append((start[i] + begin, size, zlib.crc32(ids[begin : begin + size].tobytes()), tokens[i], own, inside))
            cut = np.array(more, dtype=np.int64).reshape(-1, 6).T
            every = [np.concatenate((v[stay], c)) for v, c in zip((start, length, crc, tokens, sequence, offset), cut, strict=True)]
            rows = np.concatenate((stay, np.array(source, dtype=np.int64)))
            yield pa.RecordBatch.from_arrays(
                [column("doc_id").take(pa.array(rows)), *map(pa.array, every), *map(pa.array, places.tier_and_step(every[4]))], names=names
            )

    return place


def packed_tiers(
    docs: DataFrame, tokenizer: str | None = None, tiers: tuple[int, ...] = TIERS, end_id: int = 1, step_tokens: int = STEP_TOKENS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step of every piece."""
    items = materialise(items_of(docs, tokenizer, tiers[0], end_id, id_col, text_col), "items")
    counts = materialise(items.groupBy("length", "part").agg(F.count("*").alias("n")), "counts")
    # At most tiers[0] rows, whatever the number of documents.
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    made = plan(totals, tiers, step_tokens)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    # Only items that are cut need their ids again.
    ids = F.when(F.col("length").isin(list(made.tape)), F.col("ids")).alias("ids")
    ranked = items.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "inner", ids).join(offsets, ["length", "part"])
    shape = ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("before") + F.col("inner")).alias("rank"), "ids")
    return shape.mapInArrow(tidy(_placed(made)), PIECES)
