"""Removal of repeated word windows by super-k-mer partitioning (operator 4).

A window is `width` consecutive words of one document. Its minimiser is the smallest hash of the
`seed` word runs in it. Consecutive windows that share a minimiser travel as one packed string to the
bucket of that minimiser, so equal windows always meet, and a word travels about three times instead of
`width` times. In the bucket, hashes of all windows are sorted; windows of equal hash are compared
as bytes; the earliest keeps its place and the others are marked.

Super-k-mers that occur again within a batch stay there: only the first travels, the others are
marked at once. A first pass counts minimisers; windows of those with more than HOT_SHARE of all
super-k-mers (and more than HOT_ROWS of them) travel one by one, spread by their own hash, so a phrase
that is very common in different surroundings does not gather in one bucket. At most 2 / HOT_SHARE such
hashes exist, which bounds what the driver passes on. There are as many buckets as make about BUCKET_BYTES of text each on
average; the bucket of a minimiser just below that share grows with the corpus.

Documents are ordered by id, null last; rows that repeat an id by a hash of their text. Rows equal in id and
text are one document: they get the same result and do not repeat each other. A null or blank text has
no words. Documents with fewer words than a window keep them all. Other columns are passed on.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfwright.llm.common import WordBuffer, chunks_by_bytes, grouped, materialise, tidy

WIDTH = 20
SEED = 3
HOT_SHARE = 1 / 16_384
HOT_ROWS = 20_000
BUCKET_BYTES = 6 << 20
BATCH_BYTES = 8 << 20
LAST = (1 << 63) - 1


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of `width` values."""
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    return values if done == width else np.minimum(values[: done - width], values[width - done :])


def windows_of(words: WordBuffer, width: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of the windows and their minimisers."""
    at = words.runs(width)
    if len(at) == 0:
        return at, np.zeros(0, np.uint64)
    first = np.arange(len(words) - seed + 1)
    # Runs over a border between texts get a hash too; no window inside a text holds one.
    return at, sliding_min(words.hashes(first, first + seed - 1), width - seed + 1)[at]


def super_kmers(words: WordBuffer, width: int, seed: int, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words, last words (included) and bucket keys of the super-k-mers, in order."""
    at, least = windows_of(words, width, seed)
    if len(at) == 0:
        return at, at, least
    common = np.isin(least, hot)
    begins = np.ones(len(at), dtype=bool)
    begins[1:] = (at[1:] != at[:-1] + 1) | (least[1:] != least[:-1]) | common[1:]
    begin = np.flatnonzero(begins)
    last = at[np.concatenate((begin[1:], [len(at)])) - 1] + width - 1
    first, key = at[begin], least[begin]
    single = common[begin]
    key[single] = words.hashes(first[single], last[single])
    return first, last, key


def _text_batches(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, WordBuffer]]:
    """Documents of a batch in order, in parts of bounded size: ids, text hashes, words."""
    number, mark = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    order = np.lexsort((mark, number))
    sizes = [0 if x is None else x for x in batch.column(3).to_pylist()]
    for begin, end in chunks_by_bytes([sizes[i] for i in order], BATCH_BYTES):
        rows = order[begin:end]
        texts = [batch.column(2)[int(i)].as_py() for i in rows]
        yield number[rows], mark[rows], WordBuffer.of([[] if t is None else t.encode().split() for t in texts])


def _count(width: int, seed: int, tasks: int):
    """Per task: the number and size of its super-k-mers, and its frequent minimisers.

    What all tasks leave out of a minimiser's count is less than half of what makes it hot.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, rows, size = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0, 0
        for batch in batches:
            for _, _, words in _text_batches(batch):
                first, last, key = super_kmers(words, width, seed, np.zeros(0, np.uint64))
                if len(first) == 0:
                    continue
                found, n = np.unique(key, return_counts=True)
                keys, place = np.unique(np.concatenate((keys, found)), return_inverse=True)
                counts = np.bincount(place, np.concatenate((counts, n))).astype(np.int64)
                rows += len(first)
                size += int((words.ends[last] - words.starts[first] + 1).sum())
        if rows:
            often = counts > max(rows * HOT_SHARE, HOT_ROWS / tasks) / 4
            none = np.zeros(int(often.sum()), np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(([0], keys[often].view(np.int64)))), pa.array(np.concatenate(([size], none))),
                    pa.array(np.concatenate(([rows], counts[often]))), pa.array(np.concatenate(([True], none.astype(bool)))),
                ],
                names=["key", "bytes", "n", "total"],
            )

    return count


# Columns of a packed row: document, text hash, first word, words (or word after the last).
PACKED = ("<i8", "<i4", "<i4", "<i4")


def _pack(arrays: list[np.ndarray], text: bytes) -> bytes:
    head = np.array([len(arrays[0])], "<i8").tobytes()
    columns = [a.astype(kind).tobytes() for a, kind in zip(arrays, PACKED, strict=True)]
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(columns) + text)


def _unpack(data: bytes) -> tuple[list[np.ndarray], bytes]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n, at, arrays = int(np.frombuffer(raw, "<i8", 1)[0]), 8, []
    for kind in PACKED:
        arrays.append(np.frombuffer(raw, kind, n, at).astype(np.int64))
        at += n * np.dtype(kind).itemsize
    return arrays, raw[at:]


def _send(width: int, seed: int, hot: np.ndarray, buckets: int):
    """Packed super-k-mers by bucket (kind 0) and spans already known to repeat (kind 1)."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, mark, words in _text_batches(batch):
                first, last, key = super_kmers(words, width, seed, hot)
                if len(first) == 0:
                    continue
                owner = words.owner[first]
                _, head, group = np.unique(words.hashes(first, last), return_index=True, return_inverse=True)
                leader = head[group]
                again = (number[owner[leader]] != number[owner]) | (mark[owner[leader]] != mark[owner]) | (
                    first[leader] - words.first[owner[leader]] != first - words.first[owner]
                )
                for i in np.flatnonzero(again):  # equal hashes, compared as bytes
                    if words.slice(first[i], last[i]) != words.slice(first[leader[i]], last[leader[i]]):
                        again[i] = False
                places, kinds, blobs = [], [], []
                if again.any():
                    own = owner[again]
                    at = first[again] - words.first[own]
                    places.append(int(number[own[0]]) % buckets)
                    kinds.append(1)
                    blobs.append(_pack([number[own], mark[own], at, last[again] - first[again] + 1 + at], b""))
                sent = np.flatnonzero(~again)
                place = (key[sent] % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(place, kind="stable")
                sent, place = sent[order], place[order]
                edges = np.concatenate(([0], np.flatnonzero(place[1:] != place[:-1]) + 1, [len(place)]))
                data, begin, end = words.data, words.starts[first], words.ends[last] + 1
                for a, b in zip(edges, edges[1:], strict=False):
                    rows = sent[a:b]
                    own = owner[rows]
                    text = b"".join([data[i:j] for i, j in zip(begin[rows].tolist(), end[rows].tolist(), strict=True)])
                    places.append(int(place[a]))
                    kinds.append(0)
                    blobs.append(_pack([number[own], mark[own], first[rows] - words.first[own], last[rows] - first[rows] + 1], text))
                for a in range(0, len(places), 64):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x[a : a + 64], t) for x, t in ((places, pa.int64()), (kinds, pa.int32()), (blobs, pa.binary()))],
                        names=["bucket", "kind", "blob"],
                    )

    return send


def repeated_windows(words: WordBuffer, position: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows that equal one at a smaller position: (owner, offset of the window's first word in it).

    `position` holds (document, text hash, first word) of each text of `words`.
    """
    at = words.runs(width)
    mark = words.hashes(at, at + width - 1)
    order = np.argsort(mark, kind="stable")
    same = mark[order][1:] == mark[order][:-1]
    member = np.zeros(len(at), dtype=bool)
    member[order[1:][same]] = member[order[:-1][same]] = True
    at, mark = at[member], mark[member]
    if len(at) == 0:
        return at, at
    owner = words.owner[at]
    offset = at - words.first[owner]
    place = position[2][owner] + offset
    order = np.lexsort((place, position[1][owner], position[0][owner], mark))
    at, mark, owner, offset, place = at[order], mark[order], owner[order], offset[order], place[order]
    begins = np.concatenate(([True], mark[1:] != mark[:-1]))
    leader = np.flatnonzero(begins)[np.cumsum(begins) - 1]
    # Runs of neighbouring windows with neighbouring leaders are compared as one slice.
    by_place = np.argsort(at, kind="stable")
    i, f = at[by_place], at[leader][by_place]
    starts = np.concatenate(([0], np.flatnonzero((np.diff(i) != 1) | (np.diff(f) != 1)) + 1, [len(i)]))
    wrong = []
    for a, b in zip(starts, starts[1:], strict=False):
        if i[a] != f[a] and words.slice(i[a], i[b - 1] + width - 1) != words.slice(f[a], f[b - 1] + width - 1):
            wrong += list(by_place[a:b])
    if wrong:  # different windows with one hash: leaders by content
        first_of: dict[bytes, int] = {}
        for w in np.flatnonzero(np.isin(mark, mark[wrong])):
            text = words.slice(at[w], at[w] + width - 1)
            leader[w] = first_of.setdefault(text, w)
    own, head = owner, owner[leader]
    later = (position[0][own] != position[0][head]) | (position[1][own] != position[1][head]) | (place != place[leader])
    return owner[later], offset[later]


def _find(width: int):
    def spans(number, mark, begin, end) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (number, mark, begin, end)], names=["number", "mark", "begin", "end"])

    def solve(blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        parts = [_unpack(b) for b in blobs]
        number, mark, first, size = (np.concatenate([p[0][c] for p in parts]) for c in range(4))
        words = WordBuffer(b"".join(p[1] for p in parts), size)
        owner, offset = repeated_windows(words, [number, mark, first], width)
        order = np.lexsort((offset, owner))
        owner, offset = owner[order], offset[order]
        if len(owner):
            new = np.concatenate(([True], (owner[1:] != owner[:-1]) | (offset[1:] > offset[:-1] + width)))
            last = np.concatenate((np.flatnonzero(new)[1:] - 1, [len(owner) - 1]))
            own = owner[new]
            yield spans(number[own], mark[own], first[own] + offset[new], first[own] + offset[last] + width)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, blobs = None, []
        for (bucket,), piece in grouped(batches, ["bucket"]):
            if bucket != current:
                if blobs:
                    yield from solve(blobs)
                current, blobs = bucket, []
            for kind, blob in zip(piece.column(1).to_pylist(), piece.column(2), strict=True):
                if kind:
                    yield spans(*_unpack(blob.as_py())[0])
                else:
                    blobs.append(blob.as_py())
        if blobs:
            yield from solve(blobs)

    return find


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """Word spans covered by repeated windows: number, mark (see `_keys`), begin, end (excluded); spans may overlap."""
    source = docs.select(*_keys(docs, id_col, text_col), F.col(text_col).alias("text"), F.octet_length(text_col).cast("long").alias("size"))
    counted = source.mapInArrow(tidy(_count(width, seed, source.rdd.getNumPartitions())), "key long, bytes long, n long, total boolean")
    counts = materialise(counted.groupBy("total", "key").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")), "minimisers")
    total = counts.filter("total").first()
    if total is None:  # no document has a window
        empty = "CAST(0 AS BIGINT) AS number", "CAST(0 AS BIGINT) AS mark", "CAST(0 AS BIGINT) AS begin", "CAST(0 AS BIGINT) AS end"
        return docs.filter("false").selectExpr(*empty)
    often = counts.filter(~F.col("total") & (F.col("n") > max(HOT_ROWS, total["n"] * HOT_SHARE) / 2))
    hot = np.array([r["key"] for r in often.select("key").collect()], np.int64).view(np.uint64)
    buckets = max(1, math.ceil(total["bytes"] / BUCKET_BYTES))
    sent = source.mapInArrow(tidy(_send(width, seed, hot, buckets)), "bucket long, kind int, blob binary")
    return sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(tidy(_find(width)), "number long, mark long, begin long, end long"
    )


def _keys(docs: DataFrame, id_col: str, text_col: str) -> list:
    """A document's place in the order: its id, null last, then a hash of its text."""
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("number"), F.hash(text_col).cast("long").alias("mark")]


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, seed: int = SEED
) -> DataFrame:
    """Rows (struct `row` of all columns), n_words, n_removed and `kept`, the words that stay, joined by one space."""
    spans = repeated_spans(docs, id_col, text_col, width, seed)
    # A document's spans are fewer than its words.
    of_doc = spans.groupBy("number", "mark").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), *_keys(docs, id_col, text_col))
    joined = rows.join(of_doc, ["number", "mark"], "left").select("row", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).field(text_col)
            spans_of = batch.column(1)
            counts, removed, kept = [], [], []
            for i in range(batch.num_rows):
                text, found = texts[i].as_py(), spans_of[i]
                words = [] if text is None else text.encode().split()
                counts.append(len(words))
                if found.is_valid:
                    flags = np.zeros(len(words) + 1, dtype=np.int64)
                    pairs = found.values
                    np.add.at(flags, pairs.field("begin").to_numpy(), 1)
                    np.add.at(flags, pairs.field("end").to_numpy(), -1)
                    stay = np.cumsum(flags[:-1]) == 0
                    removed.append(int((~stay).sum()))
                    words = [words[j] for j in np.flatnonzero(stay)]
                else:
                    removed.append(0)
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                names=["row", "n_words", "n_removed", "kept"],
            )

    shape = StructType([joined.schema["row"]]).add("n_words", "long").add("n_removed", "long").add("kept", "string")
    return joined.mapInArrow(tidy(cut), shape)


def word_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of each document."""
    out = remove_repeats(docs.select("doc_id", "text"))
    return out.select("row.doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "utf-8"), 256).alias("kept_sha256"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents with repeated words removed; a text that loses none stays as it is, a text that loses all is dropped."""
    out = remove_repeats(docs).filter((F.col("n_removed") == 0) | (F.col("n_words") > F.col("n_removed")))
    text = F.when(F.col("n_removed") == 0, F.col("row.text")).otherwise(F.col("kept"))
    return out.select(*[text.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
