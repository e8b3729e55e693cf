"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwright.session import discard, materialise, scratch_path, tune

__all__ = ["discard", "materialise", "scratch_path"]

# Words everywhere in this folder: runs without space, tab, line feed, vertical
# tab, form feed and carriage return. bytes.split() splits at exactly these.
SEPARATORS = b" \t\n\x0b\x0c\r"

_PRIME = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_PRIME, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


# Texts reach Python in batches of about this size, so that a worker's memory is bounded by it.
ARROW_BYTES = 8 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """The library's runtime settings, with smaller Arrow batches."""
    tune(spark).conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark


def tidy(work):
    """`work` on batches, giving memory back to the system when a task ends: Python workers live on."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # only some systems have it
            ctypes.CDLL(None).malloc_trim(0)

    return tidied


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def words_of(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode().split()


def mix(values: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values, so that their order is as if random."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _power_table(kind: str, base: int, length: int) -> np.ndarray:
    table = _powers.get(kind)
    if table is None or len(table) < length:
        size = max(1 << 16, 1 << (length - 1).bit_length())
        table = np.full(size, base, dtype=np.uint64)
        table[0] = 1
        np.multiply.accumulate(table, out=table)
        _powers[kind] = table
    return table[:length]


class SliceHash:
    """64-bit hashes of slices of one row of numbers, each found from prefix sums in constant time."""

    def __init__(self, values: np.ndarray) -> None:
        length = len(values)
        self._prefix = np.zeros(length + 1, dtype=np.uint64)
        weighted = values.astype(np.uint64)
        weighted += np.uint64(1)
        weighted *= _power_table("up", _PRIME, length + 1)[:length]
        np.cumsum(weighted, out=self._prefix[1:])
        self._down = _power_table("down", _INVERSE, length + 1)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Equal slices get equal hashes; the length takes part."""
        found = (self._prefix[ends] - self._prefix[starts]) * self._down[starts]
        return mix(found + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


HASHED_BYTES = 1 << 20  # of words hashed at a time


class WordBuffer:
    """Words of several texts in one byte buffer, one space after each word.

    `starts` and `ends` are byte positions of the words, `owner` the text of each word and
    `first` the number of the first word of each text, with the word count at the end.
    """

    def __init__(self, data: bytes, counts: np.ndarray) -> None:
        self.data = data
        self.first = np.concatenate(([0], np.cumsum(counts)))
        self._buffer = np.frombuffer(data, dtype=np.uint8)
        self.ends = np.flatnonzero(self._buffer == 32)
        if len(self.ends) != int(self.first[-1]):
            raise ValueError("word counts do not fit the buffer")
        self.starts = np.concatenate(([0], self.ends[:-1] + 1)) if len(self.ends) else self.ends
        self.owner = np.repeat(np.arange(len(counts)), counts)
        self._hash: SliceHash | None = None

    @classmethod
    def of(cls, texts: list[list[bytes]]) -> WordBuffer:
        data = b"".join(b" ".join(words) + b" " for words in texts if words)
        return cls(data, np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)))

    def __len__(self) -> int:
        return len(self.ends)

    def word_hashes(self) -> np.ndarray:
        out, begin = np.zeros(len(self), dtype=np.uint64), 0
        while begin < len(self):
            base = self.starts[begin]
            end = max(begin + 1, int(np.searchsorted(self.ends, base + HASHED_BYTES)))
            part = SliceHash(self._buffer[base : self.ends[end - 1] + 1])
            out[begin:end] = part(self.starts[begin:end] - base, self.ends[begin:end] - base)
            begin = end
        return out

    def hashes(self, first_word: np.ndarray, last_word: np.ndarray) -> np.ndarray:
        """Hash of the words first..last, both included."""
        if self._hash is None:
            self._hash = SliceHash(self.word_hashes())
        return self._hash(first_word, last_word + 1)

    def runs(self, length: int) -> np.ndarray:
        """First words of all runs of `length` words within one text, ascending."""
        if len(self) < length:
            return np.zeros(0, dtype=np.int64)
        at = np.arange(len(self) - length + 1)
        return at[self.owner[at] == self.owner[at + length - 1]]

    def slice(self, first_word: int, last_word: int) -> bytes:
        return self.data[self.starts[first_word] : self.ends[last_word]]


def chunks_by_bytes(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items of at most `limit` bytes, or of one item."""
    begin, total = 0, 0
    for i, size in enumerate(sizes):
        if i > begin and total + size > limit:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Split sorted batches at changes of the key: (key, slice of a batch) in order.

    A group longer than a batch comes in several slices, so that no group need fit in memory.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        change = np.zeros(batch.num_rows, dtype=bool)
        change[0] = True
        columns = [batch.column(batch.schema.get_field_index(k)) for k in keys]
        for column in columns:
            values = column.to_numpy(zero_copy_only=False)
            change[1:] |= values[1:] != values[:-1]
        starts = np.flatnonzero(change)
        for begin, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            yield tuple(c[int(begin)].as_py() for c in columns), batch.slice(int(begin), int(end - begin))


def vectors(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column of equal lengths as a matrix of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def usable_vector(c: Column) -> Column:
    """Not null, not zero, all components finite."""
    x = F.transform(c, lambda v: v.cast("double"))
    finite = F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    return F.coalesce(c.isNotNull() & finite & F.exists(x, lambda v: v != 0), F.lit(False))


def hashed_sample(rows: DataFrame, key: str, total: int, most: int) -> DataFrame:
    """The `most` rows of smallest hash of a key, out of `total`.

    Rows are first narrowed to about twice as many by the hash alone, so that no task sees more, however many
    partitions there are.
    """
    hashed = F.xxhash64(key)
    low = -(1 << 63)
    if total > 2 * most:
        rows = rows.filter(hashed < low + (1 << 64) * 2 * most // total)
    return rows.orderBy(hashed, key).limit(most)


def scaled(matrix: np.ndarray) -> np.ndarray:
    """Rows divided by a power of two near their largest component: exact, and squares stay in range."""
    _, exponent = np.frexp(np.abs(matrix).max(axis=1, keepdims=True))
    return np.ldexp(matrix, -exponent)


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    rows = scaled(matrix)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def components(edges: DataFrame, label: str) -> DataFrame:
    """Connected components of edges (a, b): (node, component), component = smallest node.

    Alternates large and small stars: each round every node sends its neighbours to its
    smallest one. Minima are aggregates combined before the shuffle, and go back to the edges by
    a join with one row per node on the other side. The edges of a node with very many of them are two
    numbers each and stay in one task until they reach the size at which Spark splits a join.
    Nothing but two numbers a round comes to the driver. Self loops keep lone nodes.
    """
    current = materialise(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{label}-edges"
    )
    seen = None
    while True:
        both = current.select("u", "v").union(current.filter("u <> v").select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = (
            both.filter("v >= u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        )
        stars = large.distinct()
        least = stars.groupBy("u").agg(F.min("v").alias("low"))
        small = stars.join(least, "u")
        following = small.select("u", F.col("low").alias("v")).union(
            small.select(F.col("v").alias("u"), F.col("low").alias("v"))
        ).distinct()
        previous, current = current, materialise(following, f"{label}-round")
        discard(previous)
        state = current.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")
        ).first()
        if seen == (state["n"], state["s"]):
            break
        seen = (state["n"], state["s"])
    return current.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))


def local_components(links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Components of a bipartite link matrix: a label per row and per column (equal: connected)."""
    rows, cols = links.shape
    row_label = np.arange(rows)
    col_label = np.full(cols, rows)
    while True:
        new_cols = np.where(links, row_label[:, None], rows).min(axis=0) if rows else col_label
        new_rows = np.minimum(row_label, np.where(links, new_cols[None, :], rows).min(axis=1)) if cols else row_label
        if (new_rows == row_label).all() and (new_cols == col_label).all():
            return row_label, col_label
        row_label, col_label = new_rows, new_cols


def save(folder: str, name: str, parts: list[bytes]) -> str:
    """Write a file into a shared folder under a name of its own; gives that name.

    The name is unique to the attempt, so a retried or speculative task never touches a file that
    another attempt has written; only names that a finished task reports are ever read.
    """
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    own = re.sub(r"(\.\w+)?$", rf"-{uuid.uuid4().hex}\1", name, count=1)
    with store.open_output_stream(f"{path}/{own}", compression=None) as out:
        for part in parts:
            out.write(part)
    return own


def load(folder: str, name: str) -> bytes:
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder)
    with store.open_input_file(f"{path}/{name}") as source:
        return source.read()
