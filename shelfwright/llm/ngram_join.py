"""N-gram Jaccard join by MinHash banding (operator 9).

A document's set holds the runs of `width` consecutive words, as 64-bit hashes; a document of fewer words
has one run of all of them; one without words takes part in nothing. Two documents are linked if the
Jaccard similarity of their sets is at least `threshold`.

Documents with equal sets form a class and are compared once. Rows and bands of the MinHash table follow
from the recall wanted at the threshold. Class rows are shuffled on band hashes; within a bucket the
first rows become leaders, and a row is tied to every leader that its signature may be near. Two
similar rows of a bucket share a leader by the triangle inequality of the Jaccard distance, so buckets of any
size give a tie per row instead of pairs. Tied rows form groups; their texts are read again, and
pairs are verified on full sets in blocks: a bounded number of rows streams past the inverted index of a
bounded block. Out come link counts and spanning stars, never pairs.

Words are as they stand (`[^\\x20\\x09-\\x0D]+`). Null or blank texts: n_links 0, a group of their own. Rows
that repeat an id are documents of their own. Rows without id count as links of their equals; a set that only
such rows have is compared with no other. A class's id is its smallest id.
Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwright.llm.common import (
    WordBuffer, chunks_by_bytes, components, grouped, local_components, materialise, mix, tidy, words_of,
)

WIDTH = 5
THRESHOLD = 0.8
RECALL = 0.9999  # of a pair exactly at the threshold, by banding
MAX_HASHES = 160
CORE, HALO = 0.6, 0.3  # estimated similarity: joins a leader, is tied to a leader
BATCH_BYTES = 4 << 20
BLOCK_ROWS = 512
PART_ROWS = 2048  # rows that stream past a block in one go
PROBE_ROWS = 128


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows per band): the longest bands that reach the recall at the threshold within `most` hashes."""
    best = (most, 1)
    for rows in range(1, most + 1):
        if threshold**rows < 1e-9:
            break
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows))) if threshold < 1 else 1
        if bands * rows <= most:
            best = (bands, rows)
    return best


class Sets:
    """Sorted distinct runs of several texts: `values`, with those of text i at first[i]:first[i + 1]."""

    def __init__(self, texts: list[list[bytes]], width: int) -> None:
        words = WordBuffer.of(texts)
        at = words.runs(width)
        counts = np.diff(words.first)
        short = np.flatnonzero((counts > 0) & (counts < width))
        first = np.concatenate((at, words.first[short]))
        last = np.concatenate((at + width - 1, words.first[short + 1] - 1))
        marks = words.hashes(first, last) if len(first) else np.zeros(0, np.uint64)
        owner = words.owner[first] if len(first) else first
        order = np.lexsort((marks, owner))
        marks, owner = marks[order], owner[order]
        new = np.ones(len(marks), dtype=bool)
        new[1:] = (marks[1:] != marks[:-1]) | (owner[1:] != owner[:-1])
        self.values, owner = marks[new], owner[new]
        self.first = np.searchsorted(owner, np.arange(len(texts) + 1))
        self.sizes = np.diff(self.first)

    def content(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of each set: two sums over scrambled members."""
        out = []
        for salt in (0x51ED270B, 0x2545F491):
            total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(self.values + np.uint64(salt)))))
            out.append((total[self.first[1:]] - total[self.first[:-1]]).view(np.int64))
        return out[0], out[1]

    def signatures(self, hashes: int, seed: int = 5) -> np.ndarray:
        """Smallest value of each text's members under each hash; rows of empty sets are 0."""
        rng = np.random.default_rng(seed)
        some = np.flatnonzero(self.sizes)
        out = np.zeros((len(self.sizes), hashes), dtype=np.uint64)
        if len(some):
            for j in range(hashes):
                a, b = (rng.integers(0, 1 << 63, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))
                out[some, j] = np.minimum.reduceat(self.values * a + b, self.first[some])
        return out


def _describe(width: int, bands: int, rows: int):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [0 if x is None else x for x in batch.column(2).to_pylist()]
            for begin, end in chunks_by_bytes(sizes, BATCH_BYTES):
                sets = Sets([words_of(batch.column(1)[i].as_py()) for i in range(begin, end)], width)
                low, high = sets.content()
                signs = sets.signatures(bands * rows)
                powers = np.array([pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) for i in range(rows)], dtype=np.uint64)
                keys = mix((mix(signs) * np.tile(powers, bands)).reshape(len(signs), bands, rows).sum(axis=2, dtype=np.uint64))
                sketch = (mix(signs) & np.uint64(255)).astype(np.uint8)
                flat = pa.array(keys.view(np.int64).ravel())
                offsets = pa.array(np.arange(len(signs) + 1) * bands, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(begin, end - begin), batch.column(3).slice(begin, end - begin), pa.array(sets.sizes), pa.array(low), pa.array(high),
                        pa.ListArray.from_arrays(offsets, flat), pa.array([r.tobytes() for r in sketch], pa.binary()),
                    ],
                    names=["doc_id", "mark", "size", "low", "high", "bands", "sketch"],
                )

    return describe


def tie_to_leaders(sketches: np.ndarray, leaders: list[np.ndarray]) -> tuple[np.ndarray, list[int]]:
    """Which rows are tied to which leaders, and the rows that have become leaders, in order.

    Rows that no leader is near to are added to `leaders`, one after the other.
    """

    def near(leader: np.ndarray) -> np.ndarray:
        agree = (sketches == leader).mean(axis=1)
        return (agree - 1 / 256) / (1 - 1 / 256)

    found = [near(leader) for leader in leaders]
    covered = np.max(found, axis=0) >= CORE if found else np.zeros(len(sketches), dtype=bool)
    added = []
    while not covered.all():
        own = int(np.argmin(covered))
        leaders.append(sketches[own])
        added.append(own)
        found.append(near(sketches[own]))
        covered |= found[-1] >= CORE
        covered[own] = True
    return np.column_stack(found) >= HALO, added


def _ties(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per bucket one row for each class, and the leaders that classes tie together."""
    current, leaders, names, joined, a, b = None, [], [], set(), [], []
    for key, piece in grouped(batches, ["band", "key"]):
        if key != current:
            current, leaders, names, joined = key, [], [], set()
        ids = piece.column(2).to_numpy()
        sketches = np.frombuffer(b"".join(piece.column(3).to_pylist()), np.uint8).reshape(len(ids), -1)
        tied, added = tie_to_leaders(sketches, leaders)
        names += ids[added].tolist()
        first = tied.argmax(axis=1)
        some = tied.any(axis=1)
        a += ids[some].tolist()
        b += [names[i] for i in first[some]]
        rows, others = np.nonzero(tied)
        for pair in set(zip(first[rows].tolist(), others.tolist(), strict=True)) - joined:
            joined.add(pair)
            if pair[0] != pair[1]:
                a.append(names[pair[0]])
                b.append(names[pair[1]])
        if len(a) > 20_000:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
            a, b = [], []
    if a:
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


class Index:
    """Inverted index over the sets of a block."""

    def __init__(self, sets: Sets) -> None:
        owner = np.repeat(np.arange(len(sets.sizes)), sets.sizes)
        order = np.argsort(sets.values, kind="stable")
        values = sets.values[order]
        self.owner, self.sizes = owner[order], sets.sizes
        self.begin = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, np.int64)
        self.values = values[self.begin]
        self.count = np.diff(np.concatenate((self.begin, [len(values)])))

    def similar(self, members: np.ndarray, threshold: float) -> np.ndarray:
        """Which documents of the block have at least this similarity to the set."""
        at = np.searchsorted(self.values, members)
        at = at[(at < len(self.values)) & (self.values[np.minimum(at, len(self.values) - 1)] == members)]
        counts = self.count[at]
        total = int(counts.sum())
        place = np.repeat(self.begin[at] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(total)
        shared = np.bincount(self.owner[place], minlength=len(self.sizes))
        return (shared > 0) & (shared >= threshold * (self.sizes + len(members) - shared) - 1e-9)


def _verify(width: int, threshold: float):
    get = lambda batch, name: batch.column(batch.schema.get_field_index(name))

    def links(index: Index, block_ids, block_n, sets: Sets, ids) -> Iterator[pa.RecordBatch]:
        for begin in range(0, len(ids), PROBE_ROWS):
            rows = range(begin, min(begin + PROBE_ROWS, len(ids)))
            linked = np.stack([index.similar(sets.values[sets.first[i] : sets.first[i + 1]], threshold) for i in rows])
            own = ids[begin : begin + PROBE_ROWS]
            linked &= own[:, None] != block_ids[None, :]
            some, cols = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
            if len(some) == 0:
                continue
            inner = linked[np.ix_(some, cols)]
            row_label, col_label = local_components(inner)
            head = own[some]
            a = np.concatenate((head, head, block_ids[cols]))
            b = np.concatenate((head, head[row_label], head[col_label]))
            n = np.concatenate((inner @ block_n[cols], np.zeros(len(some) + len(cols), np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, n)], names=["a", "b", "n"])

    def sets_of(batch: pa.RecordBatch) -> tuple[Sets, np.ndarray, np.ndarray]:
        sets = Sets([words_of(t.as_py()) for t in get(batch, "text")], width)
        low, high = sets.content()
        # Of rows that share an id only those with the class's own text count, and one of them.
        right = (low == get(batch, "low").to_numpy()) & (high == get(batch, "high").to_numpy())
        ids = get(batch, "cid").to_numpy().copy()
        _, first = np.unique(np.where(right, ids, -1), return_index=True)
        once = np.zeros(len(ids), dtype=bool)
        once[first] = True
        return sets, np.where(right & once, ids, -1), get(batch, "n").to_numpy()

    def block_of(held: list[pa.RecordBatch]):
        batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        sets, ids, n = sets_of(batch)
        return sets, ids, np.where(ids < 0, 0, n)

    def clean(found: pa.RecordBatch) -> pa.RecordBatch:
        keep = (found.column(0).to_numpy() >= 0) & (found.column(1).to_numpy() >= 0)
        return found.filter(pa.array(keep))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, block, last = None, [], None, None

        def inside() -> Iterator[pa.RecordBatch]:
            """A group of one block is compared with itself."""
            if held and block is None and held[0].column(held[0].schema.get_field_index("blocks"))[0].as_py() == 1:
                sets, ids, n = block_of(held)
                usable = np.flatnonzero(ids >= 0)
                yield from (clean(x) for x in links(Index(sets), ids, n, *_pick(sets, ids, usable)))

        for key, piece in grouped(batches, ["group", "block", "part"]):
            if key != current:
                yield from inside()
                current, held, block, last = key, [], None, None
            piece, last = _once_each(piece, last)
            split = int(np.searchsorted(get(piece, "kind").to_numpy(), 1))
            if split:
                held.append(piece.slice(0, split))
            for begin in range(split, piece.num_rows, PROBE_ROWS):
                if block is None:
                    sets, ids, n = block_of(held)
                    block = Index(sets), ids, n
                sets, ids, _ = sets_of(piece.slice(begin, PROBE_ROWS))
                yield from (clean(x) for x in links(*block, *_pick(sets, ids, np.flatnonzero(ids >= 0))))
        yield from inside()

    return verify


def _once_each(piece: pa.RecordBatch, last: tuple | None) -> tuple[pa.RecordBatch, tuple]:
    """Rows in order of kind and class without those that repeat the one before: equal rows of the table."""
    kind, cid = (piece.column(piece.schema.get_field_index(n)).to_numpy() for n in ("kind", "cid"))
    keep = np.ones(len(cid), dtype=bool)
    keep[1:] = (cid[1:] != cid[:-1]) | (kind[1:] != kind[:-1])
    keep[0] = (kind[0], cid[0]) != last
    return piece.filter(pa.array(keep)), (kind[-1], cid[-1])


class _Part:
    def __init__(self, values: np.ndarray, first: np.ndarray) -> None:
        self.values, self.first = values, first


def _pick(sets: Sets, ids: np.ndarray, rows: np.ndarray) -> tuple[_Part, np.ndarray]:
    members = [sets.values[sets.first[i] : sets.first[i + 1]] for i in rows]
    first = np.concatenate(([0], np.cumsum([len(m) for m in members]))).astype(np.int64)
    return _Part(np.concatenate(members) if members else sets.values[:0], first), ids[rows]


def near_documents(
    docs: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH, recall: float = RECALL,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_links (other documents linked directly), class_id (smallest id reachable by
    links, itself included), equal_id (smallest id with an equal set)."""
    return _near_rows(docs, threshold, width, recall, id_col, text_col).select("doc_id", "n_links", "class_id", "equal_id")


def _near_rows(docs: DataFrame, threshold: float, width: int, recall: float, id_col: str, text_col: str) -> DataFrame:
    """near_documents with `mark`, a hash of the text, and `first`: whether (doc_id, mark) is the one that stays of its group.

    A row is known by its id and the hash of its text, so that null ids and ids with several texts are kept apart.
    """
    bands, rows = choose_bands(threshold, recall)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn("mark", F.xxhash64("text"))
    described = texts.select("doc_id", "text", F.octet_length("text"), "mark").mapInArrow(tidy(_describe(width, bands, rows)), "doc_id long, mark long, size long, low long, high long, bands array<long>, sketch binary"
    )
    table = materialise(described, "sets")
    content = ["size", "low", "high"]
    merged = table.filter("size > 0").groupBy(*content).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "mark")).alias("rep"), F.count("*").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")
    )
    classes = materialise(merged.withColumn("cid", F.monotonically_increasing_id()).withColumn("equal_id", F.col("rep.doc_id")), "classes")
    banded = classes.select("cid", F.posexplode("bands").alias("band", "key"))
    shared = banded.groupBy("band", "key").agg(F.count("*").alias("m")).filter("m > 1").select("band", "key")
    met = materialise(banded.join(shared, ["band", "key"]), "shared").join(classes.select("cid", "sketch"), "cid")
    bucketed = met.select("band", "key", "cid", "sketch").repartition("band", "key").sortWithinPartitions("band", "key", "cid")
    ties = bucketed.mapInArrow(tidy(_ties), "a long, b long").filter("a <> b").distinct()
    groups = components(ties, "ties").select(F.col("node").alias("cid"), F.col("component").alias("group"))
    many = [F.ceil(F.count("*") / F.lit(n)).cast("int").alias(c) for n, c in ((BLOCK_ROWS, "blocks"), (PART_ROWS, "parts"))]
    sized = groups.join(groups.groupBy("group").agg(*many), "group")
    wanted = classes.join(sized, "cid").select("rep", "cid", "n", "low", "high", "group", "blocks", "parts")
    same = texts["doc_id"].eqNullSafe(wanted["rep.doc_id"]) & (texts["mark"] == wanted["rep.mark"])
    members = texts.filter(F.octet_length("text") > 0).join(wanted, same).drop("doc_id", "mark", "rep")
    own = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    part = F.pmod(F.xxhash64(F.lit("part"), "cid"), F.col("parts")).cast("int")

    def each(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    homes = members.withColumn("block", own).withColumn("part", each("parts")).withColumn("kind", F.lit(0))
    probes = members.filter("blocks > 1").withColumn("part", part).withColumn("block", each("blocks")).withColumn("kind", F.lit(1))
    keys = ["group", "block", "part"]
    order = [*keys, "kind", "blocks", "cid", "n", "low", "high", "text"]
    blocked = homes.select(order).union(probes.select(order)).repartition(*keys).sortWithinPartitions(*keys, "kind", "cid")
    found = materialise(blocked.mapInArrow(tidy(_verify(width, threshold)), "a long, b long, n long"), "pairs")
    links = found.groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("links"))
    joined = components(found.select("a", "b"), "near").withColumnRenamed("node", "cid")
    named = joined.join(classes.select("cid", "rep"), "cid")
    names = named.groupBy("component").agg(F.min("rep").alias("chosen"))
    known = classes.join(links, "cid", "left").join(named.join(names, "component").select("cid", "chosen"), "cid", "left").select(
        *content, "equal_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("chosen", "rep").alias("chosen")
    )
    # One row per distinct set on the right: a text of very many copies is split.
    first = F.col("doc_id").eqNullSafe(F.col("chosen.doc_id")) & (F.col("mark") == F.col("chosen.mark"))
    linked = table.filter("size > 0").join(known, content).select("doc_id", "n_links", F.col("chosen.doc_id").alias("class_id"), "equal_id", "mark", first.alias("first"))
    itself = [F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("class_id"), F.col("doc_id").alias("equal_id"), "mark", F.lit(True).alias("first")]
    return linked.union(table.filter("size = 0").select("doc_id", *itself))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each group: that with the smallest id, null ids last, then by a hash of its text; equal rows once."""
    found = _near_rows(docs, THRESHOLD, WIDTH, RECALL, "doc_id", "text")
    keep = found.filter("first").select(F.col("doc_id").alias("kept_id"), F.col("mark").alias("kept_mark")).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(keep["kept_id"]) & (F.xxhash64(docs["text"]) == keep["kept_mark"])
    return docs.join(keep, same, "left_semi").dropDuplicates(["doc_id", "text"])
