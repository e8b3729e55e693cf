"""Near-duplicate embeddings by spherical k-means cells (operator 2).

Vectors are comparable if they have equal labels and lengths. Each is assigned to the nearest of
a few centroids, fitted on a bounded sample; centroids decide only who meets whom, never whether
a pair is found. A vector y of cell b has y.b >= y.a for every centroid a. A vector x within the chord c
of y, with home a, therefore has x.b >= x.a - c |b - a|; x is compared with exactly the cells
for which that holds, so no pair at or above the threshold is missed.

Cells are split into blocks of bounded size; vectors to compare stream past a block in products of
matrices. What leaves a task is a number of links per vector and block, and a spanning star per
group of linked vectors: never a row per pair. Equal vectors count as one with a multiplicity.

Vectors that are null, zero, or hold a null or non-finite component, and rows whose label is null,
link with nothing: n_links 0, component_id their own vec_id, kept. Rows that repeat a vec_id are
vectors of their own. A null vec_id counts as a vector but never names a group that has another id.
Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwright.llm.common import (
    components, grouped, hashed_sample, local_components, materialise, tidy, unit_rows, usable_vector, vectors,
)

THRESHOLD = 0.93
SAMPLE_ROWS = 20_000  # bound on the vectors that centroids are fitted on
CELL_ROWS = 4096  # vectors per centroid, as long as there are fewer than MAX_CELLS
MAX_CELLS = 256
BLOCK_ROWS = 2048
PROBE_ROWS = 512
ROUNDS = 10


def spherical_kmeans(unit: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 7) -> np.ndarray:
    """Unit centroids; an empty cell takes the vector that is worst served."""
    rng = np.random.default_rng(seed)
    centroids = unit[rng.choice(len(unit), size=min(k, len(unit)), replace=False)].copy()
    for _ in range(rounds):
        scores = unit @ centroids.T
        home = scores.argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, unit)
        lengths = np.sqrt((sums**2).sum(axis=1))
        worst = iter(scores.max(axis=1).argsort())
        for cell in np.flatnonzero(lengths < 1e-12):
            sums[cell] = unit[next(worst)]
            lengths[cell] = 1.0
        centroids = sums / lengths[:, None]
    return centroids


def fit_cells(distinct: DataFrame, rows: int) -> dict[int, np.ndarray]:
    """Centroids by vector length, from a sample of at most SAMPLE_ROWS vectors in hash order."""
    sample = hashed_sample(distinct, "gid", rows, SAMPLE_ROWS).select("embedding").toArrow().column(0)
    by_length: dict[int, list] = {}
    for value in sample.to_pylist():
        by_length.setdefault(len(value), []).append(value)
    k = min(MAX_CELLS, max(1, math.ceil(rows / CELL_ROWS)))
    return {dim: spherical_kmeans(unit_rows(np.array(v, dtype=np.float64)), k) for dim, v in by_length.items()}


def assign(distinct: DataFrame, cells: dict[int, np.ndarray], threshold: float) -> DataFrame:
    """Home cell and the cells to compare with."""
    chord = math.sqrt(2 - 2 * threshold) + 1e-9

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gaps = {d: chord * np.sqrt(np.maximum(0, 2 - 2 * c @ c.T)) for d, c in cells.items()}
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("embedding"))
            lengths = column.value_lengths().to_numpy()
            home = np.zeros(batch.num_rows, dtype=np.int32)
            probes: list = [[0]] * batch.num_rows
            for dim in np.unique(lengths):
                if int(dim) not in cells:
                    continue  # a length that the sample missed has one cell
                at = np.flatnonzero(lengths == dim)
                scores = unit_rows(vectors(column.take(pa.array(at)), int(dim))) @ cells[int(dim)].T
                own = scores.argmax(axis=1)
                near = scores >= scores[np.arange(len(at)), own][:, None] - gaps[int(dim)][own] - 1e-9
                near[np.arange(len(at)), own] = True
                home[at] = own
                for i, row in zip(at, near, strict=True):
                    probes[i] = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(home), pa.array(probes, pa.list_(pa.int32()))],
                names=[*batch.schema.names, "cell", "probes"],
            )

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in distinct.schema)
    return distinct.mapInArrow(tidy(places), f"{fields}, cell int, probes array<int>")


def _compare(threshold: float):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, home, ids, counts = None, [], None, None, None
        for key, piece in grouped(batches, ["key", "cell", "block"]):
            if key != current:
                current, held, home = key, [], None
            probing = piece.column(piece.schema.get_field_index("kind")).to_numpy()
            split = int(np.searchsorted(probing, 1))
            if split:
                held.append(piece.slice(0, split))
            if not held:
                continue
            column = lambda batch, name: batch.column(batch.schema.get_field_index(name))
            for begin in range(split, piece.num_rows, PROBE_ROWS):
                if home is None:
                    table = pa.Table.from_batches(held).combine_chunks()
                    block = table.to_batches()[0]
                    dim = len(column(block, "embedding")[0])
                    home = unit_rows(vectors(column(block, "embedding"), dim))
                    ids, counts = column(block, "gid").to_numpy(), column(block, "n").to_numpy()
                part = piece.slice(begin, PROBE_ROWS)
                probe = unit_rows(vectors(column(part, "embedding"), home.shape[1]))
                own = column(part, "gid").to_numpy()
                linked = probe @ home.T >= threshold
                linked &= own[:, None] != ids[None, :]
                rows = np.flatnonzero(linked.any(axis=1))
                if len(rows) == 0:
                    continue
                cols = np.flatnonzero(linked.any(axis=0))
                inner = linked[np.ix_(rows, cols)]
                row_label, col_label = local_components(inner)
                heads = own[rows]
                a = np.concatenate((heads, heads, ids[cols]))
                b = np.concatenate((heads, heads[row_label], heads[col_label]))
                n = np.concatenate((inner @ counts[cols], np.zeros(len(rows) + len(cols), np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, n)], names=["a", "b", "n"])

    return compare


def near_duplicates(
    table: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    rows = table.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"), F.col(label_col).alias("key")
    )
    usable = usable_vector(F.col("embedding")) & F.col("key").isNotNull()
    grouped_rows = rows.filter(usable).groupBy("key", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
    distinct = materialise(grouped_rows.withColumn("gid", F.monotonically_increasing_id()), "vectors")
    count = distinct.count()
    keyed = distinct.select(
        "gid", "embedding", "n", F.struct(F.col("key"), F.size("embedding").alias("dim")).alias("group")
    ).withColumn("key", F.to_json("group")).drop("group")
    placed = materialise(assign(keyed, fit_cells(distinct, count), threshold), "cells")
    blocks = placed.groupBy("key", "cell").agg(F.ceil(F.count("*") / F.lit(BLOCK_ROWS)).cast("int").alias("blocks"))
    spread = F.pmod(F.xxhash64("gid"), F.col("blocks")).cast("int")
    homes = placed.join(blocks, ["key", "cell"]).select(
        "key", "cell", spread.alias("block"), F.lit(0).alias("kind"), "gid", "n", "embedding"
    )
    probes = (
        placed.select("key", F.explode("probes").alias("cell"), "gid", "n", "embedding").join(blocks, ["key", "cell"])
        .select("key", "cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("kind"), "gid", "n", "embedding")
    )
    met = homes.union(probes).repartition("key", "cell", "block").sortWithinPartitions("key", "cell", "block", "kind")
    found = materialise(met.mapInArrow(tidy(_compare(threshold)), "a long, b long, n long"), "links")
    links = found.groupBy(F.col("a").alias("gid")).agg(F.sum("n").alias("links"))
    parts = components(found.select("a", "b"), "vector").withColumnRenamed("node", "gid")
    named = parts.join(distinct.select("gid", "rep"), "gid")
    names = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    known = distinct.join(links, "gid", "left").join(named.join(names, "component").select("gid", "component_id"), "gid", "left")
    result = known.select(
        F.col("key"), F.col("embedding"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component_id", "rep").alias("component_id"),
    )
    # One row per distinct vector on the right: rows of a vector that is very common are split.
    linked = rows.filter(usable).join(result, ["key", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
