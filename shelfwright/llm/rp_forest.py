"""Nearest neighbours by a forest of random-projection trees (operator 5).

Trees split space at the median of projections on the line between two random points of a bounded
sample; every row is indexed in every tree. A query walks all trees through one priority queue,
best margin first, until the leaves taken hold its budget of rows. Index rows and visiting queries
meet by leaf; leaves are split into blocks of bounded size that queries stream past. Candidates are
scored exactly, and a block hands on only each query's best.

The budget is a share of the index, tuned on the sample: the smallest share at which `target`
of the true neighbours within the sample are found (`recall` measures it on all rows). Vectors without
cluster structure need a large share; clustered ones a small one.

Vectors that are null, zero, or hold a null or non-finite component take no part. Candidates are all
rows but the query's own, compared only at equal vector length; ties go to the smaller id, null ids
last. Rows that repeat an id are rows of their own: each is a query and a candidate. Other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwright.llm.common import grouped, hashed_sample, materialise, scaled, tidy, unit_rows, usable_vector, vectors

SAMPLE_ROWS = 20_000  # bound on the vectors that planes and budget are fitted on
TUNE_QUERIES = 400
TREES = 4
LEAF_ROWS = 1024
MAX_DEPTH = 11
BLOCK_ROWS = 4096
QUERY_ROWS = 256
TARGET = 0.96


class Forest:
    """Trees of equal depth as heaps of planes; all vectors are unit rows."""

    def __init__(self, sample: np.ndarray, trees: int, depth: int, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        nodes = (1 << depth) - 1
        self.trees, self.depth, self.nodes = trees, depth, nodes
        self.normals = np.zeros((trees, max(1, nodes), sample.shape[1]))
        self.offsets = np.zeros((trees, max(1, nodes)))
        for tree in range(trees):
            inside: dict[int, np.ndarray] = {0: np.arange(len(sample))}
            for node in range(nodes):
                rows = inside.pop(node)
                normal = rng.normal(size=sample.shape[1])
                if len(rows) > 1:
                    p, q = sample[rng.choice(rows, size=2, replace=False)]
                    if (p != q).any():
                        normal = p - q
                normal /= np.linalg.norm(normal)
                along = sample[rows] @ normal
                cut = float(np.median(along)) if len(rows) else 0.0
                self.normals[tree, node], self.offsets[tree, node] = normal, cut
                inside[2 * node + 1], inside[2 * node + 2] = rows[along <= cut], rows[along > cut]
        self.sizes = np.zeros((trees, 1 << depth), dtype=np.int64)

    def leaves(self, unit: np.ndarray) -> np.ndarray:
        """Leaf of each row in each tree."""
        out = np.zeros((len(unit), self.trees), dtype=np.int32)
        for tree in range(self.trees):
            node = np.zeros(len(unit), dtype=np.int64)
            for _ in range(self.depth):
                along = np.einsum("ij,ij->i", unit, self.normals[tree, node])
                node = 2 * node + 1 + (along > self.offsets[tree, node])
            out[:, tree] = node - self.nodes
        return out

    def visits(self, query: np.ndarray, budget: float) -> list[tuple[int, int, int]]:
        """Leaves in order of their margin over all trees: (tree, leaf, rows taken up to and with it)."""
        if self.depth == 0:
            return [(0, 0, int(self.sizes[0, 0]))]
        margins = np.einsum("tnd,d->tn", self.normals, query) - self.offsets
        queue = [(-math.inf, tree, 0) for tree in range(self.trees)]
        taken, out = 0, []
        while queue and taken < budget:
            worst, tree, node = heapq.heappop(queue)
            if node >= self.nodes:
                taken += int(self.sizes[tree, node - self.nodes])
                out.append((tree, node - self.nodes, taken))
                continue
            margin = float(margins[tree, node])
            heapq.heappush(queue, (max(worst, margin), tree, 2 * node + 1))
            heapq.heappush(queue, (max(worst, -margin), tree, 2 * node + 2))
        return out

    def tuned_share(self, sample: np.ndarray, k: int, target: float) -> float:
        """Share of tree rows to visit so that `target` of the sample's own neighbours are found."""
        places = self.leaves(sample)
        sizes, self.sizes = self.sizes, np.stack([np.bincount(places[:, t], minlength=1 << self.depth) for t in range(self.trees)])
        needed = []
        for i in range(0, len(sample), max(1, len(sample) // TUNE_QUERIES)):
            scores = sample @ sample[i]
            scores[i] = -np.inf
            order = {(t, leaf): taken for t, leaf, taken in self.visits(sample[i], math.inf)}
            for j in np.argsort(-scores)[: min(k, len(sample) - 1)]:
                needed.append(min(order[t, places[j, t]] for t in range(self.trees)))
        self.sizes = sizes
        return 1.0 if not needed else float(np.quantile(needed, target, method="higher")) / (self.trees * len(sample))


def _best(k: int):
    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = lambda batch, name: batch.column(batch.schema.get_field_index(name))
        current, held, home = None, [], None
        for key, piece in grouped(batches, ["dim", "tree", "leaf", "block"]):
            if key != current:
                current, held, home = key, [], None
            split = int(np.searchsorted(get(piece, "kind").to_numpy(), 1))
            if split:
                held.append(piece.slice(0, split))
            if not held:
                continue
            for begin in range(split, piece.num_rows, QUERY_ROWS):
                if home is None:
                    block = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    home = scaled(vectors(get(block, "embedding"), key[0]))
                    size = np.sqrt(np.einsum("ij,ij->i", home, home))
                    uid = get(block, "uid").to_numpy()
                    known = get(block, "vec_id").is_valid().to_numpy(zero_copy_only=False)
                    ids = get(block, "vec_id").fill_null(0).to_numpy()
                part = piece.slice(begin, QUERY_ROWS)
                query = scaled(vectors(get(part, "embedding"), key[0]))
                length = np.sqrt(np.einsum("ij,ij->i", query, query))
                own = get(part, "uid").to_numpy()
                rough = (query @ home.T) / (length[:, None] * size[None, :])
                rough[own[:, None] == uid[None, :]] = -np.inf
                last = np.partition(rough, max(0, len(uid) - k), axis=1)[:, max(0, len(uid) - k)]
                # Products of matrices round differently by place, so near ties are scored again, pair by pair.
                q, c = np.nonzero((rough >= last[:, None] - 1e-9) & np.isfinite(rough))
                score = np.einsum("ij,ij->i", query[q], home[c]) / (length[q] * size[c])
                order = np.lexsort((uid[c], ids[c], ~known[c], -score, q))
                q, c, score = q[order], c[order], score[order]
                first = np.searchsorted(q, q, side="left")
                keep = np.arange(len(q)) - first < k
                q, c, score = q[keep], c[keep], score[keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[q]), pa.array(uid[c]), pa.array(ids[c], mask=~known[c]), pa.array(score)],
                    names=["query", "uid", "vec_id", "score"],
                )

    return best


def nearest(
    table: DataFrame, queries: Column, k: int = 5, trees: int = TREES, target: float = TARGET,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """The k nearest rows found for each row where `queries` (over vec_id) holds: query_id, rank, vec_id, score."""
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"))
    rows = rows.filter(usable_vector(F.col("embedding")))
    base = materialise(
        rows.withColumn("uid", F.monotonically_increasing_id()).withColumn("dim", F.size("embedding")), "index"
    )
    counts = {r["dim"]: r["n"] for r in base.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    sample = hashed_sample(base, "uid", sum(counts.values()), SAMPLE_ROWS).select("embedding").toArrow().column(0).to_pylist()
    forests, shares = {}, {}
    for dim in {len(v) for v in sample}:
        unit = unit_rows(np.array([v for v in sample if len(v) == dim], dtype=np.float64))
        wanted = math.ceil(math.log2(max(1, counts[dim] / LEAF_ROWS)))
        depth = max(0, min(MAX_DEPTH, wanted, int(math.log2(len(unit))) - 2))
        forests[dim] = Forest(unit, trees if depth else 1, depth)
        shares[dim] = forests[dim].tuned_share(unit, k, target)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, column = batch.column(3).to_numpy(), batch.column(1)
            out: list = [[0]] * batch.num_rows
            for dim in np.unique(dims):
                if int(dim) in forests:
                    at = np.flatnonzero(dims == dim)
                    found = forests[int(dim)].leaves(unit_rows(vectors(column.take(pa.array(at)), int(dim))))
                    for i, row in zip(at, found, strict=True):
                        out[i] = row
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int32()))], names=[*batch.schema.names, "leaves"])

    kinds = dict(base.dtypes)
    schema = f"vec_id long, embedding {kinds['embedding']}, uid long, dim int"
    routed = base.mapInArrow(tidy(route), f"{schema}, leaves array<int>")
    homes = materialise(routed.select("*", F.posexplode("leaves").alias("tree", "leaf")).drop("leaves"), "leaves")
    # At most trees x 2^depth numbers per vector length, whatever the table holds.
    sizes = homes.groupBy("dim", "tree", "leaf").agg(F.count("*").alias("n"))
    for r in sizes.collect():
        if r["dim"] in forests:
            forests[r["dim"]].sizes[r["tree"], r["leaf"]] = r["n"]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, column, out = batch.column(3).to_numpy(), batch.column(1), []
            for i, dim in enumerate(map(int, dims)):
                if dim not in forests:
                    out.append([(0, 0)])
                    continue
                unit = unit_rows(vectors(column.slice(i, 1), dim))[0]
                budget = shares[dim] * forests[dim].sizes.sum()
                out.append([(t, leaf) for t, leaf, _ in forests[dim].visits(unit, budget)])
            trees_of = pa.array([[t for t, _ in v] for v in out], pa.list_(pa.int32()))
            leaves_of = pa.array([[x for _, x in v] for v in out], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, trees_of, leaves_of], names=[*batch.schema.names, "trees", "leaves"])

    asked = base.filter(queries).mapInArrow(tidy(walk), f"{schema}, trees array<int>, leaves array<int>")
    visits = asked.select("vec_id", "embedding", "uid", "dim", F.explode(F.arrays_zip("trees", "leaves")).alias("v")).select(
        "vec_id", "embedding", "uid", "dim", F.col("v.trees").alias("tree"), F.col("v.leaves").alias("leaf")
    )
    blocks = sizes.select("dim", "tree", "leaf", F.ceil(F.col("n") / F.lit(BLOCK_ROWS)).cast("int").alias("blocks"))
    columns = ["dim", "tree", "leaf", "block", "kind", "uid", "vec_id", "embedding"]
    indexed = homes.join(blocks, ["dim", "tree", "leaf"]).withColumn(
        "block", F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int")
    ).withColumn("kind", F.lit(0))
    asking = visits.join(blocks, ["dim", "tree", "leaf"]).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    ).withColumn("kind", F.lit(1))
    keys = ["dim", "tree", "leaf", "block"]
    met = indexed.select(columns).union(asking.select(columns)).repartition(*keys).sortWithinPartitions(*keys, "kind")
    found = met.mapInArrow(tidy(_best(k)), "query long, uid long, vec_id long, score double").dropDuplicates(["query", "uid"])
    place = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "uid")
    ranked = found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    names = base.filter(queries).select(F.col("uid").alias("query"), F.col("vec_id").alias("query_id"))
    return ranked.join(names, "query").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def exact_nearest(vec_ids: np.ndarray, matrix: np.ndarray, query_ids: list[int], k: int = 5) -> list[tuple[int, int, int, float]]:
    """Brute force on the driver, for tests and recall: rows (query_id, rank, vec_id, score)."""
    rows, out = scaled(matrix), []
    size = np.sqrt(np.einsum("ij,ij->i", rows, rows))
    for query in query_ids:
        i = int(np.flatnonzero(vec_ids == query)[0])
        score = np.einsum("ij,ij->i", np.broadcast_to(rows[i], rows.shape), rows) / (size[i] * size)
        score[i] = -np.inf
        order = np.lexsort((vec_ids, -score))[: min(k, len(rows) - 1)]
        out += [(query, rank, int(vec_ids[j]), float(score[j])) for rank, j in enumerate(order, 1)]
    return out


def recall(found: list[tuple[int, int]], truth: list[tuple[int, int]]) -> float:
    """Share of the true (query, neighbour) pairs that were found."""
    return len(set(found) & set(truth)) / max(1, len(set(truth)))
