"""Hard negatives by residue-number-system products (operator 12).

Scores are exact integer inner products, found by float32 matrix products alone: components are reduced modulo
several primes below 256, so that each product's sums stay within the 24 bits that float32 holds exactly, and the
signed scores are put together by Chinese remaindering (mixed radix with balanced digits). The primes are the largest
ones whose product exceeds four times the largest squared length, a bound on every score.

A block of anchors is held by a task and the rows stream past it in tiles; per anchor and window only the first
rows are kept, so what leaves a task is bounded by its anchors. A first pass meets rows of an anchor's own label and finds the
positives; their scores set the windows of the second pass, over rows of other labels. The work is a product of
anchors and rows, as the task asks for; rows are copied once per block of ANCHOR_ROWS anchors.

Rows take no part if label or vector is null, the vector is empty, an entry is null or not finite, or the squared
length is 2^62 or more (scores must fit into 64 bits). Vectors of different lengths are not compared. Rows that repeat
an id are rows of their own, anchors of their own too; null ids are no anchors and come last among ties. Equal scores
and ids are ordered by their place in the table. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwright.llm.common import grouped, materialise, tidy

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # per cent of the positive's score
LARGEST_PRIME = 256
EXACT = 1 << 24  # float32 holds every integer up to here
ANCHOR_ROWS = 32_768
TILE = 1 << 21  # scores held at a time
STRIPE_ROWS, STRIPES, LONG_STRIPE = 8_192, 64, 4_000_000
NONE = np.iinfo(np.int64).min


def primes_beyond(bound: int) -> list[int]:
    """The largest primes below LARGEST_PRIME, at least two, whose product exceeds `bound`."""
    found, product = [], 1
    for p in range(LARGEST_PRIME - 1, 2, -1):
        if product > bound and len(found) > 1:
            break
        if all(p % q for q in range(2, int(p**0.5) + 1)):
            found.append(p)
            product *= p
    return found


def _centred(values: np.ndarray, p: int) -> np.ndarray:
    """Congruent modulo p and about within p / 2 of zero; exact below 2^24."""
    return values - np.float32(p) * np.rint(values * np.float32(1.0 / p))


class Residues:
    """Rows of integers modulo each prime, as float32 matrices."""

    def __init__(self, x: np.ndarray, primes: list[int]) -> None:
        self.primes = primes
        self.parts = [(np.mod(x + p // 2, p) - p // 2).astype(np.float32) for p in primes]

    def scores(self, other: Residues) -> np.ndarray:
        """Exact inner products of all rows with all rows of `other`."""
        length = self.parts[0].shape[1]
        digits: list[np.ndarray] = []
        for n, p in enumerate(self.primes):
            left, right = self.parts[n], other.parts[n]
            step = EXACT // (p * p)  # entries whose products surely add up within 24 bits
            found = _centred(left[:, :step] @ right[:, :step].T, p)
            for begin in range(step, length, step):
                found = _centred(found + _centred(left[:, begin : begin + step] @ right[:, begin : begin + step].T, p), p)
            for q, digit in zip(self.primes, digits, strict=False):
                inverse = pow(q, -1, p)
                found = _centred((found - digit) * np.float32(inverse - p if 2 * inverse > p else inverse), p)
            digits.append(found)
        total, weight = digits[0].astype(np.int64), 1
        for p, digit in zip(self.primes, digits[1:], strict=False):
            weight = (weight * p) % (1 << 64)
            total += digit.astype(np.int64) * np.array(weight, dtype=np.uint64).astype(np.int64)
        return total


class Firsts:
    """The first k rows of each anchor: larger scores first, then smaller ids."""

    def __init__(self, anchors: int, k: int) -> None:
        self.k, self.anchors = k, anchors
        self.least, self.last = np.full(anchors, NONE), np.full(anchors, np.iinfo(np.int64).max)
        self.held: list[np.ndarray] = [np.zeros(0, np.int64) for _ in range(4)]
        self.waiting: list[tuple] = []
        self.count = 0

    def add(self, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray, uids: np.ndarray) -> None:
        """`ids` sort null ids last."""
        allowed = allowed & (scores >= self.least[:, None])
        if np.count_nonzero(allowed) > 4 * self.k * self.anchors and scores.shape[1] > self.k:
            shown = np.where(allowed, scores, NONE)
            kth = np.partition(shown, shown.shape[1] - self.k, axis=1)[:, -self.k]
            allowed &= scores >= kth[:, None]
        a, c = np.nonzero(allowed)
        found = scores[a, c]
        wanted = (found > self.least[a]) | (ids[c] <= self.last[a])
        a, c, found = a[wanted], c[wanted], found[wanted]
        self.waiting.append((a, found, ids[c], uids[c]))
        self.count += len(a)
        if self.count > 2 * self.k * self.anchors:
            self.settle()

    def settle(self) -> list[np.ndarray]:
        """Anchor, score, id and number of the rows kept, in order."""
        a, score, ids, uids = (np.concatenate((h, *(w[n] for w in self.waiting))) for n, h in enumerate(self.held))
        order = np.lexsort((uids, ids, -score, a))
        a, score, ids, uids = a[order], score[order], ids[order], uids[order]
        place = np.arange(len(a)) - np.searchsorted(a, a, side="left")
        full = place == self.k - 1
        self.least[a[full]], self.last[a[full]] = score[full], ids[full]
        keep = place < self.k
        self.held, self.waiting, self.count = [v[keep] for v in (a, score, ids, uids)], [], 0
        return self.held


class _Anchors:
    """A block of anchors with their windows, and what was found for them."""

    def __init__(self, rows: pa.RecordBatch, primes: list[int], k: int, windows: int) -> None:
        column = lambda name: rows.column(rows.schema.get_field_index(name))
        self.uids, self.primes = column("uid").to_numpy(), primes
        labels = column("label").to_pylist()
        self.codes = {label: n for n, label in enumerate(dict.fromkeys(labels))}
        self.labels = np.array([self.codes[label] for label in labels])
        self.residues = Residues(_matrix(column("x")), primes)
        shape = (len(self.uids), windows)
        self.low = np.array([v + [1] * (windows - len(v)) for v in column("lows").to_pylist()], dtype=np.int64).reshape(shape)
        self.high = np.array([v + [0] * (windows - len(v)) for v in column("highs").to_pylist()], dtype=np.int64).reshape(shape)
        self.firsts = [Firsts(len(self.uids), k) for _ in range(windows)]

    def meet(self, rows: pa.RecordBatch, same: bool) -> None:
        step = max(1, TILE // len(self.uids))
        for begin in range(0, rows.num_rows, step):
            part = rows.slice(begin, step)
            column = lambda name: part.column(part.schema.get_field_index(name))  # noqa: B023, E731
            uids = column("uid").to_numpy()
            ids = column("vec_id").fill_null(np.iinfo(np.int64).max).to_numpy()
            labels = np.array([self.codes.get(label, -1) for label in column("label").to_pylist()])
            scores = self.residues.scores(Residues(_matrix(column("x")), self.primes))
            allowed = ((labels[None, :] == self.labels[:, None]) == same) & (uids[None, :] != self.uids[:, None])
            for n, firsts in enumerate(self.firsts):
                firsts.add(scores, allowed & (scores >= self.low[:, n, None]) & (scores <= self.high[:, n, None]), ids, uids)

    def found(self) -> Iterator[pa.RecordBatch]:
        for n, firsts in enumerate(self.firsts):
            a, score, ids, uids = firsts.settle()
            known = ids != np.iinfo(np.int64).max
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(self.uids[a]), pa.array(np.full(len(a), n, np.int32)), pa.array(score),
                    pa.array(ids, mask=~known), pa.array(uids),
                ],
                names=["anchor", "window", "score", "vec_id", "uid"],
            )


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def _meet(primes: list[int], k: int, windows: int, same: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, anchors = None, [], None
        for key, piece in grouped(batches, ["space", "block", "stripe"]):
            if key != current:
                if anchors is not None:
                    yield from anchors.found()
                current, held, anchors = key, [], None
            split = int(np.searchsorted(piece.column(piece.schema.get_field_index("kind")).to_numpy(), 1))
            if split:
                held.append(piece.slice(0, split))
            if held and split < piece.num_rows:
                if anchors is None:
                    anchors = _Anchors(pa.Table.from_batches(held).combine_chunks().to_batches()[0], primes, k, windows)
                anchors.meet(piece.slice(split), same)
        if anchors is not None:
            yield from anchors.found()

    return work


def _first_rows(rows: DataFrame, anchors: DataFrame, space: list[str], primes: list[int], total: int, k: int, windows: int, same: bool) -> DataFrame:
    """anchor, window, rank, score, vec_id, uid: the first k rows of each anchor and window.

    `anchors` has `lows` and `highs`, arrays of at most `windows` bounds; anchors and rows meet where `space` agrees.
    """
    space_of = F.to_json(F.struct(*space)).alias("space")
    most = anchors.groupBy(*space).count().agg(F.max("count")).first()[0] or 0
    blocks = max(1, -(-most // ANCHOR_ROWS))
    stripes = max(1, min(STRIPES, -(-total // STRIPE_ROWS)), -(-total // LONG_STRIPE))
    columns = ["uid", "vec_id", "label", "x"]
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("uid"), F.lit(n)).cast("int")
    asking = anchors.select(space_of, dealt(blocks).alias("block"), every(stripes).alias("stripe"), F.lit(0).alias("kind"), *columns, "lows", "highs")
    bare = F.lit(None).cast("array<bigint>")
    asked = rows.select(space_of, every(blocks).alias("block"), dealt(stripes).alias("stripe"), F.lit(1).alias("kind"), *columns, bare.alias("lows"), bare.alias("highs"))
    keys = ["space", "block", "stripe"]
    # Rows come by id, so that of many equal scores the first ones are met first.
    met = asking.union(asked).repartition(*keys).sortWithinPartitions(*keys, "kind", F.asc_nulls_last("vec_id"))
    found = met.mapInArrow(tidy(_meet(primes, k, windows, same)), "anchor long, window int, score long, vec_id long, uid long")
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "uid")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    table: DataFrame, anchors: Column, label: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES,
    low: int = LOW, high: int = HIGH, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows where `anchors` (over vec_id) holds; `label` is an expression over the table, by default its column.
    """
    entries = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    finite = F.forall(entries, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    named = F.col("label") if label is None else label
    whole = table.filter(F.coalesce((F.size(vector_col) > 0) & finite, F.lit(False))).select(
        F.col(id_col).cast("long").alias("vec_id"), named.cast("string").alias("label"),
        F.transform(entries, lambda v: F.floor(v * F.lit(float(scale))).cast("long")).alias("x"),
    )
    squares = F.aggregate("x", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    usable = whole.filter(F.col("label").isNotNull()).withColumn("squares", squares).filter(F.col("squares") < float(1 << 62))
    rows = materialise(
        usable.withColumns({"x": F.col("x").cast("array<int>"), "dim": F.size("x"), "uid": F.monotonically_increasing_id()}), "rows"
    )
    size = rows.agg(F.count("*").alias("n"), F.max("squares").alias("most")).first()
    primes = primes_beyond(4 * int((size["most"] or 0) * (1 + 1e-9)) + 4)
    asking = rows.filter(F.coalesce(anchors, F.lit(False)))
    unbounded = asking.withColumns({"lows": F.array(F.lit(NONE + 1)), "highs": F.array(F.lit((1 << 63) - 1))})
    near = materialise(_first_rows(rows, unbounded, ["dim", "label"], primes, size["n"], positives, 1, True), "positives")
    exact = F.col("score").cast("decimal(20,0)")
    bounds = near.withColumns({
        "low": F.ceil(exact * low / 100).cast("long"), "high": F.floor(exact * high / 100).cast("long"),
    }).filter("low <= high")
    # At most `positives` rows an anchor.
    windows = bounds.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "low", "high"))).alias("w")).select(
        F.col("anchor").alias("uid"), F.col("w.rank").alias("ranks"), F.col("w.low").alias("lows"), F.col("w.high").alias("highs")
    )
    asking = materialise(asking.join(windows, "uid"), "windows")
    far = _first_rows(rows, asking, ["dim"], primes, size["n"], negatives, positives, False)
    named_anchors = asking.select(F.col("uid").alias("anchor"), F.col("vec_id").alias("anchor_id"), F.posexplode("ranks").alias("window", "place"))
    chosen = near.select("anchor", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (
        far.join(named_anchors, ["anchor", "window"]).join(chosen, ["anchor", "place"])
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )
