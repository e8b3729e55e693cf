"""Near-duplicate hashes without comparing all pairs.

Two 64-bit hashes at distance <= 5 agree in at least three of their eight bytes. A
bucket is therefore a byte position and its value; buckets that hold too many hashes
are split by a second and, where still too large, a third agreeing byte. What remains
of a hash are then 40 bits, and two such remainders agree in at least five of their ten
half bytes: buckets that are too large even now are split by up to five of these. Every
pair is met in exactly one bucket: the one of its lowest agreeing units.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfwright.functions.hashes import distance, equal_units
from shelfwright.operators.joins import lookup
from shelfwright.schemas import HASH_DISTANCE
from shelfwright.session import materialise

LARGEST_DISTANCE = 5
# Larger buckets are split: comparing a hash with this many others costs about as much
# as moving it once more for each byte that could agree next.
BUCKET_ROWS = 1024
LEFT, RIGHT = 1, 2


BYTE, HALF = 8, 4
# Units that must agree when five bits differ: 3 of 8 bytes, then 5 of 10 half bytes.
BYTE_LEVELS, HALF_LEVELS = 3, 5


def _bit(i: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1), i)


def _split(items: DataFrame, scope: list[str], level: int, width: int) -> DataFrame:
    """Move items one unit of `bits` further: to each later unit that can agree next.

    `path` has a bit per agreeing unit, `mask` all bits up to the last of them, and
    `value` the units themselves.
    """
    at = F.col("at")
    unit = F.call_function("shiftright", F.col("bits"), at * width).bitwiseAND(
        F.lit((1 << width) - 1).cast("bigint")
    )
    return (
        items.select("*", F.explode(F.sequence(F.col("last") + 1, F.lit(5 + level))).alias("at"))
        .select(
            *scope, "h", "side", "bits", "bytes", "byte_mask", "byte_value", at.alias("last"),
            F.col("path").bitwiseOR(_bit(at)).alias("path"), (_bit(at + 1) - 1).alias("mask"),
            (F.col("value") * (1 << width) + unit).alias("value"),
        )
    )


def _fresh(items: DataFrame, scope: list[str], bits: Column, keep_bytes: bool) -> DataFrame:
    """Items at the root of the splits over `bits`."""
    found = ("path", "mask", "value") if keep_bytes else (F.lit(0), F.lit(0), F.lit(0).cast("bigint"))
    found = [F.col(c) if isinstance(c, str) else c for c in found]
    return items.select(
        *scope, "h", "side", bits.alias("bits"),
        *[c.alias(n) for c, n in zip(found, ("bytes", "byte_mask", "byte_value"))],
        F.lit(-1).alias("last"), F.lit(0).alias("path"), F.lit(0).alias("mask"),
        F.lit(0).cast("bigint").alias("value"),
    )


def _rest() -> Column:
    """The five bytes of a hash that are not in its path, as one number."""
    def grow(acc: Column, i: Column) -> Column:
        byte = F.call_function("shiftright", F.col("h"), i * BYTE).bitwiseAND(F.lit(255).cast("bigint"))
        free = F.col("path").bitwiseAND(_bit(i)) == 0
        return F.when(free, acc * 256 + byte).otherwise(acc)

    return F.aggregate(F.sequence(F.lit(0), F.lit(7)), F.lit(0).cast("bigint"), grow)


def _buckets(items: DataFrame, scope: list[str], bucket_rows: int) -> DataFrame:
    """Items in buckets of at most `bucket_rows`, as far as splitting can get; `salts` parts for what remains larger."""
    current = _split(_fresh(items, scope, F.col("h"), False), scope, 0, BYTE)
    keys = ["value", "path", "byte_value", "bytes", *scope]
    done, width, level = [], BYTE, 1
    while True:
        current = materialise(current, "buckets")
        large = materialise(
            current.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") > bucket_rows).select(*keys, F.ceil(F.col("_n") / bucket_rows).cast("int").alias("salts")),
            "large",
        )
        if large.isEmpty() or (width == HALF and level == HALF_LEVELS):
            current = current.join(large, keys, "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
            break
        done.append(current.join(large, keys, "left_anti").withColumn("salts", F.lit(1)))
        hot = current.join(large, keys, "left_semi")
        if width == BYTE and level == BYTE_LEVELS:
            hot, width, level = _fresh(hot, scope, _rest(), True), HALF, 0
        current = _split(hot, scope, level, width)
        level += 1
    return reduce(DataFrame.unionByName, [*done, current])


def near_pairs(
    left: DataFrame,
    right: DataFrame | None = None,
    scope: list[str] | None = None,
    max_distance: int = HASH_DISTANCE,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """(scope, h, other) for each hash of `left` and a different, near hash of `right`.

    Both sides hold distinct (scope, h); copies are to be collapsed first. Without
    `right` the hashes of `left` are compared among themselves and pairs come in both
    directions. Hashes and buckets are spread over all shuffle partitions by number, since
    this work costs far more than its few bytes suggest.
    """
    if not 0 <= max_distance <= LARGEST_DISTANCE:
        raise ValueError(f"distance must be between 0 and {LARGEST_DISTANCE}")
    scope = scope or []
    alone = right is None
    items = left.select(*scope, "h", F.lit(LEFT).alias("side"))
    if not alone:
        items = items.unionByName(right.select(*scope, "h", F.lit(RIGHT).alias("side")))
    # The most varied key first: sorts then rarely compare whole rows.
    keys = ["value", "path", "mask", "byte_value", "bytes", "byte_mask", *scope]
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = _buckets(items.repartition(partitions, "h"), scope, bucket_rows).select(*keys, "h", "side", "bits", "salts")
    a = placed if alone else placed.filter(F.col("side") == LEFT)
    b = placed if alone else placed.filter(F.col("side") == RIGHT)
    # A bucket that could not be split is met in parts: one side is dealt out, the other goes to every part.
    keys = [*keys, "salt"]
    a = a.withColumn("salt", F.pmod(F.xxhash64("h"), F.col("salts")).cast("int")).drop("side", "salts")
    b = b.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("side", "salts")
    a = a.repartition(partitions, *keys)
    b = b.repartition(partitions, *keys).withColumnsRenamed({"h": "other", "bits": "other_bits"})
    h, other = F.col("h"), F.col("other")
    different = h < other if alone else h != other
    # Below the last agreeing unit no other unit may agree, on either level.
    half = F.col("bytes") != 0
    bytes_path = F.when(half, F.col("bytes")).otherwise(F.col("path"))
    bytes_mask = F.when(half, F.col("byte_mask")).otherwise(F.col("mask"))
    first_bytes = equal_units(h, other, BYTE, 8).bitwiseAND(bytes_mask) == bytes_path
    halves = equal_units(F.col("bits"), F.col("other_bits"), HALF, 10).bitwiseAND(F.col("mask"))
    pairs = (
        a.join(b, keys)
        .filter(different & (distance(h, other) <= max_distance) & first_bytes & (~half | (halves == F.col("path"))))
        .select(*scope, "h", "other")
    )
    if not alone:
        return pairs
    ways = F.array(F.struct("h", "other"), F.struct(F.col("other").alias("h"), F.col("h").alias("other")))
    return pairs.select(*scope, F.explode(ways).alias("_w")).select(*scope, "_w.*")


# Queries of one bucket that a task holds; larger buckets are dealt out.
HELD = 65_536
# Of a bucket that is too large, as many hashes are looked at before it is split: a dense one is settled by then.
LOOKED_AT = 1_024
# Distances computed at a time.
TILE = 1 << 21


def _earliest(distance_limit: int, looked_at: int):
    """For each hash of a bucket (kind 0) the place of the first earlier near one among those streaming past (kind 1), by place.

    A hash leaves the comparison with its first hit, and those that arrive before it end it, so a dense bucket takes
    few steps. Of a `large` bucket only the first `looked_at` hashes are met; `open` says that more would have to be.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            names = batch.schema.names
            bucket, part = (batch.column(names.index(n)).to_numpy() for n in ("bucket", "part"))
            starts = np.flatnonzero(np.concatenate(([True], (bucket[1:] != bucket[:-1]) | (part[1:] != part[:-1]))))
            for begin, end in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows], strict=True):
                if (bucket[begin], part[begin]) != current:
                    if held is not None:
                        yield held.result()
                    current, held = (bucket[begin], part[begin]), _Held(distance_limit, looked_at)
                held.add(batch.slice(begin, end - begin))
        if held is not None:
            yield held.result()

    return work


class _Held:
    def __init__(self, limit: int, looked_at: int) -> None:
        self.limit, self.looked_at, self.met = limit, looked_at, 0
        self.parts: list[pa.RecordBatch] = []
        self.h: np.ndarray | None = None

    def add(self, part: pa.RecordBatch) -> None:
        column = lambda name: part.column(part.schema.names.index(name))
        split = int(np.searchsorted(column("kind").to_numpy(), 1))
        if split:
            self.parts.append(part.slice(0, split))
        if split == part.num_rows:
            return
        if self.h is None:
            self._start()
        self.meet(column("h").to_numpy()[split:].view(np.uint64), column("place").to_numpy()[split:])

    def _start(self) -> None:
        self.rows = pa.Table.from_batches(self.parts).combine_chunks().to_batches()[0]
        column = lambda name: self.rows.column(self.rows.schema.names.index(name))
        self.h, self.place = column("h").to_numpy().view(np.uint64), column("place").to_numpy()
        self.large = bool(column("large")[0].as_py())
        self.near = np.full(len(self.h), -1)
        self.open = np.arange(len(self.h))

    def meet(self, h: np.ndarray, place: np.ndarray) -> None:
        if self.large:
            h, place = h[: max(0, self.looked_at - self.met)], place[: max(0, self.looked_at - self.met)]
            self.met += len(h)
        begin = 0
        while begin < len(h) and len(self.open):
            step = max(1, min(len(h) - begin, TILE // len(self.open), 256))
            other, at = h[begin : begin + step], place[begin : begin + step]
            hit = np.bitwise_count(self.h[self.open, None] ^ other[None, :]) <= self.limit
            hit &= at[None, :] < self.place[self.open, None]
            first = hit.argmax(axis=1)
            found = hit[np.arange(len(first)), first]
            self.near[self.open[found]] = at[first[found]]
            # Places ascend: what comes before the next place has met all that could be earlier.
            self.open = self.open[~found & (self.place[self.open] > at[-1])]
            begin += step

    def result(self) -> pa.RecordBatch:
        if self.h is None:
            self._start()
        more = np.zeros(len(self.h), dtype=bool)
        if self.large and self.met >= self.looked_at:
            more[self.open] = True
        columns = [self.rows.column(self.rows.schema.names.index(n)) for n in ("bucket", "item")]
        return pa.RecordBatch.from_arrays([*columns, pa.array(self.near, mask=self.near < 0), pa.array(more)], names=["bucket", "item", "near", "open"])


def first_near(
    df: DataFrame, order: str = "ord", h: str = "h", scope: list[str] | None = None,
    max_distance: int = HASH_DISTANCE, bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Rows with an earlier near row, and the order of the first such row (`near_ord`).

    Copies of one hash are collapsed before hashes are compared, so a hash shared by any share of the rows costs
    no more than a rare one. Distinct hashes meet in buckets of one agreeing byte, in order, and a hash stops at its first
    hit: no pairs are made, and a dense cluster is settled by its first members, also where it arrives last. Hashes of large
    buckets that are still open after those go on to buckets of two and three agreeing bytes.
    """
    if not 0 <= max_distance <= LARGEST_DISTANCE:
        raise ValueError(f"distance must be between 0 and {LARGEST_DISTANCE}")
    scope = scope or []
    firsts = materialise(
        df.groupBy(*scope, F.col(h).alias("h")).agg(F.min(order).alias("place")).withColumn("item", F.monotonically_increasing_id()), "hashes"
    )
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Where even average buckets of one byte are beyond what a task holds, two bytes come first.
    skipped = int(firsts.count() > 256 * HELD)
    root = firsts.filter("h IS NOT NULL").select(*scope, "h", "place", "item", F.lit(-1).alias("last"), F.lit(0).cast("bigint").alias("path"), F.lit(True).alias("open"))
    met, current = [], root
    for level in range(BYTE_LEVELS):
        at = F.col("at")
        byte = F.call_function("shiftright", F.col("h"), at * BYTE).bitwiseAND(F.lit(255).cast("bigint"))
        # The path lists positions and values of the agreeing bytes, twelve bits each.
        split = current.select("*", F.explode(F.sequence(F.col("last") + 1, F.lit(8 - BYTE_LEVELS + level))).alias("at")).select(
            *scope, "h", "place", "item", "open", at.alias("last"), (F.col("path") * 4096 + (at + 1) * 256 + byte).alias("path")
        )
        if level < skipped:
            current = split
            continue
        split = materialise(split, "buckets")
        keys = ["path", *scope]
        sizes = split.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.count_if("open").alias("_open")).filter("_open > 0 AND _n > 1")
        sizes = materialise(
            sizes.select(
                *keys, F.monotonically_increasing_id().alias("bucket"), F.ceil(F.col("_open") / HELD).cast("int").alias("parts"),
                ((F.col("_n") > bucket_rows) & F.lit(level < BYTE_LEVELS - 1)).alias("large"),
            ),
            "sizes",
        )
        placed = split.join(sizes, keys)
        columns = ["bucket", "part", "kind", "h", "place", "item", "large"]
        asking = placed.filter("open").withColumns({"part": F.pmod(F.xxhash64("item"), F.col("parts")).cast("int"), "kind": F.lit(0)}).select(columns)
        asked = placed.withColumns({"part": F.explode(F.sequence(F.lit(0), F.col("parts") - 1)), "kind": F.lit(1)}).select(columns)
        dealt = asking.unionByName(asked).repartition(partitions, "bucket", "part").sortWithinPartitions("bucket", "part", "kind", "place")
        found = materialise(dealt.mapInArrow(_earliest(max_distance, LOOKED_AT), "bucket long, item long, near long, open boolean"), "met")
        met.append(found.filter(F.col("near").isNotNull()).select("item", "near"))
        if level == BYTE_LEVELS - 1 or found.filter("open").isEmpty():
            break
        # Whole buckets go on: their hashes are what the open ones are compared with.
        still = found.filter("open").select("bucket", "item", F.lit(True).alias("_still"))
        going = still.select("bucket").distinct()
        kept = placed.filter("large").join(going, "bucket", "left_semi")
        current = kept.join(still, ["bucket", "item"], "left").select(
            *scope, "h", "place", "item", "last", "path", F.coalesce("_still", F.lit(False)).alias("open")
        )
    around = reduce(DataFrame.unionByName, met).groupBy("item").agg(F.min("near").alias("_around"))
    best = firsts.join(around, "item", "left").select(*scope, F.col("h").alias(h), F.least("place", "_around").alias("near_ord"))
    found = lookup(df, best, [*[(c, c) for c in scope], (h, h)], F.lit(True), order, "_best")
    return found.withColumn("near_ord", F.col("_best.near_ord")).drop("_best").filter(F.col("near_ord") < F.col(order))
