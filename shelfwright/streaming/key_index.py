"""Rows by key that batches of a stream add to and look up, without reading or writing the whole.

Each batch adds a folder of its own, laid out by hash bucket of the key; a lookup reads the buckets of its keys only. Every
`fan` folders are merged into one of the next level, as in a log-structured merge tree, so a row is rewritten once per
level and the number of folders grows with the logarithm of the number of batches. A batch that runs again
replaces its folder and sees earlier batches only; merges touch nothing but earlier, finished batches.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfwright.session import materialise
from shelfwright.sources import storage

BUCKETS = 64
FAN = 16


class KeyIndex:
    def __init__(self, spark: SparkSession, path: str, shape: str, keys: list[str], buckets: int = BUCKETS, fan: int = FAN) -> None:
        """`shape` is the schema of the rows as text; `keys` are those of its columns that lookups name."""
        self.spark, self.path, self.shape, self.keys, self.buckets, self.fan = spark, path, shape, keys, buckets, fan
        self.columns = [f.split()[0] for f in shape.split(", ")]

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(self.buckets)).cast("int")

    def spans(self, before: int) -> list[tuple[int, int, int]]:
        """(level, first batch, last batch) of the finished folders that hold the batches before a number, each once."""
        found = []
        for name in storage.names(self.spark, self.path):
            parts = re.fullmatch(r"span=(\d+)-(\d+)-(\d+)", name)
            if parts and int(parts.group(3)) < before and storage.exists(self.spark, f"{self.path}/{name}/_SUCCESS"):
                found.append(tuple(map(int, parts.groups())))
        out: list[tuple[int, int, int]] = []
        for level, first, last in sorted(found, reverse=True):  # merged folders win over what they were made of
            if not any(a <= first and last <= b for _, a, b in out):
                out.append((level, first, last))
        return sorted(out, key=lambda s: s[1])

    def _folder(self, level: int, first: int, last: int) -> str:
        return f"{self.path}/span={level:02}-{first:012}-{last:012}"

    def _read(self, spans: list[tuple[int, int, int]]) -> DataFrame:
        if not spans:
            return self.spark.createDataFrame([], f"{self.shape}, bucket int")
        shape = f"{self.shape}, span string, bucket int"
        return self.spark.read.schema(shape).option("basePath", self.path).parquet(*[self._folder(*s) for s in spans]).drop("span")

    def _write(self, rows: DataFrame, level: int, first: int, last: int) -> None:
        dealt = rows.repartition("bucket").sortWithinPartitions("bucket", *self.keys)
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(self._folder(level, first, last))

    def all(self, before: int) -> DataFrame:
        return self._read(self.spans(before)).drop("bucket")

    def of(self, wanted: DataFrame, before: int) -> DataFrame:
        """Rows of earlier batches in the buckets of the keys that `wanted` holds: all rows of those keys, and some others.

        At most as many bucket numbers as there are buckets come to the driver.
        """
        spans = self.spans(before)
        if not spans:
            return self._read([]).drop("bucket")
        needed = [r[0] for r in wanted.select(self._bucket().alias("b")).distinct().collect()]
        return self._read(spans).filter(F.col("bucket").isin(needed)).drop("bucket")

    def add(self, rows: DataFrame, batch: int, since: int | None = None) -> None:
        """Add the rows of a batch (or of all batches from `since` on); what it added before is replaced."""
        shown = rows.select(*self.columns).distinct().withColumn("bucket", self._bucket())
        self._write(shown, 0, batch if since is None else since, batch)

    def merge(self, batch: int, keep: Column | None = None) -> None:
        """Merge the folders of finished batches where `batch` completes a level; rows without `keep` are dropped then."""
        level, width = 1, self.fan
        while batch and batch % width == 0:
            spans = [s for s in self.spans(batch) if s[1] >= batch - width]
            if len(spans) > 1:
                rows = self._read(spans)
                self._write(rows if keep is None else rows.filter(keep), level, batch - width, batch - 1)
                for span in spans:
                    storage.delete(self.spark, self._folder(*span))
            level, width = level + 1, width * self.fan


def first_arrivals(batch: DataFrame, number: int, index: KeyIndex, time: str | None = None, ttl: str | None = None) -> DataFrame:
    """The first row of each key that no earlier batch had; its keys are added to the index.

    With `time` the earliest row of a key in the batch counts, and with `ttl` (an interval) a key is forgotten
    when a row comes later than that after the one kept; forgotten keys leave the index when folders are merged. The index
    needs the columns of its keys, and then `seen timestamp`.
    """
    others = [c for c in batch.columns if c not in index.keys]
    order = F.struct(*([time] if time else []), *others) if others else F.lit(0)
    firsts = batch.groupBy(*index.keys).agg(F.min_by(F.struct(*batch.columns), order).alias("_row")).select("_row.*")
    newest = batch.agg(F.max(time)).first()[0] if ttl is not None else None
    index.merge(number, None if newest is None else F.col("seen") >= F.lit(newest) - F.expr(f"interval {ttl}"))
    known = index.of(firsts, number)
    same = [firsts[k].eqNullSafe(known[k]) for k in index.keys]
    if ttl is not None:
        same.append(known["seen"] >= firsts[time] - F.expr(f"interval {ttl}"))
    new = materialise(firsts.join(known, same, "left_anti"), "arrivals")
    index.add(new.withColumn("seen", F.col(time)) if time else new, number)
    return new
