"""Positions, limits, pages, renumbering and splits over an explicit row order.

A plain `row_number()` would sort a whole category, or the whole table, in one
task. `with_position` numbers rows in chunks of the order column instead and adds
the number of rows in earlier chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwright.functions.fields import padded_id, scoped

# Order values are unique integers within a scope, so a chunk of 2**18 of them holds
# at most that many rows; the second width bounds the chunks counted in one window.
DENSE_CHUNKS = (18, 36)
# For 60-bit hash keys: 65,536 chunks of equal expected size.
HASH_CHUNKS = (44,)


def _before(counts: DataFrame, scope: list[str], shifts: tuple[int, ...]) -> DataFrame:
    """Rows ahead of each chunk, and rows of the whole scope."""
    if not shifts:
        w = Window.partitionBy(*(scope or [F.lit(0)]))
        running = w.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
        ahead = F.coalesce(F.sum("_n").over(running), F.lit(0))
        return counts.select(*scope, "_chunk", ahead.alias("_ahead"), F.sum("_n").over(w).alias("_all"))
    wide = counts.withColumn("_wide", F.shiftright("_chunk", shifts[0]))
    coarse = (
        wide.groupBy(*scope, "_wide").agg(F.sum("_n").alias("_n")).withColumnRenamed("_wide", "_chunk")
    )
    upper = _before(coarse, scope, tuple(s - shifts[0] for s in shifts[1:])).withColumnsRenamed(
        {"_chunk": "_wide", "_ahead": "_base"}
    )
    inner = Window.partitionBy("_wide", *scope).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum("_n").over(inner), F.lit(0))
    return (
        wide.withColumn("_within", ahead)
        .join(upper, ["_wide", *scope])
        .select(*scope, "_chunk", (F.col("_base") + F.col("_within")).alias("_ahead"), "_all")
    )


def with_position(
    df: DataFrame,
    order: str = "ord",
    scope: list[str] | None = None,
    ties: list[str] | None = None,
    position: str = "pos",
    total: str | None = None,
    limit: int | None = None,
    shifts: tuple[int, ...] = DENSE_CHUNKS,
) -> DataFrame:
    """Add the 1-based position of each row in its scope, without a one-task sort.

    Scope columns come out filled: rows without a value share the blank one. With `limit` only
    the first rows of each scope are kept; chunks that lie beyond it are dropped before the sort.
    """
    scope = scope or []
    chunked = scoped(df, scope).withColumn("_chunk", F.shiftright(F.col(order).cast("bigint"), shifts[0]))
    counts = chunked.groupBy(*scope, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    ahead = _before(counts, scope, tuple(s - shifts[0] for s in shifts[1:]))
    if limit is not None:
        ahead = ahead.filter(F.col("_ahead") < limit)
    w = Window.partitionBy("_chunk", *scope).orderBy(order, *(ties or []))
    out = chunked.join(ahead, ["_chunk", *scope]).withColumn(
        position, F.col("_ahead") + F.row_number().over(w).cast("bigint")
    )
    if total:
        out = out.withColumn(total, F.col("_all"))
    if limit is not None:
        out = out.filter(F.col(position) <= limit)
    wanted = [*df.columns, position] + ([total] if total else [])
    return out.select(*wanted)


def first_rows(df: DataFrame, n: int, order: str = "ord", scope: list[str] | None = None, **kw) -> DataFrame:
    """The first `n` rows of each scope in order."""
    return with_position(df, order, scope, limit=n, position="_pos", **kw).drop("_pos")


def page_of(df: DataFrame, page: int, size: int, order: str = "ord", scope: list[str] | None = None) -> DataFrame:
    """Rows of a 1-based page of each scope; no offset scan through one task."""
    last = page * size
    return (
        with_position(df, order, scope, position="_pos", limit=last)
        .filter(F.col("_pos") > last - size)
        .drop("_pos")
    )


def renumbered(
    df: DataFrame, start: int = 1, width: int = 6, order: str = "ord", scope: list[str] | None = None, **kw
) -> DataFrame:
    """Replace `id` by a dense zero-padded number in row order."""
    number = F.col("_pos") + F.lit(start - 1)
    columns = df.columns if "id" in df.columns else ["id", *df.columns]
    return (
        with_position(df, order, scope, position="_pos", **kw)
        .withColumn("id", padded_id(number, width))
        .select(*columns)
    )


def seeded_key(seed: int | str, *columns: Column | str) -> Column:
    """60-bit integer from the md5 of a seed and the given columns."""
    text = F.concat_ws(":", F.lit(str(seed)), *columns)
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def shuffled(df: DataFrame, seed: int, *columns: str) -> DataFrame:
    """Rows in a repeatable random order (a range-partitioned sort)."""
    return df.withColumn("_key", seeded_key(seed, *columns)).orderBy("_key", *columns).drop("_key")


def split_sets(
    df: DataFrame, seed: int, scope: list[str], key: list[str], order: str = "ord"
) -> DataFrame:
    """Add `split`: per scope exactly floor(.8n) train, floor(.1n) valid, the rest test."""
    keyed = df.withColumn("_key", seeded_key(seed, *key, F.col(order).cast("string")))
    ranked = with_position(
        keyed, "_key", scope, ties=[order], position="_pos", total="_total", shifts=HASH_CHUNKS
    )
    train = F.expr("_total * 8 div 10")
    valid = F.expr("_total div 10")
    split = (
        F.when(F.col("_pos") <= train, "train")
        .when(F.col("_pos") <= train + valid, "valid")
        .otherwise("test")
    )
    return ranked.withColumn("split", split).drop("_key", "_pos", "_total")
