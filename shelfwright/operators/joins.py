"""Equi joins on text keys that may be blank, and last-row-wins maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwright.functions.fields import col, present, scoped


def last_wins(
    df: DataFrame, keys: list[str], ord_col: str | Column = "ord", keep: list[str] | None = None,
    scope: list[str] | None = None,
) -> DataFrame:
    """One row per scope and non-blank key: the one with the greatest order.

    An aggregate rather than a window, so a key holding a large share of the rows
    is reduced before the shuffle. Scope columns may be blank.
    """
    scope = scope or []
    columns = keep or [c for c in df.columns if c not in [*scope, *keys]]
    df = scoped(df, scope)
    for key in keys:
        df = df.filter(present(key))
    picked = df.groupBy(*scope, *keys).agg(F.max_by(F.struct(*columns), col(ord_col)).alias("_last"))
    return picked.select(*scope, *keys, "_last.*")


def _together(key: str) -> Column:
    """-1, computed from the key so that it stays a join key.

    As a constant it would be folded away; the join would then reuse the partitioning of
    an aggregation by the other keys, and a hot key could not be split at run time.
    """
    return F.least(F.length(F.col(key).cast("string")), F.lit(-1)).cast("bigint")


def _apart(alone: Column, ord_col: str) -> Column:
    """Second join key of the left rows: their own order for rows that match nothing."""
    return F.when(alone, F.col(ord_col)).otherwise(F.lit(-1).cast("bigint"))


def _keys_equal(on: list[tuple[str, str]]) -> Column:
    condition = F.col("_apart") == F.col("_together")
    for i, (l, _) in enumerate(on):
        condition = condition & (F.col(l) == F.col(f"_k{i}"))
    return condition


def lookup(
    left: DataFrame, right: DataFrame, on: list[tuple[str, str]], needed: Column, ord_col: str, name: str
) -> DataFrame:
    """Left join to a table that has one row per key, as a struct column `name`.

    Pairs before the last one in `on` are scope columns, filled on both sides.

    Rows that need no lookup (blank key, value already known) carry their own order,
    which is not negative, as a second join key. They match nothing, and they spread
    over all tasks instead of meeting in the task of the blank key.
    """
    keyed = left.withColumn("_apart", _apart(~needed, ord_col))
    side = right.select(
        *[F.col(r).alias(f"_k{i}") for i, (_, r) in enumerate(on)],
        _together(on[-1][1]).alias("_together"),
        F.struct(*right.columns).alias(name),
    )
    joined = keyed.join(side, _keys_equal(on), "left")
    return joined.drop("_apart", "_together", *[f"_k{i}" for i in range(len(on))])


def _filtered(left: DataFrame, right: DataFrame, on: list[tuple[str, str]], ord_col: str, how: str) -> DataFrame:
    # The last pair is the key; those before it are scope columns, where blank is a value.
    blank = ~present(on[-1][0])
    side = right.select(*[F.col(r).alias(f"_k{i}") for i, (_, r) in enumerate(on)]).distinct()
    side = side.withColumn("_together", _together(f"_k{len(on) - 1}"))
    return left.withColumn("_apart", _apart(blank, ord_col)).join(side, _keys_equal(on), how).drop("_apart")


def without(left: DataFrame, right: DataFrame, on: list[tuple[str, str]], ord_col: str = "ord") -> DataFrame:
    """Rows of `left` whose key is blank or does not occur in `right`."""
    return _filtered(left, right, on, ord_col, "left_anti")


def within(left: DataFrame, right: DataFrame, on: list[tuple[str, str]], ord_col: str = "ord") -> DataFrame:
    """Rows of `left` whose non-blank key occurs in `right`."""
    return _filtered(left, right, on, ord_col, "left_semi")
