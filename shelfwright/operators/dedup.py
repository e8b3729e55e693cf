"""Ordered duplicate removal.

`keep_first_by` is the single-key case. `keep_greedy` is the scan that drops a row
when any of its keys, or a near image hash, occurs in an earlier *kept* row: keys of
dropped rows block nothing. The kept rows are the lexicographically first maximal
independent set of the conflict graph, found in rounds: a row that is first under all
its keys is kept, rows that share a key with a kept row go, and the rest continue. Chains
of conflicts, which would take a round per row, are followed by pointer doubling.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from shelfwright.functions.fields import present, scoped
from shelfwright.operators.neardup import near_pairs
from shelfwright.operators.ranking import DENSE_CHUNKS, with_position
from shelfwright.schemas import HASH_DISTANCE
from shelfwright.session import discard, materialise

# With hashes, rows enter by position: the first FIRST_STEP of each scope, then STEP_GROWTH
# times as many. Later rows meet only survivors, so dense clusters are thinned out early.
FIRST_STEP = 4096
STEP_GROWTH = 4


def keep_first_by(df: DataFrame, keys: list[str], order: str = "ord") -> DataFrame:
    """First row per key (an aggregate, reduced before the shuffle); blank keys all stay."""
    full = df
    for key in keys:
        full = full.filter(present(key))
    blank = df.filter(~reduce(lambda a, b: a & b, [present(k) for k in keys]))
    firsts = full.groupBy(*keys).agg(F.min_by(F.struct(*df.columns), F.col(order)).alias("_row"))
    return firsts.select("_row.*").unionByName(blank)


def _firsts(left: DataFrame, scope: list[str], keys: list[str]) -> dict[str, DataFrame]:
    return {k: left.filter(F.col(k).isNotNull()).groupBy(*scope, k).agg(F.min("ord").alias("ord")) for k in keys}


def _around(edges: DataFrame, firsts: DataFrame, scope: list[str], near: str) -> DataFrame:
    """Per hash the first undecided row with a near hash."""
    other_first = firsts.select(*scope, F.col(near).alias("other"), F.col("ord").alias("_o"))
    return (
        edges.join(other_first, ["other", *scope]).groupBy(*scope, "h").agg(F.min("_o").alias("_around"))
        .withColumnRenamed("h", near)
    )


def _chains(left: DataFrame, scope: list[str], keys: list[str], near: str | None, edges: DataFrame | None) -> DataFrame:
    """Rows of `left` that are kept, among those whose fate follows from chains of conflicts.

    A row whose only earlier conflict is with the first row of one key group is kept if and only if
    that row is not. Such rows point to the other row; pointers are followed by doubling, so a chain
    of n rows takes about log2(n) joins. Chains that end in a row without earlier conflicts are decided.
    """
    columns = [*scope, "ord", *keys]
    firsts = _firsts(left, scope, keys)
    placed = left
    for n, k in enumerate(keys):
        first = firsts[k].select(*scope, k, F.col("ord").alias(f"_f{n}"))
        placed = placed.join(first, [k, *scope], "left")
    placed = materialise(placed, "firsts")
    for n, k in enumerate(keys):
        later = placed.filter(F.col(k).isNotNull() & (F.col("ord") > F.col(f"_f{n}")))
        second = later.groupBy(*scope, k).agg(F.min("ord").alias(f"_s{n}"))
        placed = placed.join(second, [k, *scope], "left")
    blocked = reduce(
        lambda a, b: a + b, [F.coalesce(F.col(f"_f{n}") < F.col("ord"), F.lit(False)).cast("int") for n in range(len(keys))]
    )
    parent = F.coalesce(*[
        F.when((F.col(f"_f{n}") < F.col("ord")) & (F.col(f"_s{n}") == F.col("ord")), F.col(f"_f{n}")) for n in range(len(keys))
    ])
    clear = F.lit(True)
    if edges is not None:
        placed = placed.join(_around(edges, firsts[near], scope, near), [near, *scope], "left")
        clear = F.col("_around").isNull() | (F.col("_around") > F.col("ord"))
    follows = clear & (blocked == 1) & parent.isNotNull()
    pointers = materialise(
        placed.select(
            *scope, "ord", F.when(follows, parent).otherwise(F.col("ord")).alias("up"),
            F.when(follows, 1).otherwise(0).alias("odd"), (clear & (blocked == 0)).alias("top"),
        ),
        "pointers",
    )
    while True:
        above = pointers.select(
            *scope, F.col("ord").alias("up"), F.col("up").alias("_up"), F.col("odd").alias("_odd"), F.col("top").alias("_top")
        )
        following = materialise(
            pointers.join(above, ["up", *scope]).select(
                *scope, "ord", F.col("_up").alias("up"), ((F.col("odd") + F.col("_odd")) % 2).alias("odd"), F.col("_top").alias("top"),
                (F.col("_up") != F.col("up")).alias("_moved"),
            ),
            "pointers",
        )
        discard(pointers)
        pointers = following.drop("_moved")
        pointers._scratch_path = following._scratch_path
        if following.filter("_moved").isEmpty():
            break
    decided = pointers.filter(F.col("top") & (F.col("odd") == 0)).select(*scope, "ord")
    return left.join(decided, ["ord", *scope], "left_semi").select(*columns)


def _rounds(
    left: DataFrame, scope: list[str], keys: list[str], near: str | None, max_distance: int
) -> list[DataFrame]:
    """Kept nodes of a written table `left`, as the written tables of the single rounds.

    A round that decides less than half of the rows is followed by one that also resolves chains.
    """
    columns = [*scope, "ord", *keys]
    edges = None
    if near:
        hashes = left.select(*scope, F.col(near).alias("h")).distinct()
        edges = materialise(near_pairs(hashes, None, scope, max_distance), "near")
    kept: list[DataFrame] = []
    n_left, slow = left.count(), False
    key_count = reduce(lambda a, b: a + b, [F.col(k).isNotNull().cast("int") for k in keys])
    while n_left:
        if slow:
            winners = _chains(left, scope, keys, near, edges)
        else:
            # The first row under each key; a row is kept if it is first under all its keys.
            firsts = _firsts(left, scope, keys)
            wins = reduce(DataFrame.unionByName, [f.select(*scope, "ord") for f in firsts.values()])
            wins = wins.groupBy(*scope, "ord").agg(F.count(F.lit(1)).alias("_wins"))
            winners = left.join(wins, ["ord", *scope]).filter(F.col("_wins") == key_count).select(*columns)
            if edges is not None:
                winners = (
                    winners.join(_around(edges, firsts[near], scope, near), [near, *scope], "left")
                    .filter(F.col("_around").isNull() | (F.col("_around") > F.col("ord")))
                    .select(*columns)
                )
        winners = materialise(winners, "kept")
        kept.append(winners)
        rest = left
        for k in keys:
            taken = winners.filter(F.col(k).isNotNull()).select(*scope, k)
            if k == near:
                reached = edges.join(taken.withColumnRenamed(near, "h"), ["h", *scope], "left_semi")
                taken = taken.unionByName(reached.select(*scope, F.col("other").alias(near)))
            rest = rest.join(taken, [k, *scope], "left_anti")
        following = materialise(rest.select(*columns), "undecided")
        discard(left)
        left, before = following, n_left
        n_left = left.count()
        slow = 2 * n_left > before
    return kept


def _steps(
    nodes: DataFrame, scope: list[str], keys: list[str], near: str, max_distance: int, first_step: int,
    shifts: tuple[int, ...],
) -> list[DataFrame]:
    """Kept nodes when hashes are compared: by growing ranges of positions."""
    sizes = nodes.groupBy(*scope).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()
    largest = sizes[0] or 0
    columns = [*scope, "ord", *keys]
    placed = materialise(with_position(nodes, "ord", scope, position="_pos", shifts=shifts), "nodes")
    kept: list[DataFrame] = []
    low, high = 0, first_step
    while low < largest:
        step = placed.filter((F.col("_pos") > low) & (F.col("_pos") <= high)).select(*columns)
        if kept:
            so_far = reduce(DataFrame.unionByName, kept)
            for k in keys:
                step = step.join(so_far.filter(F.col(k).isNotNull()).select(*scope, k), [k, *scope], "left_anti")
            step = materialise(step, "step")
            reached = near_pairs(
                step.select(*scope, F.col(near).alias("h")).distinct(),
                so_far.select(*scope, F.col(near).alias("h")), scope, max_distance,
            )
            step = step.join(reached.select(*scope, F.col("h").alias(near)), [near, *scope], "left_anti")
        kept += _rounds(materialise(step, "undecided"), scope, keys, near, max_distance)
        low, high = high, high * STEP_GROWTH
    return kept


def keep_greedy(
    df: DataFrame,
    keys: list[str],
    scope: list[str] | None = None,
    order: str = "ord",
    near: str | None = None,
    max_distance: int = HASH_DISTANCE,
    first_step: int = FIRST_STEP,
    shifts: tuple[int, ...] = DENSE_CHUNKS,
) -> DataFrame:
    """Kept nodes (scope, ord, keys) of the ordered scan.

    A null key never matches; callers turn blanks into nulls where blanks must not
    match. Rows with equal keys are collapsed to their first, which cannot change the
    outcome. `near` names a 64-bit hash column, never null, whose values conflict within
    `max_distance`.
    """
    scope = scope or []
    if near and near not in keys:
        keys = [*keys, near]
    no_key = reduce(lambda a, b: a & b, [F.col(k).isNull() for k in keys])
    nodes = materialise(
        df.filter(~no_key).groupBy(*scope, *keys).agg(F.min(order).alias("ord")).select(*scope, "ord", *keys),
        "nodes",
    )
    if near:
        kept = _steps(nodes, scope, keys, near, max_distance, first_step, shifts)
    else:
        kept = _rounds(nodes, scope, keys, None, max_distance)
    free = df.filter(no_key).select(*scope, F.col(order).alias("ord"), *keys)
    return reduce(DataFrame.unionByName, [*kept, free])


def keep_rows(
    df: DataFrame, keys: list[str], scope: list[str] | None = None, order: str = "ord",
    blank_is_key: bool = False, **kw,
) -> DataFrame:
    """Rows of `df` that the ordered scan over its URL columns keeps."""
    scope = scope or []
    df = scoped(df, scope)
    names = [f"key{i}" for i in range(len(keys))]
    values = [F.coalesce(F.col(k), F.lit("")) if blank_is_key else F.nullif(F.col(k), F.lit("")) for k in keys]
    nodes = df.select(*scope, F.col(order).alias("ord"), *[v.alias(n) for v, n in zip(values, names)])
    kept = keep_greedy(nodes, names, scope, **kw).select(*scope, F.col("ord").alias(order))
    return df.join(kept, [order, *scope], "left_semi")
