"""Human review decisions merged into the reviewed and clean tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwright.functions.fields import filled, first_present, image_url, present, scoped
from shelfwright.operators.joins import last_wins, lookup, without
from shelfwright.operators.ranking import page_of
from shelfwright.schemas import CLEAN, REVIEWED
from shelfwright.session import materialise


# Ids start anew in every category, so a row is known by both.
SCOPE = ["category"]


def latest_reviews(reviewed: DataFrame, scope: list[str] = SCOPE) -> DataFrame:
    """Per scope and non-blank id the last saved review, at the place of the first one."""
    columns = [c for c in REVIEWED if c not in [*scope, "id"]]
    merged = scoped(reviewed, scope).filter(present("id")).groupBy(*scope, "id").agg(
        F.max_by(F.struct(*columns), F.col("ord")).alias("_r"), F.min("ord").alias("ord")
    )
    return merged.select(*scope, "id", "_r.*", "ord").select(*REVIEWED, "ord")


def _on(scope: list[str], key: str = "id") -> list[tuple[str, str]]:
    return [(c, c) for c in [*scope, key]]


def default_category(saved: Column) -> Column:
    return first_present(saved, "final_category", "category")


def decided(
    validated: DataFrame, reviewed: DataFrame, decisions: DataFrame, run_ts: str, scope: list[str] = SCOPE, latest: DataFrame | None = None
) -> DataFrame:
    """Reviewed-table rows for the validated rows that have a decision.

    `decisions` has the scope columns and `id, reject, final_category, reviewed_at`; of several
    for a row the last one counts. A blank category keeps the default: the saved one, then
    the row's own. `latest` are the latest reviews, where they are written already.
    """
    named = decisions.select(
        *scope, "id", F.col("reject").alias("_reject"), filled("final_category").alias("_choice"),
        filled("reviewed_at").alias("_at"),
    )
    # Decisions of the same time: one of them, the same in every run.
    chosen = last_wins(named, ["id"], F.struct("_at", "_reject", "_choice"), ["_reject", "_choice"], scope)
    latest = latest_reviews(reviewed, scope) if latest is None else latest
    saved = latest.select(*scope, "id", F.col("final_category").alias("_saved"))
    known = set(validated.columns)
    asked = scoped(validated, scope).filter(present("id"))
    rows = lookup(asked, chosen, _on(scope), F.lit(True), "ord", "_d")
    rows = lookup(rows.filter(F.col("_d").isNotNull()), saved, _on(scope), F.lit(True), "ord", "_v")
    values = {
        "original_image_url": image_url("original_image_url", "image_url" if "image_url" in known else None),
        "final_category": first_present(F.col("_d._choice"), default_category(F.col("_v._saved"))),
        "human_status": F.when(F.coalesce(F.col("_d._reject"), F.lit(False)), "rejected").otherwise("approved"),
        "human_reason": F.lit(""),
        "reviewed_at": F.lit(run_ts),
    }
    columns = [
        values[c].alias(c) if c in values else (filled(c).alias(c) if c in known else F.lit("").alias(c))
        for c in REVIEWED
    ]
    return rows.select(*columns, "ord")


def upserted(reviewed: DataFrame, new: DataFrame, scope: list[str] = SCOPE, latest: DataFrame | None = None) -> DataFrame:
    """Reviewed table after new reviews: replaced in place, unknown ids at the end."""
    existing = latest_reviews(reviewed, scope) if latest is None else latest
    both = existing.withColumn("_new", F.lit(0)).unionByName(
        scoped(new, scope).filter(present("id")).select(*REVIEWED, "ord").withColumn("_new", F.lit(1))
    )
    columns = [c for c in REVIEWED if c not in [*scope, "id"]]
    at = F.struct("_new", "ord")
    merged = both.groupBy(*scope, "id").agg(F.max_by(F.struct(*columns), at).alias("_r"), F.min(at).alias("_at"))
    after = existing.agg(F.coalesce(F.max("ord") + 1, F.lit(0)).alias("n")).scalar()
    place = F.when(F.col("_at._new") == 0, F.col("_at.ord")).otherwise(after + F.col("_at.ord"))
    return merged.select(*scope, "id", "_r.*", place.alias("ord")).select(*REVIEWED, "ord")


def approved(reviewed: DataFrame) -> DataFrame:
    """Clean table: approved rows without the review columns."""
    return reviewed.filter(F.col("human_status") == "approved").select(
        *[filled(c).alias(c) for c in CLEAN], "ord"
    )


def pending(validated: DataFrame, reviewed: DataFrame, scope: list[str] = SCOPE) -> DataFrame:
    """Rows without a review status; rows without id always are."""
    done = latest_reviews(reviewed, scope).filter(present("human_status")).select(*scope, "id")
    return without(scoped(validated, scope), done, _on(scope))


def progress(validated: DataFrame, reviewed: DataFrame, scope: list[str] = SCOPE) -> DataFrame:
    """One row: total, reviewed, pending."""
    total = validated.agg(F.count(F.lit(1)).alias("total"))
    seen = latest_reviews(reviewed, scope).agg(F.count(F.lit(1)).alias("n")).scalar()
    waiting = pending(validated, reviewed, scope).agg(F.count(F.lit(1)).alias("n")).scalar()
    return total.select("total", seen.alias("reviewed"), waiting.alias("pending"))


def page_count(n: int, size: int) -> int:
    return max(1, -(-n // size))


def review_page(
    validated: DataFrame, reviewed: DataFrame, page: int, size: int = 25, scope: list[str] = SCOPE
) -> DataFrame:
    """A page of pending rows in each scope; of all its rows where none is pending."""
    rows = scoped(validated, scope)
    waiting = pending(rows, reviewed, scope)
    if not scope:
        return page_of(rows if waiting.isEmpty() else waiting, page, size)
    some = waiting.select(*scope).distinct()
    shown = waiting.unionByName(rows.join(some, scope, "left_anti"))
    return page_of(shown, page, size, scope=scope)


def apply_reviews(
    validated: DataFrame, reviewed: DataFrame, decisions: DataFrame, run_ts: str, scope: list[str] = SCOPE
) -> tuple[DataFrame, DataFrame]:
    """(reviewed table, clean table) after a set of decisions, settled once."""
    # Read three times: for saved categories, for the merge and for its last place.
    latest = materialise(latest_reviews(reviewed, scope), "latest")
    new = decided(validated, reviewed, decisions, run_ts, scope, latest)
    merged = materialise(upserted(reviewed, new, scope, latest), "reviewed")
    return merged, approved(merged)
