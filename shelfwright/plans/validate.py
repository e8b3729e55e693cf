"""Quality gate: required fields, URL duplicates, image quality, near-duplicate images."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwright.functions.fields import filled, image_url, first_present, present, scoped, two_decimals
from shelfwright.functions.hashes import hash_text
from shelfwright.operators.dedup import keep_greedy
from shelfwright.operators.joins import lookup
from shelfwright.schemas import (
    BLUR_THRESHOLD, HASH_DISTANCE, MIN_HEIGHT, MIN_WIDTH, REQUIRED_FIELDS, VALIDATED,
)
from shelfwright.session import materialise


def missing_reason(image: Column | None = None) -> Column:
    """First missing required field, then the image URL; null when all are there."""
    image = image_url() if image is None else image
    checks = [(present(field), f"missing_{field}") for field in REQUIRED_FIELDS]
    checks.append((image != "", "missing_image_url"))
    return F.coalesce(*[F.when(~there, reason) for there, reason in checks])


def image_reason(
    width: Column, height: Column, blur: Column,
    min_width: int = MIN_WIDTH, min_height: int = MIN_HEIGHT, blur_threshold: float = BLUR_THRESHOLD,
) -> Column:
    """Why an image is refused: absent, undecodable (size -1), small or blurred; else null."""
    return (
        F.when(width.isNull(), "download_failed")
        .when((width < 0) | (height < 0), "invalid_image_format")
        .when((width < min_width) | (height < min_height), "too_small")
        .when(blur < blur_threshold, "too_blurry")
    )


def distinct_features(features: DataFrame) -> DataFrame:
    """One feature row per image URL."""
    columns = ["width", "height", "blur_score", "image_hash"]
    return (
        features.groupBy("original_image_url").agg(F.min(F.struct(*columns)).alias("_f"))
        .select("original_image_url", "_f.*")
    )


def gate(
    rows: DataFrame, features: DataFrame, scope: list[str] | None = None, order: str = "ord",
    max_distance: int = HASH_DISTANCE, **kw,
) -> DataFrame:
    """All rows with `reason` ('' = pass), `image_url` and their image features.

    `features` has `original_image_url, width, height, blur_score, image_hash`. Rows
    compare only with earlier rows that pass everything, within `scope`.
    """
    scope = ["category"] if scope is None else scope
    added = ["width", "height", "blur_score", "image_hash"]
    base = scoped(rows, scope).drop(*added).withColumn(
        "_image", image_url("original_image_url", "image_url" if "image_url" in rows.columns else None)
    )
    # Features are written before anything reads them: pixels are looked at once. Reasons are settled on
    # narrow rows; the full rows take part in one join at the end.
    known = materialise(distinct_features(features), "features")
    narrow = base.select(
        *scope, F.col(order).alias("ord"), "source_url", "_image", missing_reason(F.col("_image")).alias("_missing")
    )
    checkable = F.col("_missing").isNull()
    measured = lookup(narrow, known, [("_image", "original_image_url")], checkable, "ord", "_f").select(
        *scope, "ord", "source_url", "_image", "_missing", *[F.col(f"_f.{c}").alias(c) for c in added]
    )
    refused = F.when(checkable, image_reason(F.col("width"), F.col("height"), F.col("blur_score")))
    measured = materialise(measured.withColumn("_refused", refused), "measured")
    columns = [*scope, "ord", "source_url", "_image", "image_hash"]
    eligible = measured.filter(checkable & F.col("_refused").isNull()).select(*columns)
    kept = keep_greedy(
        eligible, ["source_url"], scope, near="image_hash", max_distance=max_distance, **kw
    ).select(*scope, "ord")
    accepted = materialise(eligible.join(kept, ["ord", *scope], "left_semi"), "accepted")
    on_scope = [(c, c) for c in scope]
    by_source = accepted.select(*scope, "source_url", F.col("ord").alias("kept_ord"))
    by_image = accepted.select(*scope, "_image", F.col("ord").alias("kept_ord"))
    compared = lookup(measured, by_source, [*on_scope, ("source_url", "source_url")], checkable, "ord", "_s")
    compared = lookup(compared, by_image, [*on_scope, ("_image", "_image")], checkable, "ord", "_i")
    at = F.col("ord")
    same = (F.col("_s.kept_ord") == at) & (F.col("_i.kept_ord") == at)
    earlier = (F.col("_s.kept_ord") < at) | (F.col("_i.kept_ord") < at)
    reason = (
        F.when(~checkable, F.col("_missing"))
        .when(same, "")
        .when(F.coalesce(earlier, F.lit(False)), "duplicate_url")
        .when(F.col("_refused").isNotNull(), F.col("_refused"))
        .otherwise("duplicate_image")
    )
    reasons = materialise(compared.select(*scope, F.col("ord").alias(order), *added, reason.alias("reason")), "reasons")
    joined = base.drop("image_url").join(reasons, [order, *scope])
    return joined.select(*[c for c in base.columns if c not in ("_image", "image_url")], *added, "reason", F.col("_image").alias("image_url"))


def validated(gated: DataFrame, run_ts: str) -> DataFrame:
    """Accepted rows in the validated layout."""
    values = {
        "original_image_url": F.col("image_url"),
        "final_category": first_present("final_category", "category"),
        "width": F.col("width").cast("string"),
        "height": F.col("height").cast("string"),
        "blur_score": two_decimals("blur_score"),
        "image_hash": hash_text("image_hash"),
        "auto_status": F.lit("pass"),
        "auto_reason": F.lit(""),
        "validated_at": F.lit(run_ts),
    }
    known = set(gated.columns)
    columns = [
        values[c].alias(c) if c in values else (filled(c).alias(c) if c in known else F.lit("").alias(c))
        for c in VALIDATED
    ]
    return gated.filter(F.col("reason") == "").select(*columns, "ord")


def auto_passed(rows: DataFrame, run_ts: str, category: str = "") -> DataFrame:
    """Every row, unchecked."""
    known = set(rows.columns)
    own = filled("category") if "category" in known else F.lit(category)
    override = "final_category" if "final_category" in known else F.lit("")
    values = {
        "original_image_url": image_url("original_image_url", "image_url" if "image_url" in known else None),
        "category": own,
        "final_category": first_present(override, own),
        "auto_status": F.lit("pass"),
        "auto_reason": F.lit("auto_pass_all"),
        "validated_at": F.lit(run_ts),
    }
    columns = [
        values[c].alias(c) if c in values else (filled(c).alias(c) if c in known else F.lit("").alias(c))
        for c in VALIDATED
    ]
    return rows.select(*columns, "ord")


def reason_counts(gated: DataFrame) -> DataFrame:
    """Rows per reason; '' counts the accepted ones."""
    return gated.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def validate(
    rows: DataFrame, features: DataFrame | None, run_ts: str, auto_pass: bool = False, **kw
) -> tuple[DataFrame, DataFrame]:
    """(validated rows, rejected rows with reason)."""
    if auto_pass:
        passed = auto_passed(rows, run_ts)
        return passed, rows.withColumn("reason", F.lit("")).filter(F.lit(False))
    gated = gate(rows, features, **kw)
    return validated(gated, run_ts), gated.filter(F.col("reason") != "")
