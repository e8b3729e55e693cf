"""Plan and outcome of publishing images: what to keep, reuse or upload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwright.functions.fields import filled, final_category, first_present, image_url, present, scoped
from shelfwright.functions.naming import (
    output_filename, public_id, publish_folder, retry_locally, upload_error, upload_request,
)
from shelfwright.functions.urls import is_asos_image
from shelfwright.operators.joins import last_wins, lookup
from shelfwright.operators.ranking import with_position
from shelfwright.plans.review import SCOPE, approved
from shelfwright.schemas import FIRST_FILE_NUMBER, MAPPING, PUBLISHED
from shelfwright.session import materialise


def clean_or_approved(clean: DataFrame, reviewed: DataFrame | None) -> DataFrame:
    """The clean table, or the approved reviews while there is none."""
    if reviewed is None or not clean.isEmpty():
        return clean
    return approved(reviewed)


def with_mapping(rows: DataFrame, mapping: DataFrame, order: str = "ord", scope: list[str] = SCOPE) -> DataFrame:
    """Add `matched`: the last mapping row of the expected id, else of the file name, in the row's scope.

    A row found by id counts even if its content is unusable.
    """
    by_id = last_wins(mapping, ["public_id"], keep=["filename", "secure_url", "original_image_url"], scope=scope)
    by_name = last_wins(mapping, ["filename"], keep=["public_id", "secure_url", "original_image_url"], scope=scope)
    asked, on = present("image_url"), [(c, c) for c in scope]
    columns = [*scope, *MAPPING]
    found = lookup(
        scoped(rows, scope), by_id.select(*columns), [*on, ("expected_id", "public_id")], asked, order, "_by_id"
    )
    need_name = asked & F.col("_by_id").isNull() & present("filename")
    found = lookup(found, by_name.select(*columns), [*on, ("filename", "filename")], need_name, order, "_by_name")
    return found.withColumn("matched", F.coalesce("_by_id", "_by_name")).drop("_by_id", "_by_name")


def publish_plan(
    clean: DataFrame, mapping: DataFrame, run_ts: str, category: str = "", prefix: str = "",
    first_number: int = FIRST_FILE_NUMBER, scope: list[str] = SCOPE, reviewed: DataFrame | None = None,
) -> DataFrame:
    """One row per clean row with its action and the values it would be published with.

    Files are numbered and the mapping is searched within the scope. Actions: missing_image,
    keep_existing, reuse_mapping, upload_local, upload_remote.
    """
    rows = clean_or_approved(clean, reviewed)
    absent = [c for c in PUBLISHED if c not in rows.columns]
    rows = rows.withColumns({c: F.lit("") for c in absent}) if absent else rows
    placed = with_position(rows, "ord", scope, position="_pos")
    folder_category = final_category(first_present(F.lit(category), F.lit("unknown")))
    named = placed.withColumns({
        "old_filename": filled("filename"),
        "old_image_url": filled("original_image_url"),
        "filename": output_filename(F.col("_pos") - 1, first_number),
        "image_url": image_url("original_image_url", "image_url" if "image_url" in rows.columns else None),
        "folder": publish_folder(folder_category, prefix),
    }).drop("_pos")
    named = named.withColumn("expected_id", public_id(folder_category, "filename", prefix))
    found = with_mapping(named, mapping, scope=scope)
    published = present("cloudinary_url") & present("cloudinary_public_id")
    keeps = published & (F.col("cloudinary_public_id") == F.col("expected_id"))
    mapped_image = filled("matched.original_image_url")
    reuses = (
        present("matched.secure_url") & present("matched.public_id")
        & (mapped_image != "") & (mapped_image == F.col("image_url"))
    )
    action = (
        F.when(F.col("image_url") == "", "missing_image")
        .when(keeps, "keep_existing")
        .when(reuses, "reuse_mapping")
        .when(is_asos_image("image_url"), "upload_local")
        .otherwise("upload_remote")
    )
    uploads = F.col("action").startswith("upload")
    reused = F.col("action") == "reuse_mapping"
    return found.withColumn("action", action).withColumns({
        "legacy_mapping_ignored": uploads & F.col("matched").isNotNull() & (mapped_image == ""),
        "outside_folder": uploads & published,
        "cloudinary_url": F.when(reused, F.col("matched.secure_url")).otherwise(filled("cloudinary_url")),
        "cloudinary_public_id": F.when(reused, F.col("matched.public_id")).otherwise(filled("cloudinary_public_id")),
        "uploaded_at": F.when(reused, first_present("uploaded_at", F.lit(run_ts))).otherwise(filled("uploaded_at")),
        "request": F.when(uploads, upload_request(F.col("folder"), F.col("filename"))),
    }).drop("matched")


def _last_attempt(rows: DataFrame, scope: list[str], columns: list[str], tie: list[Column]) -> DataFrame:
    """One row per uploaded row: that of the greatest `attempt`, where there is such a column."""
    attempt = F.col("attempt").cast("bigint") if "attempt" in rows.columns else F.lit(0).cast("bigint")
    named = scoped(rows, scope).withColumn("_at", F.struct(F.coalesce(attempt, F.lit(0)), *tie))
    picked = named.groupBy(*scope, "ord").agg(F.max_by(F.struct(*columns), F.col("_at")).alias("_last"))
    return picked.select(*scope, "ord", "_last.*")


def settled_uploads(plan: DataFrame, results: DataFrame, run_ts: str, scope: list[str] = SCOPE) -> DataFrame:
    """The clean table after the uploads, with `_mapped`: whether the row's image is published.

    `results` has the scope columns, `ord`, `secure_url, public_id`, `failed BOOLEAN` and, where
    uploads were tried again, `attempt`; the last attempt counts, and without one a success.
    Failed rows stay as they were and get no mapping row; the mapping table holds this run's rows only.
    """
    columns = ["secure_url", "public_id", "failed"]
    tie = [~F.coalesce("failed", F.lit(False)), filled("secure_url"), filled("public_id")]
    outcome = _last_attempt(results, scope, columns, tie)
    uploads = F.col("action").startswith("upload")
    rows = lookup(scoped(plan, scope), outcome, [*[(c, c) for c in scope], ("ord", "ord")], uploads, "ord", "_u")
    done = uploads & F.col("_u").isNotNull() & ~F.coalesce(F.col("_u.failed"), F.lit(False))
    stands = F.col("action").isin("keep_existing", "reuse_mapping")

    def when_done(new: Column, otherwise: Column) -> Column:
        return F.when(F.col("_done"), new).otherwise(otherwise)

    settled = rows.withColumns({"_done": done, "_mapped": done | stands})
    settled = settled.withColumns({
        "cloudinary_url": when_done(filled("_u.secure_url"), F.col("cloudinary_url")),
        "cloudinary_public_id": when_done(
            F.coalesce(F.col("_u.public_id"), F.col("expected_id")), F.col("cloudinary_public_id")
        ),
        "uploaded_at": when_done(F.lit(run_ts), F.col("uploaded_at")),
        "original_image_url": F.when(F.col("_mapped"), F.col("image_url")).otherwise(F.col("old_image_url")),
        "filename": F.when(F.col("_mapped"), F.col("filename")).otherwise(F.col("old_filename")),
    })
    return settled.select(*[filled(c).alias(c) for c in PUBLISHED], "ord", "_mapped")


def published_tables(settled: DataFrame, scope: list[str] = SCOPE) -> tuple[DataFrame, DataFrame]:
    """(clean table, mapping table) of rows settled by a run."""
    clean = settled.select(*PUBLISHED, "ord")
    mapping = settled.filter("_mapped").select(
        *scope, "filename", F.col("cloudinary_url").alias("secure_url"),
        F.col("cloudinary_public_id").alias("public_id"), "original_image_url", "ord",
    )
    return clean, mapping


def apply_upload_results(
    plan: DataFrame, results: DataFrame, run_ts: str, scope: list[str] = SCOPE
) -> tuple[DataFrame, DataFrame]:
    """(clean table, mapping table) after the uploads, both read from one written table; see `settled_uploads`."""
    return published_tables(materialise(settled_uploads(plan, results, run_ts, scope), "settled"), scope)


def failed_uploads(plan: DataFrame, failures: DataFrame, scope: list[str] = SCOPE) -> DataFrame:
    """Classified failures: `failures` has the scope columns, `ord, error_class, error_message, first_try_local`."""
    joined = scoped(plan, scope).select(*scope, "ord", "image_url").join(scoped(failures, scope), [*scope, "ord"])
    verdict = upload_error(F.col("error_message"), F.col("error_class"), F.col("image_url"))
    return (
        joined.withColumn("_e", verdict)
        .withColumn("retry_local", retry_locally(F.col("_e.source"), F.col("_e.reason"), F.col("first_try_local")))
        .select(*scope, "ord", "_e.source", "_e.reason", "_e.hint", "retry_local")
    )


def action_counts(plan: DataFrame) -> DataFrame:
    return plan.groupBy("action").agg(F.count(F.lit(1)).alias("n"))
