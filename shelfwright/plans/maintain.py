"""Upkeep of published datasets: renumber, split, clean links, sync, summarise."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwright.functions.fields import filled, padded_id, present, scoped
from shelfwright.functions.naming import listed_filename
from shelfwright.operators.joins import last_wins, lookup, within
from shelfwright.operators.ranking import shuffled, split_sets, with_position
from shelfwright.schemas import CLEAN, DATASET_MAPPING, MAPPING, PUBLISHED_EXTRA
from shelfwright.sources.stage_files import merged_columns


def renumber(
    products: DataFrame, mapping: DataFrame | None = None, start: int = 1, width: int = 6,
    strict: bool = False, scope: list[str] | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Products with dense ids, and with mapping row i attached to product row i.

    Mapping rows beyond the products keep their own image URL. `strict` refuses
    different row counts.
    """
    scope = scope or []
    header = [c for c in products.columns if c != "ord"]
    numbered = with_position(products, "ord", scope, position="_pos")
    numbered = numbered.withColumn("id", padded_id(F.col("_pos") + F.lit(start - 1), width))
    if mapping is None:
        return numbered.select(*merged_columns(header, [], CLEAN), "ord"), None
    if strict:
        n, m = products.count(), mapping.count()
        if n != m:
            raise ValueError(f"{n} products cannot be paired with {m} mapping rows ({m} != {n})")
    placed = with_position(mapping, "ord", scope, position="_pos").select(
        *scope, "_pos", F.col("ord").alias("_m_ord"),
        F.struct(*[filled(c).alias(c) if c in mapping.columns else F.lit("").alias(c) for c in MAPPING]).alias("_m"),
    )
    columns = merged_columns(header, PUBLISHED_EXTRA, CLEAN)
    has = F.col("_m").isNotNull()

    def own(name: str):
        return filled(name) if name in header else F.lit("")

    attached = {
        "filename": F.when(has, F.col("_m.filename")).otherwise(own("filename")),
        "cloudinary_url": F.when(has, F.col("_m.secure_url")).otherwise(own("cloudinary_url")),
        "cloudinary_public_id": F.when(has, F.col("_m.public_id")).otherwise(own("cloudinary_public_id")),
    }
    joined = numbered.join(placed, [*scope, "_pos"], "left")
    out_products = joined.select(
        *[(attached[c] if c in attached else (F.col(c) if c in ("id", *header) else F.lit(""))).alias(c) for c in columns],
        "ord",
    )
    images = numbered.select(*scope, "_pos", filled("original_image_url").alias("_image"))
    out_mapping = placed.join(images, [*scope, "_pos"], "left").select(
        *scope, "_m.filename", "_m.secure_url", "_m.public_id",
        F.coalesce(F.col("_image"), F.col("_m.original_image_url")).alias("original_image_url"),
        F.col("_m_ord").alias("ord"),
    )
    return out_products, out_mapping


def renumber_counts(products: DataFrame, mapping: DataFrame) -> DataFrame:
    """One row: product rows, rows with a mapping attached."""
    m = mapping.agg(F.count(F.lit(1)).alias("m")).scalar()
    return products.agg(F.count(F.lit(1)).alias("rows")).select("rows", F.least("rows", m).alias("attached"))


def split_dataset(mapping: DataFrame, seed: int = 42, scope: list[str] | None = None) -> DataFrame:
    """Mapping rows with `split`, exact 80/10/10 counts per category."""
    return split_sets(mapping, seed, scope or ["category"], ["public_id"])


def split_report(split: DataFrame, scope: list[str] | None = None) -> DataFrame:
    keys = scope or ["category"]
    return (
        split.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("total"),
            *[F.count_if(F.col("split") == s).alias(s) for s in ("train", "valid", "test")],
        )
    )


def live_links(mapping: DataFrame, url_status: DataFrame) -> DataFrame:
    """Rows whose URL last answered 200; of several checks the latest by `checked_at` counts, of equal ones the smaller status."""
    at = F.struct(filled("checked_at"), -F.col("status"))
    alive = last_wins(url_status, ["secure_url"], at, ["status"]).filter(F.col("status") == 200)
    return within(mapping, alive, [("secure_url", "secure_url")])


def clean_links(
    mapping: DataFrame, url_status: DataFrame | None = None, seed: int | None = None
) -> DataFrame:
    """First three columns of the live rows, or of all rows in random order."""
    narrow = mapping.select(*DATASET_MAPPING, "ord")
    if url_status is not None:
        return live_links(narrow, url_status)
    return shuffled(narrow, seed or 0, "public_id", "ord")


def removed_links(mapping: DataFrame, url_status: DataFrame) -> DataFrame:
    kept = live_links(mapping, url_status).agg(F.count(F.lit(1)).alias("n")).scalar()
    return mapping.agg(F.count(F.lit(1)).alias("total")).select(
        "total", kept.alias("kept"), (F.col("total") - kept).alias("removed")
    )


def sync_listing(listing: DataFrame, existing: DataFrame, scope: list[str] | None = None) -> DataFrame:
    """Dataset rows of the listed resources by public id; unlisted rows go.

    Known file names stay. The order of equal ids is that of the listing, which also
    lets the sort split an id that is listed very often.
    """
    scope = scope or []
    known = last_wins(existing, ["public_id"], keep=["filename"], scope=scope)
    named = scoped(listing, scope).filter(present("public_id"))
    rows = lookup(named, known, [(c, c) for c in [*scope, "public_id"]], F.lit(True), "ord", "_known")
    return rows.orderBy(*scope, "public_id", "ord").select(
        *scope,
        listed_filename(F.col("_known.filename"), F.col("public_id"), F.col("format")).alias("filename"),
        filled("secure_url").alias("secure_url"), "public_id",
    )


def category_totals(rows: DataFrame) -> DataFrame:
    """Rows per category, and the grand total under a null category."""
    return rows.rollup("category").agg(F.count(F.lit(1)).alias("n"))


def summary(rows: DataFrame) -> DataFrame:
    """Per category: label, rows, file."""
    return rows.groupBy(F.col("category").alias("label_vi")).agg(F.count(F.lit(1)).alias("rows")).select(
        "label_vi", "rows", F.concat("label_vi", F.lit(".csv")).alias("file")
    )
