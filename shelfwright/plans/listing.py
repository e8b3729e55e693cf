"""Captured result pages to the raw product table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwright.functions.fields import filled, first_present, padded_id, parse_id, scoped, stripped
from shelfwright.operators.dedup import keep_first_by, keep_rows
from shelfwright.operators.joins import without
from shelfwright.operators.paging import (
    page_range, trailing_empty_pages, until_empty_page, until_empty_streak,
)
from shelfwright.operators.ranking import with_position
from shelfwright.schemas import RAW
from shelfwright.session import materialise
from shelfwright.sources.captures import FIRST_PAGE, PAGES, has_name_and_image

# `ord` packs keyword, page and place on the page, 22 bits for the place.
PLACE_BITS = 22
PAGE_BITS = 24
# 4096 pages per numbered chunk.
PAGE_CHUNKS = (34, 50)


def page_order(keyword_idx: Column, page: Column, place: Column) -> Column:
    """One number that orders places on pages of keywords; an error where one does not fit its bits."""
    def wide(c: Column) -> Column:
        return c.cast("bigint")

    def fits(c: Column, bits: int) -> Column:
        return (wide(c) >= 0) & (wide(c) < 1 << bits)

    packed = F.shiftleft(F.shiftleft(wide(keyword_idx), PAGE_BITS) + wide(page), PLACE_BITS) + wide(place)
    fine = fits(keyword_idx, 63 - PAGE_BITS - PLACE_BITS) & fits(page, PAGE_BITS) & fits(place, PLACE_BITS)
    return F.when(fine, packed).otherwise(F.raise_error(F.lit("keyword, page or place beyond the order column")))


def check_limits(target: int | None, max_pages: int | None, skip_pages: int = 0) -> None:
    if target is not None and target <= 0:
        raise ValueError(f"no listing can hold {target} rows: give a positive target")
    if max_pages is not None and max_pages <= 0:
        raise ValueError(f"no run can read {max_pages} pages: give a positive limit")
    if skip_pages < 0:
        raise ValueError(f"cannot skip {skip_pages} pages")


PAGE_KEYS = ["category", "source", "keyword_idx", "page"]


def latest_captures(captures: DataFrame) -> DataFrame:
    """One capture per page: the last one fetched; a fetch that failed does not replace a page."""
    others = [c for c in captures.columns if c not in PAGE_KEYS]
    at = F.struct(F.col("payload").isNotNull(), filled("fetched_at"), filled("payload"))
    picked = scoped(captures, ["category"]).groupBy(*PAGE_KEYS).agg(F.max_by(F.struct(*others), at).alias("_last"))
    return picked.select(*PAGE_KEYS, "_last.*").select(*captures.columns)


def latest_statuses(log: DataFrame) -> DataFrame:
    """Status of each page by its last capture."""
    at = F.struct(F.col("status") != "failed", filled("fetched_at"), "status")
    return log.groupBy("category", "keyword_idx", "page").agg(F.max_by("status", at).alias("status"))


def parsed_pages(captures: DataFrame, source: str, max_pages: int | None = None, skip_pages: int = 0) -> DataFrame:
    """The pages in range, parsed once: products are kept in a written table, because the end of results and the
    duplicate scan read them again."""
    if source not in PAGES:
        raise ValueError(f"unknown source: {source}; choose one of {', '.join(sorted(PAGES))}")
    skip = skip_pages if source == "lazada" else 0
    ranged = page_range(captures.filter(F.col("source") == source), skip, max_pages, FIRST_PAGE[source])
    return materialise(PAGES[source](latest_captures(ranged)), "pages")


def before_the_end(pages: DataFrame, source: str, earlier: DataFrame | None = None) -> DataFrame:
    """Pages before the end of results.

    `earlier` holds statuses of pages captured before (category, keyword_idx, page, status,
    fetched_at); they take part in finding the end.
    """
    keys, log = ["category", "keyword_idx"], None
    if earlier is not None:
        columns = ["category", "keyword_idx", "page", "status", "fetched_at"]
        log = latest_statuses(earlier.select(*columns).unionByName(pages.select(*columns)))
    return until_empty_streak(pages, keys, log=log) if source == "lazada" else until_empty_page(pages, keys, log)


def visited_pages(captures: DataFrame, source: str, max_pages: int | None = None, skip_pages: int = 0) -> DataFrame:
    """Parsed pages that a run looks at: in range and before the end of results."""
    return before_the_end(parsed_pages(captures, source, max_pages, skip_pages), source)


def listed_products(pages: DataFrame) -> DataFrame:
    """One row per product, or per product image, in crawl order."""
    return (
        pages.select("category", "keyword_idx", "page", "source", F.posexplode("products").alias("_place", "_p"))
        .select(
            page_order(F.col("keyword_idx"), F.col("page"), F.col("_place")).alias("ord"),
            "category", "source", "_p.*",
        )
        .filter(has_name_and_image() | (F.col("source") != "lazada"))
    )


def seen_urls(existing: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """Product and image URLs that an earlier run has stored, by category."""
    if source == "lazada":
        product, image = F.col("source_url"), first_present("original_image_url", "image_url")
    elif source == "tiki":
        product, image = stripped("source_url"), stripped("image_url")
    else:
        product, image = F.col("source_url"), F.col("image_url")
    return (
        existing.select("category", product.alias("source_url")),
        existing.select("category", image.alias("image_url")),
    )


def unseen(products: DataFrame, existing: DataFrame | None, source: str) -> DataFrame:
    """Products none of whose compared URLs is stored already."""
    return products if existing is None else without_urls(products, *seen_urls(existing, source), source)


def without_urls(products: DataFrame, urls: DataFrame, images: DataFrame, source: str) -> DataFrame:
    """Products whose URLs are not among the stored ones; of some sources only images are compared."""
    if source != "asos":
        products = without(products, urls, [("category", "category"), ("source_url", "source_url")])
    return without(products, images, [("category", "category"), ("image_url", "image_url")])


def new_products(products: DataFrame, existing: DataFrame | None, source: str) -> DataFrame:
    """Products that are neither stored nor repeated within the run."""
    fresh = unseen(products, existing, source)
    if source == "asos":
        return keep_first_by(fresh, ["category", "image_url"])
    return keep_rows(
        fresh, ["source_url", "image_url"], ["category"], blank_is_key=source == "tiki"
    )


def last_ids(existing: DataFrame) -> DataFrame:
    """The largest id by category."""
    return scoped(existing, ["category"]).groupBy("category").agg(F.max(parse_id("id")).alias("_last"))


def numbered(kept: DataFrame, ids: DataFrame | None, target: int | None, run_ts: str) -> DataFrame:
    """The raw table rows: first `target` per category, ids after the stored ones (`last_ids`)."""
    placed = with_position(kept, "ord", ["category"], position="_n", limit=target, shifts=PAGE_CHUNKS)
    last = F.lit(0).cast("bigint")
    if ids is not None:
        placed = placed.join(materialise(ids, "last_ids"), "category", "left")
        last = F.coalesce(F.greatest(F.col("_last"), F.lit(0)), F.lit(0))
    values = {
        "id": padded_id(last + F.col("_n")),
        "final_category": F.col("category"),
        "crawl_status": F.lit("raw"),
        "crawled_at": F.lit(run_ts),
    }
    columns = [values.get(c, F.col(c)).cast("string").alias(c) for c in RAW]
    return placed.select(*columns, "ord")


def extract_listings(
    captures: DataFrame, source: str, existing: DataFrame | None = None,
    target: int | None = None, max_pages: int | None = None, skip_pages: int = 0, run_ts: str = "",
) -> DataFrame:
    """New raw rows of one run over captured pages; without limits, all of them."""
    source = source.lower()
    check_limits(target, max_pages, skip_pages)
    pages = visited_pages(captures, source, max_pages, skip_pages)
    kept = materialise(new_products(listed_products(pages), existing, source), "kept")
    return numbered(kept, None if existing is None else last_ids(existing), target, run_ts)


def crawl_stats(
    captures: DataFrame, source: str, existing: DataFrame | None = None,
    target: int | None = None, max_pages: int | None = None, skip_pages: int = 0,
) -> DataFrame:
    """Per category: rows collected, duplicates skipped, longest trailing run without products.

    Only pages up to the one that reached the target count.
    """
    check_limits(target, max_pages, skip_pages)
    pages = visited_pages(captures, source, max_pages, skip_pages)
    products = listed_products(pages)
    kept = materialise(new_products(products, existing, source), "kept")
    page_of_row = F.shiftright(F.col("ord"), PLACE_BITS)
    collected = (
        with_position(kept, "ord", ["category"], position="_n", limit=target, shifts=PAGE_CHUNKS)
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("collected"), F.max(page_of_row).alias("_last_page"))
    )
    # One row per category, written so that rows join to it without a shuffle.
    reached = materialise(
        collected.withColumn("_last_page", F.when(F.col("collected") >= F.lit(target), F.col("_last_page"))), "reached"
    )

    def counted(df: DataFrame, name: str) -> DataFrame:
        seen = df.join(reached, "category", "left").filter(
            F.col("_last_page").isNull() | (page_of_row <= F.col("_last_page"))
        )
        return seen.groupBy("category").agg(F.count(F.lit(1)).alias(name))

    order = page_order(F.col("keyword_idx"), F.col("page"), F.lit(0))
    run_pages = (
        pages.select("category", "keyword_idx", "page", "status", order.alias("ord"))
        .join(reached, "category", "left")
        .filter(F.col("_last_page").isNull() | (page_of_row <= F.col("_last_page")))
    )
    streaks = (
        trailing_empty_pages(run_pages, ["category", "keyword_idx"])
        .groupBy("category").agg(F.max("empty_streak").alias("empty_streak"))
    )
    return (
        streaks.join(reached.drop("_last_page"), "category", "left")
        .join(counted(products, "_listed"), "category", "left")
        .join(counted(kept, "_new"), "category", "left")
        .select(
            "category",
            F.coalesce("collected", F.lit(0)).alias("collected"),
            (F.coalesce("_listed", F.lit(0)) - F.coalesce("_new", F.lit(0))).alias("skipped_duplicates"),
            "empty_streak",
        )
    )
