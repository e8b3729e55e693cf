"""Result pages: ranges, end-of-results truncation, request frontier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwright.functions.urls import request_url
from shelfwright.schemas import EMPTY_STREAK
from shelfwright.session import materialise


def page_range(df: DataFrame, skip: int, limit: int | None, first: int = 1) -> DataFrame:
    """Pages after the first `skip`, at most `limit` of them (a pushed-down range)."""
    if limit is None:
        return df.filter(F.col("page") >= first + skip)
    return df.filter(F.col("page").between(first + skip, first + skip + limit - 1))


def _cut_before(pages: DataFrame, ends: DataFrame, keys: list[str], inclusive: bool) -> DataFrame:
    """Pages up to the cut of their key; keys without a cut keep all pages.

    Cuts are written first: with their size known, they join without a shuffle of the pages.
    """
    joined = pages.join(materialise(ends, "ends"), keys, "left")
    kept = F.col("page") <= F.col("_end") if inclusive else F.col("page") < F.col("_end")
    return joined.filter(F.col("_end").isNull() | kept).drop("_end")


def until_empty_page(pages: DataFrame, keys: list[str], log: DataFrame | None = None) -> DataFrame:
    """Stop at the first empty page of `log` (default: the pages themselves); failed pages are passed over."""
    ends = (pages if log is None else log).filter(F.col("status") == "empty").groupBy(*keys).agg(F.min("page").alias("_end"))
    return _cut_before(pages, ends, keys, inclusive=False)


def until_empty_streak(
    pages: DataFrame, keys: list[str], streak: int = EMPTY_STREAK, log: DataFrame | None = None
) -> DataFrame:
    """Stop with the last page of the first run, in `log` (default: the pages), of `streak` pages without products.

    A page captured more than once counts once. Each such page votes for itself and the next ones; a page with `streak` votes ends
    a run. That needs counts per page only, so a keyword with very many pages is not
    sorted in one task.
    """
    votes = (pages if log is None else log).filter(F.col("status") != "ok").select(*keys, "page").distinct().select(
        *keys, F.explode(F.sequence(F.col("page"), F.col("page") + F.lit(streak - 1))).alias("_at")
    )
    ends = (
        votes.groupBy(*keys, "_at").agg(F.count(F.lit(1)).alias("_votes"))
        .filter(F.col("_votes") == streak)
        .groupBy(*keys).agg(F.min("_at").alias("_end"))
    )
    return _cut_before(pages, ends, keys, inclusive=True)


def trailing_empty_pages(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Per key the number of captured pages without products after the last page with some.

    Page numbers without a capture do not count.
    """
    last = pages.filter(F.col("status") == "ok").groupBy(*keys).agg(F.max("page").alias("_last"))
    seen = pages.select(*keys, "page").distinct().join(last, keys, "left")
    after = F.col("_last").isNull() | (F.col("page") > F.col("_last"))
    return seen.groupBy(*keys).agg(F.count_if(after).alias("empty_streak"))


def frontier(categories: DataFrame, skip: int, limit: int, source: Column, trackity_id: str) -> DataFrame:
    """One request per category, keyword and page.

    `categories` has `category` and `keywords`. The first page of asos is number 0, and
    only lazada skips pages.
    """
    first = F.when(source == "lazada", 1 + skip).when(source == "asos", 0).otherwise(1)
    return (
        categories.withColumn("source", source)
        .select("category", "source", F.posexplode("keywords").alias("keyword_idx", "keyword"))
        .withColumn("page", F.explode(F.sequence(first, first + F.lit(limit - 1))))
        .withColumn("url", request_url(F.col("source"), F.col("keyword"), F.col("page"), trackity_id))
    )
