"""Stage tables written to the scratch area and read back."""

from pyspark.sql import functions as F

from checks.registry import register
from checks.relations import INSERTED_SQL
from checks.views import Inputs
from shelfwright.operators.ranking import with_position
from shelfwright.schemas import MAPPING, RAW
from shelfwright.session import scratch_path
from shelfwright.sources import stage_files as files
from shelfwright.sources import storage, versions

FEED_COLUMNS = ["id", "name", "price", "source_url", "original_image_url", "category"]
PLAIN_CSV = {"quote": '"', "escape": '"', "emptyValue": "", "nullValue": ""}


@register("a1_a5_stage_round_trip", """
SELECT row_number() OVER (ORDER BY ord) - 1 AS ord, id, name || ',"' || chr(10) || '"' AS name, price, source_url, original_image_url, category,
  '' AS crawl_status FROM feed
""")
def a1(v: Inputs):
    path = scratch_path(v.spark, "stage")
    rows = v.feed.withColumn("name", F.concat("name", F.lit(',"\n"')))
    files.write_stage(rows, path, FEED_COLUMNS)
    return files.read_stage(v.spark, path, FEED_COLUMNS + ["crawl_status"])


@register("a1_missing_stage", "SELECT id, ord, NULL::VARCHAR AS stored FROM feed")
def a1_missing(v: Inputs):
    """The whole feed against a stage that has not been written yet."""
    nothing = files.read_stage(v.spark, scratch_path(v.spark, "nothing"), ["id", "name"])
    return v.feed.select("id", "ord").join(nothing.select("id", F.col("name").alias("stored")), "id", "left")


@register("a2_headerless_scan", """
SELECT row_number() OVER (ORDER BY ord) - 1 AS ord, id, name, price, brand, source, source_url, original_image_url, '' AS image_url,
  category, final_category, '' AS image_index, '' AS crawl_status, '' AS crawled_at FROM feed
""")
def a2(v: Inputs):
    path = scratch_path(v.spark, "headerless")
    rows = files.projected(v.feed, RAW).repartitionByRange("ord").sortWithinPartitions("ord").drop("ord")
    rows.write.options(header=False, **PLAIN_CSV).csv(path)
    return files.read_tolerant(v.spark, path, RAW)


@register("a2_header_scan", """
SELECT row_number() OVER (ORDER BY ord) - 1 AS ord, id, name, price, brand, source, source_url, original_image_url, '' AS image_url,
  category, final_category, '' AS image_index, '' AS crawl_status, '' AS crawled_at FROM feed
""")
def a2_header(v: Inputs):
    path = scratch_path(v.spark, "header")
    files.write_stage(v.feed, path, RAW)
    rows = with_position(files.read_tolerant(v.spark, path, RAW), "ord")
    return rows.select(*RAW, (F.col("pos") - 1).alias("ord"))


@register("a3_quarantine", """
SELECT id, name, price, source_url, original_image_url, category, 'moved' AS place FROM feed
""")
def a3(v: Inputs):
    path, aside = scratch_path(v.spark, "odd"), scratch_path(v.spark, "quarantine")
    files.write_stage(v.feed, path, FEED_COLUMNS)
    kept = files.read_or_quarantine(v.spark, path, RAW, aside, "20240303000000")
    moved = files.read_stage(v.spark, f"{aside}/ts=20240303000000", FEED_COLUMNS)
    return moved.select(*FEED_COLUMNS, F.lit("moved").alias("place")).unionByName(
        kept.select(*FEED_COLUMNS, F.lit("kept").alias("place"))
    )


def _mixed(v: Inputs, path: str) -> None:
    """A folder whose files have their columns in three orders, one of them with more columns around, one without a column."""
    for n, names in enumerate((FEED_COLUMNS, ["before", "more", *FEED_COLUMNS[::-1], "after"], FEED_COLUMNS[1:])):
        files.write_stage(v.feed.filter(F.col("ord") % 3 == n), f"{path}/part{n}", names)


@register("a1_mixed_headers", """
SELECT CASE WHEN ord % 3 = 2 THEN '' ELSE id END AS id, name, price, source_url, original_image_url, category FROM feed
""")
def a1_mixed(v: Inputs):
    path = scratch_path(v.spark, "mixed")
    _mixed(v, path)
    return files.read_stage(v.spark, f"{path}/*", FEED_COLUMNS).drop("ord")


@register("a3_mixed_headers", """
SELECT CASE WHEN ord % 3 = 2 THEN '' ELSE id END AS id, name, price, source_url, original_image_url, category, ord % 3 = 0 AS kept FROM feed
""")
def a3_mixed(v: Inputs):
    path, aside = scratch_path(v.spark, "mixed"), scratch_path(v.spark, "quarantine")
    _mixed(v, path)
    kept = files.read_or_quarantine(v.spark, f"{path}/*", FEED_COLUMNS, aside, "T")
    moved = files.read_stage(v.spark, f"{aside}/*", FEED_COLUMNS)
    return kept.drop("ord").withColumn("kept", F.lit(True)).unionByName(moved.drop("ord").withColumn("kept", F.lit(False)))


@register("a2_mixed_folder", """
SELECT id, name, price, brand, source, source_url, original_image_url, '' AS image_url,
  category, final_category, '' AS image_index, '' AS crawl_status, '' AS crawled_at FROM feed
""")
def a2_mixed(v: Inputs):
    path = scratch_path(v.spark, "folder")
    files.write_stage(v.feed.filter(F.col("ord") % 2 == 0), f"{path}/a", RAW)
    files.projected(v.feed.filter(F.col("ord") % 2 == 1), RAW).drop("ord").write.options(header=False, **PLAIN_CSV).csv(f"{path}/b")
    return files.read_tolerant(v.spark, f"{path}/*", RAW).drop("ord")


@register("a4_lenient_scan", "SELECT filename, secure_url, public_id FROM mapping")
def a4(v: Inputs):
    path = scratch_path(v.spark, "links")
    files.write_stage(v.mapping, path, MAPPING)
    return files.read_first_columns(v.spark, path).drop("ord")


@register("a6_append_batches", """
SELECT CAST(ord % 3 AS INT) AS batch, ord, id, name, price, source_url, original_image_url, category FROM feed
""")
def a6(v: Inputs):
    path = scratch_path(v.spark, "batches")
    for batch in (0, 1, 2, 1):
        files.append_batch(v.feed.filter(F.col("ord") % 3 == batch), path, FEED_COLUMNS, batch)
    return v.spark.read.parquet(path).withColumn("batch", F.col("batch").cast("int"))


@register("a7_snapshot_replace", "SELECT ord, id, upper(name) AS name FROM feed")
def a7(v: Inputs):
    path = scratch_path(v.spark, "table")
    files.write_stage(v.feed, path, ["id", "name"], fmt="parquet")
    saved = files.snapshot(files.read_table(v.spark, path, ["id", "name"]), path + "_saved", "20240303000000")
    files.write_stage(saved.withColumn("name", F.upper("name")), path, ["id", "name"], fmt="parquet")
    return files.read_table(v.spark, path, ["id", "name"])


@register("a7_overwrite_what_is_read", """
SELECT row_number() OVER (ORDER BY ord) - 1 AS ord, id, upper(name) || '!' AS name, category, 1 AS versions_kept FROM feed WHERE id <> ''
""")
def a7_overwrite(v: Inputs):
    """A table by category replaced three times by what is computed from itself, then the same through CSV."""
    path, columns = scratch_path(v.spark, "swapped"), ["id", "name", "category"]
    files.write_stage(v.feed, path, columns, fmt="parquet", by_category=True, swap=True)
    for change in (F.upper("name"), F.concat("name", F.lit("!"))):
        rows = files.read_table(v.spark, path, columns)
        files.write_stage(rows.withColumn("name", change), path, columns, fmt="parquet", by_category=True)
    text = scratch_path(v.spark, "swapped-text")
    files.write_stage(files.read_table(v.spark, path, columns), text, columns, swap=True)
    files.write_stage(files.read_stage(v.spark, text, columns).filter("id <> ''"), text, columns, base=1)
    versions.prune(v.spark, text, keep=1)
    kept = len([n for n in storage.names(v.spark, text) if n.startswith("v")])
    return files.read_stage(v.spark, text, columns).withColumn("versions_kept", F.lit(kept))


@register("a8_category_layout", "SELECT ord, id, category FROM feed WHERE category = 'cat3'")
def a8(v: Inputs):
    path = scratch_path(v.spark, "by_category")
    files.write_stage(v.feed, path, ["id", "category"], fmt="parquet", by_category=True)
    return files.read_table(v.spark, path, ["id", "category"], category="cat3")


@register("a9_discover_categories", "SELECT DISTINCT category FROM feed")
def a9(v: Inputs):
    path = scratch_path(v.spark, "discover")
    files.write_stage(v.feed, path, ["id", "category"], by_category=True)
    return files.discover_categories(v.spark, path)


@register("a13_insert_sink", INSERTED_SQL + """
SELECT category, name, price, brand, source, "sourceUrl", "originalImageUrl", "cloudinaryUrl", "cloudinaryPublicId", "createdAt" FROM target
UNION ALL
SELECT category, name, price, brand, source, "sourceUrl", "originalImageUrl", "cloudinaryUrl", "cloudinaryPublicId", "createdAt" FROM ins
""")
def a13(v: Inputs):
    """Two imports into a target table; the second one finds everything in place, and a part written again replaces itself."""
    from shelfwright.plans.final import import_documents
    from shelfwright.schemas import FINAL
    path = scratch_path(v.spark, "documents")
    versions.add_part(v.target.select(*FINAL), path, "first")
    for batch in ("a", "b", "b"):
        new, _ = import_documents(v.import_rows, versions.read_version(v.spark, path))
        versions.add_part(new.select(*FINAL), path, batch)
    return versions.read_version(v.spark, path)


@register("a14_mapping_preference", "SELECT 'curated-' || filename AS filename, secure_url, public_id, original_image_url FROM mapping")
def a14(v: Inputs):
    preferred, fallback = scratch_path(v.spark, "curated"), scratch_path(v.spark, "stage")
    curated = v.mapping.withColumn("filename", F.concat(F.lit("curated-"), "filename"))
    files.write_stage(curated, preferred, MAPPING)
    files.write_stage(v.mapping, fallback, MAPPING)
    return files.read_mapping(v.spark, preferred, fallback, MAPPING).drop("ord")
