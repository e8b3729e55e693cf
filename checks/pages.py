"""Extraction from captured pages, incremental ingest, images."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from checks.registry import ORACLES, register
from checks.relations import INSERTED_SQL, KEEP_STEPS, OUTCOME_SQL
from checks.views import Inputs
from shelfwright.functions.hashes import hash_text
from shelfwright.functions.images import with_features
from shelfwright.plans import listing
from shelfwright.plans.everything import StageTables, run_all, run_stages
from shelfwright.schemas import FINAL
from shelfwright.session import materialise, scratch_path
from shelfwright.sources import captures
from shelfwright.sources.images import image_file_features
from shelfwright.streaming import ingest

RUN_TS = "2024-03-03T00:00:00"
ALL_PAGES = 10**7

# A product's images: (5, 3), (3, 4), (3, primary) or the primary one alone.
ASOS_LISTED = """
SELECT p_partkey AS product, p_name AS name, CAST(p_retailprice AS STRING) AS price, p_brand AS brand,
  'https://www.asos.com/prd/' || CAST(p_partkey AS STRING) AS source_url, i AS image_index, k,
  CASE WHEN i = 0 THEN 'https://images.example/' || CAST(p_partkey AS STRING) || '-p.jpg'
    ELSE 'https://images.example/' || CAST(p_partkey % 577 AS STRING) || '-' || CAST(i AS STRING) || '.jpg' END AS image_url
FROM (SELECT *, unnest(CASE WHEN p_partkey % 7 >= 5 THEN [5, 3] WHEN p_partkey % 7 = 4 THEN [3, 4] WHEN p_partkey % 7 = 3 THEN [3, 0] ELSE [0] END) AS i,
    unnest(CASE WHEN p_partkey % 7 >= 3 THEN [0, 1] ELSE [0] END) AS k FROM part) t
"""


@register("a10_h1_asos_products", f"""
SELECT name, price, brand, source_url, image_index, image_url, image_url AS original_image_url FROM ({ASOS_LISTED}) t
""")
def h1(v: Inputs):
    pages = listing.visited_pages(v.asos_captures, "asos", ALL_PAGES)
    return listing.listed_products(pages).drop("ord", "category", "source")


@register("e9_product_images", f"SELECT product, image_index, image_url, k AS pos FROM ({ASOS_LISTED}) t")
def e9(v: Inputs):
    key = F.col("p_partkey")
    additional = F.transform(
        F.slice(F.sequence(F.lit(1), F.lit(6)), F.lit(1), (key % 7).cast("int")),
        lambda i: F.concat(F.lit("images.example/"), (key % 577).cast("string"), F.lit("-"), i.cast("string")),
    )
    primary = F.concat(F.lit("images.example/"), key.cast("string"), F.lit("-p"))
    return (
        v.part.select(key.alias("product"), F.posexplode(captures.product_images(additional, primary)).alias("pos", "i"))
        .select("product", "i.image_index", F.col("i.url").alias("image_url"), "pos")
    )


@register("e9_best_image", """
SELECT p_partkey AS product, CASE WHEN p_partkey % 7 >= 5 THEN 'https://images.example/' || CAST(p_partkey % 577 AS STRING) || '-5.jpg'
  WHEN p_partkey % 7 >= 3 THEN 'https://images.example/' || CAST(p_partkey % 577 AS STRING) || '-3.jpg'
  ELSE 'https://images.example/' || CAST(p_partkey AS STRING) || '-p.jpg' END AS image_url FROM part
""")
def e9_best(v: Inputs):
    key = F.col("p_partkey")
    additional = F.transform(
        F.slice(F.sequence(F.lit(1), F.lit(6)), F.lit(1), (key % 7).cast("int")),
        lambda i: F.concat(F.lit("images.example/"), (key % 577).cast("string"), F.lit("-"), i.cast("string")),
    )
    primary = F.concat(F.lit("images.example/"), key.cast("string"), F.lit("-p"))
    return v.part.select(key.alias("product"), captures.best_image(additional, primary).alias("image_url"))


ASOS_KEPT = f"""
SELECT format('{{:06d}}', row_number() OVER (ORDER BY product, k)) AS id, name, price, brand, 'asos' AS source, source_url,
  image_url AS original_image_url, image_url, 'vay' AS category, 'vay' AS final_category, CAST(image_index AS STRING) AS image_index,
  'raw' AS crawl_status, '{RUN_TS}' AS crawled_at
FROM (SELECT *, row_number() OVER (PARTITION BY image_url ORDER BY product, k) AS rn FROM ({ASOS_LISTED}) t) q WHERE rn = 1
"""


@register("i1_asos_listings", ASOS_KEPT)
def i1_asos(v: Inputs):
    return listing.extract_listings(v.asos_captures, "asos", None, None, ALL_PAGES, run_ts=RUN_TS).drop("ord")


@register("j1_incremental_ingest", ASOS_KEPT)
def j1(v: Inputs):
    """Captures in several batches, in the order of their pages."""
    table = scratch_path(v.spark, "raw")
    pages, progress = scratch_path(v.spark, "captures"), scratch_path(v.spark, "progress")
    captures = v.asos_captures.withColumn("part", F.least(F.col("page") / 20, F.lit(3)).cast("int"))
    for part in range(4):
        captures.filter(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(pages)
        stream = ingest.captured_stream(v.spark, pages)
        ingest.ingest(stream, "asos", table, progress, RUN_TS).awaitTermination()
    return ingest.stored_rows(v.spark, table).drop("ord")


@register("j2_first_by_key_stream", f"""
SELECT DISTINCT image_url FROM ({ASOS_LISTED}) t
""")
def j2(v: Inputs):
    rows = scratch_path(v.spark, "images")
    products = listing.listed_products(listing.visited_pages(v.asos_captures, "asos", ALL_PAGES))
    products.select("image_url").write.parquet(rows)
    stream = v.spark.readStream.schema("image_url STRING").parquet(rows)
    out = scratch_path(v.spark, "first")
    (
        ingest.first_by_key(stream, ["image_url"]).writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", scratch_path(v.spark, "progress")).trigger(availableNow=True).start().awaitTermination()
    )
    return v.spark.read.parquet(out)


@register("j2_first_by_key_indexed", f"""
SELECT image_url, min(product) AS product FROM ({ASOS_LISTED}) t GROUP BY image_url
""")
def j2_indexed(v: Inputs):
    """First product of each image over four batches, the keys seen in an index on storage."""
    rows, out, progress = (scratch_path(v.spark, n) for n in ("images", "first", "progress"))
    products = materialise(listing.listed_products(listing.visited_pages(v.asos_captures, "asos", ALL_PAGES)), "products")
    place = F.shiftright("ord", listing.PLACE_BITS)
    shown = products.select("image_url", F.regexp_extract("source_url", "([0-9]+)$", 1).cast("bigint").alias("product"), F.least(place / 20, F.lit(3)).cast("int").alias("part"))
    for part in range(4):
        shown.filter(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(rows)
        stream = v.spark.readStream.schema("image_url STRING, product BIGINT").parquet(rows)
        ingest.ingest_first_by_key(stream, ["image_url"], out, progress).awaitTermination()
    return v.spark.read.parquet(out).select("image_url", "product")


TIKI_LISTED = """
SELECT p_partkey AS ord, p_name AS name, CAST(p_retailprice AS STRING) AS price, p_brand AS brand,
  'https://tiki.vn/p' || CAST(p_partkey % 401 AS STRING) || '.html' AS source_url,
  'https://salt.tikicdn.com/cache/280x280/ts/' || CAST(p_partkey % 577 AS STRING) || '.jpg' AS original_image_url,
  'https://salt.tikicdn.com/ts/' || CAST(p_partkey % 577 AS STRING) || '.jpg' AS image_url FROM part
"""


@register("a10_h2_tiki_products", f"SELECT name, price, brand, source_url, original_image_url, image_url FROM ({TIKI_LISTED}) t")
def h2(v: Inputs):
    pages = listing.visited_pages(v.tiki_captures, "tiki", ALL_PAGES)
    return listing.listed_products(pages).drop("ord", "category", "source", "image_index")


def kept_sql(urls: str, select: str) -> str:
    return f"WITH RECURSIVE {urls}, steps AS ({KEEP_STEPS}) {select}"


TIKI_URLS = f"""
listed AS ({TIKI_LISTED}),
urls AS (SELECT ord, 'vay' AS category, source_url AS s, image_url AS i, row_number() OVER (ORDER BY ord) AS rn FROM listed)
"""


@register("i1_tiki_listings", kept_sql(TIKI_URLS, f"""
SELECT format('{{:06d}}', row_number() OVER (ORDER BY l.ord)) AS id, name, price, brand, 'tiki' AS source, source_url, original_image_url, image_url,
  'vay' AS category, 'vay' AS final_category, '0' AS image_index, 'raw' AS crawl_status, '{RUN_TS}' AS crawled_at
FROM steps st JOIN listed l ON st.ord = l.ord WHERE kept
"""))
def i1_tiki(v: Inputs):
    return listing.extract_listings(v.tiki_captures, "tiki", None, None, ALL_PAGES, run_ts=RUN_TS).drop("ord")


@register("h3_h4_h5_lazada_products", """
SELECT category, page, name, price, source_url, image_url FROM lazada_listed
""")
def h345(v: Inputs):
    # Parsed once, as every run does it: a filter that Spark derives from `explode` would parse each page again.
    pages = materialise(captures.lazada_pages(v.lazada_captures), "pages")
    rows = pages.select("category", "page", F.explode("products").alias("p"))
    return rows.select("category", "page", "p.name", "p.price", "p.source_url", "p.image_url")


@register("h3_json_ld_products", """
SELECT category, page, name, price, source_url, image_url FROM lazada_listed WHERE (ord // 40) % 3 = 0
""")
def h3(v: Inputs):
    rows = v.lazada_captures.select("category", "page", F.explode(captures.json_ld_products(F.col("payload"))).alias("p"))
    return rows.select("category", "page", "p.name", "p.price", "p.source_url", "p.image_url")


LAZADA_URLS = """
listed AS (SELECT * FROM lazada_listed),
urls AS (SELECT ord, category, nullif(source_url, '') AS s, nullif(image_url, '') AS i,
  row_number() OVER (PARTITION BY category ORDER BY ord) AS rn FROM listed WHERE {fresh})
"""
# Stored before the run: the feed under its crawl categories, most rows with URLs that
# have changed since.
LAZADA_STORED = """
stored AS (SELECT 'c' || CAST((ord // 40) % 4 AS STRING) AS category, source_url || was AS source_url,
  regexp_replace(original_image_url, '_200x200q80.jpg$', '') || was AS image_url, ord AS n
  FROM (SELECT *, CASE WHEN ord % 97 = 3 THEN '' ELSE '?was' END AS was FROM feed) f)
"""
FRESH = """NOT EXISTS (SELECT 1 FROM stored s WHERE s.category = listed.category AND s.source_url <> '' AND s.source_url = listed.source_url)
  AND NOT EXISTS (SELECT 1 FROM stored s WHERE s.category = listed.category AND s.image_url <> '' AND s.image_url = listed.image_url)"""


def stored(v: Inputs):
    block = F.floor(F.col("ord") / 40)
    image = F.regexp_replace("original_image_url", "_200x200q80.jpg$", "")
    was = F.when(F.col("ord") % 97 == 3, "").otherwise("?was")
    return v.feed.select(
        "id", F.concat(F.lit("c"), (block % 4).cast("string")).alias("category"), F.concat("source_url", was).alias("source_url"),
        F.concat(image, was).alias("original_image_url"), F.lit("").alias("image_url"),
    )


@register("i1_lazada_listings", kept_sql(LAZADA_STORED + "," + LAZADA_URLS.format(fresh=FRESH), f"""
SELECT format('{{:06d}}', coalesce((SELECT max(n) FROM stored s WHERE s.category = l.category), 0) + row_number() OVER (PARTITION BY l.category ORDER BY l.ord)) AS id,
  name, price, 'Lazada' AS brand, 'lazada' AS source, source_url, image_url AS original_image_url, image_url, l.category,
  l.category AS final_category, '0' AS image_index, 'raw' AS crawl_status, '{RUN_TS}' AS crawled_at
FROM steps st JOIN listed l ON st.ord = l.ord WHERE kept
"""))
def i1_lazada(v: Inputs):
    return listing.extract_listings(v.lazada_captures, "lazada", stored(v), None, ALL_PAGES, run_ts=RUN_TS).drop("ord")


@register("f6_crawl_stats", kept_sql(LAZADA_URLS.format(fresh="true"), """,
k AS (SELECT l.category, l.page, row_number() OVER (PARTITION BY l.category ORDER BY l.ord) AS r FROM steps st JOIN listed l ON st.ord = l.ord WHERE kept),
reach AS (SELECT category, max(page) FILTER (WHERE r = 100) AS last FROM k GROUP BY category),
pages AS (SELECT DISTINCT 'c' || CAST((ord // 40) % 4 AS STRING) AS category, (ord // 40) // 4 + 1 AS page, (ord // 40) % 11 <> 7 AS ok FROM feed)
SELECT r.category, (SELECT least(count(*), 100) FROM k WHERE k.category = r.category) AS collected,
  (SELECT count(*) FROM listed l WHERE l.category = r.category AND (r.last IS NULL OR l.page <= r.last))
    - (SELECT count(*) FROM k WHERE k.category = r.category AND (r.last IS NULL OR k.page <= r.last)) AS skipped_duplicates,
  (SELECT max(page) - max(page) FILTER (WHERE ok) FROM pages p WHERE p.category = r.category AND (r.last IS NULL OR p.page <= r.last)) AS empty_streak
FROM reach r
"""))
def f6(v: Inputs):
    return listing.crawl_stats(v.lazada_captures, "lazada", None, 100, ALL_PAGES)


@register("a11_h4_html_links", """
SELECT page_id, CAST(i - 1 AS INT) AS pos, regexp_extract(tag, '(?is)^<a\\b[^>]*\\shref\\s*=\\s*["'']([^"'']*)["'']', 1) AS href,
  trim(regexp_replace(regexp_replace(regexp_replace(tag, '(?is)^<a\\b[^>]*>', ''), '(?s)<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS text
FROM (SELECT page_id, unnest(tags) AS tag, generate_subscripts(tags, 1) AS i
  FROM (SELECT page_id, regexp_extract_all(html, '(?is)(<a\\b[^>]*>.*?)</a>', 1) AS tags FROM pages) p) q
""")
def h4(v: Inputs):
    return captures.html_links(v.table("pages"))


@register("h6_image_size", "SELECT CAST(vec_id AS STRING) AS original_image_url, 8 AS width, 8 AS height FROM embeddings")
def h6(v: Inputs):
    return v.images.select("original_image_url", "image.width", "image.height")


@register("h7_f12_blur_score", """
WITH px AS (SELECT vec_id, (i - 1) // 8 AS y, (i - 1) % 8 AS x, CAST(least(greatest(floor((CAST(e AS DOUBLE) + 1) * 127.5), 0), 255) AS BIGINT) AS g
  FROM (SELECT vec_id, unnest(embedding) AS e, generate_subscripts(embedding, 1) AS i FROM embeddings) t),
side AS (SELECT p.vec_id, p.y, p.x, p.g, u.g AS up, d.g AS down, l.g AS lft, r.g AS rgt FROM px p
  JOIN px u ON u.vec_id = p.vec_id AND u.x = p.x AND u.y = CASE WHEN p.y = 0 THEN 1 ELSE p.y - 1 END
  JOIN px d ON d.vec_id = p.vec_id AND d.x = p.x AND d.y = CASE WHEN p.y = 7 THEN 6 ELSE p.y + 1 END
  JOIN px l ON l.vec_id = p.vec_id AND l.y = p.y AND l.x = CASE WHEN p.x = 0 THEN 1 ELSE p.x - 1 END
  JOIN px r ON r.vec_id = p.vec_id AND r.y = p.y AND r.x = CASE WHEN p.x = 7 THEN 6 ELSE p.x + 1 END),
sums AS (SELECT vec_id, sum(up + down + lft + rgt - 4 * g) AS s, sum((up + down + lft + rgt - 4 * g) * (up + down + lft + rgt - 4 * g)) AS q
  FROM side GROUP BY vec_id)
SELECT CAST(vec_id AS STRING) AS original_image_url, CAST(round((64 * q - s * s) / 4096.0 * 4096.0) AS BIGINT) AS blur_4096 FROM sums
""")
def h7(v: Inputs):
    scored = with_features(v.images)
    return scored.select("original_image_url", F.round(F.col("blur_score") * 4096).cast("bigint").alias("blur_4096"))


@register("h8_perceptual_hash", """
WITH taps AS (
  SELECT i, j, j - (i + 0.5) / 4 + 0.5 AS x FROM (SELECT unnest(range(32)) AS i) a, (SELECT unnest(range(8)) AS j) b
  WHERE j >= greatest(trunc((i + 0.5) / 4 - 2.5), 0) AND j < least(trunc((i + 0.5) / 4 + 3.5), 8)),
raw AS (SELECT i, j, CASE WHEN x = 0 THEN 1 WHEN abs(x) < 3 THEN sin(pi() * x) / (pi() * x) * sin(pi() * x / 3) / (pi() * x / 3) ELSE 0 END AS v FROM taps),
w AS (SELECT i, j, CAST(trunc(v / sum(v) OVER (PARTITION BY i) * 4194304 + 0.5 * sign(v)) AS BIGINT) AS w FROM raw),
px AS (SELECT vec_id, (i - 1) // 8 AS y, (i - 1) % 8 AS x, CAST(least(greatest(floor((CAST(e AS DOUBLE) + 1) * 127.5), 0), 255) AS BIGINT) AS g
  FROM (SELECT vec_id, unnest(embedding) AS e, generate_subscripts(embedding, 1) AS i FROM embeddings) t),
across AS (SELECT vec_id, y, w.i AS m, least(greatest(floor((sum(g * w) + 2097152) / 4194304.0), 0), 255) AS a FROM px JOIN w ON w.j = px.x GROUP BY ALL),
small AS (SELECT vec_id, w.i AS n, m, least(greatest(floor((sum(a * w) + 2097152) / 4194304.0), 0), 255) AS s FROM across JOIN w ON w.j = across.y GROUP BY ALL),
basis AS (SELECT k, n, 2 * cos(pi() * k * (2 * n + 1) / 64) AS c FROM (SELECT unnest(range(8)) AS k) a, (SELECT unnest(range(32)) AS n) b),
half AS (SELECT vec_id, k, m, sum(c * s) AS h FROM small JOIN basis USING (n) GROUP BY ALL),
low AS (SELECT vec_id, half.k AS k, b.k AS l, sum(h * c) AS v FROM half JOIN basis b ON b.n = half.m GROUP BY ALL),
middle AS (SELECT vec_id, median(v) AS mid FROM low GROUP BY vec_id),
nibbles AS (SELECT vec_id, (k * 8 + l) // 4 AS q, sum(CASE WHEN v > mid THEN 8 >> CAST((k * 8 + l) % 4 AS INT) ELSE 0 END) AS d
  FROM low JOIN middle USING (vec_id) GROUP BY ALL)
SELECT CAST(vec_id AS STRING) AS original_image_url, string_agg(substr('0123456789abcdef', CAST(d AS INT) + 1, 1), '' ORDER BY q) AS image_hash
FROM nibbles GROUP BY vec_id
""")
def h8(v: Inputs):
    return with_features(v.images).select("original_image_url", hash_text("image_hash").alias("image_hash"))


BLUR_SQL = ORACLES["h7_f12_blur_score"]


@register("a12_image_files", BLUR_SQL.replace(
    "SELECT CAST(vec_id AS STRING) AS original_image_url, CAST(round(", "SELECT CAST(vec_id AS STRING) AS original_image_url, "
    "CASE WHEN vec_id % 7 = 3 THEN -1 ELSE 8 END AS width, CASE WHEN vec_id % 7 = 3 THEN -1 ELSE 8 END AS height, CASE WHEN vec_id % 7 <> 3 THEN CAST(round("
).replace("AS BIGINT) AS blur_4096 FROM sums", "AS BIGINT) END AS blur_4096 FROM sums"))
def a12(v: Inputs):
    """Image files that are written from the table, every seventh damaged, in folders whose file names repeat."""
    folder = scratch_path(v.spark, "image_files")
    grey = F.transform("pixels", lambda p: F.repeat(p, 3))
    lines = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda y: F.array_join(F.slice(grey, 57 - y * 8, F.lit(8)), ""))
    head = F.lit("424DF6000000000000003600000028000000" + "08000000" * 2 + "01001800" + "00000000" + "C0000000" + "130B0000" * 2 + "00000000" * 2)
    rows = v.images.select(
        F.col("original_image_url").alias("id"), F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.substring(F.hex("image.data"), 2 * i + 1, F.lit(2))).alias("pixels")
    )
    broken = F.col("id").cast("long") % 7 == 3
    content = F.when(broken, F.lit("6A756E6B")).otherwise(F.concat(head, F.array_join(lines, "")))
    name = F.concat(F.lit("d"), F.col("id"), F.lit("/a b+c.bmp"))
    named = rows.select("id", name.alias("file_name"), F.unhex(content).alias("content"))

    def write(batches):
        from pyarrow import fs

        for batch in batches:
            for row in batch[["file_name", "content"]].itertuples(index=False):
                store, path = fs.FileSystem.from_uri(f"{folder}/{row.file_name}")
                store.create_dir(path.rsplit("/", 1)[0], recursive=True)
                with store.open_output_stream(path) as out:
                    out.write(row.content)
            yield batch[["file_name"]]

    named.mapInPandas(write, "file_name string").count()
    index = named.select("file_name", F.col("id").alias("original_image_url"))
    return image_file_features(v.spark, folder, index).select(
        "original_image_url", "width", "height", F.round(F.col("blur_score") * 4096).cast("bigint").alias("blur_4096")
    )


RECORD = "category, name, price, brand, source, \"sourceUrl\", \"originalImageUrl\", \"cloudinaryUrl\", \"cloudinaryPublicId\", \"createdAt\""


def _places(sql: str) -> str:
    """The import's oracle over `final_rows`, whose `ord` repeats from category to category."""
    sql = sql.replace("import_rows", "final_rows").replace("ORDER BY ord", f"ORDER BY ord, {RECORD}")
    for a in ("pid", "src"):
        mine, other = (", ".join(f"{t}.{c.strip()}" for c in ("ord, " + RECORD).split(",")) for t in (a, "i"))
        sql = sql.replace(f"{a}.ord < i.ord", f"({mine}) < ({other})")
    return sql


RUN_SQL = OUTCOME_SQL + f""",
newmap AS (SELECT category, new_name AS filename, max_by(out_url, ord) AS secure_url, max_by(out_id, ord) AS public_id FROM settled WHERE mapped AND new_name <> '' GROUP BY 1, 2),
final_rows AS (
  SELECT s.ord, coalesce(nullif(s.final_category, ''), s.category) AS category, s.name, s.price, s.brand, s.source, s.source_url AS "sourceUrl",
    trim(CASE WHEN mapped THEN image ELSE original_image_url END) AS "originalImageUrl", coalesce(nullif(out_url, ''), m.secure_url, '') AS "cloudinaryUrl",
    coalesce(nullif(out_id, ''), m.public_id, '') AS "cloudinaryPublicId", out_at AS "createdAt"
  FROM settled s LEFT JOIN newmap m ON s.category = m.category AND CASE WHEN mapped THEN new_name ELSE s.filename END = m.filename
  WHERE coalesce(nullif(out_url, ''), m.secure_url, '') <> '' AND coalesce(nullif(out_id, ''), m.public_id, '') <> ''),
""" + _places(INSERTED_SQL).strip().removeprefix("WITH ")


@register("i12_run_all", RUN_SQL + f"SELECT ord, {RECORD} FROM ins")
def i12(v: Inputs):
    """All stages; publishing and import cover every category of the shelf."""
    run = run_all(
        v.tiki_captures, "tiki", None, v.clean, v.reviewed.filter("false"), v.shelf_mapping, v.results, v.target, RUN_TS, auto_pass=True
    )
    return run.inserted.select("ord", *FINAL)


def _as_text(*columns: str) -> str:
    return " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns)


PRODUCT = ["id", "name", "price", "brand", "source", "source_url", "original_image_url", "category", "final_category"]
SHOWN = {
    "raw": [*PRODUCT, "image_url", "crawl_status", "crawled_at"], "validated": [*PRODUCT, "auto_status", "auto_reason", "validated_at"],
    "clean": [*PRODUCT, "cloudinary_url", "cloudinary_public_id", "uploaded_at", "filename"],
    "mapping": ["category", "filename", "secure_url", "public_id", "original_image_url"], "final": list(FINAL), "target": list(FINAL),
}
STAGES_SQL = "WITH RECURSIVE " + TIKI_URLS.strip() + f""", steps AS ({KEEP_STEPS}),
raw AS (SELECT format('{{:06d}}', row_number() OVER (ORDER BY l.ord)) AS id, name, price, brand, 'tiki' AS source, source_url, original_image_url, image_url,
  'vay' AS category, 'vay' AS final_category, 'raw' AS crawl_status, '{RUN_TS}' AS crawled_at FROM steps st JOIN listed l ON st.ord = l.ord WHERE kept),
""" + RUN_SQL.strip().removeprefix("WITH ") + """
SELECT 'raw' AS stage, """ + _as_text(*SHOWN["raw"]) + """ AS shown FROM raw
UNION ALL SELECT 'validated', """ + _as_text(*PRODUCT, "'pass'", "'auto_pass_all'", f"'{RUN_TS}'") + """ FROM raw
UNION ALL SELECT 'clean', """ + _as_text(
    "id", "name", "price", "brand", "source", "source_url", "CASE WHEN mapped THEN image ELSE original_image_url END", "category", "final_category",
    "out_url", "out_id", "out_at", "CASE WHEN mapped THEN new_name ELSE filename END") + """ FROM settled
UNION ALL SELECT 'mapping', """ + _as_text("category", "new_name", "out_url", "out_id", "image") + """ FROM settled WHERE mapped
UNION ALL SELECT 'final', """ + _as_text(*[f'"{c}"' for c in FINAL]) + """ FROM final_rows
UNION ALL SELECT 'target', """ + _as_text(*[f'"{c}"' for c in FINAL]) + """ FROM target
UNION ALL SELECT 'target', """ + _as_text(*[f'"{c}"' for c in FINAL]) + """ FROM ins
"""


@register("i12_stage_tables", STAGES_SQL)
def i12_tables(v: Inputs):
    """Every stored stage table after a run over stored ones that was started twice."""
    root = scratch_path(v.spark, "stages")
    seed = StageTables(v.spark, root, "seed")
    for name, rows in (("clean", v.clean), ("mapping", v.shelf_mapping), ("target", v.target)):
        seed.commit(name, lambda rows=rows: rows)
    for _ in range(2):
        tables = StageTables(v.spark, root, "run")
        run_stages(tables, v.tiki_captures, "tiki", None, v.results, RUN_TS, auto_pass=True)
    shown = [
        tables.read(name).select(F.lit(name).alias("stage"), F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("")) for c in columns]).alias("shown"))
        for name, columns in SHOWN.items()
    ]
    return reduce(DataFrame.unionByName, shown)
