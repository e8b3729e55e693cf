"""Scalar expressions and row filters."""

from pyspark.sql import functions as F

from checks.registry import register
from checks.views import Inputs
from shelfwright.functions import fields, naming, urls
from shelfwright.plans import validate
from shelfwright.plans.final import documents, keyed
from shelfwright.plans.review import default_category
from shelfwright.operators.paging import page_range
from shelfwright.sources.captures import has_name_and_image
from shelfwright.sources.stage_files import merged_columns, not_all_blank

RUN_TS = "2024-03-03T00:00:00"


@register("b1_image_url", """
SELECT ord, trim(coalesce(nullif(a, ''), nullif(b, ''), '')) AS image_url
FROM (SELECT ord, CASE WHEN ord % 6 = 0 THEN '' WHEN ord % 6 = 1 THEN ' ' ELSE original_image_url END AS a,
  ' ' || source_url || ' ' AS b FROM feed) t
""")
def b1(v: Inputs):
    first = F.when(F.col("ord") % 6 == 0, "").when(F.col("ord") % 6 == 1, " ").otherwise(F.col("original_image_url"))
    return v.feed.select("ord", fields.image_url(first, F.concat(F.lit(" "), "source_url", F.lit(" "))).alias("image_url"))


@register("b2_normal_category", """
SELECT ord, lower(trim('  ' || upper(category) || ' ')) AS category FROM feed
""")
def b2(v: Inputs):
    return v.feed.select("ord", fields.normal_category(F.concat(F.lit("  "), F.upper("category"), F.lit(" "))).alias("category"))


URL_VARIANTS = """(SELECT ord, CASE ord % 4 WHEN 0 THEN replace(original_image_url, 'https:', '')
  WHEN 1 THEN replace(original_image_url, 'https://img.example', '') WHEN 2 THEN original_image_url
  ELSE upper(original_image_url) END AS url FROM feed) t"""


def url_variants(v: Inputs):
    url = F.col("original_image_url")
    return v.feed.select(
        "ord",
        F.when(F.col("ord") % 4 == 0, F.replace(url, F.lit("https:"), F.lit("")))
        .when(F.col("ord") % 4 == 1, F.replace(url, F.lit("https://img.example"), F.lit("")))
        .when(F.col("ord") % 4 == 2, url).otherwise(F.upper(url)).alias("url"),
    )


@register("b3_absolute_url", f"""
SELECT ord, CASE WHEN starts_with(url, '//') THEN 'https:' || url
  WHEN starts_with(url, '/') THEN 'https://www.lazada.vn' || url ELSE url END AS url FROM {URL_VARIANTS}
""")
def b3(v: Inputs):
    return url_variants(v).select("ord", urls.absolute_url("url").alias("url"))


@register("b4_strip_resize_suffix", f"""
SELECT ord, regexp_replace(CASE WHEN starts_with(url, '//') THEN 'https:' || url
  WHEN starts_with(url, '/') THEN 'https://www.lazada.vn' || url ELSE url END,
  '(\\.(?:jpg|jpeg|png|webp))_\\d+x\\d+q\\d+\\.(?:jpg|jpeg|png|webp)$', '\\1') AS url FROM {URL_VARIANTS}
""")
def b4(v: Inputs):
    return url_variants(v).select("ord", urls.lazada_image_url("url").alias("url"))


@register("b5_asos_image_url", f"""
SELECT ord, CASE WHEN url = '' THEN '' ELSE
  CASE WHEN starts_with(url, '//') THEN 'https:' WHEN starts_with(url, 'http://') OR starts_with(url, 'https://') THEN ''
  ELSE 'https://' END || url || CASE WHEN ends_with(url, '.jpg') THEN '' ELSE '.jpg' END END AS url FROM {URL_VARIANTS}
""")
def b5(v: Inputs):
    return url_variants(v).select("ord", urls.asos_image_url("url").alias("url"))


@register("b6_product_urls", """
SELECT ord, CASE WHEN filename = '' THEN '' ELSE 'https://www.asos.com/' || filename END AS asos_url,
  'https://tiki.vn/' || filename AS tiki_url FROM feed
""")
def b6(v: Inputs):
    return v.feed.select("ord", urls.asos_product_url("filename").alias("asos_url"), urls.tiki_product_url("filename").alias("tiki_url"))


@register("b7_tiki_image_url", """
SELECT ord, replace('https://salt.tikicdn.com/cache/280x280/ts/' || filename || '?again=salt.tikicdn.com/cache/280x280/',
  'salt.tikicdn.com/cache/280x280/', 'salt.tikicdn.com/') AS url FROM feed
""")
def b7(v: Inputs):
    raw = F.concat(F.lit("https://salt.tikicdn.com/cache/280x280/ts/"), "filename", F.lit("?again=salt.tikicdn.com/cache/280x280/"))
    return v.feed.select("ord", urls.tiki_image_url(raw).alias("url"))


@register("b8_card_image_url", """
SELECT ord, CASE WHEN src <> '' THEN src WHEN data_src <> '' THEN data_src WHEN lazy <> '' THEN lazy
  WHEN ord % 10 = 0 THEN ', ,' ELSE 'https://b.example/' || CAST(ord AS STRING) END AS url
FROM (SELECT ord, CASE WHEN ord % 5 = 0 THEN '' ELSE filename END AS src,
  CASE WHEN ord % 3 = 0 THEN cloudinary_url ELSE '' END AS data_src,
  CASE WHEN ord % 7 = 0 THEN 'lazy' ELSE '' END AS lazy FROM feed) t
""")
def b8(v: Inputs):
    o = F.col("ord")
    srcset = F.when(o % 10 == 0, ", ,").otherwise(F.concat(F.lit("https://a.example/x 1x,  https://b.example/"), o.cast("string"), F.lit(" 2x, ")))
    return v.feed.select(
        "ord",
        urls.card_image_url(
            F.when(o % 5 == 0, "").otherwise(F.col("filename")),
            F.when(o % 3 == 0, F.col("cloudinary_url")).otherwise(""),
            F.when(o % 7 == 0, "lazy").otherwise(""), srcset,
        ).alias("url"),
    )


@register("b9_keyword_slug", """
SELECT ord, replace(url_encode(replace(lower(trim(' Quần ' || name || '/~*+ ')), ' ', '-')), '%2F', '/') AS slug FROM feed
""")
def b9(v: Inputs):
    return v.feed.select("ord", urls.keyword_slug(F.concat(F.lit(" Quần "), "name", F.lit("/~*+ "))).alias("slug"))


@register("b10_request_urls", """
SELECT ord, 'https://www.lazada.vn/tag/' || replace(url_encode(replace(lower(trim(k)), ' ', '-')), '%2F', '/')
    || '/?spm=a2o4n.homepage.search.d_go&q=' || replace(url_encode(k), '%2F', '/') || '&catalog_redirect_tag=true'
    || CASE WHEN page > 1 THEN '&page=' || CAST(page AS STRING) ELSE '' END AS lazada,
  'https://www.asos.com/api/product/search/v2/?offset=' || CAST(page * 72 AS STRING) || '&q=' || k
    || '&store=ROW&lang=en-GB&currency=USD&limit=72&country=VN' AS asos,
  'https://tiki.vn/api/v2/products?limit=40&include=advertisement&is_mweb=1&aggregations=2&version=&_v=within_promotions&trackity_id=session-1&q='
    || replace(url_encode(k), '%20', '+') || '&page=' || CAST(page AS STRING) AS tiki
FROM (SELECT ord, name || ' áo/~*' AS k, ord % 4 + 1 AS page FROM feed) t
""")
def b10(v: Inputs):
    k, page = F.concat("name", F.lit(" áo/~*")), F.col("ord") % 4 + 1
    return v.feed.select(
        "ord", urls.lazada_request(k, page).alias("lazada"), urls.asos_request(k, page).alias("asos"),
        urls.tiki_request(k, page, "session-1").alias("tiki"),
    )


@register("b11_output_filename", """
SELECT ord, CASE WHEN filename <> '' AND NOT (source = 'asos' AND regexp_matches(regexp_replace(filename, '^(.+)\\.[^.]+$', '\\1'), '^[0-9]+$'))
    THEN filename WHEN source = 'asos' AND id <> '' THEN 'asos_' || id || '.jpg'
  ELSE CAST(10000 + pos AS STRING) || '.jpg' END AS filename
FROM (SELECT ord, source, CASE WHEN ord % 7 = 0 THEN '' ELSE id END AS id,
    CASE WHEN ord % 6 = 0 THEN 'x' || filename ELSE filename END AS filename,
    row_number() OVER (ORDER BY ord) - 1 AS pos FROM feed) t
""")
def b11(v: Inputs):
    from shelfwright.operators.ranking import with_position
    rows = (
        with_position(v.feed, "ord")
        .withColumn("id", F.when(F.col("ord") % 7 == 0, "").otherwise(F.col("id")))
        .withColumn("filename", F.when(F.col("ord") % 6 == 0, F.concat(F.lit("x"), "filename")).otherwise(F.col("filename")))
    )
    return rows.select("ord", naming.output_filename(F.col("pos") - 1, 10000).alias("filename"))


@register("b12_folders", """
SELECT ord, 'shop/' || CASE WHEN c = '' THEN 'unknown' ELSE category END AS folder,
  CASE WHEN c = '' THEN 'shop' ELSE 'shop/' || category END AS listing_folder
FROM (SELECT ord, category, CASE WHEN ord % 5 = 0 THEN '' ELSE '/' || category || '/' END AS c FROM feed) t
""")
def b12(v: Inputs):
    c = F.when(F.col("ord") % 5 == 0, "").otherwise(F.concat(F.lit("/"), "category", F.lit("/")))
    return v.feed.select("ord", naming.publish_folder(c, "/shop/").alias("folder"), naming.listing_folder(c, "/shop/").alias("listing_folder"))


@register("b13_public_id", """
SELECT ord, category || '/' || regexp_replace(split_part(f, '/', -1), '^(.+)\\.[^.]+$', '\\1') AS public_id
FROM (SELECT ord, category, 'dir.x/' || CASE WHEN filename = '' THEN '.hidden' ELSE CAST(ord AS STRING) || '_jpg.rf.' || filename END AS f FROM feed) t
""")
def b13(v: Inputs):
    f = F.concat(F.lit("dir.x/"), F.when(F.col("filename") == "", ".hidden").otherwise(F.concat(F.col("ord").cast("string"), F.lit("_jpg.rf."), "filename")))
    return v.feed.select("ord", naming.public_id("category", f).alias("public_id"))


@register("b14_listed_filename", """
SELECT ord, CASE WHEN f <> '' THEN f WHEN format <> '' THEN split_part(public_id, '/', -1) || '.' || format
  ELSE split_part(public_id, '/', -1) END AS filename
FROM (SELECT *, CASE WHEN ord % 4 = 0 THEN 'known.jpg' ELSE '' END AS f FROM listing) t
""")
def b14(v: Inputs):
    known = F.when(F.col("ord") % 4 == 0, "known.jpg").otherwise("")
    return v.listing.select("ord", naming.listed_filename(known, "public_id", "format").alias("filename"))


@register("b15_padded_id", """
SELECT ord, format('{:06d}', ord * 997) AS id, format('{:04d}', ord + 1) AS short_id FROM feed
""")
def b15(v: Inputs):
    return v.feed.select("ord", fields.padded_id(F.col("ord") * 997).alias("id"), fields.padded_id(F.col("ord") + 1, 4).alias("short_id"))


VERDICTS = """
SELECT ord,
  CASE WHEN remote THEN CASE WHEN asos THEN 'asos_image_url' ELSE 'remote_image_url' END
    WHEN asos THEN 'asos_image_url' ELSE 'cloudinary' END AS source,
  CASE WHEN remote AND contains(m, '403 forbidden') THEN 'http_403_forbidden' WHEN remote THEN 'remote_load_failed'
    WHEN asos AND (contains(m, '403') OR contains(m, 'forbidden')) THEN 'http_403_forbidden' ELSE error_class END AS reason,
  CASE WHEN remote AND contains(m, '403 forbidden') THEN 'Source image host rejected Cloudinary''s remote fetch.'
    WHEN remote THEN 'Cloudinary could not load the source image URL.'
    WHEN asos AND (contains(m, '403') OR contains(m, 'forbidden')) THEN 'Source image host rejected the local download.'
    WHEN asos THEN 'ASOS image failed during local download or Cloudinary file upload.'
    ELSE 'Cloudinary upload request failed before or during asset creation.' END AS hint, first_try_local
FROM (SELECT *, lower(message) AS m, contains(lower(message), 'error in loading') AS remote,
  contains(lower(url), 'images.asos-media.com') AS asos FROM failures) t
"""


def verdicts(v: Inputs):
    e = naming.upload_error(F.col("message"), F.col("error_class"), F.col("url"))
    return v.failures.select("ord", "first_try_local", e.alias("e")).select("ord", "e.*", "first_try_local")


@register("b16_upload_error", f"SELECT ord, source, reason, hint FROM ({VERDICTS}) q")
def b16(v: Inputs):
    return verdicts(v).drop("first_try_local")


@register("b17_retry_locally", f"""
SELECT ord, NOT first_try_local AND (source = 'asos_image_url' OR reason IN ('http_403_forbidden', 'remote_load_failed')) AS retry
FROM ({VERDICTS}) q
""")
def b17(v: Inputs):
    return verdicts(v).select("ord", naming.retry_locally(F.col("source"), F.col("reason"), F.col("first_try_local")).alias("retry"))


@register("b18_asos_host", "SELECT ord, contains(lower(upper(url)), 'images.asos-media.com') AS local FROM failures")
def b18(v: Inputs):
    return v.failures.select("ord", urls.is_asos_image(F.upper("url")).alias("local"))


@register("b19_parse_id", """
SELECT ord, CASE ord % 3 WHEN 0 THEN ord WHEN 1 THEN 0 ELSE 0 END AS n FROM feed
""")
def b19(v: Inputs):
    text = F.when(F.col("ord") % 3 == 0, F.concat(F.lit(" "), "id", F.lit(" "))).when(F.col("ord") % 3 == 1, F.concat("id", F.lit("x"))).otherwise("")
    return v.feed.select("ord", fields.parse_id(text).alias("n"))


@register("b20_stage_timestamp", f"SELECT ord, '{RUN_TS}' AS validated_at FROM feed")
def b20(v: Inputs):
    return validate.auto_passed(v.feed, RUN_TS).select("ord", "validated_at")


@register("b21_auto_pass", f"""
SELECT ord, id, name, price, brand, source, source_url, trim(original_image_url) AS original_image_url, category,
  CASE WHEN final_category <> '' THEN final_category ELSE category END AS final_category,
  '' AS width, '' AS height, '' AS blur_score, '' AS image_hash, 'pass' AS auto_status, 'auto_pass_all' AS auto_reason,
  '' AS crawled_at, '{RUN_TS}' AS validated_at FROM feed
""")
def b21(v: Inputs):
    return validate.auto_passed(v.feed, RUN_TS)


@register("b22_final_category", """
SELECT ord, coalesce(nullif(final_category, ''), nullif(CASE WHEN ord % 4 = 0 THEN '' ELSE category END, ''), 'unknown') AS final_category FROM feed
""")
def b22(v: Inputs):
    rows = v.feed.withColumn("category", F.when(F.col("ord") % 4 == 0, "").otherwise(F.col("category")))
    return rows.select("ord", fields.final_category("unknown").alias("final_category"))


@register("b23_document_projection", """
SELECT ord, category, name, price, brand, source, source_url AS "sourceUrl", original_image_url AS "originalImageUrl",
  cloudinary_url AS "cloudinaryUrl", cloudinary_public_id AS "cloudinaryPublicId", '' AS "createdAt" FROM feed
""")
def b23(v: Inputs):
    return documents(v.feed)


@register("b23_document_projection_camel", """
SELECT ord, category, name, price, brand, source, "sourceUrl", "originalImageUrl", "cloudinaryUrl", "cloudinaryPublicId", "createdAt" FROM import_rows
""")
def b23_camel(v: Inputs):
    return documents(v.import_rows)


@register("b24_merged_columns", """
SELECT id, ord, name, '' AS uploaded_at, filename FROM feed
""")
def b24(v: Inputs):
    rows = v.feed.select("ord", "name", "filename", F.col("id").alias("_id"))
    columns = merged_columns(["ord", "name"], ["uploaded_at", "filename"], [])
    shown = {"id": F.col("_id"), "uploaded_at": F.lit("")}
    return rows.select(*[shown.get(c, F.col(c)).alias(c) for c in columns])


@register("b25_two_decimals", "SELECT ord, printf('%.2f', CAST(price AS BIGINT) / 16.0) AS blur_score FROM feed")
def b25(v: Inputs):
    return v.feed.select("ord", fields.two_decimals(F.col("price").cast("bigint") / F.lit(16.0)).alias("blur_score"))


@register("b26_keyword_list", """
SELECT ord, CASE ord % 4 WHEN 0 THEN brand WHEN 1 THEN replace('ao_' || category, '_', ' ')
  WHEN 2 THEN 'ao_' || category ELSE brand || '|' || category END AS keywords FROM feed
""")
def b26(v: Inputs):
    o, none = F.col("ord") % 4, F.lit(None).cast("array<string>")
    category = F.concat(F.lit("ao_"), "category")
    configured = (
        F.when(o == 0, F.array(F.lit("unused"))).when(o == 1, F.array(F.lit(" ")))
        .when(o == 3, F.array(F.concat(F.lit(" "), "brand"), F.lit(""), F.col("category"))).otherwise(none)
    )
    explicit = F.when(o == 0, F.array(F.concat("brand", F.lit(" ")), F.lit("  "))).otherwise(none)
    return v.feed.select("ord", F.array_join(fields.keyword_list(category, configured, explicit), "|").alias("keywords"))


@register("b27_review_key", """
SELECT ord, CASE WHEN ord % 3 = 0 AND source_url <> '' THEN source_url WHEN ord % 3 = 0 THEN 'row-' || CAST(ord AS STRING)
  ELSE id END AS review_key FROM feed
""")
def b27(v: Inputs):
    rows = v.feed.withColumn("id", F.when(F.col("ord") % 3 == 0, "").otherwise(F.col("id")))
    return rows.select("ord", fields.review_key(F.col("ord")).alias("review_key"))


@register("b28_upload_request", """
SELECT ord, category AS folder, regexp_replace(filename, '^(.+)\\.[^.]+$', '\\1') AS public_id, false AS overwrite,
  'image' AS resource_type, filename FROM feed
""")
def b28(v: Inputs):
    request = naming.upload_request(naming.publish_folder("category"), F.col("filename"))
    return v.feed.select("ord", request.alias("r")).select("ord", "r.*")


@register("c1_required_fields", """
SELECT ord, CASE WHEN name = '' THEN 'missing_name' WHEN source_url = '' THEN 'missing_source_url' ELSE '' END AS reason
FROM feed
""")
def c1(v: Inputs):
    reason = F.coalesce(validate.missing_reason(F.lit("x")), F.lit(""))
    return v.feed.select("ord", reason.alias("reason"))


@register("c2_image_url_present", """
SELECT ord, CASE WHEN name = '' THEN 'missing_name' WHEN source_url = '' THEN 'missing_source_url'
  WHEN original_image_url = '' THEN 'missing_image_url' ELSE '' END AS reason FROM feed
""")
def c2(v: Inputs):
    reason = F.coalesce(validate.missing_reason(fields.image_url("original_image_url", None)), F.lit(""))
    return v.feed.select("ord", reason.alias("reason"))


@register("c3_c4_c5_image_quality", """
SELECT f.ord, CASE WHEN g.width IS NULL THEN 'download_failed' WHEN g.width < 0 THEN 'invalid_image_format'
  WHEN g.width < 300 OR g.height < 300 THEN 'too_small' WHEN g.blur_score < 40.0 THEN 'too_blurry' ELSE '' END AS reason
FROM feed f LEFT JOIN features g ON f.original_image_url = g.original_image_url
""")
def c345(v: Inputs):
    from shelfwright.operators.joins import lookup
    rows = lookup(
        v.feed, v.features, [("original_image_url", "original_image_url")],
        fields.present("original_image_url"), "ord", "f",
    )
    reason = validate.image_reason(F.col("f.width"), F.col("f.height"), F.col("f.blur_score"))
    return rows.select("ord", F.coalesce(reason, F.lit("")).alias("reason"))


@register("c8_publishable", """
SELECT ord FROM feed WHERE cloudinary_url <> '' AND cloudinary_public_id <> ''
""")
def c8(v: Inputs):
    return v.feed.filter(fields.present("cloudinary_url") & fields.present("cloudinary_public_id")).select("ord")


@register("c9_name_and_image", "SELECT ord FROM feed WHERE name <> '' AND original_image_url <> ''")
def c9(v: Inputs):
    return v.feed.withColumnRenamed("original_image_url", "image_url").filter(has_name_and_image()).select("ord")


@register("c10_page_range", "SELECT category, keyword, page, status FROM page_log WHERE page BETWEEN 11 AND 60")
def c10(v: Inputs):
    return page_range(v.page_log, skip=10, limit=50)


@register("c11_not_all_blank", """
SELECT ord FROM (SELECT ord, final_category AS a, cloudinary_url AS b, CASE WHEN ord % 4 = 0 THEN ' ' ELSE filename END AS c FROM feed) t
WHERE trim(a) <> '' OR trim(b) <> '' OR trim(c) <> ''
""")
def c11(v: Inputs):
    third = F.when(F.col("ord") % 4 == 0, " ").otherwise(F.col("filename"))
    return v.feed.filter(not_all_blank([F.col("final_category"), F.col("cloudinary_url"), third])).select("ord")


@register("c12_listed_with_id", "SELECT ord FROM listing WHERE public_id <> ''")
def c12(v: Inputs):
    return v.listing.filter(fields.present("public_id")).select("ord")


@register("c14_import_key", """
SELECT ord, CASE WHEN "cloudinaryPublicId" <> '' THEN 'cloudinaryPublicId' WHEN "sourceUrl" <> '' THEN 'sourceUrl'
  WHEN "originalImageUrl" <> '' THEN 'originalImageUrl' ELSE '' END AS key_kind,
  coalesce(nullif("cloudinaryPublicId", ''), nullif("sourceUrl", ''), nullif("originalImageUrl", ''), '') AS key FROM import_rows
""")
def c14(v: Inputs):
    return keyed(documents(v.import_rows)).select("ord", fields.filled("key_kind").alias("key_kind"), fields.filled("key").alias("key"))


@register("i3_default_category", """
SELECT ord, CASE WHEN ord % 7 = 0 THEN 'saved' WHEN final_category <> '' THEN final_category ELSE category END AS final_category FROM feed
""")
def i3_default(v: Inputs):
    saved = F.when(F.col("ord") % 7 == 0, "saved").otherwise("")
    return v.feed.select("ord", default_category(saved).alias("final_category"))
