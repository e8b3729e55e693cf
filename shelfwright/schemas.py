"""Fixed column lists of the stage tables and the shapes of captured payloads.

Every persisted column is a string; `ord BIGINT` is the explicit row order that
each table carries next to them.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Stage contracts, in file order.
RAW = [
    "id", "name", "price", "brand", "source", "source_url", "original_image_url", "image_url",
    "category", "final_category", "image_index", "crawl_status", "crawled_at",
]
CLEAN = [
    "id", "name", "price", "brand", "source", "source_url", "original_image_url",
    "category", "final_category", "width", "height", "blur_score", "image_hash",
]
VALIDATED = CLEAN + ["auto_status", "auto_reason", "crawled_at", "validated_at"]
REVIEWED = CLEAN + ["auto_status", "auto_reason", "human_status", "human_reason", "reviewed_at"]
PUBLISHED_EXTRA = ["cloudinary_url", "cloudinary_public_id", "uploaded_at", "filename"]
PUBLISHED = CLEAN + PUBLISHED_EXTRA
MAPPING = ["filename", "secure_url", "public_id", "original_image_url"]
DATASET_MAPPING = ["filename", "secure_url", "public_id"]
FINAL = [
    "category", "name", "price", "brand", "source", "sourceUrl", "originalImageUrl",
    "cloudinaryUrl", "cloudinaryPublicId", "createdAt",
]

# Quality thresholds and defaults of the stage jobs.
REQUIRED_FIELDS = ["name", "source", "source_url", "category"]
MIN_WIDTH = 300
MIN_HEIGHT = 300
BLUR_THRESHOLD = 40.0
HASH_DISTANCE = 5
EMPTY_STREAK = 3
FIRST_FILE_NUMBER = 10000

CAPTURES = T.StructType([
    T.StructField("category", T.StringType()),
    T.StructField("keyword", T.StringType()),
    T.StructField("keyword_idx", T.IntegerType()),
    T.StructField("source", T.StringType()),
    T.StructField("page", T.IntegerType()),
    T.StructField("payload", T.StringType()),
    T.StructField("fetched_at", T.StringType()),
])

ASOS_PAYLOAD = (
    "products ARRAY<STRUCT<name STRING, brandName STRING, url STRING, imageUrl STRING, "
    "additionalImageUrls ARRAY<STRING>, price STRUCT<current STRUCT<value STRING>>>>"
)
TIKI_PAYLOAD = (
    "data ARRAY<STRUCT<name STRING, price STRING, brand_name STRING, "
    "url_path STRING, thumbnail_url STRING>>"
)


def string_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])
