"""File names, folders and public ids of published images; upload errors."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from shelfwright.functions.fields import col, filled, first_present, present, stripped
from shelfwright.functions.urls import is_asos_image

# Reasons and hints reported for a failed upload.
REMOTE_403_HINT = "Source image host rejected Cloudinary's remote fetch."
REMOTE_LOAD_HINT = "Cloudinary could not load the source image URL."
LOCAL_403_HINT = "Source image host rejected the local download."
LOCAL_FAILED_HINT = "ASOS image failed during local download or Cloudinary file upload."
REQUEST_FAILED_HINT = "Cloudinary upload request failed before or during asset creation."


def base_name(c: Column | str) -> Column:
    """Last path component."""
    return F.substring_index(F.rtrim(filled(c), F.lit("/")), "/", -1)


def stem(c: Column | str) -> Column:
    """Base name without its last extension."""
    return F.regexp_replace(base_name(c), r"^(.+)\.[^.]+$", "$1")


def output_filename(position: Column, first_number: int) -> Column:
    """Name of the published file; `position` is the 0-based row position."""
    source = F.lower(stripped("source"))
    row_id = stripped("id")
    generated = (source == "asos") & stem("filename").rlike("^[0-9]+$")
    return (
        F.when(present("filename") & ~generated, F.col("filename"))
        .when((source == "asos") & (row_id != ""), F.concat(F.lit("asos_"), row_id, F.lit(".jpg")))
        .otherwise(F.concat((position + F.lit(first_number)).cast("string"), F.lit(".jpg")))
    )


def _joined(parts: list[Column]) -> Column:
    return F.array_join(F.filter(F.array(*parts), lambda p: p != ""), "/")


def publish_folder(category: Column | str, prefix: str = "") -> Column:
    named = first_present(category, F.lit("unknown"))
    return _joined([F.btrim(stripped(F.lit(prefix)), F.lit("/")), F.btrim(stripped(named), F.lit("/"))])


def listing_folder(category: Column | str, prefix: str = "") -> Column:
    return _joined([F.btrim(F.lit(prefix), F.lit("/")), F.btrim(filled(category), F.lit("/"))])


def public_id(category: Column | str, filename: Column | str, prefix: str = "") -> Column:
    return _joined([publish_folder(category, prefix), stem(filename)])


def listed_filename(existing: Column | str, listed_id: Column | str, fmt: Column | str) -> Column:
    """File name of a listed resource: the known one, else its base name and format."""
    name = base_name(listed_id)
    ext = stripped(fmt)
    derived = F.when(ext != "", F.concat(name, F.lit("."), ext)).otherwise(name)
    return first_present(existing, derived)


def upload_request(folder: Column, filename: Column) -> Column:
    return F.struct(
        F.nullif(folder, F.lit("")).alias("folder"),
        stem(filename).alias("public_id"),
        F.lit(False).alias("overwrite"),
        F.lit("image").alias("resource_type"),
        filename.alias("filename"),
    )


def upload_error(message: Column, error_class: Column, url: Column) -> Column:
    """(source, reason, hint) of a failed upload."""
    text = F.lower(filled(message))
    asos = is_asos_image(url)
    remote = F.contains(text, F.lit("error in loading"))
    host = F.when(asos, "asos_image_url").otherwise("remote_image_url")

    def verdict(source, reason, hint) -> Column:
        return F.struct(source.alias("source"), reason.alias("reason"), F.lit(hint).alias("hint"))

    forbidden = F.lit("http_403_forbidden")
    return (
        F.when(remote & F.contains(text, F.lit("403 forbidden")), verdict(host, forbidden, REMOTE_403_HINT))
        .when(remote, verdict(host, F.lit("remote_load_failed"), REMOTE_LOAD_HINT))
        .when(
            asos & (F.contains(text, F.lit("403")) | F.contains(text, F.lit("forbidden"))),
            verdict(F.lit("asos_image_url"), forbidden, LOCAL_403_HINT),
        )
        .when(asos, verdict(F.lit("asos_image_url"), col(error_class), LOCAL_FAILED_HINT))
        .otherwise(verdict(F.lit("cloudinary"), col(error_class), REQUEST_FAILED_HINT))
    )


def retry_locally(source: Column, reason: Column, first_try_local: Column) -> Column:
    retryable = (source == "asos_image_url") | reason.isin("http_403_forbidden", "remote_load_failed")
    return ~F.coalesce(first_try_local, F.lit(False)) & retryable
