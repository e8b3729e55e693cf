"""Captured image files."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwright.functions.images import with_features


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, image) of the captured files below a folder; `file_name` is the path below it.

    Undecodable files stay, with width and height -1.
    """
    files = spark.read.format("image").options(dropInvalid=False, recursiveFileLookup=True).load(path)
    root = F.lit(re.sub(r"^[a-z]+:(//[^/]*)?", "", path).rstrip("/"))
    origin = F.url_decode(F.replace("image.origin", F.lit("+"), F.lit("%2B")))
    below = F.substring(origin, F.instr(origin, root) + F.length(root) + 1, F.length(origin))
    return files.select(below.alias("file_name"), "image")


def image_file_features(spark: SparkSession, path: str, index: DataFrame) -> DataFrame:
    """(original_image_url, width, height, blur_score, image_hash); `index` maps `file_name` to the URL.

    Pixels end in the task that reads them: only the measures meet the index.
    """
    return with_features(read_images(spark, path)).join(index, "file_name").drop("file_name")
