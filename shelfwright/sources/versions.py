"""Tables that are replaced or extended in one step, also by a job that reads them.

Every write goes to a folder of its own. A manifest names the folders that make up the table, by part; it is renamed
into place under the next number, which fails if another writer was faster. Readers take the manifest with the
largest number, so they see the table before or after a write and never in between, and a writer that stops half way leaves the table
as it was. Folders that no kept manifest names are deleted after a write.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession, types as T

from shelfwright.sources import storage

MANIFESTS = "_manifests"
WHOLE = "whole"


class Conflict(RuntimeError):
    """Another writer changed the table since this one looked at it."""


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n) for n in storage.names(spark, f"{path}/{MANIFESTS}") if re.fullmatch(r"\d{12}", n))


def latest(spark: SparkSession, path: str) -> int:
    """Number of the current version; 0 where there is none."""
    return max(_numbers(spark, path), default=0)


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict | None:
    number = version or latest(spark, path)
    if not number:
        return None
    return json.loads(storage.read_text(spark, f"{path}/{MANIFESTS}/{number:012}"))


def folders(spark: SparkSession, path: str, version: int | None = None) -> list[str] | None:
    """Folders of a version of the table, or None where it has no manifest."""
    found = manifest(spark, path, version)
    return None if found is None else [f"{path}/{f}" for f in found["parts"].values()]


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """The current version or an older one that is still kept; None where nothing was ever written."""
    found = manifest(spark, path, version)
    if found is None:
        return None
    return _read(spark, path, found, list(found["parts"].values()))


def read_part(spark: SparkSession, path: str, part: str) -> DataFrame | None:
    """One part of the current version."""
    found = manifest(spark, path)
    return None if found is None or part not in found["parts"] else _read(spark, path, found, [found["parts"][part]])


def _read(spark: SparkSession, path: str, found: dict, names: list[str]) -> DataFrame:
    shape = T.StructType.fromJson(found["schema"])
    reader = spark.read.schema(T.StructType([*shape.fields, T.StructField("v", T.StringType())]))
    return reader.option("basePath", path).parquet(*[f"{path}/{f}" for f in names]).select(*shape.fieldNames())


def version_of(spark: SparkSession, path: str, note: str) -> int | None:
    """The newest kept version that was written with a note."""
    return next((n for n in reversed(_numbers(spark, path)) if manifest(spark, path, n).get("note") == note), None)


def _commit(spark: SparkSession, path: str, number: int, parts: dict[str, str], schema: T.StructType, note: str | None) -> None:
    draft = f"{path}/{MANIFESTS}/.draft-{uuid.uuid4().hex}"
    storage.write_text(spark, draft, json.dumps({"parts": parts, "schema": schema.jsonValue(), "note": note}))
    if not storage.move_new(spark, draft, f"{path}/{MANIFESTS}/{number:012}"):
        storage.delete(spark, draft)
        raise Conflict(f"{path} has a version {number} already")


def prune(spark: SparkSession, path: str, keep: int) -> None:
    """Delete all but the last `keep` versions, and what writers that stopped or lost have left behind.

    A folder carries the number it was written for: one that is not newer than the current version is either
    named by a kept manifest or will never be.
    """
    numbers = _numbers(spark, path)
    kept = numbers[-keep:]
    named = {f for n in kept for f in manifest(spark, path, n)["parts"].values()}
    for name in storage.names(spark, path):
        number = re.fullmatch(r"v=(\d{12})-[0-9a-f]+", name)
        if number and name not in named and int(number.group(1)) <= numbers[-1]:
            storage.delete(spark, f"{path}/{name}")
    for number in numbers[:-keep]:
        storage.delete(spark, f"{path}/{MANIFESTS}/{number:012}")


def _write(df: DataFrame, path: str, part: str, alone: bool, base: int | None, keep: int, save, note: str | None = None) -> int:
    spark = df.sparkSession
    current = latest(spark, path)
    if base is not None and base != current:
        raise Conflict(f"{path} is at version {current}, not {base}")
    number = current + 1
    folder = f"v={number:012}-{uuid.uuid4().hex}"
    save(df, f"{path}/{folder}")
    before = {} if alone or not current else manifest(spark, path, current)["parts"]
    _commit(spark, path, number, {**before, part: folder}, df.schema, note)
    prune(spark, path, keep)
    return number


def replace_table(df: DataFrame, path: str, base: int | None = None, keep: int = 2, save=None, note: str | None = None) -> int:
    """Make `df` the whole table; `df` may read the table itself. Gives the new version's number.

    `base` is the version that `df` was computed from: the write fails if there is a newer one. Older versions
    stay readable until `keep` newer ones exist. A `note` is stored with the version, in the same step.
    """
    return _write(df, path, WHOLE, True, base, keep, save or (lambda d, p: d.write.parquet(p)), note)


def add_part(
    df: DataFrame, path: str, part: str, base: int | None = None, keep: int = 2, save=None, note: str | None = None
) -> int:
    """Add rows as a named part; a part that is written again replaces what it held."""
    return _write(df, path, part, False, base, keep, save or (lambda d, p: d.write.parquet(p)), note)
