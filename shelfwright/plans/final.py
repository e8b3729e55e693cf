"""Final documents and their insert-if-absent import."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shelfwright.functions.fields import filled, first_present, image_url, present, scoped
from shelfwright.operators.joins import last_wins, lookup
from shelfwright.plans.review import SCOPE
from shelfwright.schemas import FINAL
from shelfwright.session import materialise

# Document field, and the stage column it may come from instead.
DOCUMENT_FIELDS = {
    "category": "final_category", "name": None, "price": None, "brand": None, "source": None,
    "sourceUrl": "source_url", "originalImageUrl": "original_image_url",
    "cloudinaryUrl": "cloudinary_url", "cloudinaryPublicId": "cloudinary_public_id",
    "createdAt": "uploaded_at",
}
# Key fields of a document, most specific first.
KEY_FIELDS = ["cloudinaryPublicId", "sourceUrl", "originalImageUrl"]


def build_final(clean: DataFrame, mapping: DataFrame, scope: list[str] = SCOPE) -> DataFrame:
    """Documents of the rows that have a published URL and id, their own or the mapping's.

    File names repeat from category to category, so the mapping carries the scope columns too.
    """
    known = set(clean.columns)
    published = last_wins(mapping, ["filename"], keep=["secure_url", "public_id"], scope=scope)
    incomplete = ~present("cloudinary_url") | ~present("cloudinary_public_id")
    on = [(c, c) for c in [*scope, "filename"]]
    rows = lookup(scoped(clean, scope), published, on, present("filename") & incomplete, "ord", "_m")
    values = {
        "category": first_present("final_category", "category"),
        "originalImageUrl": image_url("original_image_url", "image_url" if "image_url" in known else None),
        "cloudinaryUrl": first_present("cloudinary_url", F.col("_m.secure_url")),
        "cloudinaryPublicId": first_present("cloudinary_public_id", F.col("_m.public_id")),
    }
    columns = [
        values.get(field, filled(stage or field) if (stage or field) in known else F.lit("")).alias(field)
        for field, stage in DOCUMENT_FIELDS.items()
    ]
    return rows.select(*columns, "ord").filter(present("cloudinaryUrl") & present("cloudinaryPublicId"))


def documents(rows: DataFrame) -> DataFrame:
    """Document projection that accepts both namings."""
    known = set(rows.columns)

    def either(field: str, other: str | None) -> Column:
        names = [n for n in (field, other) if n and n in known]
        return first_present(*names) if names else F.lit("")

    return rows.select(*[either(f, o).alias(f) for f, o in DOCUMENT_FIELDS.items()], "ord")


def keyed(records: DataFrame) -> DataFrame:
    """Add `key_kind` and `key`: the first filled key field; null where there is none."""
    kind = F.coalesce(*[F.when(present(f), f) for f in KEY_FIELDS])
    key = F.coalesce(*[F.when(present(f), F.col(f)) for f in KEY_FIELDS])
    return records.withColumn("key_kind", kind).withColumn("key", key)


def inserted_documents(records: DataFrame, target: DataFrame) -> DataFrame:
    """Records that an insert-if-absent run adds to `target`.

    Kinds are settled from the most specific on: a record is also held back by one of
    an earlier kind that precedes it in the batch, is added, and carries its key value.

    Places are `ord` and, where it repeats in a batch of several categories, the record itself.
    The first record of each (kind, key) is a candidate. The values that the target and candidates
    hold in the key fields are looked up by (field, value) in one join; which candidates of
    earlier kinds are added themselves is settled by one more pass per kind over candidates only.
    """
    batch = keyed(records).filter(F.col("key_kind").isNotNull())
    place = F.struct("ord", *FINAL)
    firsts = batch.groupBy("key_kind", "key").agg(F.min(place).alias("_row"))
    held = target.select(F.explode(F.array(*[F.struct(F.lit(f).alias("key_kind"), F.col(f).alias("key")) for f in KEY_FIELDS])).alias("_k"))
    stored = held.select("_k.*").filter(present("key")).distinct()
    fresh = materialise(firsts.join(stored, ["key_kind", "key"], "left_anti").select("key_kind", "key", "_row.*"), "candidates")
    added = [fresh.filter(F.col("key_kind") == KEY_FIELDS[0])]
    for kind, field in enumerate(KEY_FIELDS[1:], 1):
        values = reduce(DataFrame.unionByName, [d.select(F.col(field).alias("key"), place.alias("_place")) for d in added[:kind]])
        blocking = values.filter(present("key")).groupBy("key").agg(F.min("_place").alias("_at"))
        own = fresh.filter(F.col("key_kind") == field)
        added.append(
            own.join(blocking, "key", "left").filter(F.col("_at").isNull() | (F.col("_at") > place)).select(*fresh.columns)
        )
    return reduce(DataFrame.unionByName, added).select(*FINAL, "ord")


def import_counts(records: DataFrame, inserted: DataFrame) -> DataFrame:
    """One row: inserted, existed, skipped (no key at all)."""
    n = inserted.agg(F.count(F.lit(1)).alias("n")).scalar()
    keys = keyed(records)
    totals = keys.agg(
        F.count("key_kind").alias("_operations"), F.count_if(F.col("key_kind").isNull()).alias("skipped")
    )
    return totals.select(n.alias("inserted"), (F.col("_operations") - n).alias("existed"), "skipped")


def import_documents(final: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records to append to the target, one row of counts of the written records)."""
    records = documents(final)
    new = materialise(inserted_documents(records, target), "inserted")
    return new, import_counts(records, new)
