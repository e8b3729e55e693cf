"""All stages in one run, without the human review."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from shelfwright.functions.fields import filled
from shelfwright.plans.final import build_final, documents, import_counts, import_documents
from shelfwright.plans.listing import extract_listings
from shelfwright.plans.publish import apply_upload_results, publish_plan, published_tables, settled_uploads
from shelfwright.plans.validate import validate
from shelfwright.schemas import CLEAN, FINAL, MAPPING, RAW, REVIEWED
from shelfwright.sources import versions
from shelfwright.sources.stage_files import empty_stage


@dataclass
class Run:
    raw: DataFrame
    validated: DataFrame
    clean: DataFrame
    mapping: DataFrame
    final: DataFrame
    inserted: DataFrame
    counts: DataFrame


def run_all(
    captures: DataFrame, source: str, features: DataFrame | None, clean: DataFrame, reviewed: DataFrame,
    mapping: DataFrame, results: DataFrame, target: DataFrame, run_ts: str,
    existing: DataFrame | None = None, auto_pass: bool = False, **listing,
) -> Run:
    """Extract, validate, publish, build and import.

    Publishing takes the clean table, or approved reviews: rows validated here reach it
    only after a review.
    """
    raw = extract_listings(captures, source, existing, run_ts=run_ts, **listing)
    validated, _ = validate(raw, features, run_ts, auto_pass)
    plan = publish_plan(clean, mapping, run_ts, reviewed=reviewed)
    published, new_mapping = apply_upload_results(plan, results, run_ts)
    final = build_final(published, new_mapping)
    inserted, counts = import_documents(final, target)
    return Run(raw, validated, published, new_mapping, final, inserted, counts)


# What a stage table is before it was ever written.
EMPTY = {"raw": RAW, "clean": CLEAN, "reviewed": REVIEWED, "mapping": ["category", *MAPPING], "target": FINAL}


@dataclass
class StageTables:
    """Stage tables below one folder, each laid out by category and replaced in one step.

    Every version carries the run that wrote it, so a run that is started again knows which of its stages are
    committed: those are read, not repeated.
    """

    spark: SparkSession
    root: str
    run_id: str
    repeated: list[str] = field(default_factory=list)
    done: list[str] = field(default_factory=list)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        """The current version of a table; an empty one if there is none."""
        found = versions.read_version(self.spark, self.path(name))
        return empty_stage(self.spark, EMPTY.get(name, RAW)) if found is None else found.withColumn("category", filled("category"))

    def added(self, name: str) -> DataFrame:
        """What this run has added to a table."""
        return versions.read_part(self.spark, self.path(name), self.run_id).withColumn("category", filled("category"))

    def commit(self, name: str, build: Callable[[], DataFrame], append: bool = False) -> DataFrame:
        """The table after this run's stage; `build` is called only if the run has not committed it before."""
        path = self.path(name)
        if versions.version_of(self.spark, path, self.run_id) is None:
            def save(rows: DataFrame, folder: str) -> None:
                place = [c for c in ("category", "ord") if c in rows.columns]
                dealt = rows.repartitionByRange(*place).sortWithinPartitions(*place)
                dealt.write.partitionBy("category").parquet(folder)

            rows, base = build(), versions.latest(self.spark, path)
            if append:
                versions.add_part(rows, path, self.run_id, base, save=save, note=self.run_id)
            else:
                versions.replace_table(rows, path, base, save=save, note=self.run_id)
            self.done.append(name)
        else:
            self.repeated.append(name)
        return self.read(name)


def run_stages(
    tables: StageTables, captures: DataFrame, source: str, features: DataFrame | None, results: DataFrame, run_ts: str,
    auto_pass: bool = False, **listing,
) -> Run:
    """All stages over stored tables (raw, validated, settled, clean, mapping, final, target), each committed before the next.

    Raw rows and imported documents are added, other tables are replaced. A run that stopped goes on after the last
    stage it has committed. The clean and mapping tables both follow from `settled`, which is computed from their former versions,
    so stopping between the two changes nothing.
    """
    read, commit = tables.read, tables.commit
    raw = commit("raw", lambda: extract_listings(captures, source, read("raw"), run_ts=run_ts, **listing), append=True)
    validated = commit("validated", lambda: validate(raw, features, run_ts, auto_pass)[0])
    plan = lambda: publish_plan(read("clean"), read("mapping"), run_ts, reviewed=read("reviewed"))
    settled = commit("settled", lambda: settled_uploads(plan(), results, run_ts))
    clean = commit("clean", lambda: published_tables(settled)[0])
    mapping = commit("mapping", lambda: published_tables(settled)[1])
    final = commit("final", lambda: build_final(clean, mapping))
    commit("target", lambda: import_documents(final, read("target"))[0], append=True)
    inserted = tables.added("target")
    return Run(raw, validated, clean, mapping, final, inserted, import_counts(documents(final), inserted))
