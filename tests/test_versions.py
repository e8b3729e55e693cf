"""Tables replaced in one step: writers that stop or lose, readers in between, old versions."""

import pytest
from pyspark.sql import functions as F

from shelfwright.sources import stage_files as files
from shelfwright.sources import storage, versions


def values(df):
    return sorted(r[0] for r in df.collect())


def test_a_table_replaced_by_what_is_read_from_it(spark, tmp_path):
    path = str(tmp_path / "t")
    assert versions.read_version(spark, path) is None and versions.latest(spark, path) == 0
    versions.replace_table(spark.range(5), path)
    for _ in range(3):
        versions.replace_table(versions.read_version(spark, path).select((F.col("id") + 1).alias("id")), path)
    rows = versions.read_version(spark, path)
    assert values(rows) == [3, 4, 5, 6, 7] and versions.latest(spark, path) == 4
    assert values(versions.read_version(spark, path, 3)) == [2, 3, 4, 5, 6]
    assert len([n for n in storage.names(spark, path) if n.startswith("v")]) == 2


def test_a_writer_that_stops_half_way_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace_table(spark.range(5), path)
    bad = versions.read_version(spark, path).select(F.when(F.col("id") == 4, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        versions.replace_table(bad, path)
    assert values(versions.read_version(spark, path)) == [0, 1, 2, 3, 4] and versions.latest(spark, path) == 1

    def stops_after_its_files(df, folder):
        df.write.parquet(folder)
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        versions.replace_table(spark.range(2), path, save=stops_after_its_files)
    assert values(versions.read_version(spark, path)) == [0, 1, 2, 3, 4]
    versions.replace_table(spark.range(1), path, keep=1)
    assert values(versions.read_version(spark, path)) == [0]
    assert len([n for n in storage.names(spark, path) if n.startswith("v")]) == 1  # what the others left is gone


def test_of_two_writers_one_loses(spark, tmp_path):
    path = str(tmp_path / "t")
    base = versions.replace_table(spark.range(3), path)

    def overtaken(df, folder):
        df.write.parquet(folder)
        versions.replace_table(spark.range(9, 10), path)

    with pytest.raises(versions.Conflict):
        versions.replace_table(spark.range(4), path, save=overtaken)
    with pytest.raises(versions.Conflict):
        versions.replace_table(spark.range(4), path, base=base)
    assert values(versions.read_version(spark, path)) == [9]


def test_a_reader_keeps_its_version(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace_table(spark.range(3), path)
    before = versions.read_version(spark, path)
    versions.replace_table(spark.range(8), path)
    assert values(before) == [0, 1, 2]


def test_parts_are_added_and_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    for part, rows in (("a", (0, 2)), ("b", (2, 4)), ("a", (7, 8))):
        versions.add_part(spark.range(*rows), path, part)
    assert values(versions.read_version(spark, path)) == [2, 3, 7]
    versions.replace_table(spark.range(1), path)
    assert values(versions.read_version(spark, path)) == [0]


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_stage_tables_are_swapped(spark, tmp_path, fmt):
    path = str(tmp_path / "s")
    rows = spark.range(4).select(F.col("id").cast("string").alias("id"), F.lit("n").alias("name"), F.col("id").alias("ord"))
    read = lambda: (files.read_stage if fmt == "csv" else files.read_table)(spark, path, ["id", "name"])
    files.write_stage(rows, path, ["id", "name"], fmt=fmt, swap=True)
    files.write_stage(read().filter("id <> '2'"), path, ["id", "name"], fmt=fmt)
    assert values(read()) == ["0", "1", "3"]
    with pytest.raises(versions.Conflict):
        files.write_stage(read(), path, ["id", "name"], fmt=fmt, base=1)
