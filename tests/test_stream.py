"""Incremental ingest over several runs."""

import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from shelfwright.schemas import CAPTURES, RAW
from shelfwright.sources.stage_files import append_batch
from shelfwright.sources import storage
from shelfwright.streaming import ingest, key_index
from shelfwright.streaming.key_index import KeyIndex


def capture(spark, path, number, names):
    payload = json.dumps({"products": [{"name": n, "url": n, "imageUrl": f"h/{n}"} for n in names]})
    spark.createDataFrame([("vay", "k", 0, "asos", number, payload, "")], CAPTURES).write.mode("append").parquet(path)


def run(spark, pages, table, progress):
    query = ingest.ingest(ingest.captured_stream(spark, pages), "asos", table, progress, "T")
    query.awaitTermination()
    return [(r.id, r.name) for r in ingest.stored_rows(spark, table).orderBy("id").collect()]


def test_later_runs_continue(spark, tmp_path):
    pages, table, progress = (str(tmp_path / n) for n in ("pages", "table", "progress"))
    capture(spark, pages, 0, "ab")
    first = run(spark, pages, table, progress)
    assert first == [("000001", "a"), ("000002", "b")]
    capture(spark, pages, 1, "bcd")
    second = run(spark, pages, table, progress)
    assert second == first + [("000003", "c"), ("000004", "d")]
    assert run(spark, pages, table, progress) == second


def test_batch_written_twice_replaces_itself(spark, tmp_path):
    rows = spark.range(3).select(F.col("id").cast("string").alias("id"), F.col("id").alias("ord"))
    for _ in range(2):
        append_batch(rows, str(tmp_path / "t"), RAW, 4)
    assert ingest.stored_rows(spark, str(tmp_path / "t")).count() == 3
    assert ingest.stored_rows(spark, str(tmp_path / "t"), before=4).count() == 0


def many_captures(spark, path, batches, per_batch=30):
    """One file a batch; every batch repeats a third of the images of the one before."""
    for number in range(batches):
        names = [f"n{number * per_batch + i - (per_batch // 3 if number else 0)}" for i in range(per_batch)]
        capture(spark, path, number, names)


def ids_and_names(spark, table):
    return [(r.id, r.name) for r in ingest.stored_rows(spark, table).orderBy("id").collect()]


def test_what_a_batch_writes_does_not_grow_with_the_table(spark, tmp_path, monkeypatch):
    pages, table, progress = (str(tmp_path / n) for n in ("pages", "table", "progress"))
    written = []
    for number in range(5):
        many = [f"n{number}_{i:03}" for i in range(40)]
        capture(spark, pages, number, many)
        before = {n: storage.size_of(spark, table + n) for n in ("_urls", "_pages", "_counts")}
        run(spark, pages, table, progress)
        written.append(sum(storage.size_of(spark, table + n) - before[n] for n in before))
    assert max(written) < 1.3 * min(written)
    assert [r for r, _ in ids_and_names(spark, table)] == [f"{n:06d}" for n in range(1, 201)]


def test_an_index_missing_beside_a_table_is_built_once(spark, tmp_path):
    pages, table, progress = (str(tmp_path / n) for n in ("pages", "table", "progress"))
    capture(spark, pages, 0, "abc")
    run(spark, pages, table, progress)
    for name in ("_urls", "_counts"):
        storage.delete(spark, table + name)
    capture(spark, pages, 1, "bcd")
    assert [n for _, n in run(spark, pages, table, progress)] == list("abcd")
    assert [r for r, _ in ids_and_names(spark, table)] == [f"{n:06d}" for n in range(1, 5)]


SHAPE = "k string, v int"


def index_at(spark, tmp_path, **options):
    return KeyIndex(spark, str(tmp_path / "index"), SHAPE, ["k"], **options)


def rows_of(spark, *names, v=0):
    return spark.createDataFrame([(n, v) for n in names], SHAPE)


def test_lookups_read_only_the_buckets_of_their_keys(spark, tmp_path):
    index = index_at(spark, tmp_path, buckets=32)
    for batch in range(3):
        index.add(rows_of(spark, *[f"k{batch}_{i}" for i in range(100)], v=batch), batch)
    found = index.of(rows_of(spark, "k0_5", "k2_7", "none"), 3)
    assert {"k0_5", "k2_7"} <= {r.k for r in found.collect()} and found.count() < 60
    read = found.select(F.input_file_name().alias("f")).distinct().collect()
    assert {r.f.split("/bucket=")[1].split("/")[0] for r in read} <= {str(r.b) for r in rows_of(spark, "k0_5", "k2_7", "none").select(index._bucket().alias("b")).collect()}
    assert index.of(rows_of(spark, "k0_5"), 0).count() == 0  # a batch sees earlier ones only


def test_folders_are_merged_by_levels(spark, tmp_path):
    index, total = index_at(spark, tmp_path, buckets=2, fan=3), set()
    for batch in range(11):
        index.merge(batch)
        index.add(rows_of(spark, f"k{batch}", "again"), batch)
        index.add(rows_of(spark, f"k{batch}", "again"), batch)  # the batch runs twice
        total |= {f"k{batch}", "again"}
        assert {r.k for r in index.all(batch + 1).collect()} == total
    assert index.spans(11) == [(2, 0, 8), (0, 9, 9), (0, 10, 10)]
    # A merge that stopped before its end, and one that stopped before it deleted its sources.
    (tmp_path / "index" / "span=01-000000000009-000000000011").mkdir()
    index._write(rows_of(spark, "k9", "k10", "again").withColumn("bucket", index._bucket()), 1, 9, 10)
    assert index.spans(11) == [(2, 0, 8), (1, 9, 10)] and {r.k for r in index.all(11).collect()} == total


EVENTS = "k string, v int, at timestamp"


def arrivals(spark, tmp_path, batches, name, **options):
    rows, out, progress = (str(tmp_path / f"{name}{n}") for n in ("rows", "out", "progress"))
    for batch in batches:
        spark.createDataFrame(batch, EVENTS).coalesce(1).write.mode("append").parquet(rows)
        stream = spark.readStream.schema(EVENTS).parquet(rows)
        ingest.ingest_first_by_key(stream, ["k"], out, progress, **options).awaitTermination()
    return sorted((r.k or "", r.v) for r in spark.read.parquet(out).collect()), out


def test_first_arrivals_do_not_depend_on_where_batches_end(spark, tmp_path):
    day = lambda n: datetime(2024, 1, 1) + timedelta(days=n)
    events = [(k, n, day(n)) for n, k in enumerate(["a", "b", None, "a", "c", "b", None, "d", "a"])]
    whole, _ = arrivals(spark, tmp_path, [events], "whole", time="at")
    parts, _ = arrivals(spark, tmp_path, [events[:2], events[2:5], [], events[5:]], "parts", time="at")
    assert whole == parts == [("", 2), ("a", 0), ("b", 1), ("c", 4), ("d", 7)]


def test_keys_are_forgotten_after_their_time(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(key_index.KeyIndex.__init__, "__defaults__", (4, 2))
    day = lambda n: datetime(2024, 1, 1) + timedelta(days=n)
    batches = [[(f"k{n}_{i}", n, day(n)) for i in range(20)] + [("again", n, day(n))] for n in range(5)]
    got, out = arrivals(spark, tmp_path, batches, "ttl", time="at", ttl="2 days")
    assert [v for k, v in got if k == "again"] == [0, 3]
    index = KeyIndex(spark, f"{out}_keys", "k string, seen timestamp", ["k"], 4, 2)
    assert index.all(5).count() < 81  # of 102 that were added
