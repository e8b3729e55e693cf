"""Incremental ingest of captured pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfwright.functions.fields import present, scoped
from shelfwright.operators.ranking import with_position
from shelfwright.plans.listing import (
    PAGE_CHUNKS, before_the_end, check_limits, last_ids, listed_products, new_products, numbered, parsed_pages, seen_urls, without_urls,
)
from shelfwright.schemas import CAPTURES, RAW
from shelfwright.session import materialise, passing_tables, tune
from shelfwright.sources import storage
from shelfwright.sources.stage_files import append_batch, read_table
from shelfwright.streaming.key_index import KeyIndex, first_arrivals


def captured_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of new capture files."""
    reader = spark.readStream.schema(CAPTURES)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def stored_rows(spark: SparkSession, table: str, before: int | None = None) -> DataFrame:
    """Rows of the raw table written by earlier batches."""
    rows = read_table(spark, table, RAW + ["batch"])
    if before is not None:
        rows = rows.filter(F.col("batch").cast("bigint") < before)
    return rows.drop("batch")


URLS = "category string, kind string, url string"
STATUSES = "category string, keyword_idx int, page int, status string, fetched_at string"
COUNTS = "category string, _last bigint, _stored bigint"


def seen_pages(spark: SparkSession, table: str) -> KeyIndex:
    """Statuses of captured pages, by keyword."""
    return KeyIndex(spark, f"{table}_pages", STATUSES, ["category", "keyword_idx"])


def stored_urls(spark: SparkSession, table: str) -> KeyIndex:
    """URLs of stored products, by themselves."""
    return KeyIndex(spark, f"{table}_urls", URLS, ["category", "kind", "url"])


def _urls_of(rows: DataFrame, source: str) -> DataFrame:
    urls, images = seen_urls(rows, source)
    kinds = [images.select("category", F.lit("image").alias("kind"), F.col("image_url").alias("url"))]
    if source != "asos":
        kinds.append(urls.select("category", F.lit("product").alias("kind"), F.col("source_url").alias("url")))
    return scoped(kinds[0] if len(kinds) == 1 else kinds[0].unionByName(kinds[1]), ["category"]).filter(present("url"))


def _stored_counts(spark: SparkSession, table: str, before: int) -> DataFrame:
    """Last id and number of rows by category after the batches before a number."""
    done = [int(n) for n in storage.names(spark, f"{table}_counts") if n.isdigit() and int(n) < before]
    written = [n for n in done if storage.exists(spark, f"{table}_counts/{n:012}/_SUCCESS")]
    if not written:
        return spark.createDataFrame([], COUNTS)
    return spark.read.schema(COUNTS).parquet(f"{table}_counts/{max(written):012}")


def _counts(rows: DataFrame) -> DataFrame:
    stored = scoped(rows, ["category"]).groupBy("category").agg(F.count(F.lit(1)).alias("_stored"))
    return last_ids(rows).join(stored, "category").select("category", "_last", "_stored")


def _write_counts(counts: DataFrame, table: str, batch: int) -> None:
    counts.coalesce(1).write.mode("overwrite").parquet(f"{table}_counts/{batch:012}")


def _build_index(spark: SparkSession, table: str, source: str, batch: int) -> None:
    """Index of a table that earlier batches wrote without one."""
    history = stored_rows(spark, table, before=batch)
    stored_urls(spark, table).add(_urls_of(history, source), batch - 1, since=0)
    _write_counts(_counts(history), table, batch - 1)


def ingest(
    captures: DataFrame, source: str, table: str, checkpoint: str, run_ts: str,
    target: int | None = None, max_pages: int | None = None,
) -> StreamingQuery:
    """Append the new products of each batch of captures, with continued ids.

    Beside the table lie an index of stored URLs, the statuses of captured pages by keyword, and last id and row count by
    category. A batch looks up the URLs and keywords that it holds and adds its own, so neither what it reads
    nor what it writes is the history. A batch that is run again replaces what it wrote before and sees only
    earlier batches. The end of results is found over all pages seen, and the target counts
    the stored rows. Where a keyword's pages arrive in order, the outcome is that of one run
    over all captures, wherever the batches end; a page that was stored and is captured again adds
    what is new on it.
    """
    check_limits(target, max_pages)
    name = source.lower()

    def step(batch: DataFrame, batch_id: int) -> None:
        with passing_tables(batch.sparkSession):
            add(batch, batch_id)

    def add(batch: DataFrame, batch_id: int) -> None:
        spark = tune(batch.sparkSession)
        statuses, urls = seen_pages(spark, table), stored_urls(spark, table)
        if batch_id and not urls.spans(batch_id) and storage.exists(spark, table):
            _build_index(spark, table, name, batch_id)
        for index in (statuses, urls):
            index.merge(batch_id)
        parsed = parsed_pages(batch, name, max_pages)
        pages = before_the_end(parsed, name, statuses.of(parsed, batch_id))
        products = materialise(listed_products(pages), "listed")
        wanted = [products.select("category", F.lit(kind).alias("kind"), F.col(c).alias("url")) for kind, c in (("image", "image_url"), ("product", "source_url"))]
        known = urls.of(wanted[0].unionByName(wanted[1]), batch_id)
        of_kind = lambda kind, c: known.filter(F.col("kind") == kind).select("category", F.col("url").alias(c))
        fresh = without_urls(products, of_kind("product", "source_url"), of_kind("image", "image_url"), name)
        kept = new_products(fresh, None, name)
        counts = _stored_counts(spark, table, batch_id)
        if target is not None:
            placed = with_position(kept, "ord", ["category"], position="_n", limit=target, shifts=PAGE_CHUNKS)
            room = placed.join(counts, "category", "left").filter(F.col("_n") + F.coalesce("_stored", F.lit(0)) <= target)
            kept = room.drop("_n", "_stored", "_last")
        rows = materialise(numbered(materialise(kept, "kept"), counts.select("category", "_last"), None, run_ts), "rows")
        append_batch(rows, table, RAW, batch_id)
        urls.add(_urls_of(rows, name), batch_id)
        statuses.add(parsed, batch_id)
        sums = counts.unionByName(_counts(rows)).groupBy("category").agg(F.max("_last").alias("_last"), F.sum("_stored").alias("_stored"))
        _write_counts(sums, table, batch_id)

    return (
        captures.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_first_by_key(
    stream: DataFrame, keys: list[str], table: str, checkpoint: str, time: str | None = None, ttl: str | None = None,
) -> StreamingQuery:
    """Append the first arrival of each key to a table; what was seen lies in an index on storage, not in memory.

    Every batch looks up its own keys only. With `time` (a timestamp column) and `ttl` (an interval such as `7 days`) keys are
    forgotten that long after they were seen, and the index shrinks when its folders are merged. Without, the outcome
    is that of one run over all rows, wherever the batches end. `keys` are compared as they are, null with null.
    """
    kinds = dict(stream.dtypes)
    shape = ", ".join([f"{k} {kinds[k]}" for k in keys] + ["seen timestamp"] * (time is not None))

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = tune(batch.sparkSession)
        with passing_tables(spark):
            new = first_arrivals(batch, batch_id, KeyIndex(spark, f"{table}_keys", shape, keys), time, ttl)
            new.write.mode("overwrite").parquet(f"{table}/batch={batch_id}")

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_by_key(stream: DataFrame, keys: list[str], event_time: str | None = None, delay: str | None = None) -> DataFrame:
    """First arrival per key in a stream.

    Without an event time the keys are remembered for ever, in the query's state; with one, for `delay`. See
    `ingest_first_by_key` for state on storage.
    """
    if event_time and delay:
        return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)
    return stream.dropDuplicates(keys)
