"""Session settings and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators rely on. Skewed joins are split even when that
# costs an extra shuffle, because one key may hold a third of the rows.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Batches of decoded images sent to Python stay small whatever the image size.
    "spark.sql.execution.arrow.maxBytesPerBatch": "67108864",
}

_local_scratch: dict[str, str] = {}
# Lists of paths kept by open `passing_tables` blocks.
_watched: list[list[str]] = []


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the cluster's `spark.checkpoint.dir`.

    Only a local[...] session without that setting gets a temporary folder; on a
    cluster such a folder would not be shared, so its absence is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    app = spark.sparkContext.applicationId
    if configured:
        return f"{configured.rstrip('/')}/shelfwright/{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="shelfwright-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage of `df` by writing it to the scratch area and reading it back.

    A written table survives the loss of executors and, unlike a checkpointed
    plan, keeps its size statistics for the planner.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    for made in _watched:
        made.append(path)
    written = spark.read.schema(df.schema).parquet(path)
    written._scratch_path = path
    return written


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def discard(df: DataFrame) -> None:
    """Delete a table that `materialise` wrote and that nothing will read again."""
    path = getattr(df, "_scratch_path", None)
    if path is not None:
        _delete(df.sparkSession, path)


@contextmanager
def passing_tables(spark: SparkSession):
    """Delete what is materialised inside the block when it ends."""
    made: list[str] = []
    _watched.append(made)
    try:
        yield
    finally:
        _watched.remove(made)
        for path in made:
            _delete(spark, path)
