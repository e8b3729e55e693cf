"""Stage tables on files: tolerant reads, fixed-column writes, snapshots, discovery."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from shelfwright.functions.fields import filled, stripped
from shelfwright.schemas import DATASET_MAPPING, string_schema
from shelfwright.session import materialise
from shelfwright.sources.versions import folders, latest, replace_table

CSV_OPTIONS = {"quote": '"', "escape": '"', "multiLine": True, "encoding": "UTF-8"}


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def empty_stage(spark: SparkSession, columns: list[str]) -> DataFrame:
    return spark.createDataFrame([], string_schema(columns)).withColumn("ord", F.lit(0).cast("bigint"))


def _import(spark: SparkSession, path: str, width: int, headers: bool, encoding: str = "UTF-8") -> DataFrame:
    """Records of all files, parsed once into a written table: `_file`, `_seq`, `_cells`, `_names`, `_first`, `ord`.

    Numbers given by a scan depend on how files are packed into tasks, and that changes with the cluster. They are
    therefore written together with the cells; headers, counts and places are found in the written table, so whatever is read
    later agrees with it. A file with line breaks in fields is never split, so its numbers ascend in one task.

    `_cells` has the first `width` cells, and more where a header has more; `_names` are the cells of the first
    record of the same file. `ord` counts records by file name and place, without first records if `headers`.
    """
    shape = string_schema([*[f"_p{i}" for i in range(width)], "_raw"])
    # A record with another number of cells than the schema leaves its text in `_raw`.
    options = {**CSV_OPTIONS, "encoding": encoding, "columnNameOfCorruptRecord": "_raw", "columnPruning": False}
    scanned = spark.read.schema(shape).options(header=False, mode="PERMISSIVE", **options).csv(folders(spark, path) or path)
    cells = materialise(
        scanned.select(
            F.array(*[filled(f"_p{i}") for i in range(width)]).alias("_cells"), "_raw",
            F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_seq"),
        ),
        "cells",
    )
    files = cells.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"), F.min("_seq").alias("_from"))
    # One row per file.
    before = Window.partitionBy(F.lit(0)).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    places = files.select("_file", "_from", F.coalesce(F.sum(F.col("_n") - int(headers)).over(before), F.lit(0)).alias("_start"))
    firsts = materialise(
        cells.withColumnRenamed("_seq", "_from").join(materialise(places, "places"), ["_file", "_from"]), "firsts"
    )
    widest = max(width, firsts.agg(F.max(_count_of_cells("_raw"))).first()[0] or 0)
    names = F.transform(_all_cells(width, widest), lambda c, i: F.when(i == 0, F.ltrim(c, F.lit("\ufeff"))).otherwise(c))
    layout = firsts.select("_file", "_from", "_start", names.alias("_names"))
    return cells.join(layout, "_file").select(
        "_file", "_seq", _all_cells(width, widest).alias("_cells"), "_names", (F.col("_seq") == F.col("_from")).alias("_first"),
        (F.col("_start") + F.col("_seq") - F.col("_from") - int(headers)).alias("ord"),
    )


def _count_of_cells(record: str) -> Column:
    """Separators outside quotes, and one."""
    plain = F.regexp_replace(record, r'(^|,)\s*+"(?:[^"]++|"")*+"', "$1")
    return F.length(plain) - F.length(F.replace(plain, F.lit(","), F.lit(""))) + 1


def _all_cells(width: int, widest: int) -> Column:
    """`_cells`, or all cells of the record's text where headers are wider than what was scanned."""
    if widest == width:
        return F.col("_cells")
    shape = ", ".join(f"_p{i} string" for i in range(widest))
    again = F.from_csv(F.col("_raw"), shape, {"quote": '"', "escape": '"', "multiLine": "true"})
    parsed = F.array(*[filled(again[f"_p{i}"]) for i in range(widest)])
    return F.when(F.col("_raw").isNotNull(), parsed).otherwise(F.col("_cells"))


def _imported(spark: SparkSession, path: str, width: int, headers: bool, encoding: str = "UTF-8") -> DataFrame | None:
    """The records below a path, or None if there is none."""
    try:
        return _import(spark, path, width, headers, encoding)
    except AnalysisException as error:
        if not _missing(error):
            raise
        return None


def _headers(rows: DataFrame) -> DataFrame:
    """The distinct headers, blank cells at their end left out: one row per layout that occurs."""
    return rows.filter("_first").select(_trimmed("_names").alias("_names")).distinct().orderBy("_names")


def _trimmed(names: str) -> Column:
    last = F.aggregate(F.sequence(F.lit(1), F.size(names)), F.lit(0), lambda best, i: F.when(F.get(names, i - 1) != "", i).otherwise(best))
    return F.slice(names, F.lit(1), last)


def read_stage(spark: SparkSession, path: str, columns: list[str], required: bool = False) -> DataFrame:
    """Read a CSV table by the names in each file's own header; a missing table is empty, or an error if required.

    Files may have their columns in another order; columns that a file lacks are blank.
    """
    rows = _imported(spark, path, len(columns), headers=True)
    if rows is None:
        if required:
            raise FileNotFoundError(path)
        return empty_stage(spark, columns)
    return _by_name(rows.filter("NOT _first"), columns)


def _by_name(rows: DataFrame, columns: list[str]) -> DataFrame:
    place = {c: F.array_position("_names", F.lit(c)).cast("int") for c in columns}
    shown = [F.when(place[c] > 0, filled(F.get("_cells", place[c] - 1))).otherwise("").alias(c) for c in columns]
    return rows.select(*shown, "ord")


def read_tolerant(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Read a table whose files may lack their header and may start with a byte-order mark.

    The first row of a file is a header if it names the columns in order, ignoring case
    and spaces; a cell that is not spelled exactly like its column hides that column in that file.
    All-blank rows are dropped; `ord` ascends but skips the rows left out.
    """
    width = len(columns)
    rows = _imported(spark, path, width, headers=False)
    if rows is None:
        return empty_stage(spark, columns)
    wanted = F.array(*[F.lit(c) for c in columns])
    header = F.transform(F.slice("_names", 1, width), lambda n: F.lower(F.trim(n))) == wanted
    cells = [F.get("_cells", F.lit(i)) for i in range(width)]
    shown = [
        F.when(~header | (F.get("_names", F.lit(i)) == column), filled(_unmarked(cell, i))).otherwise("").alias(column)
        for i, (cell, column) in enumerate(zip(cells, columns))
    ]
    return rows.filter(~(header & F.col("_first")) & not_all_blank(cells)).select(*shown, "ord")


def _unmarked(cell: Column, i: int) -> Column:
    """A byte-order mark before the first cell of a file without header goes."""
    return F.when(F.col("_first"), F.ltrim(cell, F.lit("\ufeff"))).otherwise(cell) if i == 0 else cell


def not_all_blank(cells: list[Column]) -> Column:
    return F.exists(F.array(*cells), lambda c: stripped(c) != "")


# The byte sequences of UTF-8, written as characters of one byte each.
UTF8_CHARACTER = (
    "[\\x00-\\x7f]|[\\xc2-\\xdf][\\x80-\\xbf]|\\xe0[\\xa0-\\xbf][\\x80-\\xbf]|[\\xe1-\\xec\\xee\\xef][\\x80-\\xbf]{2}"
    "|\\xed[\\x80-\\x9f][\\x80-\\xbf]|\\xf0[\\x90-\\xbf][\\x80-\\xbf]{2}|[\\xf1-\\xf3][\\x80-\\xbf]{3}|\\xf4[\\x80-\\x8f][\\x80-\\xbf]{2}"
)


def _decoded(cell: Column) -> Column:
    """Text of a cell read byte by byte; bytes that are no part of a character are left out, and nothing else is."""
    valid = F.array_join(F.regexp_extract_all(cell, F.lit(f"((?:{UTF8_CHARACTER})++)"), F.lit(1)), "")
    text = F.decode(F.encode(valid, "ISO-8859-1"), "UTF-8")
    return F.when(cell.rlike("[\\x80-\\xff]"), text).otherwise(cell)


def read_first_columns(spark: SparkSession, path: str, width: int = 3) -> DataFrame:
    """Lenient scan by position: undecodable bytes ignored, empty lines skipped, first columns only.

    The first record of each file is its header; columns are named by that of the first file.
    """
    rows = _imported(spark, path, width, headers=True, encoding="ISO-8859-1")
    if rows is None:
        raise FileNotFoundError(path)
    first = rows.filter("_first").orderBy("_file").select(F.transform("_names", _decoded).alias("n")).first()
    names = [v.lstrip("\ufeff") for v in first["n"][:width]] if first else DATASET_MAPPING[:width]
    cells = [_decoded(F.get("_cells", F.lit(i))).alias(n or f"_p{i}") for i, n in enumerate(names)]
    return rows.filter("NOT _first").select(*cells, "ord")


def projected(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exactly the fixed columns as text, '' where absent; `ord` stays if there."""
    shown = [
        (filled(F.col(c).cast("string")) if c in df.columns else F.lit("")).alias(c) for c in columns
    ]
    return df.select(*shown, *(["ord"] if "ord" in df.columns else []))


def write_stage(
    df: DataFrame, path: str, columns: list[str], fmt: str = "csv", mode: str = "overwrite",
    by_category: bool = False, swap: bool = False, base: int | None = None,
) -> None:
    """Write the fixed columns in row order; parquet keeps `ord`, CSV keeps it as file order.

    By category, each task writes a range of one or few categories: a large category is
    split over tasks, and small ones do not leave a file per task.

    With `swap`, or where the table has versions already, a new version takes the old one's place in one step when it is complete: `df`
    may read the table itself, and `base` may name the version it was computed from (see `sources/versions.py`). Without, `path` must
    not be one that `df` reads.
    """
    out = projected(df, columns)
    if "ord" in out.columns:
        place = ["category", "ord"] if by_category else ["ord"]
        out = out.repartitionByRange(*place).sortWithinPartitions(*place)

    def save(rows: DataFrame, folder: str) -> None:
        writer = (rows.drop("ord") if fmt == "csv" else rows).write.mode(mode)
        if by_category:
            writer = writer.partitionBy("category")
        if fmt == "csv":
            writer.options(header=True, quote='"', escape='"', emptyValue="", nullValue="").csv(folder)
        else:
            writer.parquet(folder)

    if mode == "overwrite" and (swap or latest(df.sparkSession, path)):
        replace_table(out, path, base, save=save)
    else:
        save(out, path)


def read_table(spark: SparkSession, path: str, columns: list[str], category: str | None = None) -> DataFrame:
    """Parquet stage table laid out by category, in its current version; a category prunes to its folder."""
    try:
        df = spark.read.parquet(*(folders(spark, path) or [path]))
    except AnalysisException as error:
        if not _missing(error):
            raise
        return empty_stage(spark, columns)
    if category is not None:
        df = df.filter(F.col("category") == category)
    return projected(df, columns)


def append_batch(df: DataFrame, path: str, columns: list[str], batch: int | str) -> None:
    """Append one batch; writing the same batch again replaces it."""
    projected(df, columns).write.mode("overwrite").parquet(f"{path}/batch={batch}")


def read_or_quarantine(
    spark: SparkSession, path: str, columns: list[str], quarantine: str, run_ts: str
) -> DataFrame:
    """Read a stage table; files with another header are copied aside, by header, and left out.

    The first other header goes to `ts=<run_ts>`, further ones to `ts=<run_ts>.1` and so on.
    """
    rows = _imported(spark, path, len(columns), headers=True)
    if rows is None:
        return empty_stage(spark, columns)
    wanted, own = F.array(*[F.lit(c) for c in columns]), _trimmed("_names")
    # One row per layout that occurs.
    for n, layout in enumerate(_headers(rows).filter(F.col("_names") != wanted).collect()):
        names = [c for c in layout["_names"] if c]
        aside = _by_name(rows.filter(~F.col("_first") & (own == F.lit(layout["_names"]))), names)
        write_stage(aside, f"{quarantine}/ts={run_ts}" + (f".{n}" if n else ""), names)
    return _by_name(rows.filter(~F.col("_first") & (own == wanted)), columns)


def snapshot(df: DataFrame, folder: str, run_ts: str) -> DataFrame:
    """Save a table before it is replaced and continue from the saved copy.

    What is computed from the returned frame may overwrite the table's own path.
    """
    path = f"{folder}/_snapshots/ts={run_ts}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discover_categories(spark: SparkSession, folder: str) -> DataFrame:
    """Categories that have a CSV file below a folder, from the file listing alone.

    A file's category is its `category=` folder, or else its own name.
    """
    files = (
        spark.read.format("binaryFile")
        .options(pathGlobFilter="*.csv", recursiveFileLookup=True)
        .load(folder).select(F.url_decode("path").alias("path"))
    )
    foldered = F.regexp_extract("path", "/category=([^/]+)/", 1)
    name = F.regexp_extract("path", r"([^/]+)\.csv$", 1)
    return (
        files.select(F.when(foldered != "", foldered).otherwise(name).alias("category"))
        .distinct().orderBy("category")
    )


def read_mapping(spark: SparkSession, preferred: str, fallback: str, columns: list[str]) -> DataFrame:
    """The curated mapping if there is one, else the stage mapping, which must exist.

    Every file must name the columns that products are joined by.
    """
    rows = _imported(spark, preferred, len(columns), headers=True)
    path = preferred
    if rows is None:
        path, rows = fallback, _imported(spark, fallback, len(columns), headers=True)
    if rows is None:
        raise FileNotFoundError(fallback)
    lacking = F.array_except(F.array(*[F.lit(c) for c in DATASET_MAPPING]), "_names")
    absent = [r["c"] for r in rows.filter("_first").select(F.explode(lacking).alias("c")).distinct().collect()]
    if absent:
        raise ValueError(f"{path} is missing columns: {', '.join(c for c in DATASET_MAPPING if c in absent)}")
    return _by_name(rows.filter("NOT _first"), columns)


def merged_columns(columns: list[str], extra: list[str], default: list[str]) -> list[str]:
    """Keep the order of a header, put `id` first if it is absent, append what is missing."""
    base = list(columns) or list(default)
    if "id" not in base:
        base = ["id", *base]
    return base + [c for c in extra if c not in base]
