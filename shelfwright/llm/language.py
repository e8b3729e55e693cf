"""Language by compression with per-language zstd dictionaries (operator 7).

A text is reduced to lower-case words (letters only) and compressed whole with the raw-content dictionary of each
language; the language whose dictionary makes it smallest is chosen. Longer texts are compressed in blocks of at most
BLOCK_BYTES, each anew behind the dictionary, and the sizes of all blocks are added up, so every part of a text counts
alike. The score is the relative margin over the second, on a scale of 0 to 1. `rejected` marks texts without letters
and those whose margin is below `margin`.

Dictionaries come from a bounded sample of labelled texts: per language at most SAMPLE_DOCS documents in hash
order and DICTIONARY_BYTES bytes. So that none gains by size, two languages are compared at the size of the smaller
dictionary. A small one, of at most 1/PIECES of the other's bytes, hardly tells more than the subject of a text or two: it
wins only if it is ahead of PIECES pieces of its size of the other dictionary by more than CLEAR of what the whole
other dictionary saves; else it does not count for the score, which, where no other language counts, is the share that
the winner's dictionary saves. Languages are tried from the largest
dictionary down. Languages are what the `lang` column of the learning rows holds; with none, every text is `und`. With one, the score is 1.
Null texts and texts without a letter are `und` with score 0. Null ids are held out by no rule (crc32 of null is null):
they count as not held out and are not learned from. Rows that repeat are answered alike. Ties go to the
language that sorts first. Other columns are passed on.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfwright.llm.common import tidy

SAMPLE_DOCS = 400
SAMPLE_TEXT_BYTES = 16_384  # of longer documents the start is used, from the first letter on
DICTIONARY_BYTES = 64 << 10
PIECES = DICTIONARY_BYTES // SAMPLE_TEXT_BYTES  # one text alone is small beside a full dictionary
CLEAR = 0.5
PACKERS = 64  # compressors for parts of dictionaries that a worker keeps
BLOCK_BYTES = 32 << 10  # with a dictionary well within the window, and small enough not to outweigh it
MARGIN = 0.001
# Lazy matching from four bytes on over the whole dictionary: word stems of a language are short.
PARAMETERS = {
    "strategy": zstandard.STRATEGY_LAZY2, "min_match": 4, "window_log": 18, "hash_log": 17, "chain_log": 16,
    "search_log": 4, "write_content_size": False,
}
UNKNOWN = "und"

_NO_LETTER = re.compile(r"[\W\d_]+")


def normal(text: str | None) -> bytes:
    """Lower-case words of letters with single spaces around."""
    return b"" if text is None else _NO_LETTER.sub(" ", f" {text.lower()} ").encode()


def blocks(data: bytes) -> list[bytes]:
    """Pieces of at most BLOCK_BYTES, cut after a space where there is one."""
    found, begin = [], 0
    while len(data) - begin > BLOCK_BYTES:
        space = data.rfind(b" ", begin + 1, begin + BLOCK_BYTES)
        end = begin + BLOCK_BYTES if space < 0 else space + 1
        found.append(data[begin:end])
        begin = end
    return [*found, data[begin:]]


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that nothing is learned from."""
    return F.coalesce(F.crc32(F.encode(F.col(id_col).cast("string"), "utf-8")) % 4 == 2, F.lit(False))


def fit_dictionaries(docs: DataFrame, learn: Column, lang_col: str = "lang", text_col: str = "text") -> dict[str, bytes]:
    """Raw-content dictionary per language, each as large as its sample allows."""
    usable = docs.filter(learn & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")
    )
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 20))
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    # Hash ranges wide enough for about four times the sample of each language, then exact bounds.
    limit = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1 << 20, ((4 * SAMPLE_DOCS + 40) << 20) // n))])
    start = F.substring(F.regexp_replace("text", r"^[^\p{L}]+", ""), 1, SAMPLE_TEXT_BYTES)
    cut = F.when(F.octet_length("text") > SAMPLE_TEXT_BYTES, start).otherwise(F.col("text")).alias("text")
    near = usable.withColumn("place", place).filter(F.col("place") < limit[F.col("lang")])
    few = near.select("lang", cut, "place").groupBy("lang", "text").agg(F.min("place").alias("place"))
    order = Window.partitionBy("lang").orderBy("place", F.xxhash64(F.lit(1), "text"), "text")
    chosen = few.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= SAMPLE_DOCS)
    texts: dict[str, list] = {lang: [] for lang in counts}
    for row in sorted(chosen.select("lang", "n", "text").collect()):
        texts[row["lang"]].append(normal(row["text"])[:SAMPLE_TEXT_BYTES])
    return {lang: b"".join(t)[:DICTIONARY_BYTES].ljust(8) for lang, t in texts.items()}


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]) -> None:
        self.names = sorted(dictionaries, key=lambda name: (-len(dictionaries[name]), name))
        self._dictionaries = [dictionaries[name] for name in self.names]
        self._settings = zstandard.ZstdCompressionParameters(**PARAMETERS)
        self._packers = [self._packer(i, 0, len(d)) for i, d in enumerate(self._dictionaries)]
        self._bare = zstandard.ZstdCompressor(compression_params=self._settings)
        self._part = lru_cache(PACKERS)(self._packer)

    def _packer(self, i: int, begin: int, size: int) -> zstandard.ZstdCompressor:
        piece = self._dictionaries[i][begin : begin + size]
        content = zstandard.ZstdCompressionDict(piece, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(compression_params=self._settings)
        return zstandard.ZstdCompressor(compression_params=self._settings, dict_data=content)

    def __call__(self, text: str | None) -> tuple[str, float]:
        data = normal(text)
        if not self.names or data in (b"", b" "):
            return UNKNOWN, 0.0
        if len(self.names) == 1:
            return self.names[0], 1.0
        parts, known = blocks(data), {}

        def packed(i: int, size: int, begin: int = 0) -> int:
            """Bytes of the text behind a part of a dictionary."""
            if (i, size, begin) not in known:
                whole = size == len(self._dictionaries[i])
                packer = self._packers[i] if whole else self._part(i, begin, size)
                known[i, size, begin] = sum(len(packer.compress(x)) for x in parts)
            return known[i, size, begin]

        def saved(i: int) -> float:
            bare = sum(len(self._bare.compress(x)) for x in parts)
            return max(0.0, 1.0 - packed(i, len(self._dictionaries[i])) / bare)

        def lead(a: int, b: int) -> tuple[float, bool]:
            """By how much `b`, whose dictionary is not larger, is ahead of `a` (negative: behind), and whether it wins."""
            whole, size = len(self._dictionaries[a]), len(self._dictionaries[b])
            there, here = packed(a, size), packed(b, size)
            if whole < PIECES * size:
                ahead = 1.0 - here / there if here < there else there / here - 1.0
                return ahead, here < there or here == there and self.names[b] < self.names[a]
            if here < there:
                ahead = 1.0 - here / min(packed(a, size, k * whole // PIECES) for k in range(PIECES))
                if ahead > CLEAR * saved(a):
                    return ahead, True
            return -np.inf, False

        best = 0
        for i in range(1, len(self.names)):
            if lead(best, i)[1]:
                best = i
        over = [lead(i, best)[0] if i < best else -lead(best, i)[0] for i in range(len(self.names)) if i != best]
        least = min(over)
        return self.names[best], max(0.0, float(least)) if least < np.inf else saved(best)


def identify(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = MARGIN, text_col: str = "text") -> DataFrame:
    """`row` (struct of all columns), lang_pred, score and rejected of every document."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(dictionaries)
        for batch in batches:
            found = [classify(t.as_py()) for t in batch.column(0).field(text_col)]
            names, scores = [n for n, _ in found], np.array([s for _, s in found])
            rejected = [n == UNKNOWN or s < margin for n, s in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                names=["row", "lang_pred", "score", "rejected"],
            )

    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    shape = StructType([rows.schema["row"]]).add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return rows.mapInArrow(tidy(predict), shape)


def predictions(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of each document, learned from those not held out."""
    found = identify(docs.select("doc_id", "text"), fit_dictionaries(docs, ~held_out()))
    return found.select("row.doc_id", held_out("row.doc_id").alias("held_out"), "lang_pred", "score", "rejected")


def of_known_language(docs: DataFrame) -> DataFrame:
    """The documents that are not rejected."""
    return identify(docs, fit_dictionaries(docs, ~held_out())).filter("NOT rejected").select("row.*")
