"""Document quality by co-training (operator 10).

Two classifiers see a document from different sides: one the set of its words (hashed, letters only, lower case), the
other its metadata (source, language, length and layout: shares of upper case, digits, signs, white space, words per
line, distinct words). Both are logistic regressions. Over several rounds each labels the
unlabelled documents it is most sure of for the other. Both are then calibrated on labelled documents kept aside,
and the calibrated log odds are added up. This is done once for each question that the labels answer: is the
quality good, is it free of toxic words. `score` is the product of the two probabilities; documents below `CUT` are `rejected`.

A label with a null answers only the other question; of contradicting labels of a document the worse counts.
Fitting uses at most LABELLED_ROWS labelled and POOL_ROWS unlabelled documents, both in hash order of their ids,
one row per id; every document is scored whole. A question with answers of one kind only, or none, decides nothing: its probability is 1.

Null or blank texts have no words and only metadata; null columns are a value of their own. Rows that repeat
are scored alike. Other columns are passed on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfwright.llm.common import WordBuffer, chunks_by_bytes, mix, tidy
from shelfwright.llm.language import normal

LABELLED_ROWS = 12_000
POOL_ROWS = 6_000
BUCKETS = 1 << 18
ROUNDS = 3
EPOCHS = 6
CONFIDENT = 0.97
LEAST_DOCS = 5  # training documents that a word must be in
CUT = 0.5
BATCH_BYTES = 4 << 20
BINS = 10
NAMED = 64  # buckets for sources and for languages

# Kinds of bytes: 0 other, 1 lower case, 2 upper case, 3 digit, 4 space, 5 line feed, 6 ASCII sign, 7 not ASCII.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[ord("a") : ord("z") + 1] = 1
_KIND[ord("A") : ord("Z") + 1] = 2
_KIND[ord("0") : ord("9") + 1] = 3
_KIND[32], _KIND[10] = 4, 5
_KIND[[c for c in range(33, 127) if not chr(c).isalnum()]] = 6
_KIND[128:] = 7


def word_sets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the distinct words of each text, their ends per text, and numbers of words."""
    words = WordBuffer.of([normal(t).split() for t in texts])
    marks = (words.word_hashes() >> np.uint64(46)).astype(np.int64) if len(words) else np.zeros(0, np.int64)
    pairs = np.unique(words.owner * BUCKETS + marks) if len(words) else marks
    owner = pairs // BUCKETS
    return pairs % BUCKETS, np.searchsorted(owner, np.arange(len(texts)), side="right"), np.diff(words.first)


def layout(texts: list[str | None], distinct: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Numbers that describe how each text looks, one row per text."""
    data = [b"" if t is None else t.encode() for t in texts]
    sizes = np.fromiter(map(len, data), np.int64, len(data))
    kinds = _KIND[np.frombuffer(b"".join(data), np.uint8)]
    owner = np.repeat(np.arange(len(data)), sizes)
    counts = np.bincount(owner * 8 + kinds, minlength=8 * len(data)).reshape(-1, 8).astype(np.float64)
    size = np.maximum(sizes, 1)
    letters = np.maximum(counts[:, 1] + counts[:, 2] + counts[:, 7], 1)
    return np.column_stack(
        [
            np.log1p(sizes), counts[:, 2] / letters, counts[:, 3] / size, counts[:, 6] / size, counts[:, 5] / size,
            letters / np.maximum(words, 1), distinct / np.maximum(words, 1) ** 0.8, (counts[:, 4] + 1) / (counts[:, 5] + 1),
        ]
    )


def named(values: list[str | None], salt: int) -> np.ndarray:
    """Bucket of each name by a hash; null has its own."""
    cache: dict = {}
    for v in values:
        if v not in cache:
            raw = np.frombuffer((v or "").encode().ljust(8, b"\0")[:4096], np.uint8).astype(np.uint64)
            cache[v] = 0 if v is None else 1 + int(mix(np.array([(raw * np.arange(1, len(raw) + 1, dtype=np.uint64) ** 3).sum() + np.uint64(salt)], np.uint64))[0] % np.uint64(NAMED - 1))
    return np.array([cache[v] for v in values], dtype=np.int64)


@dataclass
class Rows:
    """Both views of some documents."""

    words: np.ndarray
    ends: np.ndarray
    shape: np.ndarray
    source: np.ndarray
    lang: np.ndarray

    @classmethod
    def of(cls, texts: list, sources: list, langs: list) -> Rows:
        words, ends, count = word_sets(texts)
        distinct = np.diff(np.concatenate(([0], ends)))
        return cls(words, ends, layout(texts, distinct, count), named(sources, 1), named(langs, 2))

    def __len__(self) -> int:
        return len(self.ends)

    def pick(self, rows: np.ndarray) -> Rows:
        starts = np.concatenate(([0], self.ends))
        sizes = self.ends[rows] - starts[rows]
        ends = np.cumsum(sizes)
        at = np.arange(int(sizes.sum())) - np.repeat(ends - sizes, sizes) + np.repeat(starts[rows], sizes)
        return Rows(self.words[at], ends, self.shape[rows], self.source[rows], self.lang[rows])


def _fit_sparse(words: np.ndarray, ends: np.ndarray, y: np.ndarray, buckets: int, penalty: float, seed: int) -> tuple[np.ndarray, float]:
    """Logistic regression on sets of buckets, by adaptive gradient steps over small batches."""
    rng = np.random.default_rng(seed)
    weights, squares = np.zeros(buckets), np.full(buckets, 1e-2)
    share = np.clip(y.mean(), 0.01, 0.99)
    bias, bias_square = float(np.log(share / (1 - share))), 1e-2
    starts = np.concatenate(([0], ends[:-1]))
    often = np.bincount(words, minlength=buckets) >= min(LEAST_DOCS, len(y))
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for begin in range(0, len(y), 128):
            rows = order[begin : begin + 128]
            sizes = ends[rows] - starts[rows]
            last = np.cumsum(sizes)
            at = np.arange(int(sizes.sum())) - np.repeat(last - sizes, sizes) + np.repeat(starts[rows], sizes)
            ids, owner = words[at], np.repeat(np.arange(len(rows)), sizes)
            odds = bias + np.bincount(owner, weights[ids], minlength=len(rows))
            error = 1 / (1 + np.exp(-np.clip(odds, -30, 30))) - y[rows]
            seen, place = np.unique(ids, return_inverse=True)
            step = np.bincount(place, error[owner], minlength=len(seen)) / len(rows) + penalty * weights[seen]
            step[~often[seen]] = 0
            squares[seen] += step**2
            weights[seen] -= 0.2 * step / np.sqrt(squares[seen])
            change = error.mean()
            bias_square += change**2
            bias -= 0.2 * change / np.sqrt(bias_square)
    return weights, bias


@dataclass
class TextView:
    weights: np.ndarray
    bias: float

    @classmethod
    def fit(cls, rows: Rows, y: np.ndarray, seed: int = 1) -> TextView:
        weights, bias = _fit_sparse(rows.words, rows.ends, y, BUCKETS, 1e-4, seed)
        return cls(weights.astype(np.float32), bias)

    def odds(self, rows: Rows) -> np.ndarray:
        owner = np.repeat(np.arange(len(rows)), np.diff(np.concatenate(([0], rows.ends))))
        return self.bias + np.bincount(owner, self.weights[rows.words], minlength=len(rows))


@dataclass
class MetadataView:
    edges: np.ndarray
    weights: np.ndarray
    bias: float

    @staticmethod
    def _items(rows: Rows, edges: np.ndarray) -> np.ndarray:
        """One bucket per number, source and language of each document."""
        bins = [np.searchsorted(edges[i], rows.shape[:, i]) + i * (BINS + 1) for i in range(len(edges))]
        base = len(edges) * (BINS + 1)
        return np.column_stack([*bins, base + rows.source, base + NAMED + rows.lang])

    @classmethod
    def fit(cls, rows: Rows, y: np.ndarray, seed: int = 2) -> MetadataView:
        cuts = np.linspace(0, 1, BINS + 2)[1:-1]
        # Finer cuts at the ends, where odd layouts are.
        cuts = np.clip(0.5 + 0.5 * np.sign(cuts - 0.5) * np.abs(2 * cuts - 1) ** 0.6, 0.01, 0.99)
        edges = np.quantile(rows.shape, cuts, axis=0).T.copy()
        items = cls._items(rows, edges)
        ends = np.arange(1, len(items) + 1) * items.shape[1]
        total = len(edges) * (BINS + 1) + 2 * NAMED
        weights, bias = _fit_sparse(items.ravel(), ends, y, total, 1e-4, seed)
        return cls(edges, weights, bias)

    def odds(self, rows: Rows) -> np.ndarray:
        return self.bias + self.weights[self._items(rows, self.edges)].sum(axis=1)


def calibrate(odds: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve from odds to labels, by Newton steps with a small penalty."""
    scale = max(1.0, float(np.abs(odds).std()))
    x = np.column_stack([odds / scale, np.ones(len(odds))])
    w = np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + 1e-2 * (w - np.array([1.0, 0.0]))
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        w = w - np.linalg.solve(curve, gradient)
    return max(0.0, float(w[0])) / scale, float(w[1])


@dataclass
class Model:
    text: TextView | None = None
    metadata: MetadataView | None = None
    curves: list[tuple[float, float]] = field(default_factory=list)
    prior: float = 0.0

    def score(self, rows: Rows) -> np.ndarray:
        """Probability that each document is good: calibrated log odds of both views, the prior counted once."""
        if self.text is None:
            return np.ones(len(rows))
        (a, b), (c, d) = self.curves
        odds = a * self.text.odds(rows) + b + c * self.metadata.odds(rows) + d - self.prior
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def cotrain(labelled: Rows, y: np.ndarray, pool: Rows, rounds: int = ROUNDS, confident: float = CONFIDENT) -> Model:
    """Fit both views; each round adds the surest documents of one view to the other's."""
    if len(y) == 0 or y.min() == y.max():
        return Model()
    aside = np.arange(len(y)) % 5 == 4
    if len(np.unique(y[aside])) < 2 or len(np.unique(y[~aside])) < 2:
        aside[:] = False
    train, held = labelled.pick(np.flatnonzero(~aside)), labelled.pick(np.flatnonzero(aside if aside.any() else ~aside))
    y_train, y_held = y[~aside], y[aside] if aside.any() else y
    views = [TextView.fit(train, y_train), MetadataView.fit(train, y_train)]
    given: list[dict[int, float]] = [{}, {}]  # pseudo-labels that each view has got from the other
    for turn in range(rounds if len(pool) else 0):
        for giver in (0, 1):
            slope, shift = calibrate(views[giver].odds(held), y_held)
            p = 1 / (1 + np.exp(-np.clip(slope * views[giver].odds(pool) + shift, -30, 30)))
            most = len(pool) * (turn + 1) // (4 * rounds) + 1
            for sure, label in ((p, 1.0), (1 - p, 0.0)):
                share = most * (y_train.mean() if label else 1 - y_train.mean())
                best = np.argsort(-sure, kind="stable")[: max(1, int(share))]
                given[1 - giver].update({int(i): label for i in best[sure[best] >= confident]})
        for taker, kind in ((0, TextView), (1, MetadataView)):
            rows = np.array(sorted(given[taker]), dtype=np.int64)
            both = _join(train, pool.pick(rows))
            views[taker] = kind.fit(both, np.concatenate((y_train, [given[taker][int(i)] for i in rows])))
    curves = [calibrate(v.odds(held), y_held) for v in views]
    share = np.clip(y_held.mean(), 0.01, 0.99)
    return Model(views[0], views[1], curves, float(np.log(share / (1 - share))))


def _join(a: Rows, b: Rows) -> Rows:
    last = int(a.ends[-1]) if len(a) else 0
    return Rows(
        np.concatenate((a.words, b.words)), np.concatenate((a.ends, b.ends + last)), np.concatenate((a.shape, b.shape)),
        np.concatenate((a.source, b.source)), np.concatenate((a.lang, b.lang)),
    )


def _views(batch: pa.RecordBatch, get) -> Iterator[tuple[int, int, Rows]]:
    texts, sources, langs = (get(batch, c) for c in ("text", "source", "lang"))
    sizes = [0 if not t.is_valid else t.as_buffer().size for t in texts]
    for begin, end in chunks_by_bytes(sizes, BATCH_BYTES):
        part = [c.slice(begin, end - begin).to_pylist() for c in (texts, sources, langs)]
        yield begin, end, Rows.of(*part)


QUESTIONS = ("good", "clean")


def _sampled(rows: DataFrame, answers: tuple[str, ...]) -> tuple[Rows, np.ndarray]:
    """Views of a bounded sample, computed on the executors; only hashed words and numbers come to the driver."""
    columns = [F.col(c).cast("string").alias(c) for c in ("text", "source", "lang")]
    source = rows.select(*columns, F.array(*[F.col(c).cast("double") for c in answers]).cast("array<double>").alias("y"))

    def view(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, found in _views(batch, lambda b, c: b.column(b.schema.get_field_index(c))):
                offsets = pa.array(np.concatenate(([0], found.ends)), pa.int32())
                flat = pa.array(found.shape.ravel())
                numbers = pa.array(np.arange(len(found) + 1) * found.shape.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.ListArray.from_arrays(offsets, pa.array(found.words, pa.int32())), pa.ListArray.from_arrays(numbers, flat),
                        pa.array(found.source), pa.array(found.lang), batch.column(3).slice(begin, end - begin),
                    ],
                    names=["words", "shape", "source", "lang", "y"],
                )

    table = source.mapInArrow(tidy(view), "words array<int>, shape array<double>, source long, lang long, y array<double>").toArrow()
    parts = table.combine_chunks().to_batches()
    if not parts or table.num_rows == 0:
        none = np.zeros(0, np.int64)
        return Rows(none, none, np.zeros((0, 8)), none, none), np.zeros((0, len(answers)))
    words, shape, sources, langs, y = parts[0].columns
    found = Rows(
        words.flatten().to_numpy().astype(np.int64), np.cumsum(words.value_lengths().to_numpy()).astype(np.int64),
        shape.flatten().to_numpy().reshape(table.num_rows, -1), sources.to_numpy(), langs.to_numpy(),
    )
    return found, y.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(table.num_rows, -1)


def fit(docs: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS, pool_rows: int = POOL_ROWS) -> list[Model]:
    """Co-train on bounded samples, the first documents in hash order of their ids: a model per question."""
    answers = [F.min(F.expr(x)).alias(c) for c, x in zip(QUESTIONS, ("quality", "1 - toxic"), strict=True)]
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(*answers).filter("good IS NOT NULL OR clean IS NOT NULL")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "source", "lang")
    place = F.xxhash64(F.lit("sample"), "doc_id")
    # Ids are chosen first, on narrow rows; the texts of the chosen follow by a join.
    ids = texts.select("doc_id").filter("doc_id IS NOT NULL").distinct()
    chosen = ids.join(known, "doc_id").orderBy(place, "doc_id").limit(labelled_rows)
    other = ids.join(known, "doc_id", "left_anti").orderBy(place, "doc_id").limit(pool_rows)
    order = [F.xxhash64(F.lit("row"), "doc_id"), "doc_id", "text"]

    def one_each(some: DataFrame) -> DataFrame:
        """One row per id, also where an id repeats."""
        first = F.min(F.struct(F.xxhash64("text").alias("place"), "text", "source", "lang")).alias("first")
        rows = texts.join(F.broadcast(some), "doc_id").groupBy(*some.columns).agg(first)
        return rows.select(*some.columns, "first.text", "first.source", "first.lang").orderBy(*order)

    labelled, y = _sampled(one_each(chosen), QUESTIONS)
    pool, _ = _sampled(one_each(other), ())
    models = []
    for column in y.T:
        rows = np.flatnonzero(~np.isnan(column))
        models.append(cotrain(labelled.pick(rows), (column[rows] > 0.5).astype(np.float64), pool))
    return models


def score(docs: DataFrame, models: list[Model], cut: float = CUT) -> DataFrame:
    """`row` (struct of all columns), score and rejected of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(models)  # of fixed size: one weight per bucket

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            found = [np.prod([m.score(rows) for m in held], axis=0) for _, _, rows in _views(batch, lambda b, c: b.column(0).field(c).cast(pa.string()))]
            scores = np.concatenate(found) if found else np.zeros(0)
            rejected = scores < cut
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())], names=["row", "score", "rejected"])

    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    return rows.mapInArrow(tidy(judge), StructType([rows.schema["row"]]).add("score", "double").add("rejected", "boolean"))


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, score, rejected of each document."""
    found = score(docs.select("doc_id", "text", "source", "lang"), fit(docs, labels))
    return found.select("row.doc_id", "score", "rejected")


def of_good_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected."""
    return score(docs, fit(docs, labels)).filter("NOT rejected").select("row.*")
