"""Byte-pair encoding with a lexicon of frequent words as a minimal acyclic transducer (operator 8).

Words are counted over all documents; the most frequent ones (a bounded number) are encoded by merging and
compiled into an automaton whose states are shared by all words with equal endings. Numbers on its
transitions add up to a word's place in the lexicon, which leads to its ids. The automaton is one file of
plain arrays in the shared folder; Spark ships it to each executor, where workers map it into
memory. A batch looks its distinct words up together, a byte at a time; words that are not in the lexicon are
split by the pre-tokenisation pattern and merged exactly, by merge rank (by tiktoken's merge loop where ids follow
the order of the merges, as they do in public vocabularies, else by `Vocabulary.merge`).

Byte-level pre-tokenisation never joins a character to white space after it, so in texts whose white space is
single spaces and line feeds a word is what stands between those, with the space before it. Other texts, and texts
that hold an added token, are cut by the pattern itself.

Null texts are empty: no ids, empty decoded text. Repeated rows and ids are documents of their own. Other
columns are not read. An empty table gives an empty lexicon and result.
"""

from __future__ import annotations

import contextlib
import gc
import hashlib
import heapq
import json
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwright.llm.common import chunks_by_bytes, discard, materialise, save, scratch_path, tidy
from shelfwright.llm.tokens import default_tokenizer, settled

# The pre-tokenisation pattern, and the bytes that byte-level vocabularies write as themselves.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
# White space other than space and line feed, by any Unicode version.
OTHER_SPACE = (
    "\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u180e\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u200b\u2028\u2029\u202f\u205f\u2060\u3000\ufeff"
)
RUNS = ("  ", "\n\n", " \n", "\n ")
ALONE = "\r"  # before what has no space before it; texts that hold it are cut by the pattern
EDGES = (ALONE, "\n")
# White space but a space before a word.
SPACED = re.compile(r"[^\S ]|(?<!\A) |\A ?\Z")

LEXICON_WORDS = 65_536
STEPS = 32  # of the histogram per doubling of a count
LONGEST_WORD = 64  # bytes; longer words are merged
KEPT_WORDS = 50_000  # merged words that a worker remembers
BATCH_BYTES = 8 << 20
MAGIC = b"LEXICON1"


class Vocabulary:
    """Merges, bytes and added tokens of a byte-level vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as source:
            data = json.load(source)
        others = [b for b in range(256) if b not in PRINTED]
        written = {chr(b): b for b in PRINTED} | {chr(256 + i): b for i, b in enumerate(others)}
        ids = data["model"]["vocab"]
        self.bytes_of = {i: bytes(written[c] for c in token) for token, i in ids.items()}
        self.single = [ids[next(c for c, x in written.items() if x == b)] for b in range(256)]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(data["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[ids[left], ids[right]] = rank, ids[left + right]
        self.added = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        self.bytes_of |= {i: text.encode() for text, i in self.added.items()}
        self.names = {i: str(i) for i in self.bytes_of}
        names = sorted(self.added, key=len, reverse=True)
        self._added = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self._pattern = regex.compile(PATTERN)
        in_order = [i for _, i in sorted(self.merges.values())]
        self._fast = None
        if in_order == sorted(in_order) and sorted(self.single) == list(range(256)):
            ranks = {text: i for i, text in self.bytes_of.items() if i not in self.added.values()}
            self._fast = tiktoken.Encoding("merges", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            self._whole = tiktoken.Encoding("pieces", pat_str="(?s:.+)", mergeable_ranks=ranks, special_tokens={})

    def merge(self, token: bytes) -> list[int]:
        """Join the pair of lowest rank, leftmost first, until none is left; n log n steps for n bytes."""
        parts: list[int | None] = [self.single[b] for b in token]
        after, before = [*range(1, len(parts)), -1], [*range(-1, len(parts) - 1)]
        waiting: list[tuple[int, int, int, int]] = []

        def offer(at: int) -> None:
            if at >= 0 and after[at] >= 0 and (found := self.merges.get((parts[at], parts[after[at]]))) is not None:
                heapq.heappush(waiting, (found[0], at, parts[at], parts[after[at]]))

        for at in range(len(parts) - 1):
            offer(at)
        while waiting:
            _, at, left, right = heapq.heappop(waiting)
            other = after[at]
            if parts[at] != left or other < 0 or parts[other] != right:
                continue  # one of the two has been joined with its other neighbour
            parts[at], parts[other] = self.merges[left, right][1], None
            after[at] = after[other]
            if after[at] >= 0:
                before[after[at]] = at
            offer(before[at])
            offer(at)
        return [i for i in parts if i is not None]

    def encode_word(self, word: str) -> list[int]:
        if word in self.added:
            return [self.added[word]]
        if self._fast is None or not word:
            return [i for token in self._pattern.findall(word) for i in self.merge(token.encode())]
        if self._settled(word):
            return self._fast.encode_ordinary(word)
        return [i for token in self._pattern.findall(word) for i in self._whole.encode_ordinary(token)]

    @staticmethod
    def _settled(word: str) -> bool:
        return word.isascii() or max(word) < "\u0250" or all(map(settled, set(word)))

    def write(self, ids: list[int]) -> tuple[str, bytes]:
        """Ids as text, and the bytes that they decode to."""
        return ",".join([self.names[i] for i in ids]), b"".join([self.bytes_of[i] for i in ids])

    def written(self, words: list[str], apart: list[bool]) -> tuple[list[str], list[bytes]]:
        """Of each word: its ids as text, and the bytes that these decode to.

        Words that a line feed between them keeps apart (no white space in them but a space before them, no added
        token) are encoded as one text; ids of the line feeds part the result.
        """
        names, parts = [""] * len(words), [b""] * len(words)
        joined = []
        for i, (word, x) in enumerate(zip(words, apart, strict=True)):
            if x and self._fast is not None and self._settled(word):
                joined.append(i)
            else:
                names[i], parts[i] = self.write(self.encode_word(word))
        if joined:
            ids = self._fast.encode_ordinary("\n".join([words[i] for i in joined]))
            name_of, bytes_of = self.names.__getitem__, self.bytes_of.__getitem__
            some_names = ",".join(map(name_of, ids)).split(f",{name_of(self.single[10])},")
            some_parts = b"".join(map(bytes_of, ids)).split(b"\n")
            for i, name, part in zip(joined, some_names, some_parts, strict=True):
                names[i], parts[i] = name, part
        return names, parts

    def has_added(self, text: str) -> bool:
        return any(name in text for name in self.added)

    def tokens(self, text: str) -> list[str]:
        """Added tokens, and what the pattern makes of the text between them."""
        parts = self._added.split(text) if self._added else [text]
        return [t for i, part in enumerate(parts) for t in ([part] if i % 2 else self._pattern.findall(part))]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def units(text: str, vocabulary: Vocabulary) -> list[str]:
    """A text cut at its spaces, each unit with what its first character says of its words; see `words_of`."""
    if any(c in text for c in OTHER_SPACE) or any(r in text for r in RUNS) or vocabulary.has_added(text):
        return [ALONE + token for token in vocabulary.tokens(text)]
    return (ALONE + text).replace("\n", " \n").split(" ")


def words_of(unit: str) -> tuple[str, ...]:
    """The words of a unit: itself with a space before it, or a line feed and what follows, or what stands alone."""
    if unit[:1] == ALONE:
        return (unit[1:],)
    return ("\n", unit[1:]) if unit[:1] == "\n" else (" " + unit,)


def compile_lexicon(words: dict[bytes, list[int]]) -> list[bytes]:
    """File parts of the minimal automaton of the words and their ids.

    Words are added in byte order; the part of the last word that the next one does not share is final and
    is replaced by an equal state if there is one already.
    """
    order = sorted(words)
    states: list[tuple] = []  # (accepts, ((byte, state), ...)) of frozen states
    frozen: dict[tuple, int] = {}

    def freeze(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in frozen:
            frozen[key] = len(states)
            states.append(key)
        return frozen[key]

    # The path of the last word: nodes [accepts, [(byte, frozen state), ...]]; the last child is still open.
    path: list[list] = [[False, []]]
    last = b""
    for word in [*order, None]:
        shared = 0
        if word is not None:
            while shared < min(len(last), len(word)) and last[shared] == word[shared]:
                shared += 1
        while len(path) > shared + 1:
            node = path.pop()
            path[-1][1].append((last[len(path) - 1], freeze(node)))
        if word is not None:
            for _ in range(shared, len(word)):
                path.append([False, []])
            path[-1][0] = True
            last = word
    root = freeze(path[0])
    counts = []  # words that can be read from each state; targets are frozen before their sources
    for accepts, moves in states:
        counts.append(int(accepts) + sum(counts[target] for _, target in moves))
    keys, targets, skips = [], [], []
    for state, (accepts, moves) in enumerate(states):
        before = int(accepts)
        for byte, target in moves:
            keys.append(state * 256 + byte)
            targets.append(target)
            skips.append(before)
            before += counts[target]
    ids = [words[w] for w in order]
    sections = [
        np.array(keys, "<i8"), np.array(targets, "<i4"), np.array(skips, "<i4"),
        np.array([s[0] for s in states], "u1"), np.cumsum([0, *map(len, ids)]).astype("<i8"),
        np.array([i for x in ids for i in x], "<i4"),
    ]
    head = json.dumps({"root": root, "words": len(order), "sections": [[s.dtype.str, len(s)] for s in sections]}).encode()
    head = head.ljust(-(-(len(head) + 12) // 8) * 8 - 12)
    parts = [MAGIC, np.array([len(head)], "<u4").tobytes(), head]
    for s in sections:
        parts.append(s.tobytes() + b"\0" * (-s.nbytes % 8))
    return parts


class Lexicon:
    """The automaton, mapped from its file."""

    def __init__(self, path: str) -> None:
        data = np.memmap(path, dtype=np.uint8, mode="r")
        if bytes(data[:8]) != MAGIC:
            raise ValueError("not a lexicon file")
        size = int(data[8:12].view("<u4")[0])
        head = json.loads(bytes(data[12 : 12 + size]))
        at, sections = 12 + size, []
        for kind, length in head["sections"]:
            n = length * np.dtype(kind).itemsize
            sections.append(data[at : at + n].view(kind))
            at += n + -n % 8
        self.keys, self.targets, self.skips, self.accepts, self.begin, self.ids = sections
        self._ids, self._begin = np.asarray(self.ids), np.asarray(self.begin)  # plain views, quicker to slice
        self.root, self.words = head["root"], head["words"]

    def find(self, words: list[bytes]) -> np.ndarray:
        """Place of each word in the lexicon, -1 if it is not there; all words take one step at a time."""
        place = np.full(len(words), -1, dtype=np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        if self.words == 0 or len(words) == 0:
            return place
        short = np.flatnonzero(sizes <= LONGEST_WORD)
        if len(short) == 0:
            return place
        text = np.frombuffer(b"".join([words[i] for i in short]) + b"\0", np.uint8)
        size = sizes[short]
        start = np.concatenate(([0], np.cumsum(size)[:-1]))
        state = np.full(len(short), self.root, dtype=np.int64)
        number = np.zeros(len(short), dtype=np.int64)
        live = np.arange(len(short))
        keys = np.asarray(self.keys)
        for step in range(int(size.max()) + 1):
            ended = size[live] == step
            done = live[ended]
            good = done[self.accepts[state[done]] == 1]
            place[short[good]] = number[good]
            live = live[~ended]
            if len(live) == 0 or len(keys) == 0:
                break
            wanted = state[live] * 256 + text[start[live] + step]
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            found = keys[at] == wanted
            live, at = live[found], at[found]
            number[live] += self.skips[at]
            state[live] = self.targets[at]
        return place

    def ids_at(self, place: int) -> list[int]:
        return self._ids[self._begin[place] : self._begin[place + 1]].tolist()


class Speller:
    """Encodes batches of texts with a lexicon; units of lexicon words and, up to a bound, merged ones are remembered.

    `names` has the ids of a unit as text, `parts` the bytes that they decode to.
    """

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon) -> None:
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.names: dict[str, str] = {}
        self.parts: dict[str, bytes] = {}
        self._merged = 0  # remembered units that are not in the lexicon
        self._passing: list[str] = []

    def learn(self, texts: list[list[str]]) -> None:
        """Fill the tables with all units of the texts; what the last call left beyond the bound goes."""
        for unit in self._passing:
            del self.names[unit], self.parts[unit]
        self._passing = []
        fresh = set().union(*texts).difference(self.names)
        inner = [u for u in fresh if u[:1] not in EDGES]
        words = [" " + u for u in inner]
        places = self.lexicon.find([w.encode() for w in words])
        for i in np.flatnonzero(places >= 0).tolist():
            self.names[inner[i]], self.parts[inner[i]] = self.vocabulary.write(self.lexicon.ids_at(places[i]))
        others = np.flatnonzero(places < 0).tolist()
        merged = [inner[i] for i in others]
        names, parts = self.vocabulary.written([words[i] for i in others], [u != "" for u in merged])
        self.names.update(zip(merged, names, strict=True))
        self.parts.update(zip(merged, parts, strict=True))
        self._keep(merged)
        outer = [u for u in fresh if u[:1] in EDGES]
        words = list({w for u in outer for w in words_of(u)})
        known, merged = {}, []
        for word, place in zip(words, self.lexicon.find([w.encode() for w in words]).tolist(), strict=True):
            if place >= 0 and word not in self.vocabulary.added:
                known[word] = self.vocabulary.write(self.lexicon.ids_at(place))
            else:
                merged.append(word)
        apart = [w not in self.vocabulary.added and not SPACED.search(w) for w in merged]
        known |= zip(merged, zip(*self.vocabulary.written(merged, apart), strict=True), strict=True)
        for unit in outer:
            found = [known[w] for w in words_of(unit)]
            self.names[unit] = ",".join([x[0] for x in found if x[0]])
            self.parts[unit] = b"".join([x[1] for x in found])
        rare = set(merged)
        self._keep([u for u in outer if not rare.isdisjoint(words_of(u))])

    def _keep(self, merged: list[str]) -> None:
        """Remember units that are not in the lexicon while there is room; the others pass."""
        short = [u for u in merged if len(u) <= LONGEST_WORD][: max(0, KEPT_WORDS - self._merged)]
        self._merged += len(short)
        self._passing += set(merged).difference(short)

    def spell(self, text: list[str]) -> tuple[str, bytes]:
        """Ids of a learnt text as text, and the bytes that they decode to."""
        return ",".join(filter(None, map(self.names.__getitem__, text))), b"".join(map(self.parts.__getitem__, text))


_vocabularies: dict[str, Vocabulary] = {}
_spellers: dict[tuple[str, str], Speller] = {}


@contextlib.contextmanager
def uncollected() -> Iterator[None]:
    """No garbage collection: batches of words make no cycles, but their many strings would be visited again and again."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def vocabulary_of(path: str) -> Vocabulary:
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


def _speller(path: str, lexicon: str) -> Speller:
    if (path, lexicon) not in _spellers:
        _spellers.clear()
        _spellers[path, lexicon] = Speller(vocabulary_of(path), Lexicon(lexicon))
    return _spellers[path, lexicon]


def _parts(batch: pa.RecordBatch, text: int, size: int) -> Iterator[tuple[int, int, list[str]]]:
    for begin, end in chunks_by_bytes([x or 0 for x in batch.column(size).to_pylist()], BATCH_BYTES):
        yield begin, end, [t.as_py() or "" for t in batch.column(text).slice(begin, end - begin)]


def word_counts(docs: DataFrame, tokenizer: str | None = None, text_col: str = "text") -> DataFrame:
    """word, n over all whole texts; a word behind a space includes it."""
    path = tokenizer or default_tokenizer()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(path)
        for batch in batches:
            for _, _, texts in _parts(batch, 0, 1):
                with uncollected():
                    found, counts = Counter(), Counter()
                    for text in texts:
                        found.update(units(text, vocabulary))
                    for unit in [u for u in found if u[:1] in EDGES]:
                        n = found.pop(unit)
                        for word in words_of(unit):
                            counts[word] += n
                    counts.update({" " + u: n for u, n in found.items()})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
                )

    source = docs.select(F.col(text_col).alias("text"), F.octet_length(text_col).alias("size"))
    return source.mapInArrow(tidy(count), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, tokenizer: str | None = None, words: int = LEXICON_WORDS, text_col: str = "text") -> str:
    """Compile the most frequent words, at most `words`, into a file, ship it to the executors and give its name there.

    A histogram of counts (some hundred steps, whatever the corpus) gives the smallest count whose words
    still fit; only those words come to the driver. Words that occur once are not frequent.
    """
    spark, path = docs.sparkSession, tokenizer or default_tokenizer()
    frequent = word_counts(docs, path, text_col).filter((F.octet_length("word") > 0) & (F.octet_length("word") <= LONGEST_WORD))
    step = F.floor(F.log2("n") * STEPS).alias("step")
    counted = materialise(frequent.filter("n > 1").withColumn("step", step), "words")
    taken, least = 0, None
    for r in sorted(counted.groupBy("step").agg(F.count("*").alias("m")).collect(), reverse=True):
        taken += r["m"]
        if taken > words:
            break
        least = r["step"]
    top = [] if least is None else [r["word"] for r in counted.filter(F.col("step") >= least).select("word").collect()]
    discard(counted)
    vocabulary = vocabulary_of(path)
    folder = scratch_path(spark, "lexicon")
    parts = compile_lexicon({w.encode(): vocabulary.encode_word(w) for w in top if w not in vocabulary.added})
    name = save(folder, "lexicon.bin", parts)
    spark.sparkContext.addFile(f"{folder}/{name}")
    return name


def encode_documents(
    docs: DataFrame, lexicon: str, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id and ids of every document."""
    path = tokenizer or default_tokenizer()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speller = _speller(path, SparkFiles.get(lexicon))
        for batch in batches:
            for begin, end, texts in _parts(batch, 1, 2):
                cut = [units(t, speller.vocabulary) for t in texts]
                speller.learn(cut)
                names = [speller.spell(x)[0] for x in cut]
                ids = [[int(i) for i in x.split(",")] if x else [] for x in names]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, end - begin), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.octet_length(text_col).alias("size"))
    return source.mapInArrow(tidy(encode), "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id and text of encoded documents."""
    path = tokenizer or default_tokenizer()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(path)
        for batch in batches:
            texts = [vocabulary.decode(x.as_py() or []) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(tidy(decode), "doc_id long, text string")


def token_digests(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: ids and the text decoded from them, of each whole text."""
    path = tokenizer or default_tokenizer()
    lexicon = build_lexicon(docs, path)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speller = _speller(path, SparkFiles.get(lexicon))
        for batch in batches:
            for begin, end, texts in _parts(batch, 1, 2):
                with uncollected():
                    cut = [units(t, speller.vocabulary) for t in texts]
                    speller.learn(cut)
                    counts, ids_of, texts_of = [], [], []
                    for text in cut:
                        ids, decoded = speller.spell(text)
                        back = decoded.decode("utf-8", "replace")
                        counts.append(ids.count(",") + 1 if ids else 0)
                        ids_of.append(hashlib.sha256(ids.encode()).hexdigest())
                        texts_of.append(hashlib.sha256(back.encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, end - begin), pa.array(counts, pa.int64()), pa.array(ids_of, pa.string()), pa.array(texts_of, pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.octet_length("text").alias("size"))
    return source.mapInArrow(tidy(digest), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
