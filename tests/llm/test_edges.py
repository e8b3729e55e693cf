"""Nulls, empty and long texts, ties, repeated rows, empty tables and columns with clashing names, for every operator."""

import gc
import hashlib
import math
import weakref
import zlib
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfwright.llm import (
    bpe_lexicon, cotraining, embedding_dedup, language, ngram_join, packing, rp_forest, substring, warc, wavelet,
)
from shelfwright.llm.tokens import default_tokenizer

WORDS = [f"w{i}" for i in range(3000)]
LONG = " ".join(WORDS)
TEXTS = [
    (0, "same words here again and more of them"), (1, "same words here again and more of them"), (2, None), (3, ""),
    (4, " \t\n "), (None, "no number at all"), (5, LONG), (6, "tail " + LONG[: len(LONG) // 2]), (6, "again six"),
    (6, "again six"), (7, "naïve Ünïcode   text \U0001f600 <|endoftext|> x"), (8, "a  b\n\n\nc\t\td   "), (9, "x" * 5000),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside.
CLASHING = ["row", "number", "mark", "spans", "size", "bands", "sketch", "cid", "group", "kept", "score", "rejected", "ids", "y", "part"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", None, "fr"][n % 3], None if n % 2 else "s", None) for n, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in CLASHING}).repartition(3)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def encode():
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def key(value):
    return (value is not None, value if value is not None else 0)


def test_wavelet_shards(docs, no_docs, encode):
    got = sorted(wavelet.token_shards(docs).collect(), key=lambda r: r["start"])
    want = sorted(TEXTS, key=lambda r: (key(r[0]), r[1] is not None, r[1] or ""))
    at = 0
    for r, (number, text) in zip(got, want, strict=True):
        ids = [*encode(text), 0]
        assert tuple(r) == (number, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert wavelet.token_shards(no_docs).count() == 0


@pytest.mark.parametrize("top", [0, 1, 5, 40_000, 70_000])
def test_wavelet_access_rank_select(top):
    rng = np.random.default_rng(top)
    for n in (0, 1, 511, 512, 513, 5000):
        ids = np.minimum(rng.zipf(1.3, n) - 1, top).astype(np.uint32)
        lengths = np.array([n // 3, 0, n - n // 3])
        data = b"".join(wavelet.build(ids, np.array([4, 5, 6]), np.array([True, True, False]), lengths))
        shard = wavelet.Shard(data)
        assert (shard.decode() == ids).all() and (shard.access(np.arange(n)) == ids).all()
        for token in (0, 1, int(ids[0]) if n else 3, 99_999):
            places = np.flatnonzero(ids == token)
            assert shard.count(token) == len(places) and shard.rank(token, n // 2) == (places < n // 2).sum()
            assert (shard.occurrences(token) == places).all()
    with pytest.raises(ValueError):
        wavelet.Shard(data + b"x")


def test_embeddings(spark):
    base = [1.0, 2.0, 3.0]
    rows = [
        (5, base, 1), (3, base, 1), (4, [2.0, 4.0, 6.0], 1), (1, base, 2), (2, base, None), (6, None, 1), (7, [0.0, 0.0, 0.0], 1),
        (8, [math.nan, 1.0, 1.0], 1), (9, [math.inf, 1.0, 1.0], 1), (10, [None, 1.0, 1.0], 1), (11, [1.0, 2.0], 1), (11, [1.0, 2.0], 1),
        (12, [-1.0, -2.0, -3.0], 1), (13, [], 1), (None, [1.0, 2.0, 3.1], 1),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("cell", F.lit(1))
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.near_duplicates(table).collect()), key=lambda r: (key(r[0]), r[1]))
    assert got == [
        (None, 3, 3, False), (1, 0, 1, True), (2, 0, 2, True), (3, 3, 3, True), (4, 3, 3, False), (5, 3, 3, False), (6, 0, 6, True),
        (7, 0, 7, True), (8, 0, 8, True), (9, 0, 9, True), (10, 0, 10, True), (11, 1, 11, True), (11, 1, 11, True), (12, 0, 12, True), (13, 0, 13, True),
    ]
    assert embedding_dedup.near_duplicates(table.filter("false")).count() == 0
    assert embedding_dedup.near_duplicates(table.filter("vec_id = 6")).count() == 1


def test_embeddings_against_all_pairs(spark, monkeypatch):
    """Many small cells and blocks, one hot group."""
    monkeypatch.setattr(embedding_dedup, "CELL_ROWS", 40)
    monkeypatch.setattr(embedding_dedup, "BLOCK_ROWS", 32)
    rng = np.random.default_rng(3)
    points = rng.normal(size=(600, 8))
    points[:200] = rng.normal(size=8) + 0.25 * rng.normal(size=(200, 8))
    label = rng.integers(0, 2, 600)
    table = spark.createDataFrame([(i, p.tolist(), int(k)) for i, (p, k) in enumerate(zip(points, label, strict=True))], "vec_id long, embedding array<double>, label int")
    unit = points / np.linalg.norm(points, axis=1)[:, None]
    links = (unit @ unit.T >= 0.93) & (label[:, None] == label[None, :]) & ~np.eye(600, dtype=bool)
    component = np.arange(600)
    while True:
        following = np.minimum(component, np.where(links, component[None, :], 600).min(axis=1))
        if (following == component).all():
            break
        component = following
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(table).collect()}
    assert [got[i]["n_links"] for i in range(600)] == links.sum(axis=1).tolist()
    assert [got[i]["component_id"] for i in range(600)] == component.tolist()


def test_web_archives(spark):
    rows = [(1, "http://a b", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "u", None), (4, "u", ""), (None, "u", "<p>x</p>"), (5, "u", "é" * 50_000), (6, "v\r\nw", "\r\n\r\nWARC/1.1"), (6, "v", "other")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("key", F.lit(1))
    got = {(r["page_id"], r["payload_digest"]): (r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.page_records(pages).collect()}
    assert len(got) == len(rows)
    sha = lambda t: warc.digest(t.encode())
    assert got[1, sha("<p>x</p>")] == got[None, sha("<p>x</p>")] == (8, "revisit", 2) and got[2, sha("<p>x</p>")][1:] == ("response", None)
    assert got[3, sha("")] == (0, "revisit", 4) and got[4, sha("")] == (0, "response", None) and got[5, sha("é" * 50_000)][0] == 100_000
    assert warc.page_records(pages.filter("false")).count() == 0


def test_web_archive_payloads_and_damage(spark, tmp_path):
    pages = spark.createDataFrame([(i, None, f"<p>{i}</p>" * 50) for i in range(30)], "page_id long, url string, html string")
    files = warc.write_archives(pages, str(tmp_path), min_bytes=10**6)
    assert {r["page_id"]: bytes(r["payload"]) for r in warc.read_archives(files, str(tmp_path), payloads=True).collect()} == {
        i: f"<p>{i}</p>".encode() * 50 for i in range(30)
    }
    data = (tmp_path / files.first()["file"]).read_bytes()
    assert sum(1 for _ in warc.records_of(data)) == files.first()["n_records"]
    for bad in (data[:-3], data + b"junk", data[: len(data) // 2] + b"\0" + data[len(data) // 2 + 1 :]):
        with pytest.raises(Exception):  # noqa: B017
            list(warc.records_of(bad))
    good = warc.record(1, "u", b"abc", None, "2024-01-01T00:00:00Z")
    assert warc.parse(good)["payload"] == b"abc"
    for a, b in ((b"WARC/1.1", b"WARC/1.0"), (b"X-Payload-Length: 3", b"X-Payload-Length: 4"), (b"abc", b"abd"), (b"WARC-Date", b"WARC-Dat"), (b"WARC-Type: response", b"WARC-Type: revisit")):
        with pytest.raises(ValueError):
            warc.parse(good.replace(a, b))


def removed(texts, width):
    """Words that stay, by one pass over the documents in order."""
    seen, out = set(), []
    for text in texts:
        words = (text or "").split()
        gone = set()
        for i in range(len(words) - width + 1):
            window = tuple(words[i : i + width])
            if window in seen:
                gone.update(range(i, i + width))
            seen.add(window)
        out.append((len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return out


def test_repeated_windows(spark, docs, no_docs, monkeypatch):
    got = {(r["row"]["doc_id"], r["row"]["text"]): (r["n_words"], r["n_removed"]) for r in substring.remove_repeats(docs).collect()}
    assert got[5, LONG] == (3000, 0) and got[2, None] == got[3, ""] == got[4, " \t\n "] == (0, 0)
    half = len(LONG[: len(LONG) // 2].split())
    n, gone = got[6, "tail " + LONG[: len(LONG) // 2]]
    assert n == half + 1 and gone in (half, half - 1)
    assert substring.remove_repeats(docs).first()["row"]["number"] == "clash"
    assert substring.remove_repeats(no_docs).count() == 0
    assert substring.without_repeats(docs).columns == docs.columns


@pytest.mark.parametrize("hot", [False, True])
def test_repeated_windows_against_one_pass(spark, hot, monkeypatch):
    if hot:  # every minimiser that occurs twice sends its windows one by one
        monkeypatch.setattr(substring, "HOT_ROWS", 1)
        monkeypatch.setattr(substring, "HOT_SHARE", 1e-9)
    monkeypatch.setattr(substring, "BUCKET_BYTES", 2000)
    rng = np.random.default_rng(8)
    words = [f"v{i}" for i in range(40)]
    shared = " ".join(rng.choice(words, 60))
    texts = []
    for i in range(120):
        text = " ".join(rng.choice(words, rng.integers(0, 60)))
        if i % 3 == 0:
            text += "\t" + shared
        if i % 10 == 0:
            text += "  same" * 50
        texts.append(text if i % 4 else texts[-1] if texts else text)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r["row"]["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substring.remove_repeats(docs, width=20, seed=3).collect()}
    assert [got[i] for i in range(len(texts))] == removed(texts, 20)


def test_nearest(spark):
    rows = [(0, [1.0, 0.0]), (50, [0.0, 1.0]), (7, [1.0, 0.0]), (3, [2.0, 0.0]), (4, [0.0, 0.0]), (100, None), (8, [math.nan, 1.0]), (9, [-1.0, 0.0]), (150, [1.0, 2.0, 3.0]), (None, [1.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("dim", F.lit("clash"))
    asked = F.col("vec_id") % 50 == 0
    got = sorted(tuple(r) for r in rp_forest.nearest(table, asked).filter("query_id = 0").collect())
    assert got == [(0, 1, 3, 1.0), (0, 2, 7, 1.0), (0, 3, None, 1.0), (0, 4, 50, 0.0), (0, 5, 9, -1.0)]
    assert {r["query_id"] for r in rp_forest.nearest(table, asked).collect()} == {0, 50}
    assert rp_forest.nearest(table.filter("false"), asked).count() == 0


def test_nearest_through_trees(spark, monkeypatch):
    """Clustered vectors with a hot group of equal ones: deep trees, small blocks."""
    monkeypatch.setattr(rp_forest, "LEAF_ROWS", 32)
    monkeypatch.setattr(rp_forest, "BLOCK_ROWS", 24)
    rng = np.random.default_rng(1)
    points = rng.normal(size=(40, 16))[rng.integers(0, 40, 1500)] + 0.2 * rng.normal(size=(1500, 16))
    points[:300] = points[0]
    table = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
    asked = [i for i in range(1500) if i % 50 == 0]
    truth = rp_forest.exact_nearest(np.arange(1500), points, asked)
    got = [tuple(r) for r in rp_forest.nearest(table, F.col("vec_id") % 50 == 0).collect()]
    assert rp_forest.recall([x[::2] for x in got], [x[::2] for x in truth]) >= 0.9
    assert sorted(x for x in got if x[0] == 0) == [x for x in truth if x[0] == 0]


def test_packing(docs, no_docs, encode):
    got = packing.packed_documents(docs).collect()
    assert sum(r["length"] for r in got) == sum(len(encode(t)) + 1 for _, t in TEXTS)
    spans = sorted((r["sequence_id"], r["offset"], r["length"]) for r in got)
    for (s, a, n), (t, b, _) in zip(spans, spans[1:], strict=False):
        assert b == (a + n if s == t else 0)
    assert packing.packed_documents(no_docs).count() == 0


def test_plan_is_best_fit_decreasing():
    rng = np.random.default_rng(2)
    for n in (1, 5, 200, 2000):
        lengths = rng.choice([1, 2, 3, 50, 333, 334, 500, 512, 513, 700, 1023, 1024, *rng.integers(1, 1025, 30)], n)
        counts = {int(k): int(c) for k, c in zip(*np.unique(lengths, return_counts=True), strict=True)}
        placed: dict[int, list] = {}
        for length, _, pieces, first, each, offset in packing.plan(counts):
            for i in range(pieces):
                placed.setdefault(first + i // each, []).append((offset + length * (i % each), length))
        rooms: list[int] = []
        for length in sorted(lengths.tolist(), reverse=True):
            fits = [r for r in rooms if r >= length]
            if fits:
                rooms.remove(min(fits))
            rooms.append((min(fits) if fits else 1024) - length)
        assert sorted(1024 - sum(x for _, x in p) for p in placed.values()) == sorted(rooms)
        for p in placed.values():
            p.sort()
            assert all(a + n == b for (a, n), (b, _) in zip(p, p[1:], strict=False)) and p[0][0] == 0


def test_language(spark, docs, no_docs):
    found = {(r["doc_id"], r["held_out"]): (r["lang_pred"], r["score"]) for r in language.predictions(docs).collect()}
    assert len(found) <= len(TEXTS) and {p for p, _ in found.values()} <= {"en", "fr", "und"}
    assert found[3, zlib.crc32(b"3") % 4 == 2] == ("und", 0.0)
    assert language.predictions(no_docs).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language.predictions(unlabelled).collect()} == {"und"}
    assert language.of_known_language(docs).columns == docs.columns


def test_shards_are_let_go_of():
    data = np.arange(1 << 20, dtype="<u4").tobytes()
    held = weakref.ref(owner := np.frombuffer(data, np.uint8).copy())
    at = np.array([400, 404, 404, 4000, len(data)])
    found = wavelet.slices(memoryview(owner), at)
    assert found.to_pylist() == [data[a:b] for a, b in zip(at, at[1:], strict=False)]
    del owner, found
    gc.collect()
    assert held() is None


def test_lexicon(docs, no_docs, encode):
    want = sorted((i, t or "") for i, t in TEXTS if i is not None)
    got = sorted(tuple(r) for r in bpe_lexicon.token_digests(docs).collect() if r["doc_id"] is not None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert got == sorted((i, len(encode(t)), sha(",".join(map(str, encode(t)))), sha(t)) for i, t in want)
    assert bpe_lexicon.token_digests(no_docs).count() == 0
    name = bpe_lexicon.build_lexicon(docs, words=50)
    encoded = bpe_lexicon.encode_documents(docs, name)
    assert sorted((r["doc_id"], r["ids"]) for r in encoded.collect() if r["doc_id"] is not None) == sorted((i, encode(t)) for i, t in want)
    back = bpe_lexicon.decode_documents(encoded).collect()
    assert sorted((key(r["doc_id"]), r["text"]) for r in back) == sorted((key(i), t or "") for i, t in TEXTS)


def test_merged_words_of_a_batch_are_encoded_together(tmp_path, monkeypatch):
    vocabulary = bpe_lexicon.Vocabulary(default_tokenizer())
    (tmp_path / "x").write_bytes(b"".join(bpe_lexicon.compile_lexicon({b" known": vocabulary.encode_word(" known")})))
    texts = [t or "" for _, t in TEXTS] + ["it's x\nknown known,\n", "\n", " ", "\r\n a\tb", "новое 漢字 \u0378x known", "tail "]
    texts += [" ".join(f"{a}{n}ness" for a in ("un", "re")) for n in range(500)]
    calls, encode = [], vocabulary._fast.encode_ordinary
    monkeypatch.setattr(vocabulary, "_fast", SimpleNamespace(encode_ordinary=lambda text: calls.append(text) or encode(text)))
    monkeypatch.setattr(bpe_lexicon, "KEPT_WORDS", 100)
    speller = bpe_lexicon.Speller(vocabulary, bpe_lexicon.Lexicon(str(tmp_path / "x")))
    cut = [bpe_lexicon.units(t, vocabulary) for t in texts]
    for _ in range(2):  # words beyond the bound are learnt again
        speller.learn(cut)
    assert len(calls) < 100
    for text, found in zip(texts, cut, strict=True):
        ids = [i for token in vocabulary.tokens(text) for i in vocabulary.encode_word(token)]
        assert speller.spell(found) == vocabulary.write(ids)
        assert speller.spell(found)[1].decode() == text
    speller.learn([])
    assert len(speller.names) < 200


def test_lexicon_automaton(tmp_path):
    words = {w.encode(): [n] * (n % 4) for n, w in enumerate(["", "a", "ab", "abc", "xbc", "bc", "c", "tions", "nations", "é"])}
    (tmp_path / "x").write_bytes(b"".join(bpe_lexicon.compile_lexicon(words)))
    lexicon = bpe_lexicon.Lexicon(str(tmp_path / "x"))
    asked = [*words, b"abcd", b"b", b"x", b"tion", b"z" * 100]
    places = lexicon.find(asked)
    assert [lexicon.ids_at(p) for p in places[: len(words)]] == list(words.values()) and (places[len(words) :] == -1).all()
    many = {f"w{i}ing".encode(): [i] for i in range(500)}
    (tmp_path / "y").write_bytes(b"".join(bpe_lexicon.compile_lexicon(many)))
    small = bpe_lexicon.Lexicon(str(tmp_path / "y"))
    assert len(small.accepts) < 100  # endings are shared
    assert [small.ids_at(p) for p in small.find(list(many))] == list(many.values())
    (tmp_path / "z").write_bytes(b"".join(bpe_lexicon.compile_lexicon({})))
    assert bpe_lexicon.Lexicon(str(tmp_path / "z")).find([b"", b"a"]).tolist() == [-1, -1]


def test_near_documents(docs, no_docs):
    got = sorted(((r["doc_id"], r["n_links"], r["class_id"]) for r in ngram_join.near_documents(docs).collect()), key=lambda r: (key(r[0]), r))
    assert got == [
        (None, 0, None), (0, 1, 0), (1, 1, 0), (2, 0, 2), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 0, 6), (6, 1, 6), (6, 1, 6), (7, 0, 7), (8, 0, 8), (9, 0, 9),
    ]
    assert ngram_join.near_documents(no_docs).count() == 0
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(key(r["doc_id"]) for r in kept.collect()) == sorted(key(i) for i in (None, 0, 2, 3, 4, 5, 6, 6, 7, 8, 9))


def test_null_and_repeated_ids_are_told_apart(spark):
    a, b, c, d = (" ".join(f"{x}{n}" for n in range(60)) for x in "abcd")
    rows = [(1, a), (None, a), (None, a + " more"), (5, a + " again"), (5, c), (9, c + " x"), (None, b), (None, b + " y"), (None, b), (7, d), (7, d + " z"), (None, ""), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = [(r["doc_id"], r["text"]) for r in ngram_join.one_of_each(docs).collect()]
    assert sorted((k[0] or 0, k[1][:1]) for k in kept) == [(0, ""), (0, "b"), (1, "a"), (5, "c"), (7, "d")]
    links = sorted((r["doc_id"] or 0, r["n_links"], r["class_id"] or 0) for r in ngram_join.near_documents(docs).collect())
    assert links == [(0, 0, 0), (0, 0, 0), (0, 2, 0), (0, 2, 0), (0, 2, 0), (0, 3, 1), (0, 3, 1), (1, 3, 1), (5, 1, 5), (5, 3, 1), (7, 1, 7), (7, 1, 7), (9, 1, 5)]


def test_near_documents_against_all_pairs(spark, monkeypatch):
    """A large group of different near copies over several blocks, small groups, a passage that many share."""
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 16)
    monkeypatch.setattr(ngram_join, "PART_ROWS", 40)
    rng = np.random.default_rng(4)
    base, passage = rng.choice(WORDS, 120).tolist(), rng.choice(WORDS, 30).tolist()
    texts = []
    for i in range(160):
        if i % 2:
            words = list(base)
            for _ in range(rng.integers(0, 6)):
                words[rng.integers(0, 120)] = f"edit{rng.integers(0, 10**6)}"
        elif i % 8 == 0 and i:
            words = texts[i - 2].split() + ["more"]
        else:
            words = rng.choice(WORDS, 60).tolist() + passage
        texts.append(" ".join(words))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    links = np.array([[i != j and len(a & b) >= 0.8 * len(a | b) for j, b in enumerate(sets)] for i, a in enumerate(sets)])
    group = np.arange(len(texts))
    while True:
        following = np.minimum(group, np.where(links, group[None, :], len(texts)).min(axis=1))
        if (following == group).all():
            break
        group = following
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    repeated = docs.union(docs.filter("doc_id = 7")).union(docs.filter("doc_id = 7"))
    more = {r["doc_id"]: r["n_links"] for r in ngram_join.near_documents(repeated).collect()}
    assert [more[i] for i in range(len(texts))] == (links.sum(axis=1) + 2 * (links[:, 7] | (np.arange(len(texts)) == 7))).tolist()
    got = {r["doc_id"]: r for r in ngram_join.near_documents(docs).collect()}
    assert [got[i]["class_id"] for i in range(len(texts))] == group.tolist()
    assert [got[i]["n_links"] for i in range(len(texts))] == links.sum(axis=1).tolist()


def test_bands_reach_the_recall():
    for threshold, recall in ((0.8, 0.9999), (0.5, 0.99), (0.9, 0.999)):
        bands, rows = ngram_join.choose_bands(threshold, recall)
        assert bands * rows <= ngram_join.MAX_HASHES and 1 - (1 - threshold**rows) ** bands >= recall


def test_quality(spark, docs, no_docs):
    labels = spark.createDataFrame([(0, 1, 0), (5, 0, None), (5, 1, 1), (6, None, 1), (None, 0, 0), (99, 0, 1), (8, None, None), (9, 1, 0)], "doc_id long, quality int, toxic int")
    got = cotraining.scores(docs, labels).collect()
    assert len(got) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in got)
    none = labels.filter("false")
    assert {(r["score"], r["rejected"]) for r in cotraining.scores(docs, none).collect()} == {(1.0, False)}
    assert cotraining.scores(no_docs, labels).count() == 0
    assert cotraining.of_good_quality(docs, labels).columns == docs.columns


def test_pipeline_on_few_and_no_rows(spark, docs, no_docs, tmp_path):
    labels = spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int")
    for name, table in (("few", docs.select("doc_id", "text", "lang", "source", "n_chars")), ("none", no_docs)):
        table.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.write.parquet(f"{tmp_path}/{name}/labels.parquet")
        assert (corpus_pipeline.run(spark, f"{tmp_path}/{name}").count() > 0) == (name == "few")
