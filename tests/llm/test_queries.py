"""The numbered queries over whole supplied tables against plain Python and the tokenizers library."""

import base64
import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from __spark_entry__ import queries
from shelfwright.llm.rp_forest import exact_nearest, recall
from tests.conftest import SMALL

pytestmark = pytest.mark.filterwarnings("ignore")


def rows(spark, name, folder=SMALL):
    return [r.asDict() for r in queries()[name](spark, folder).collect()]


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def ids_of(documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = tokenizer.encode_batch([r["text"] or "" for r in documents.values()], add_special_tokens=False)
    return {k: e.ids for k, e in zip(documents, found, strict=True)}


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_op1(spark, ids_of):
    got, start = sorted(rows(spark, "op1_wavelet_shards"), key=lambda r: r["doc_id"]), 0
    assert len(got) == len(ids_of)
    for r in got:
        ids = [*ids_of[r["doc_id"]], 0]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), crc(ids))
        start += len(ids)


def test_op3_digest(spark):
    pages = {r["page_id"]: r["html"].encode() for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    for r in rows(spark, "op3_warc_records"):
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(pages[r["page_id"]]).digest()).decode()
        assert r["payload_bytes"] == len(pages[r["page_id"]])


@pytest.mark.parametrize("folder", [SMALL, "/root/testdata/sf0.1"])
def test_op5(spark, folder):
    table = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    matrix = np.stack(table.embedding.to_numpy()).astype(np.float64)
    truth = exact_nearest(table.vec_id.to_numpy(), matrix, [i for i in table.vec_id if i % 50 == 0])
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in rows(spark, "op5_nearest_vectors", folder)]
    assert len(got) == len(truth)
    assert recall([x[::2] for x in got], [x[::2] for x in truth]) >= 0.9
    scores = {(q, v): s for q, _, v, s in truth}
    assert all(scores.get((q, v), s) == s for q, _, v, s in got)
    for q in {x[0] for x in got}:
        own = sorted((x for x in got if x[0] == q), key=lambda x: x[1])
        assert [x[1] for x in own] == [1, 2, 3, 4, 5]
        assert own == sorted(own, key=lambda x: (-x[3], x[2]))


def test_op6(spark, ids_of):
    got = rows(spark, "op6_best_fit_packing")
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(pieces) == set(ids_of)
    for number, own in pieces.items():
        ids, at = [*ids_of[number], 2], 0
        own.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert len(own) == -(-len(ids) // 1024) and all(r["length"] == 1024 for r in own[1:])
        for r in own:
            assert r["start"] == at and r["ids_crc32"] == crc(ids[at : at + r["length"]])
            at += r["length"]
        assert at == len(ids)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    # One piece after another, longest first, each into the fullest sequence that holds it.
    rooms: list[int] = []
    for length in sorted((r["length"] for r in got), reverse=True):
        fits = [x for x in rooms if x >= length]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - length)
        else:
            rooms.append(1024 - length)
    assert len(sequences) == len(rooms)


def test_op7_accuracy_on_rows_held_out(spark, documents):
    got = rows(spark, "op7_language", "/root/testdata/sf0.01")
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(got) == len(langs) and all(0 <= r["score"] <= 1 for r in got)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in held]) >= 0.95


def test_op8(spark, documents, ids_of):
    for r in rows(spark, "op8_bpe_lexicon"):
        ids, text = ids_of[r["doc_id"]], documents[r["doc_id"]]["text"] or ""
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_op10_tells_good_from_bad(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = {r["doc_id"]: r for r in rows(spark, "op10_quality_scores", folder)}
    good = [got[k]["rejected"] for k, r in labels.items() if r["quality"] == 1 and r["toxic"] == 0]
    junk = [got[k]["rejected"] for k, r in labels.items() if r["quality"] == 0]
    toxic = [got[k]["rejected"] for k, r in labels.items() if r["toxic"] == 1]
    assert np.mean(good) < 0.05 and np.mean(junk) > 0.8 and np.mean(toxic) > 0.6


def test_pipeline_against_plain_python(spark, ids_of):
    """Every stage on what its predecessor kept, computed again on the driver."""
    import corpus_pipeline as pipeline
    from shelfwright.llm import cotraining, language
    from tests.llm.test_edges import removed

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    stages = [stage for _, stage in pipeline.STAGES]

    def run(stage, table):
        out = stage(spark, table, SMALL)
        assert out.columns == docs.columns
        rows = sorted(out.collect(), key=lambda r: r["doc_id"])
        return spark.createDataFrame(rows, docs.schema), {r["doc_id"]: r["text"] for r in rows}

    classify = language.Classifier(language.fit_dictionaries(docs, ~language.held_out()))
    want = {}
    for r in docs.collect():
        name, score = classify(r["text"])
        if name != "und" and score >= language.MARGIN:
            want[r["doc_id"]] = r["text"]
    known, texts = run(stages[0], docs)
    assert texts == want and len(texts) > 150

    models, rows = cotraining.fit(known, labels), known.collect()
    views = cotraining.Rows.of(*[[r[c] for r in rows] for c in ("text", "source", "lang")])
    scores = np.prod([m.score(views) for m in models], axis=0)
    good, texts = run(stages[1], known)
    assert texts == {r["doc_id"]: r["text"] for r, x in zip(rows, scores, strict=True) if x >= cotraining.CUT}

    sets = {k: {tuple(t.split()[i : i + 5]) for i in range(max(1, len(t.split()) - 4))} for k, t in texts.items()}
    group = {k: k for k in texts}
    changed = True
    while changed:
        changed = False
        for a in texts:
            for b in texts:
                if group[a] < group[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                    group[b], changed = group[a], True
    want = {k: t for k, t in texts.items() if group[k] == k}
    distinct, texts = run(stages[2], good)
    assert texts == want

    want = {}
    for (number, text), (n, gone, kept) in zip(sorted(texts.items()), removed([t for _, t in sorted(texts.items())], 20), strict=True):
        if gone < n or n == 0:
            want[number] = kept if gone else text
    passages, texts = run(stages[3], distinct)
    assert texts == want

    packed = stages[4](spark, passages, SMALL)
    assert packed.select("doc_id").distinct().count() == len(texts)
    assert pipeline.run(spark, SMALL).count() == packed.count()
