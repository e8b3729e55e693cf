"""Packing into several context sizes, and the token encoder, against the tokenizers library and plain checks."""

import json
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from shelfwright.llm import bpe_lexicon, tier_packing, tokens
from tests.conftest import SMALL

TIERS = tier_packing.TIERS


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.default_tokenizer())


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def laid_out(counts, step_tokens):
    """Sequences as lists of (offset, length), the number of cut items, and tokens by step."""
    made = tier_packing.plan(counts, TIERS, step_tokens)
    places, sequences, cut = tier_packing.Places(made), defaultdict(list), 0
    for length, n in counts.items():
        sequence, offset, tape = places.of(length, np.arange(n))
        for i in range(n):
            if tape[i] < 0:
                sequences[int(sequence[i])].append((int(offset[i]), length))
                continue
            pieces = list(places.cuts(int(tape[i]), length))
            assert [p[0] for p in pieces] == np.cumsum([0, *(p[1] for p in pieces)])[:-1].tolist()
            assert sum(p[1] for p in pieces) == length
            cut += len(pieces) > 1
            for _, size, own, inside in pieces:
                sequences[own].append((inside, size))
    sizes, steps = places.tier_and_step(np.array(sorted(sequences), dtype=np.int64))
    assert sizes.tolist() == [sum(n for _, n in sequences[s]) for s in sorted(sequences)]
    return sequences, cut, np.bincount(steps, weights=sizes)


@pytest.mark.parametrize("seed", range(60))
def test_every_sequence_is_full_and_steps_are_even(seed):
    rng = random.Random(seed)
    most = rng.choice([3, 20, 300, 2048])
    counts = {rng.randint(1, most): rng.randint(1, rng.choice([1, 5, 400])) for _ in range(rng.randint(1, 30))}
    sequences, _, loads = laid_out(counts, rng.choice([2048, 8192, 32768]))
    assert set(sequences) == set(range(len(sequences)))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048 and at & (at - 1) == 0
    assert sum(n for v in sequences.values() for _, n in v) == sum(k * n for k, n in counts.items())
    assert loads.max() - loads.min() <= 2048


def test_whole_items_fill_longer_tiers_before_anything_is_cut():
    # 100 items of 1,500 leave 548 each: the items of 500 go there whole, those of 48 after them.
    sequences, cut, _ = laid_out({1500: 100, 500: 100, 48: 100}, 32768)
    assert cut == 0 and len(sequences) == 100 and all(sorted(n for _, n in v) == [48, 500, 1500] for v in sequences.values())
    # Nothing short at hand: half of the sequences are taken apart for the gaps of the others.
    sequences, cut, _ = laid_out({1030: 1000}, 32768)
    assert len(sequences) == -(-1030 * 1000 // 2048) + 5 and cut <= 500


def checked(rows, texts, library):
    """All ids of all documents, each in one place; every sequence full."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(pieces) == set(texts)
    for number, own in pieces.items():
        ids, at = [*library.encode(texts[number] or "", add_special_tokens=False).ids, 1], 0
        for r in sorted(own, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["ids_crc32"] == crc(ids[at : at + r["length"]])
            at += r["length"]
        assert at == len(ids)
    steps = defaultdict(int)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert {r["tier"] for r in own} == {at} and at <= 2048 and at & (at - 1) == 0
        steps[own[0]["step"]] += at
    if steps:
        assert max(steps.values()) - min(steps.values()) <= 2048 and set(steps) == set(range(len(steps)))
    return sequences


@pytest.mark.parametrize("folder", [SMALL, "/root/testdata/sf0.01"])
def test_op11(spark, library, folder):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries()["op11_tier_packing"](spark, folder).collect()
    sequences = checked(rows, texts, library)
    assert sum(r[0]["tier"] < 256 for r in sequences.values()) <= 8


def test_tiers_of_odd_documents(spark, library):
    texts = {
        0: None, 1: "", 2: " \t\n ", None: "no number", 3: "word " * 9000, 4: "中文" * 3000, 5: "<|endoftext|> a", 6: "naïve \U0001f600 \U0001fae8",
        7: "a" * 50_000, **{i: "same text again" for i in range(10, 300)},
    }
    source = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    clashing = source.withColumns({c: F.lit("clash") for c in ("length", "start", "part", "inner", "rank", "ids", "tier", "step", "before", "n")})
    checked(tier_packing.packed_tiers(clashing.repartition(7)).collect(), texts, library)
    assert tier_packing.packed_tiers(source.filter("false")).count() == 0
    repeated = spark.createDataFrame([(1, "a b c")] * 40, "doc_id long, text string")
    rows = tier_packing.packed_tiers(repeated).collect()
    assert sum(r["length"] for r in rows) == 160 and len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)


ALPHABETS = [
    "abcdefghi  \n\n\t'sst'll123", "àéîöü ß ñ", "αβγδ εζ", "абвг де", "中文字 漢", "\U0001f600\U0001f9ff ab", "​ 　\xa0\u0085 x",
    "!?.,;:-_#$% a1", "กั้ क्", "\U0001e900\U00016e40Აՠ q", "<|endoftext|> ",
]


def test_encoder_equals_the_library(library):
    encode, rng = tokens.encoder(tokens.default_tokenizer()), random.Random(7)
    fast = 0
    for _ in range(6000):
        text = "".join(rng.choices("".join(rng.sample(ALPHABETS, 2)), k=rng.randint(0, 40)))
        assert np.frombuffer(encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        fast += encode._clear(text)
    assert fast > 2000


def test_files_that_do_not_merge_by_rank_go_to_the_library(tmp_path, library):
    data = json.loads(library.to_str())
    assert tokens.merge_ranks(data) is not None
    changes = [("pre_tokenizer", {"type": "Whitespace"}), ("normalizer", {"type": "Lowercase"})]
    for key, value in changes:
        assert tokens.merge_ranks(data | {key: value}) is None
    merges = data["model"]["merges"]
    swapped = data | {"model": data["model"] | {"merges": [merges[1], merges[0], *merges[2:]]}}
    assert tokens.merge_ranks(swapped) is None
    (tmp_path / "lower.json").write_text(json.dumps(data | {"normalizer": {"type": "Lowercase"}}))
    other = tokens.Encoder(str(tmp_path / "lower.json"))
    assert other("Some TEXT") == other("some text") == tokens.encoder(tokens.default_tokenizer())("some text")


def test_long_runs_without_spaces_take_few_steps(library):
    rng = random.Random(8)
    vocabulary = bpe_lexicon.Vocabulary(tokens.default_tokenizer())
    for low, high in ((0x4E00, 0x9FA5), (0x3B1, 0x3C9), (0x21, 0x2F)):
        text = "".join(chr(rng.randint(low, high)) for _ in range(300_000 if high < 0x100 else 100_000))
        want = library.encode(text, add_special_tokens=False).ids
        assert vocabulary.encode_word(text) == want
        if high > 0x100:
            assert vocabulary.merge(text.encode()) == want
