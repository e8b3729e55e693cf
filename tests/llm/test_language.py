"""Languages of long texts, of languages with few or long learning texts."""

import random

import pytest

from shelfwright.llm import language


def words_of(seed, n=4000):
    """Made-up words of a language with syllables of its own."""
    rng = random.Random(seed)
    syllables = ["".join(rng.choice(x) for x in ("bcdfghklmnprstvz", "aeiouy", "lmnrst")) for _ in range(120)]
    return ["".join(rng.choices(syllables, k=rng.choice((1, 2, 2, 3)))) for _ in range(n)]


VOCABULARY = {"aa": words_of(1), "bb": words_of(2), "cc": words_of(3)}


def prose(lang, size, seed=0):
    rng, found, length = random.Random(f"{lang}{seed}"), [], 0
    while length < size:
        word = VOCABULARY[lang][int(len(VOCABULARY[lang]) * rng.random() ** 3)]
        found.append(word)
        length += len(word) + 1
    return " ".join(found)


@pytest.fixture(scope="module")
def full():
    return {x: language.normal(prose(x, language.DICTIONARY_BYTES, 1))[: language.DICTIONARY_BYTES] for x in VOCABULARY}


def test_long_text_of_one_language(full):
    name, score = language.Classifier(full)(prose("bb", 3_000_000))
    assert name == "bb" and score > 10 * language.MARGIN


def test_language_that_changes_after_a_start(full):
    classify = language.Classifier(full)
    for rest in (900_000, 2_600_000):
        name, score = classify(prose("aa", 300_000) + " " + prose("bb", rest))
        assert name == "bb" and score > 10 * language.MARGIN


def test_blocks_hold_the_whole_text():
    for data in (b"", b" ", b" ab ", b"x" * 100_000, language.normal(prose("aa", 100_000))):
        parts = language.blocks(data)
        assert b"".join(parts) == data and max(map(len, parts)) <= language.BLOCK_BYTES


def learning_rows(n=60, size=3000):
    return [(i * 3 + k, prose(x, size, i), x) for i in range(n) for k, x in enumerate(VOCABULARY)]


def dictionaries_of(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return language.fit_dictionaries(docs, language.held_out("doc_id") | ~language.held_out("doc_id"))


@pytest.mark.parametrize("size", [20, 200, 3000, 12_000])
def test_one_stray_label_takes_nothing_from_the_others(spark, size):
    found = dictionaries_of(spark, [*learning_rows(), (999, prose("aa", size, 999), "zz")])
    assert sorted(found) == ["aa", "bb", "cc", "zz"]
    assert {len(found[x]) for x in VOCABULARY} == {language.DICTIONARY_BYTES}
    classify = language.Classifier(found)
    for x in VOCABULARY:
        answers = [classify(prose(x, 1500, f"new{i}")) for i in range(40)]
        assert all(name == x and score >= language.MARGIN for name, score in answers)


@pytest.mark.parametrize("size", [1000, 4000, 20_000])
def test_language_with_little_to_learn_from(full, size):
    classify = language.Classifier({**full, "cc": full["cc"][:size]})
    for x in VOCABULARY:
        answers = [classify(prose(x, 1500, f"new{i}")) for i in range(40)]
        assert sum(name == x and score >= language.MARGIN for name, score in answers) >= 39
    assert language.Classifier({"aa": full["aa"], "cc": full["cc"][:size]})(prose("cc", 3000, "new"))[0] == "cc"


def test_language_of_long_texts_only(spark):
    rows = [r for r in learning_rows() if r[2] != "bb"]
    found = dictionaries_of(spark, [*rows, *[(900 + i, "1 " * 20_000 + prose("bb", 30_000, i), "bb") for i in range(6)]])
    assert {x: len(d) for x, d in found.items()} == dict.fromkeys(VOCABULARY, language.DICTIONARY_BYTES)
    for x in VOCABULARY:
        name, score = language.Classifier(found)(prose(x, 1500, "new"))
        assert name == x and score >= language.MARGIN


def test_one_long_stray_text(spark):
    found = dictionaries_of(spark, [*learning_rows(), (999, prose("aa", 200_000, 999), "zz")])
    assert len(found["zz"]) == language.SAMPLE_TEXT_BYTES
    answers = [language.Classifier(found)(prose("aa", 1500, f"new{i}")) for i in range(20)]
    assert all(name == "aa" and score >= language.MARGIN for name, score in answers)
