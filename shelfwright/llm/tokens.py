"""Token ids of whole texts, exactly those of the tokenizers library.

A byte-level BPE file whose ids follow its merge order, without normaliser, with the usual splitting pattern, is the same
vocabulary that tiktoken encodes by rank, several times faster; `Encoder` reads the file's settings and
takes that way only where all of this holds. The two libraries may know characters of different Unicode versions:
a text with a character whose class (letter, number, space, other) has changed since Unicode 3.2, or that names one of the
file's added tokens, is encoded by the tokenizers library itself, as is every text for any other file.
"""

from __future__ import annotations

import array
import json
import os
import unicodedata

import numpy as np

# Fixed value: how byte-level tokenizers split a text before they merge.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# A lead byte of UTF-8 above this one begins a character from U+0240 on; characters below it are as old as Unicode 3.
LATIN_LEAD = 0xC8


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _written_bytes() -> dict[int, str]:
    """How byte-level vocabularies write each byte: visible ones as themselves, the others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # fixed values
    others = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(others)}


def merge_ranks(data: dict) -> dict[bytes, int] | None:
    """Ids by bytes if they alone decide every merge of a tokenizer file, else None."""
    model, split = data.get("model", {}), data.get("pre_tokenizer") or {}
    plain = data.get("normalizer") is None and split.get("type") == "ByteLevel"
    plain = plain and not split.get("add_prefix_space", True) and split.get("use_regex", True)
    plain = plain and model.get("type", "BPE") == "BPE" and not any(
        model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    )
    if not plain:
        return None
    bytes_of = {c: b for b, c in _written_bytes().items()}
    ids = model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [ids[left + right] for left, right in pairs]
    ranks = {bytes(bytes_of[c] for c in text): i for text, i in ids.items() if all(c in bytes_of for c in text)}
    singles = [ranks.get(bytes([b])) for b in range(256)]
    if None in singles or made != sorted(made) or set(made) | set(singles) < set(ranks.values()) - _added_ids(data):
        return None
    if made and max(singles) > made[0]:
        return None
    return {text: i for text, i in ranks.items() if i not in _added_ids(data)}


def _added_ids(data: dict) -> set[int]:
    return {t["id"] for t in data.get("added_tokens", [])}


def _class(category: str) -> str:
    return category[0] if category[0] in "LNZ" else "other"


def settled(char: str) -> bool:
    """Whether every Unicode version from 3.2 on puts a character into the same class."""
    now, then = unicodedata.category(char), unicodedata.ucd_3_2_0.category(char)
    return now != "Cn" and _class(now) == _class(then)


class Encoder:
    """Ids of a text as packed little-endian unsigned 32-bit integers."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as source:
            data = json.load(source)
        self._tokenizer = Tokenizer.from_str(json.dumps(data))
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        self._added = [t["content"] for t in data.get("added_tokens", [])]
        self._settled: dict[str, bool] = {}
        ranks = merge_ranks(data)
        self._by_rank = None
        if ranks is not None:
            import tiktoken

            self._by_rank = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def whole(self, text: str) -> bytes:
        return array.array("I", self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _clear(self, text: str) -> bool:
        if any(name in text for name in self._added):
            return False
        if text.isascii() or np.frombuffer(text.encode(), np.uint8).max() <= LATIN_LEAD:
            return True
        for char in set(text):
            if char not in self._settled:
                self._settled[char] = settled(char)
            if not self._settled[char]:
                return False
        return True

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self._by_rank is None or not self._clear(text):
            return self.whole(text)
        return array.array("I", self._by_rank(text)).tobytes()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per Python worker and vocabulary."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
