"""Tokenizing with a word cache."""

from __future__ import annotations

import json
import os
import re
from array import array

from tesserae.llm.common import keep

#: White space, a space, and no text after it: the space is part of a longer run.
_RUN = re.compile(r"\s (?!\S)")
#: Words kept by each Python worker; the rest are encoded each time.
CACHE_WORDS = 500_000
#: Letters end here for the shortcuts below; beyond, Unicode versions could differ in what a letter is.
_LAST_LETTER = "ɏ"
_MARKS = ".,!?;:|*$#%&"
#: Byte-level BPE writes byte b as this character: itself if it prints, else the next unused one from 256.
_PRINTS = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_CHARS = {b: chr(b) for b in _PRINTS} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _PRINTS)}


class _Cache(dict):
    def __init__(self, encode, most: int):
        self.encode, self.most = encode, most

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(word)
        if len(self) < self.most:
            self[word] = ids
        return ids


class Encoder:
    """Encodes texts with a ``tokenizers`` file into little-endian unsigned 32-bit ids.

    Byte-level BPE with the usual splitting pattern, and its lower-casing kin that drops white space,
    split a text before every single space that follows text, so the ids of a text are the ids of its
    pieces between spaces. Pieces are looked up in a cache; a word of letters alone goes straight to the
    tokenizer's model. Runs of white space, where the rule fails, and files of any other kind send whole
    texts to the tokenizer.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.kind = _kind(json.loads(self.tokenizer.to_str()))
        self.space = " " if self.kind == "bytes" else ""
        self.first = _Cache(lambda word: self._word(word, self.first, ""), cache_words)
        self.later = _Cache(lambda word: self._word(word, self.later, self.space), cache_words) if self.space else self.first

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _letters(self, word: str) -> bytes:
        """Ids of a space or nothing and then letters, which the splitting pattern keeps together."""
        if self.kind == "lower":
            word = word.lower()
        if not word.isascii() or self.space:
            word = word.encode().decode("latin-1").translate(_BYTE_CHARS)
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def _word(self, word: str, cache: _Cache, space: str) -> bytes:
        """Marks after letters, and lines after a single end of line, are pieces of their own."""
        if _plain(word, self.kind):
            return self._letters(space + word)
        if "\n" in word:
            lines = word.split("\n")
            if all(lines) and not any(x[0].isspace() or x[-1].isspace() for x in lines):
                return cache[lines[0]] + b"".join([self.first["\n"] + self.first[x] for x in lines[1:]])
        elif len(word) > 1 and word[-1] in _MARKS:
            letters = word.rstrip(_MARKS)
            if letters and _plain(letters, self.kind):
                return cache[letters] + self.first[word[len(letters) :]]
        return self.whole(space + word)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.kind or _RUN.search(text):
            return self.whole(text)
        first, _, rest = text.partition(" ")
        if not _:
            return self.first[first]
        return self.first[first] + b"".join(map(self.later.__getitem__, rest.split(" ")))


def _plain(word: str, kind: str) -> bool:
    """Letters alone, whose lower case (where that matters) is letters alone too."""
    return word.isalpha() and (word.isascii() or max(word) <= _LAST_LETTER and (kind == "bytes" or word == word.lower()))


def _kind(spec: dict) -> str:
    model, split, normal = spec["model"], spec["pre_tokenizer"] or {}, spec["normalizer"] or {}
    plain = model["type"] == "BPE" and not any(model[k] for k in ("dropout", "continuing_subword_prefix", "ignore_merges"))
    if plain and not normal and split.get("type") == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"]:
        return "bytes"
    steps = [x["type"] for x in normal.get("normalizers", [])]
    removed = [x.get("behavior") for x in split.get("pretokenizers", [])]
    if plain and steps == ["NFC", "Replace", "Lowercase"] and removed == ["Removed", None] and model["end_of_word_suffix"]:
        return "lower"
    return ""


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, cache_words: int = CACHE_WORDS) -> Encoder:
    """The encoder of this Python worker for ``path``."""
    key = path, cache_words
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, cache_words)
    keep(_ENCODERS[key].first, _ENCODERS[key].later)
    return _ENCODERS[key]


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
