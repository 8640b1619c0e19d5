"""Token ids of whole texts by a public tokenizer, each distinct word encoded once per worker.

The two vocabularies used here never merge across white space, so a text's ids are the ids of
its chunks in turn. A chunk is encoded by the tokenizers library the first time a worker meets
it and looked up after that. Texts in which chunks might depend on each other (white space
other than the common kinds, control characters, the marks of special tokens) go to the
library whole.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import regex

# The pre-tokenizers' published patterns, as in the vocabulary files.
SPACED_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# Texts with these go to the library whole: control characters, white space beside the common
# kinds, and what might begin a special token. Patterns that begin with one set of characters
# are searched fast, alternatives are not.
_RARE = re.compile("[\x00-\x08\x0e-\x1f\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff]")
_SPECIAL = "<|"
# In byte-level vocabularies white space ties the text's words together in other ways than one
# space if it is doubled or at either end.
_WHITE = frozenset(" \t\n\x0b\x0c\r")
_DOUBLED = re.compile("[ \t-\r][ \t-\r]")

#: Entries of each of a worker's two tables; at about 130 bytes they stay below 200 MB.
CACHE_ENTRIES = 700_000


def public_path(name: str) -> str:
    """Where the machine keeps a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for
    themselves, the others for code points from 256 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


# Of a word's bytes, as a translation of Latin-1.
_LETTERS = {b: x for b, x in enumerate(_byte_letters())}


def _uneven(text: str) -> bool:
    return text[0] in _WHITE or text[-1] in _WHITE or _DOUBLED.search(text) is not None


class _Words(dict):
    """Ids by word; a word that is missing comes from the table before, or from ``encode``."""

    def __init__(self, encode, before: dict[str, bytes]):
        super().__init__()
        self.encode, self.before = encode, before

    def __missing__(self, word: str) -> bytes:
        self[word] = ids = self.before.pop(word, None) or self.encode(word)
        return ids


class Encoder:
    """Encodes texts to little-endian 16-bit ids.

    ``spaced``: the vocabulary keeps the space before a word; otherwise it drops white space
    and normalises case.
    """

    def __init__(self, path: str, spaced: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError(f"ids of {path} do not fit 16 bits")
        self.model, self.spaced = self.tokenizer.model, spaced
        self.pieces = regex.compile(SPACED_PIECES if spaced else WORD_PIECES).findall
        self.known = _Words(self._word, {})

    def _whole(self, text: str) -> bytes:
        return array("H", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        letters = piece.encode().decode("latin-1").translate(_LETTERS)
        return array("H", [x.id for x in self.model.tokenize(letters)]).tobytes()

    def _word(self, word: str) -> bytes:
        if self.spaced:
            word = " " + word
        elif word.isascii():
            word = word.lower()
        else:
            word = self.tokenizer.normalizer.normalize_str(word)
        if word[self.spaced :].isalpha():
            return self._piece(word)
        return b"".join(map(self._piece, self.pieces(word)))

    def _text(self, text: str | None) -> bytes:
        if not text:
            return b""
        if _RARE.search(text) or _SPECIAL in text or self.spaced and _uneven(text):
            return self._whole(text)
        if not self.spaced:
            return b"".join(map(self.known.__getitem__, text.split()))
        # Each word but the first has a space before it; a line break stays within a word.
        first, *words = text.split(" ")
        first = b"".join(map(self._piece, self.pieces(first)))
        return first + b"".join(map(self.known.__getitem__, words))

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text as 16-bit unsigned numbers; null counts as empty."""
        out = []
        for text in texts:
            if len(self.known) > CACHE_ENTRIES:
                self.known = _Words(self._word, self.known)
                self.known.before.before = {}
            out.append(np.frombuffer(self._text(text), dtype="<u2"))
        return out


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, spaced: bool) -> Encoder:
    """The worker's encoder for ``path``; workers are reused, so its tables stay warm."""
    if (path, spaced) not in _ENCODERS:
        _ENCODERS[path, spaced] = Encoder(path, spaced)
    return _ENCODERS[path, spaced]
