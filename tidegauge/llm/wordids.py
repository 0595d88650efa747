"""Token ids of whole texts with a word-splitting tokenizer file, a word at a time.

The tokenizer drops white space and never joins text across it, so a text's ids
are the ids of its words in a row. Each worker process keeps the ids of words
it has met, in a table of bounded size; what it has not met is encoded by the
tokenizers library.
"""

from __future__ import annotations

import re
import struct
import unicodedata

#: Words that a worker remembers in its young table; a full one becomes the old table, from which words return when met again.
REMEMBERED = 150_000
#: Python splits at these, the tokenizer does not.
_SEPARATORS = re.compile("[\x1c-\x1f]")
#: A run of letters and a run of signs, which the tokenizer parts there; an apostrophe may begin an ending of its own, and special tokens hold `<`.
_LETTERS_SIGNS = re.compile("([A-Za-z]+)([!-&(-/:;=?-@[-`{-~]+)")
_LOADED: dict[str, WordEncoder] = {}


def pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _byte_letters() -> dict[int, str]:
    """The printable stand-ins of bytes in byte-level vocabularies: printable Latin-1 stands for itself, the rest follows from 256 on."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in keep]
    return {b: chr(b) for b in keep} | {b: chr(256 + i) for i, b in enumerate(rest)}


BYTE_LETTERS = _byte_letters()


class WordEncoder(dict):
    """word -> ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.old: dict[str, bytes] = {}

    def keep(self, word: str, ids: bytes) -> bytes:
        if len(self) >= REMEMBERED:
            self.old = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def forget(self) -> None:
        self.clear()
        self.old = {}

    @classmethod
    def load(cls, path: str) -> WordEncoder:
        if path not in _LOADED:
            _LOADED[path] = cls(path)
        return _LOADED[path]

    def __missing__(self, word: str) -> bytes:
        if (known := self.old.get(word)) is not None:
            return self.keep(word, known)
        if word.isalpha():
            if word.isascii():
                return self.keep(word, self._letters(word) if word.islower() else self[word.lower()])
            if word == word.lower() and unicodedata.is_normalized("NFC", word):
                # one run of letters, already normal: the model alone splits it
                return self.keep(word, self._letters(word.encode().decode("latin-1").translate(BYTE_LETTERS)))
        elif word[-1] in ",." and word[:-1].isalpha():
            return self.keep(word, self[word[:-1]] + self[word[-1]])
        elif m := _LETTERS_SIGNS.fullmatch(word):
            return self.keep(word, self[m[1]] + self[m[2]])
        return self.keep(word, pack(self.tokenizer.encode(word, add_special_tokens=False).ids))

    def _letters(self, byte_letters: str) -> bytes:
        return pack([t.id for t in self.model.tokenize(byte_letters)])

    def ids(self, text: str) -> bytes:
        if _SEPARATORS.search(text):
            return pack(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return b"".join(map(self.__getitem__, text.split()))
