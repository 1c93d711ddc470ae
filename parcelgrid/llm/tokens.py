"""Token ids by public tokenizer files; the folder and file are parameters.

``WordIds`` gives the ids that the library gives for a whole text, from a
bounded cache of words. That is exact for a tokenizer that drops white space
before it merges: cutting a text at spaces and line feeds then changes nothing.
A word of plain letters with plain marks behind it is cut once more between the
two, since the tokenizer's own pattern cuts there as well and lower-cases the
letters one by one; its parts go to the library's model directly. Everything
else goes through the whole library as it stands.
"""

from __future__ import annotations

import re
from functools import cache
from itertools import filterfalse

import numpy as np
from public_tokenizers import path
from tokenizers import Tokenizer

MARKS = '.,;:!?()|#$%&*<>"-'
LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")


def byte_characters() -> str:
    """The character that stands for each byte in byte-level vocabularies.

    Printable bytes stand for themselves, the others for the characters from 256 on.
    """
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return "".join(chr(b if b in plain else next(rest)) for b in range(256))


class WordIds:
    """Ids of words, as unsigned 16-bit little-endian bytes."""

    def __init__(self, file: str, most: int = 600_000) -> None:
        self.tokenizer = Tokenizer.from_file(path(file))
        if max(self.tokenizer.get_vocab(with_added_tokens=True).values()) >= 1 << 16:
            raise ValueError(f"{file}: ids do not fit 16 bits")
        self.characters = dict(enumerate(byte_characters()))
        self.merge = self.tokenizer.model.tokenize
        self.most = most
        self.parts: dict[str, bytes] = {"": b""}
        self.words: dict[str, bytes] = {"": b""}

    def encode(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u2").tobytes()

    def part(self, part: str) -> bytes:
        """Ids of one piece of lower-case letters or of marks."""
        found = self.parts.get(part)
        if found is None:
            seen = part if part.isascii() else part.encode().decode("latin-1").translate(self.characters)
            found = self.parts[part] = b"".join([token.id.to_bytes(2, "little") for token in self.merge(seen)])
        return found

    def learn(self, word: str) -> None:
        letters = word.rstrip(MARKS)
        if letters.isascii() and letters.isalpha() or LETTERS.fullmatch(letters):
            self.words[word] = self.part(letters.lower()) + self.part(word[len(letters) :])
        else:
            self.words[word] = self.encode(word)

    def of(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each whole text; null as the empty text."""
        out = []
        for text in texts:
            if len(self.words) > self.most:
                self.words = {"": b""}
            if len(self.parts) > self.most:
                self.parts = {"": b""}
            words = (text or "").replace("\n", " ").split(" ")
            for word in set(filterfalse(self.words.__contains__, words)):
                self.learn(word)
            out.append(b"".join(map(self.words.__getitem__, words)))
        return out


@cache
def word_ids(file: str) -> WordIds:
    """One per Python worker, kept between tasks."""
    return WordIds(file)
