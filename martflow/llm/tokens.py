"""Reading public tokenizer files, and whole texts to ids with the byte-level vocabulary."""

from __future__ import annotations

import re
from array import array

END_OF_TEXT = "<|endoftext|>"
# Cached words of one task; when full, the cache starts anew.
CACHED_WORDS = 600_000


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself where printable, else 256 and up."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, unused = {b: chr(b) for b in printable}, 256
    for b in range(256):
        if b not in letters:
            letters[b] = chr(unused)
            unused += 1
    return [letters[b] for b in range(256)]


class Cache(dict):
    """Computes what is missing, and forgets everything when full, so that its size is bounded."""

    def __init__(self, compute, limit: int = CACHED_WORDS):
        self.compute, self.limit = compute, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.compute(key)
        return value


class ByteLevelEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers.

    Words between single spaces are encoded once and remembered: no token of this vocabulary continues past a
    space. Only where white space meets white space does the text have to be encoded as a whole.
    """

    def __init__(self, path: str):
        import json

        import tiktoken

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        back = {letter: b for b, letter in enumerate(byte_letters())}
        ranks = {bytes(back[c] for c in token): i for token, i in content["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        for token in self.special:
            ranks.pop(token.encode(), None)
        # How byte-level vocabularies of this kind split a text into words.
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.words = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.marks = re.compile("|".join(map(re.escape, self.special)))
        self.later = Cache(self._later)

    def _plain(self, text: str) -> bytes:
        return array("I", self.words.encode_ordinary(text)).tobytes()

    def _later(self, word: str) -> bytes | None:
        """Ids of a word after a space; None if white space is at an end of it, or it is empty."""
        return self._plain(" " + word) if word and word == word.strip() else None

    def _segment(self, text: str) -> bytes:
        first, *later = text.split(" ")
        if first and first == first.strip():
            try:
                return self._plain(first) + b"".join(map(self.later.__getitem__, later))
            except TypeError:  # a word with white space at an end
                pass
        return self._plain(text)

    def encode(self, text: str) -> bytes:
        if "<|" not in text:
            return self._segment(text) if text else b""
        out, at = [], 0
        for found in self.marks.finditer(text):
            out += self._segment(text[at : found.start()]), array("I", [self.special[found[0]]]).tobytes()
            at = found.end()
        return b"".join([*out, self._segment(text[at:])])
