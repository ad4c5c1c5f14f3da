"""Encoding and decoding with a word-end BPE vocabulary by forced-boundary splitting.

A pair of bytes that no token of the vocabulary holds can never be joined by a merge. Every word is cut at such pairs,
the fragments are encoded independently, each once per task, and their ids are concatenated.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from heapq import heapify, heappop, heappush

from pyspark.sql import DataFrame

from martflow.llm.common import map_columns
from martflow.llm.tokens import Cache, byte_letters

WORD_END = "</w>"
# White space, and the words of a text, as the vocabulary file defines them.
WHITE = r"\t-\r\x20\x85\xa0  -     　"
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# Symbols of a fragment up to which looking at all pairs is faster than a heap.
SHORT = 64


class WordEncoder:
    """Encodes and decodes whole texts with the vocabulary in a tokenizer file."""

    def __init__(self, path: str):
        import json

        import regex

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.special: dict[str, int] = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.tokens = {i: t for t, i in (self.ids | self.special).items()}
        self.ranks = {tuple(m.split(" ") if isinstance(m, str) else m): r for r, m in enumerate(model["merges"])}
        self.letters = byte_letters()
        self.joinable = self._joinable()
        self.word_pattern = regex.compile(WORDS)
        self.white = re.compile(f"[{WHITE}]+")
        # White space to str.split() that is none to the vocabulary.
        self.separators = re.compile("[\x1c-\x1f]")
        self.marks = re.compile("|".join(map(re.escape, self.special)))
        self.fragments = Cache(self._merge)
        self.words = Cache(self._encode_word)
        self.chunks = Cache(self._encode_chunk)

    def _joinable(self) -> set[str]:
        """Neighbours in some token. All other pairs are forced boundaries."""
        pairs = set()
        for token in self.ids:
            if token not in self.special:
                plain = token.removesuffix(WORD_END)
                pairs.update(map("".join, zip(plain, plain[1:])))
        return pairs

    def _merge(self, fragment: tuple[str, bool]) -> tuple[int, ...]:
        """Ids of a fragment; the flag tells whether it ends its word."""
        letters, ends = fragment
        symbols = list(letters)
        if ends:
            symbols[-1] += WORD_END
        if len(symbols) > SHORT:
            return self._merge_long(symbols)
        ranks, worst = self.ranks, len(self.ranks)
        order = [ranks.get(pair, worst) for pair in zip(symbols, symbols[1:])]
        while order:
            best = min(order)
            if best == worst:
                break
            at = order.index(best)
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            del order[at]
            if at:
                order[at - 1] = ranks.get((symbols[at - 1], symbols[at]), worst)
            if at < len(order):
                order[at] = ranks.get((symbols[at], symbols[at + 1]), worst)
        return tuple(self.ids[s] for s in symbols)

    def _merge_long(self, symbols: list[str]) -> tuple[int, ...]:
        """As ``_merge``: the pair of the lowest rank first, the leftmost of those, from a heap over linked symbols."""
        ranks, count = self.ranks, len(symbols)
        after, before = list(range(1, count + 1)), list(range(-1, count - 1))
        waiting = [(ranks[pair], k, *pair) for k, pair in enumerate(zip(symbols, symbols[1:])) if pair in ranks]
        heapify(waiting)
        while waiting:
            _, at, left, right = heappop(waiting)
            end = after[at]
            # A pair one side of which has been joined meanwhile is out of date.
            if symbols[at] != left or end >= count or symbols[end] != right:
                continue
            symbols[at], symbols[end] = left + right, ""
            after[at] = end = after[end]
            if end < count:
                before[end] = at
            for first, second in ((before[at], at), (at, end)):
                if first >= 0 and second < count and (pair := (symbols[first], symbols[second])) in ranks:
                    heappush(waiting, (ranks[pair], first, *pair))
        return tuple(self.ids[s] for s in symbols if s)

    def _encode_word(self, word: str) -> tuple[int, ...]:
        letters = "".join([self.letters[b] for b in word.encode()])
        joinable, start = self.joinable, 0
        out: list[int] = []
        for k in range(1, len(letters)):
            if letters[k - 1 : k + 1] not in joinable:
                out.extend(self.fragments[letters[start:k], False])
                start = k
        out.extend(self.fragments[letters[start:], True])
        return tuple(out)

    def _encode_chunk(self, chunk: str) -> tuple[bytes, str]:
        """Ids and decoded text of what stands between white space."""
        if not chunk.isascii():
            chunk = unicodedata.normalize("NFC", chunk).replace("Σ", "σ")  # lower case regardless of the place
        ids = [i for word in self.word_pattern.findall(chunk.lower()) for i in self.words[word]]
        return array("I", ids).tobytes(), " ".join([self.tokens[i] for i in ids])

    def _plain(self, text: str) -> list[tuple[bytes, str]]:
        chunks = self.white.split(text) if self.separators.search(text) else text.split()
        return [self.chunks[chunk] for chunk in chunks if chunk]

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids of a whole text as little-endian unsigned 32-bit integers, and what they decode to."""
        if "<|" not in text:
            parts = self._plain(text)
        else:
            parts, at = [], 0
            for found in self.marks.finditer(text):
                parts += self._plain(text[at : found.start()])
                parts.append((array("I", [self.special[found[0]]]).tobytes(), found[0]))
                at = found.end()
            parts += self._plain(text[at:])
        return b"".join([ids for ids, _ in parts]), " ".join([decoded for ids, decoded in parts if ids])

    def decode(self, ids: bytes) -> str:
        return " ".join([self.tokens[i] for i in array("I", ids)])


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit), decoded: one row for each row, whole texts.

    A null or empty text has no ids and decodes to an empty text. A word of any length takes time in proportion to it, but for
    a logarithm. Marks of special tokens in a text become those
    tokens. Other columns are not read; an empty table gives an empty result.
    """

    def start():
        encoder = WordEncoder(tokenizer)

        def apply(columns):
            both = [encoder.encode(text or "") for text in columns["text"]]
            return {"doc_id": columns["doc_id"], "ids": [b[0] for b in both], "decoded": [b[1] for b in both]}

        return apply

    return map_columns(docs.select("doc_id", "text"), "doc_id long, ids binary, decoded string", start)


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, decoded: the text of the ids in ``ids``; null counts as none."""

    def start():
        encoder = WordEncoder(tokenizer)
        return lambda columns: {
            "doc_id": columns["doc_id"],
            "decoded": [encoder.decode(ids or b"") for ids in columns["ids"]],
        }

    return map_columns(encoded.select("doc_id", "ids"), "doc_id long, decoded string", start)
