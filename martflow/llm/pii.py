"""Personal data: fixed patterns, and a linear-chain conditional random field that adds what they miss.

The patterns give the base spans, exactly. Around every digit, and every at or dot that may stand for a sign, the words
form a sequence, whose shapes the random field labels; it is trained on a small labelled table of contacts in other
spellings, and decoded by Viterbi for many sequences at once. What it finds is kept only where it does not touch a base span and an
exact check of its kind holds.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import map_columns
from martflow.llm.pii_table import LABELLED

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{place}-{kind}" for kind in KINDS for place in "BI"))
# Words of context on either side of a word with a digit or an at-sign.
CONTEXT = 4
# Cells of one batch of sequences: sequences times words.
CELLS = 200_000
EPOCHS = 12

# The base patterns. Where a pattern can fail, the run of letters or digits it failed in is passed over
# as a whole, which finds the same spans in linear time.
IP = re.compile(r"[0-9]++(?:(\.[0-9]++)(\.[0-9]++)(\.[0-9]+))?")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
EMAIL_TAIL = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
EMAIL_HEAD = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")

WORD = re.compile(r"\S+")
# Every spelling that the checks below accept has a digit or one of these.
TRIGGER = re.compile(r"[0-9@]|[(\[]at[)\]]|\bdot\b|(?<=\s)at(?=\s+[\w-]+\s*\.\s*[\w-])", re.I)
# Checks of what the random field adds.
SPOKEN_EMAIL = re.compile(
    r"[\w.+-]+\s*(?:@|\(at\)|\[at\]|\sat\s)\s*[\w-]+(?:\s*(?:\.|\(dot\)|\[dot\]|\sdot\s)\s*[\w-]+)+", re.I | re.A
)
BROKEN_IP = re.compile(r"[0-9]{1,3}(?:\s*(?:\[\.\]|\(\.\)|\.|\[dot\]|\(dot\))\s*[0-9]{1,3}){3}", re.I)
SPACED_CARD = re.compile(r"[0-9]{4}(?:[\s./_-]{1,3}[0-9]{3,6}){2,4}")
LOCAL_PHONE = re.compile(r"\(?0?[0-9]{2,4}\)?[\s./-]{1,2}[0-9]{3,4}[\s./-]{1,2}[0-9]{3,5}")


def luhn(digits: str) -> bool:
    total = 0
    for k, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + k % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str):
    """Leftmost matches: each at-sign with the letters before it, back to the end of the match before."""
    end, at = 0, text.find("@")
    while at >= 0:
        tail = EMAIL_TAIL.match(text, at) if at >= end else None
        if tail:
            start = at
            while start > end and text[start - 1] in EMAIL_HEAD:
                start -= 1
            if start < at:
                end = tail.end()
                yield start, end
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, by start and then kind as listed, in code points."""
    spans = [(start, end, "email") for start, end in _emails(text)] if "@" in text else []
    for found in CARD.finditer(text):
        digits = _digits(found[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            spans.append((*found.span(), "card"))
    if "." in text:
        for found in IP.finditer(text):
            if found[1] and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found[0].split(".")):
                spans.append((*found.span(), "ip"))
    if "+" in text:
        for found in PHONE.finditer(text):
            if 9 <= len(_digits(found[0])) <= 15:
                spans.append((*found.span(), "phone"))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def shape(word: str) -> str:
    """Letters by case and digits as a run each, with the number of digits; other signs as they are."""
    word = word[:40]
    folded = re.sub(r"[^\W\d_]+", lambda m: "A" if m[0].isupper() else "a", word)
    return re.sub(r"[0-9]+", lambda m: f"9{{{len(m[0])}}}", folded)


def features(words: list[str]) -> list[list[str]]:
    """Names of what holds at each word: shapes and cue words of it and its neighbours."""
    shapes = [shape(w.rstrip(".,;:!?")) for w in words]
    coarse = [re.sub(r"\{[0-9]+\}", "", s) for s in shapes]
    cues = [re.sub(r"[^a-z]", "", w.lower()[:20]) if len(w) <= 20 else "" for w in words]
    edge = "^"
    out = []
    for k, word in enumerate(words):
        names = ["always", f"s={shapes[k]}", f"c={coarse[k]}", f"cue={cues[k]}", f"end={word[-1]}"]
        for step in (-2, -1, 1, 2):
            near = 0 <= k + step < len(words)
            names.append(f"s{step}={shapes[k + step] if near else edge}")
            names.append(f"c{step}={coarse[k + step] if near else edge}")
            names.append(f"cue{step}={cues[k + step] if near else edge}")
        if any("0" <= c <= "9" for c in word):
            names.append(f"digits={min(sum('0' <= c <= '9' for c in word), 20)}")
        out.append(names)
    return out


def labelled_rows() -> list[tuple[list[str], list[int]]]:
    """Words and labels of the table, each row also with other digits, so that none is learnt by heart."""
    random = np.random.default_rng(11)
    rows = []
    for marked in LABELLED:
        for copy in range(4):
            words, labels = [], []
            for part in re.split(r"(<\w+>.*?</\w+>)", marked):
                inside = re.fullmatch(r"<(\w+)>(.*)</\w+>", part)
                for k, word in enumerate(WORD.findall(inside[2] if inside else part)):
                    if copy:
                        word = re.sub(r"[0-9]", lambda m: str(random.integers(0, 10)), word)
                    words.append(word)
                    labels.append(LABELS.index(f"{'I' if k else 'B'}-{inside[1]}") if inside else 0)
            rows.append((words, labels))
    return rows


class ChainModel:
    """Scores of features and of label transitions."""

    def __init__(self, names: dict[str, int], emission: np.ndarray, transition: np.ndarray, first: np.ndarray):
        self.names, self.emission, self.transition, self.first = names, emission, transition, first

    def indices(self, words: list[str]) -> list[list[int]]:
        return [[self.names[n] for n in names if n in self.names] for names in features(words)]

    def scores(self, words: list[str]) -> np.ndarray:
        return np.stack([self.emission[found].sum(axis=0) for found in self.indices(words)])

    def decode(self, sequences: list[list[str]]) -> list[np.ndarray]:
        """The likeliest labels of each sequence, by Viterbi over batches of sequences of similar length."""
        order = sorted(range(len(sequences)), key=lambda k: len(sequences[k]))
        out: list = [None] * len(sequences)
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and len(sequences[order[end]]) * (end + 1 - at) <= CELLS:
                end += 1
            batch = order[at:end]
            for k, labels in zip(batch, self._viterbi([self.scores(sequences[k]) for k in batch])):
                out[k] = labels
            at = end
        return out

    def _viterbi(self, scores: list[np.ndarray]) -> list[np.ndarray]:
        lengths = np.array([len(s) for s in scores])
        longest = int(lengths.max())
        padded = np.zeros((len(scores), longest, len(LABELS)))
        for row, s in zip(padded, scores):
            row[: len(s)] = s
        best = self.first + padded[:, 0]
        back = np.zeros((len(scores), longest, len(LABELS)), np.int8)
        for t in range(1, longest):
            through = best[:, :, None] + self.transition
            back[:, t] = through.argmax(axis=1)
            # A sequence that has ended keeps its scores.
            going = (lengths > t)[:, None]
            best = np.where(going, through.max(axis=1) + padded[:, t], best)
        labels = np.zeros((len(scores), longest), np.int64)
        rows = np.arange(len(scores))
        current = best.argmax(axis=1)
        for t in range(longest - 1, -1, -1):
            ends_here = lengths - 1 == t
            current = np.where(ends_here, best.argmax(axis=1), current)
            labels[:, t] = current
            if t:
                current = np.where(lengths > t, back[rows, t, current], current)
        return [row[:n] for row, n in zip(labels, lengths)]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    most = x.max(axis=axis, keepdims=True)
    return (most + np.log(np.exp(x - most).sum(axis=axis, keepdims=True))).squeeze(axis)


@lru_cache
def train() -> ChainModel:
    """Gradient ascent on the conditional likelihood of the labelled table, one row at a time."""
    rows = labelled_rows()
    names: dict[str, int] = {}
    for words, _ in rows:
        for found in features(words):
            for name in found:
                names.setdefault(name, len(names))
    n = len(LABELS)
    model = ChainModel(names, np.zeros((len(names), n)), np.zeros((n, n)), np.zeros(n))
    indexed = [(model.indices(words), np.array(labels)) for words, labels in rows]
    random = np.random.default_rng(3)
    for epoch in range(EPOCHS):
        rate = 0.3 / (1 + epoch / 4)
        for k in random.permutation(len(indexed)):
            found, labels = indexed[k]
            scores = np.stack([model.emission[f].sum(axis=0) for f in found])
            length = len(scores)
            ahead, behind = np.zeros((length, n)), np.zeros((length, n))
            ahead[0] = model.first + scores[0]
            for t in range(1, length):
                ahead[t] = _log_sum(ahead[t - 1][:, None] + model.transition, 0) + scores[t]
            for t in range(length - 2, -1, -1):
                behind[t] = _log_sum(model.transition + (scores[t + 1] + behind[t + 1])[None, :], 1)
            total = _log_sum(ahead[-1], 0)
            slope = -np.exp(ahead + behind - total)
            slope[np.arange(length), labels] += 1
            for t, f in enumerate(found):
                model.emission[f] += rate * slope[t]
            model.first += rate * slope[0]
            for t in range(1, length):
                joint = ahead[t - 1][:, None] + model.transition + (scores[t] + behind[t])[None, :]
                step = -np.exp(joint - total)
                step[labels[t - 1], labels[t]] += 1
                model.transition += rate * step / length
        model.emission *= 1 - 1e-3
    return model


def windows(text: str) -> list[list[tuple[int, int]]]:
    """Sequences of word spans: every word with a digit or a sign of an address, and its context."""
    if not TRIGGER.search(text):
        return []
    words = [found.span() for found in WORD.finditer(text)]
    starts = np.array([w[0] for w in words])
    hits = np.array([found.start() for found in TRIGGER.finditer(text)])
    marked = np.unique(np.searchsorted(starts, hits, side="right") - 1)
    # Words further apart than both contexts begin a new sequence.
    breaks = np.flatnonzero(np.diff(marked) > 2 * CONTEXT) + 1
    return [
        words[max(0, group[0] - CONTEXT) : group[-1] + CONTEXT + 1] for group in np.split(marked, breaks)
    ]


def _holds(kind: str, found: str) -> bool:
    digits = _digits(found)
    if kind == "email":
        return SPOKEN_EMAIL.fullmatch(found) is not None
    if kind == "ip":
        return BROKEN_IP.fullmatch(found) is not None and all(int(p) <= 255 for p in re.findall(r"[0-9]+", found))
    if kind == "card":
        return SPACED_CARD.fullmatch(found) is not None and 12 <= len(digits) <= 19 and luhn(digits)
    return LOCAL_PHONE.fullmatch(found) is not None and 9 <= len(digits) <= 15


def added_spans(texts: list[str], bases: list[list[tuple[int, int, str]]], model: ChainModel):
    """For every text the spans that the random field adds to the base ones."""
    sequences, owners = [], []
    for number, text in enumerate(texts):
        for spans in windows(text):
            sequences.append(spans)
            owners.append(number)
    out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    decoded = model.decode([[texts[o][s:e] for s, e in spans] for o, spans in zip(owners, sequences)])
    for owner, spans, labels in zip(owners, sequences, decoded):
        k = 0
        while k < len(labels):
            if not labels[k]:
                k += 1
                continue
            kind = LABELS[labels[k]][2:]
            last = k
            while last + 1 < len(labels) and LABELS[labels[last + 1]] == f"I-{kind}":
                last += 1
            text, start, end = texts[owner], spans[k][0], spans[last][1]
            while end > start and text[end - 1] in ".,;:!?)]}\"'" and not _holds(kind, text[start:end]):
                end -= 1
            while start < end and text[start] in "\"'[{<" and not _holds(kind, text[start:end]):
                start += 1
            free = all(end <= b[0] or start >= b[1] for b in bases[owner])
            if free and _holds(kind, text[start:end]):
                out[owner].append((start, end, kind))
            k = last + 1
    return out


def spans(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, base and spans of every row: arrays of (start, end, kind) in code points of the whole text.

    ``base`` holds what the fixed patterns give, ``spans`` that and what the random field adds, both by start and then
    by kind. A null or empty text has none. Only ``key`` and ``text`` are read.
    """
    model = train()
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.names, model.emission, model.transition, model.first)
    )

    def start():
        fitted = ChainModel(*shared.value)

        def apply(columns):
            texts = [text or "" for text in columns["text"]]
            bases = [base_spans(text) for text in texts]
            more = added_spans(texts, bases, fitted)
            both = [sorted(b + m, key=lambda s: (s[0], KINDS.index(s[2]))) for b, m in zip(bases, more)]
            as_rows = [[[{"start": s, "end": e, "kind": k} for s, e, k in row] for row in rows] for rows in (bases, both)]
            return {"key": columns["key"], "base": as_rows[0], "spans": as_rows[1]}

        return apply

    span = "array<struct<start:int,end:int,kind:string>>"
    return map_columns(docs.select(F.col(key).alias("key"), "text"), f"key long, base {span}, spans {span}", start)


def redact(text: str, found: list[tuple[int, int, str]]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans by that of the first."""
    parts, at = [], 0
    for start, end, kind in found:
        if start >= at:
            parts += text[at:start], f"[{kind.upper()}]"
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redacted(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """``docs`` with personal data replaced in its texts and their length brought up to date; null stays null."""
    model = train()
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.names, model.emission, model.transition, model.first)
    )
    place, size = docs.columns.index(text), docs.columns.index(length)

    def run(batches):
        import pyarrow as pa

        fitted = ChainModel(*shared.value)
        for batch in batches:
            given = batch.column(place).to_pylist()
            texts = [t or "" for t in given]
            bases = [base_spans(t) for t in texts]
            out = []
            for old, base, more in zip(given, bases, added_spans(texts, bases, fitted)):
                found = sorted(base + more, key=lambda s: (s[0], KINDS.index(s[2])))
                out.append(redact(old, found) if found else old)
            lengths = [old_n if new is None else len(new) for new, old_n in zip(out, batch.column(size).to_pylist())]
            columns = list(batch.columns)
            columns[place] = pa.array(out, batch.schema.field(place).type)
            columns[size] = pa.array(lengths, batch.schema.field(size).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
