"""Secrets: fixed patterns, and an assignment-aware reading of source and configuration text that adds what they miss.

The patterns give the base spans, exactly. A text that holds a word of a sensitive name is then cut into names, literals
and signs. Assignments, key-value pairs, named arguments, setters, flags, elements and addresses with a password give pairs of
a name and a value; values are literals, names bound to earlier ones, and sums of both. A value that reaches a sensitive
name is scored by the name and by how much a guess at it would take; if the product is high enough, the literals it was put
together from are added, wherever they stand.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass
from math import log2

from pyspark.sql import DataFrame

from martflow.llm.common import map_columns

KINDS = ("assign", "access", "hex")

# The base patterns. A run that is too short can't hold a long one, so lengths stand in the patterns.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
LEAST_ASSIGNED, LEAST_ACCESS = 6, 20

# Words of names. A strong word or pair names a secret by itself, a weak one needs a value that is hard to guess.
STRONG = {
    "password", "passwd", "passwort", "pwd", "passphrase", "passcode", "secret", "secrets", "token", "apikey",
    "credential", "credentials", "bearer", "privatekey", "secretkey", "accesskey", "authtoken", "accesstoken",
}
PAIRS = {
    (first, "key")
    for first in ("api", "access", "private", "secret", "auth", "encryption", "signing", "account", "master", "shared", "storage")
}
WEAK = {"auth", "authorization", "pass", "pw", "key", "salt", "signature"}
# A name that ends so tells of a secret, but does not hold it.
ABOUT = {
    "name", "id", "url", "uri", "path", "file", "filename", "dir", "length", "len", "count", "type", "field", "label", "hint",
    "policy", "expiry", "expires", "ttl", "limit", "max", "min", "size", "header", "param", "class", "prefix", "suffix", "format",
    "error", "message", "regex", "pattern", "index", "manager", "provider", "service", "age", "enabled", "required",
}
# Without one of these a text has no sensitive name and is not read further.
STEM = re.compile(
    r"pass|pw|secret|token|key|credential|bearer|auth|signature|salt|://", re.I | re.A
)
PLACEHOLDER = re.compile(
    r"(?:change.?me|example|your.*|my.*here|x{3,}|\*+|\.{3,}|none|null|nil|undefined|true|false|todo|redacted|string|str|"
    r"placeholder|dummy|<.*>|\$\{.*\}|\{\{.*\}\}|%\(.*\)s|\$[A-Z_a-z]\w*)",
    re.I | re.A,
)
# Calls that hand on the text of their arguments.
PASSING = {
    "str", "string", "bytes", "b64decode", "decode", "encode", "fromhex", "unhexlify", "strip", "trim", "concat", "join", "format",
    "frombase64", "buffer", "from", "of",
}
# Calls whose second argument is a default.
DEFAULTING = {"getenv", "get", "getordefault", "env"}
JOINING = {"+", "||", "??", ".", "or"}
OPENING = {"{", "[", "(", "<", ",", ";", ":", ")", "]", "}", ">"}
SETTERS = {"set", "with", "add", "put", "use", "setproperty", "header", "setheader", "addheader", "setenv", "define"}
LEAST_SCORE = 0.45
# Bits of a guess that count as full; what has no letter or no digit counts for less.
FULL_BITS = 80.0
UNMIXED = 0.8

TOKEN = re.compile(
    r"""
    (?P<string>(?<!\\)[fFrRbBuU]{0,2}"(?:[^"\\\n]|\\.)*"|(?<![A-Za-z0-9\\])'(?:[^'\\\n]|\\.)*'|`[^`\n]*`)
  | (?P<flag>(?<!\S)--?[A-Za-z][A-Za-z0-9]*(?:-[A-Za-z0-9]+)*)
  | (?P<name>[A-Za-z_$][A-Za-z0-9_$]*(?:[.-][A-Za-z_$][A-Za-z0-9_$]*)*)
  | (?P<number>[0-9][A-Za-z0-9_.]*)
  | (?P<sign>:=|=>|==|!=|<=|>=|\+=|\|\||\?\?|[=:+,;()\[\]{}<>/?.])
  | (?P<line>\n)
    """,
    re.X | re.A,
)
BARE = re.compile(r"[^\s\"'`,;(){}\[\]<>]+")
ELEMENT = re.compile(r"<([A-Za-z_][\w.:-]*)(?:\s[^<>]*)?>([^<>\s]+)</", re.A)
ADDRESS = re.compile(r"[A-Za-z][A-Za-z0-9+.-]{1,30}://[^\s:/@\"'<>]{0,200}:([^\s/@\"'<>]+)@")
PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, by start and then kind as listed, in code points."""
    spans = [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    spans += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    spans += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def name_score(name: str) -> float:
    """How surely a name holds a secret, from 0 to 1."""
    words = [w.lower() for w in PART.findall(name)]
    if not words or words[-1] in ABOUT:
        return 0.0
    if any(w in STRONG for w in words) or any(pair in PAIRS for pair in zip(words, words[1:])):
        return 1.0
    return 0.5 if words[-1] in WEAK else 0.0


@dataclass(eq=False)
class Value:
    """A constant: a literal with its place, or the sum of two others. What the score needs is kept, not the text."""

    length: int
    classes: int
    placeholder: bool
    span: tuple[int, int] | None = None
    parts: tuple = ()
    told: bool = False

    def score(self) -> float:
        """The bits that a guess at a text of this length and these kinds of signs takes, as a share of the full."""
        if self.length < LEAST_ASSIGNED or self.placeholder:
            return 0.0
        signs = sum(size for bit, size in ((1, 26), (2, 26), (4, 10), (8, 30)) if self.classes & bit)
        mixed = self.classes & 4 and self.classes & 3
        return min(1.0, self.length * log2(max(2, signs)) / FULL_BITS) * (1 if mixed else UNMIXED)


def literal(text: str, start: int, end: int) -> Value:
    body = text[start:end]
    classes = (
        bool(re.search("[a-z]", body)) | 2 * bool(re.search("[A-Z]", body))
        | 4 * bool(re.search("[0-9]", body)) | 8 * bool(re.search("[^A-Za-z0-9]", body))
    )
    # Several words are a sentence, not a secret.
    sentence = len(body.split()) > 2
    return Value(end - start, classes, sentence or PLACEHOLDER.fullmatch(body) is not None, (start, end))


def added(one: Value | None, other: Value | None) -> Value | None:
    if one is None or other is None:
        return one or other
    return Value(
        one.length + other.length, one.classes | other.classes, one.placeholder and other.placeholder, None, (one, other)
    )


class Reader:
    """Reads the pairs of one text from left to right. Each token is looked at a bounded number of times."""

    def __init__(self, text: str):
        self.text = text
        self.tokens = [(m.lastgroup, m.start(), m.end()) for m in TOKEN.finditer(text)]
        self.bound: dict[str, Value] = {}
        self.found: list[tuple[int, int]] = []
        # The last value of a field called name or key, whose partner field follows.
        self.field: str | None = None

    def said(self, k: int) -> str:
        return self.text[self.tokens[k][1] : self.tokens[k][2]] if k < len(self.tokens) else ""

    def kind(self, k: int) -> str:
        return self.tokens[k][0] if k < len(self.tokens) else ""

    def inside(self, k: int) -> tuple[int, int]:
        """The body of a string, without prefix and quotes."""
        start, end = self.tokens[k][1:]
        while self.text[start] not in "\"'`":
            start += 1
        return start + 1, end - 1

    def read(self) -> list[tuple[int, int]]:
        k = 0
        while k < len(self.tokens):
            kind = self.kind(k)
            if kind in ("name", "string"):
                k = self.pair(k)
            elif kind == "flag":
                k = self.option(k)
            else:
                k += 1
        for m in ELEMENT.finditer(self.text):
            self.offer(m[1], literal(self.text, *m.span(2)))
        for m in ADDRESS.finditer(self.text):
            self.offer("password", literal(self.text, *m.span(1)))
        return self.found

    def name_at(self, k: int) -> str:
        if self.kind(k) == "string":
            return self.text[slice(*self.inside(k))]
        return self.said(k)

    def pair(self, k: int) -> int:
        """A name and what is assigned to it. Returns the next token to look at, always a later one."""
        at = k + 1
        if self.kind(k) == "name" and self.said(at) == "(":
            return self.call(k)
        if self.said(at) == "]":
            at += 1
        if self.kind(k) == "name" and self.said(at) == ":" and self.kind(at + 1) == "name" and self.said(at + 2) == "=":
            at += 2  # a declared type
        sign = self.said(at)
        if sign not in ("=", ":=", "=>", ":", "+="):
            return k + 1
        name = self.name_at(k)
        if len(name) > 200:
            return k + 1
        value, after = self.value(at + 1, configured=sign in ("=", ":"))
        key = name.rpartition(".")[2]
        if sign == "+=":
            value = added(self.bound.get(key), value)
        if key.lower() in ("name", "key") and self.kind(at + 1) in ("name", "string"):
            self.field = self.name_at(at + 1)[:200]
        elif value is not None:
            if key.lower() == "value" and self.field:
                self.offer(self.field, value)
                self.field = None
            else:
                self.bound[key] = value
            self.offer(name, value)
        # A value that is itself a text of pairs is read on its own.
        if self.kind(k) == "string" and value is None:
            return k + 1
        return max(k + 1, after)

    def call(self, k: int) -> int:
        """Setters, with the name in their own or in the first argument."""
        words = [w.lower() for w in PART.findall(self.said(k).rpartition(".")[2])]
        if words and (words[0] in SETTERS or "".join(words) in SETTERS):
            name, at = "".join(w.title() for w in words[1:]), k + 2
            if self.kind(at) == "string" and self.said(at + 1) == ",":
                name, at = self.name_at(at), at + 2
            value, _ = self.value(at, configured=False)
            if value is not None:
                self.offer(name, value)
        return k + 2

    def option(self, k: int) -> int:
        """A flag of a command and its value."""
        at = k + 2 if self.said(k + 1) == "=" else k + 1
        if at < len(self.tokens) and name_score(self.said(k)) > 0:
            if self.kind(at) == "string":
                self.offer(self.said(k), literal(self.text, *self.inside(at)))
            elif self.kind(at) in ("name", "number") and "\n" not in self.text[self.tokens[k][2] : self.tokens[at][1]]:
                bare = BARE.match(self.text, self.tokens[at][1])
                self.offer(self.said(k), literal(self.text, *bare.span()))
        return k + 1

    def value(self, k: int, configured: bool) -> tuple[Value | None, int]:
        """A sum of literals, bound names and calls that hand on their arguments. Also the token after it."""
        total: Value | None = None
        start = k
        while True:
            kind, said = self.kind(k), self.said(k)
            word = said.rpartition(".")[2]
            called = kind == "name" and self.said(k + 1) == "("
            if configured and k == start and kind in ("name", "number", "sign", "flag"):
                if said not in OPENING and not called and word not in self.bound:
                    return self.bare(k)
            if kind == "string":
                total = added(total, literal(self.text, *self.inside(k)))
                k += 1
                if self.kind(k) == "string" and self.text[self.tokens[k - 1][2] : self.tokens[k][1]].isspace():
                    continue  # neighbouring literals are one
            elif called:
                if word.lower() in DEFAULTING and self.kind(k + 2) == "string" and self.said(k + 3) == ",":
                    k += 4  # past the name that is looked up
                elif word.lower() in PASSING:
                    k += 2
                else:
                    return total, k + 1
                continue
            elif kind in ("name", "number"):
                total = added(total, self.bound.get(word))
                k += 1
            else:
                return total, k
            while self.said(k) in (")", "]"):
                k += 1
            if self.said(k) not in JOINING:
                return total, k
            k += 1

    def bare(self, k: int) -> tuple[Value | None, int]:
        """A value without quotes, as configuration files have: no space inside, and more than a plain word."""
        found = BARE.match(self.text, self.tokens[k][1])
        if not found:
            return None, k + 1
        end = found.end()
        while end > found.start() and self.text[end - 1] in ".:!?":
            end -= 1
        after = k
        while after < len(self.tokens) and self.tokens[after][1] < found.end():
            after += 1
        body = self.text[found.start() : end]
        value = literal(self.text, found.start(), end)
        mixed = bool(value.classes & 4) and bool(value.classes & 3)
        return (value if mixed and "(" not in body else None), max(after, k + 1)

    def offer(self, name: str, value: Value) -> None:
        """Add the literals of a value if the name and the value score high enough. No literal is looked at twice."""
        if value.told or name_score(name) * value.score() < LEAST_SCORE:
            return
        waiting = [value]
        while waiting:
            one = waiting.pop()
            if one.told:
                continue
            one.told = True
            if one.span:
                self.found.append(one.span)
            waiting.extend(one.parts)


def added_spans(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Literals of sensitive names that touch no base span."""
    if not STEM.search(text):
        return []
    taken: list[tuple[int, int]] = []
    for start, end, _ in base:
        if taken and start <= taken[-1][1]:
            taken[-1] = (taken[-1][0], max(end, taken[-1][1]))
        else:
            taken.append((start, end))
    out: list[tuple[int, int, str]] = []
    for start, end in sorted(set(Reader(text).read())):
        before = bisect_left(taken, (end,)) - 1  # the last that starts before the end
        if (before < 0 or taken[before][1] <= start) and (not out or out[-1][1] <= start):
            out.append((start, end, "assign"))
    return out


def spans(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, base, spans of every row: lists of (start, end, kind) by start and kind; ``spans`` holds the base ones too.

    A null text counts as empty and has no spans, like an empty one. Every text is read whole, in time linear in its length.
    Rows that repeat a key are scanned each. An empty table gives an empty result. Only ``key`` and text are read.
    """

    def start():
        def apply(columns):
            out: dict[str, list] = {"key": columns["key"], "base": [], "spans": []}
            for text in columns["text"]:
                base = base_spans(text or "")
                whole = base + (added_spans(text, base) if text else [])
                whole.sort(key=lambda s: (s[0], KINDS.index(s[2])))
                for name, found in (("base", base), ("spans", whole)):
                    out[name].append([{"start": a, "end": b, "kind": kind} for a, b, kind in found])
            return out

        return apply

    listed = "array<struct<start:long,end:long,kind:string>>"
    rows = docs.selectExpr(f"`{key}` as key", "text")
    key_type = rows.schema["key"].dataType.simpleString()
    return map_columns(rows, f"key {key_type}, base {listed}, spans {listed}", start)
