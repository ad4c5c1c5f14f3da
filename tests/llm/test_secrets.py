"""Secret scans: base spans against plain patterns, planted assignments, and texts without secrets."""

import hashlib
import re
import time

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from martflow.llm import secret_scan
from martflow.llm.queries import QUERIES
from martflow.llm.secret_scan import added_spans, base_spans

SMALL = "/root/testdata/sf0.01"

PLAIN = (
    ("assign", r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", lambda m: len(m[2]) >= 6),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
)


def plain(text):
    spans = []
    for place, (kind, pattern, holds) in enumerate(PLAIN):
        spans += [(m.start(), place, m.end(), kind) for m in re.finditer(pattern, text) if holds(m)]
    return [(start, end, kind) for start, _, end, kind in sorted(spans)]


PIECES = st.sampled_from(
    ["password", "PassWD", "secret", "api_key", "apiKey", "tok\u017fen", "TO\u212aEN", "token", '"', "'", " ", "=", ":", "\n", "\\",
     "abc", "AKIA", "ABCDEFGH0123456789", "0123456789abcdef", "é", "+", "-", ".", "(", ")", "<", ">", "name", "value", ",", "--"]
)


@settings(max_examples=400, deadline=None)
@given(st.lists(PIECES, max_size=30).map("".join))
def test_base_spans_equal_plain_patterns_and_stay(text):
    base = base_spans(text)
    assert base == plain(text)
    for start, end, _ in added_spans(text, base):
        assert 0 <= start < end <= len(text) and all(b[1] <= start or b[0] >= end for b in base)


@pytest.mark.parametrize(
    "text, secrets",
    [
        ('DB_PASSWORD_PROD="s3cr3tV4lue9"', ["s3cr3tV4lue9"]),
        ("db_pwd: k9#Lm2$Qx8", ["k9#Lm2$Qx8"]),
        ('export DB_PWD=Zx81kQ00pLmn', ["Zx81kQ00pLmn"]),
        ('String dbPassword2 = "Zx81kQ00pLmn";', ["Zx81kQ00pLmn"]),
        ("$config['passphrase'] = 'Zx81kQ00pLmn';", ["Zx81kQ00pLmn"]),
        ('"private_key" => "Zx81kQ00pLmn"', ["Zx81kQ00pLmn"]),
        ('client.setAccessKey("Zx81kQ00pLmn")', ["Zx81kQ00pLmn"]),
        ('request.header("Authorization", "Basic Zx81kQ00pLmn")', ["Basic Zx81kQ00pLmn"]),
        ("login --access-key Zx81kQ00pLmn --user me", ["Zx81kQ00pLmn"]),
        ("<dbPassword>Zx81kQ00pLmn</dbPassword>", ["Zx81kQ00pLmn"]),
        ("postgres://app:Zx81kQ00pLmn@db.local/main", ["Zx81kQ00pLmn"]),
        ('- name: SIGNING_KEY\n  value: "Zx81kQ00pLmn"', ["Zx81kQ00pLmn"]),
        ('first = "Zx81"\nsecond = first + "kQ00pLmn"\ncredentials = second', ["Zx81", "kQ00pLmn"]),
        ('part = "Zx81kQ00"\npassphrase = b64decode(part) + "pLmn7"', ["Zx81kQ00", "pLmn7"]),
        ('passphrase = os.getenv("PASSPHRASE_NAME_1", "Zx81kQ00pLmn")', ["Zx81kQ00pLmn"]),
        ('credential: str = "Zx81kQ00" "pLmn7"', ["Zx81kQ00", "pLmn7"]),
        ('pwd = "Zx81"\npwd += "kQ00pLmn"', ["Zx81", "kQ00pLmn"]),
    ],
)
def test_added(text, secrets):
    base = base_spans(text)
    assert [text[a:b] for a, b, _ in added_spans(text, base)] == secrets


@pytest.mark.parametrize(
    "text",
    [
        "The key: it was 12 o'clock, and the author's passage was long.",
        'password_file = "/etc/app/config2.yaml"',
        'token_count = "123456789012"',
        'pwd = os.getenv("DB_PWD_2024_NAME")',
        'passphrase = "change_me"',
        "credentials: ${DB_CREDENTIALS_1}",
        'keyboard = "qwertyuiop1234"',
        'if passphrase == "Zx81kQ00pLmn":',
        "sort_key = lastModifiedDescending",
        'private_key_path: "keys/prod2024/id"',
        "passing: grade 1a2b3c4d5e6f7g8h",
    ],
)
def test_not_added(text):
    assert added_spans(text, base_spans(text)) == []


def test_long_texts_take_linear_time():
    for piece in ('\\"', '"', "password ", "a=", "pwd+", 'x="a"+', "set(", "--key ", "str(", "<a>b</", "AKIA", "x://y:"):
        began = time.time()
        text = "token " + piece * (200_000 // len(piece))
        assert base_spans(text) == plain(text)
        added_spans(text, [])
        assert time.time() - began < 5, piece


def test_query_over_the_whole_table(spark):
    documents = dict(duckdb.sql(f"select doc_id, text from '{SMALL}/documents.parquet'").fetchall())
    found = QUERIES["op12_assignment_lexing"](spark, SMALL).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(documents)
    for r in found:
        base = plain(documents[r["doc_id"]] or "")
        told = [f"{kind}:{start}:{end}" for start, end, kind in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(told).encode()).hexdigest()
        assert [r[f"n_{kind}"] for kind in secret_scan.KINDS] == [sum(b[2] == kind for b in base) for kind in secret_scan.KINDS]
        assert set(told) <= set(r["spans"].split(",")) or not told
    assert sum(r["n_assign"] for r in found) > 0


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, None, "b", "s", "k"), (2, "", "b", "s", "k"), (3, 'pwd = "Zx81kQ00pLmn"', "b", "s", "k"), (None, "token=abcdef", "b", "s", "k")]
    docs = spark.createDataFrame(rows + rows[2:3], "doc_id long, text string, base string, spans string, key string")
    found = sorted((str(r["key"]), len(r["base"]), len(r["spans"])) for r in secret_scan.spans(docs).collect())
    assert found == [("1", 0, 0), ("2", 0, 0), ("3", 0, 1), ("3", 0, 1), ("None", 1, 1)]
    assert secret_scan.spans(docs.limit(0)).collect() == []
