"""The secret scan against a scan character by character, on declarations of several languages, and on long lines."""

from __future__ import annotations

import random
import string
import time
from pathlib import Path

import pytest

from delaylake.llm.secret_scan import assignments, base_spans, secret_spans

NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")
VALUE = set(string.ascii_letters + string.digits + "+/_.=-")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def run_of(text, at, allowed):
    end = at
    while end < len(text) and text[end] in allowed:
        end += 1
    return end


def plain_assign(text):
    """The first pattern by hand: name, quote, spaces, sign, spaces, quote, value."""
    found, at, low = [], 0, lower(text)
    while at < len(text):
        end = None
        for name in NAMES:
            if not low.startswith(name, at):
                continue
            i = at + len(name)
            i += text[i : i + 1] in ("'", '"')
            i = run_of(text, i, " ")
            if text[i : i + 1] not in (":", "="):
                continue
            i = run_of(text, i + 1, " ")
            quoted = i + (text[i : i + 1] in ("'", '"'))
            if (stop := run_of(text, quoted, VALUE)) > quoted:
                end = stop
                if stop - quoted >= 6:
                    found.append(("assign", at, stop))
                break
        at = end or at + 1
    return found


def plain_runs(text, kind, prefix, allowed, least):
    found, at = [], 0
    while at < len(text):
        if text.startswith(prefix, at) and (stop := run_of(text, at + len(prefix), allowed)) > at + len(prefix):
            if stop - at >= least:
                found.append((kind, at, stop))
            at = stop
        else:
            at += 1
    return found


def plain(text):
    return (
        plain_assign(text)
        + plain_runs(text, "access", "AKIA", set(string.ascii_uppercase + string.digits), 20)
        + plain_runs(text, "hex", "", set("0123456789abcdef"), 24)
    )


def random_text(rng):
    stock = [*NAMES, "Password", "TOKEN", "apiKey", "AKIA", "AKI", "'", '"', " ", "  ", ":", "=", "==", "\n", "\t", "é", "ſecret"]
    stock += ["abc", "f00dcafe" * 3, "deadbeef", "A1B2C3D4E5F6G7H8", "x+/_.=-y", "K", "K"]
    return "".join(rng.choice(stock) for _ in range(rng.randrange(40)))


def test_base_spans_equal_a_scan_by_character():
    rng = random.Random(8)
    for _ in range(4000):
        text = random_text(rng)
        assert sorted(base_spans(text)) == sorted(plain(text)), repr(text)
        assert set(base_spans(text)) <= set(secret_spans(text))


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="test tables not present")
def test_base_spans_of_all_documents(spark):
    from delaylake.llm.secret_scan import op3_secret_scans

    texts = dict(map(tuple, spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()))
    for row in op3_secret_scans(spark, "/root/testdata/sf0.001").collect():
        found = plain(texts[row.doc_id] or "")
        counts = [sum(k == kind for k, _, _ in found) for kind in ("assign", "access", "hex")]
        assert [row.n_assign, row.n_access, row.n_hex] == counts


SECRET = "Zx81kPq99Lm"


@pytest.mark.parametrize(
    "line",
    [
        f'db_pwd: str = "{SECRET}"',
        f'const dbPassphrase: string = "{SECRET}";',
        f'let dbPwd: Option<String> = "{SECRET}";',
        f'String dbPwd = "{SECRET}";',
        f"db_pwd := `{SECRET}`",
        f'"db.pwd": "{SECRET}",',
        f"db-pwd: {SECRET}",
        f"'dbPwd' => '{SECRET}',",
    ],
)
def test_declarations_of_several_languages(line):
    start = line.index(SECRET)
    assert ("literal", start, start + len(SECRET)) in secret_spans(line)
    assert sum(k == "literal" for k, _, _ in secret_spans(line)) == 1


def test_constants_stand_for_their_literals():
    text = 'part = "Zx81"\nother = part\ndb_pwd = other + "kPq99Lm"\n'
    found = [text[a:b] for k, a, b in secret_spans(text) if k == "literal"]
    assert found == ["Zx81", "kPq99Lm"]


@pytest.mark.parametrize(
    "text",
    [
        "a" * 1_000_000 + "\nx=1",
        "ab " * 300_000 + "x=1",
        "a:b=c " * 100_000,
        "a='" * 100_000,
        "a" + " " * 1_000_000 + "=1",
        "x = x + x\n" * 50_000,
        "x = x + 'y'\n" * 20_000,
    ],
    ids=["word", "line", "names", "quotes", "spaces", "doubling", "growing"],
)
def test_long_texts_take_linear_time(text):
    begun = time.perf_counter()
    secret_spans(text)
    half = time.perf_counter() - begun
    begun = time.perf_counter()
    secret_spans(text + "\n" + text)
    assert time.perf_counter() - begun < 5 * half + 2
    assert half < 20


def test_assignments_keep_their_order():
    assert [(n, c.value) for n, c in assignments("a = 1\n\nb: 2\nnothing here\nc = a")] == [("a", "1"), ("b", "2"), ("c", "1")]
