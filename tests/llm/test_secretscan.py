"""Secret scans: base spans against a plain reading of the contract, formats by held-out accuracy."""

from __future__ import annotations

import hashlib
import math
import random
import re

import pytest

from adperf.llm import secretscan

LETTERS = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")


def runs(text, allowed):
    at = 0
    while at < len(text):
        end = at
        while end < len(text) and text[end] in allowed:
            end += 1
        if end > at:
            yield at, end
        at = max(end, at + 1)


def assignments(text):
    """Without regular expressions: keyword, quote, blanks, sign, blanks, quote, value."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    at = 0
    while at < len(text):
        word = next((w for w in ("password", "passwd", "secret", "token", "api_key", "apikey") if low.startswith(w, at)), None)
        if word is None:
            at += 1
            continue
        i = at + len(word)
        i += text[i : i + 1] in ("'", '"') and text[i : i + 1] != ""
        while text[i : i + 1] == " ":
            i += 1
        if text[i : i + 1] not in (":", "="):
            at += 1
            continue
        i += 1
        while text[i : i + 1] == " ":
            i += 1
        i += text[i : i + 1] in ("'", '"') and text[i : i + 1] != ""
        end = i
        while end < len(text) and text[end] in LETTERS:
            end += 1
        if end == i:
            at += 1
            continue
        if end - i >= 6:
            yield at, end
        at = end


def brute(text):
    text = text or ""
    out = [(a, 0, "assign", e) for a, e in assignments(text)]
    at = text.find("AKIA")
    while at >= 0:
        end = at + 4
        while end < len(text) and (text[end].isascii() and (text[end].isupper() or text[end].isdigit())):
            end += 1
        if end - at >= 20:
            out.append((at, 1, "access", end))
        at = text.find("AKIA", end if end > at + 4 else at + 1)
    out += [(a, 2, "hex", e) for a, e in runs(text, set("0123456789abcdef")) if e - a >= 24]
    spans = [(k, a, e) for a, _, k, e in sorted(out)]
    joined = ",".join(f"{k}:{a}:{e}" for k, a, e in spans)
    return (*(sum(k == kind for k, _, _ in spans) for kind in ("assign", "access", "hex")),
            hashlib.sha256(joined.encode()).hexdigest(), joined)


def got(spark, rows, schema="doc_id long, text string"):
    return secretscan.digests(secretscan.scan(spark.createDataFrame(rows, schema).repartition(3))).collect()


def test_documents_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = {r.doc_id: r for r in secretscan.digests(secretscan.scan(docs)).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(found) == len(texts)
    assert sum(r.n_assign for r in found.values()) > 10
    for doc_id, text in texts.items():
        assert tuple(found[doc_id][1:5]) == brute(text)[:4]
        assert set(brute(text)[4].split(",")) <= set(found[doc_id].spans.split(","))
    # card numbers, addresses and long words of the corpus are no secrets
    assert not [r for r in found.values() if "format" in r.spans]


EDGES = [
    "", None, "token=abc", "token=abcdef", 'API_KEY": "a.b/c+d=e"', "apikey'  =  'xxxxxx", "api-key=abcdefgh",
    "ſecret=abcdefgh toKen=abcdefgh", "password password:hunter2x", "token== =abcdefgh", "secret:\n abcdefgh",
    "token = token=abcdefg", "passwd:secret=abcdefgh", "é𝒳token:abcdef AKIA" + "B7" * 8, "AKIA" + "b" * 30,
    "AKIAAKIA" + "0" * 12 + "AKIA", "xAKIA" + "Z" * 15, "a" * 23 + " " + "b" * 24, "0123456789abcdef" * 2 + "G" + "f" * 24,
    "token = " + "9f" * 20, "TOKEN:" + "9F" * 20, "deadbeef" * 50_000, "word " * 100_000 + "secret=zzzzzz",
]


def test_edges_equal_brute_force(spark):
    rows = list(enumerate(EDGES)) + [(3, EDGES[3]), (None, "token=abcdef"), (None, "token=abcdef")]
    want = sorted(((i, *brute(t)) for i, t in rows), key=str)
    assert sorted((tuple(r) for r in got(spark, rows)), key=str) == want


def test_empty_table_and_clashing_columns(spark):
    assert got(spark, []) == []
    wide = got(spark, [(1, "token=abcdef", 1, "x", 2, 3)], "doc_id long, text string, found int, pairs string, kind int, spans int")
    assert [tuple(r) for r in wide] == [(1, *brute("token=abcdef"))]


def hexes(rng, n, length=40):
    return ["".join(rng.choice("0123456789abcdef") for _ in range(length)) for _ in range(n)]


def keys(rng, n):
    return ["AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16)) for _ in range(n)]


def test_formats_of_held_out_credentials(spark):
    """Credentials that no base pattern shows are found by their format; ordinary runs are not."""
    rng = random.Random(5)
    syllables = ["lich", "ung", "ver", "ing", "tion", "ment", "ach", "der", "es", "an", "re", "de", "be", "fa", "ce"]
    word = lambda k: "".join(rng.choice(syllables) for _ in range(k))
    ordinary = [word(7) for _ in range(150)] + ["".join(rng.choice("0123456789") for _ in range(16)) for _ in range(150)]
    ordinary += [f"mail{rng.randrange(9)}.example.com/{word(2)}" for _ in range(150)] + [f"{word(2)}-{word(3)}_{word(2)}" for _ in range(150)]
    prose = lambda: " ".join(word(rng.randrange(1, 4)) for _ in range(60))
    mixed = ["".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(32)) for _ in range(300)]
    rows = [(i, f"{prose()} token = \"{v}\" {prose()}") for i, v in enumerate(mixed[:200])]
    rows += [(1000 + i, f"{prose()} {v} {prose()}") for i, v in enumerate(keys(rng, 100))]
    rows += [(2000 + i, f"{prose()} {v} {prose()}") for i, v in enumerate(mixed[200:])]  # held out, without a keyword
    rows += [(3000 + i, f"{prose()} {v} {prose()}") for i, v in enumerate(ordinary)]
    found = {r.doc_id: r.spans for r in got(spark, rows)}
    hits = [i for i in range(2000, 2100) if "format" in found[i]]
    assert len(hits) >= 95
    for i in hits:
        (start, end), = [m.span() for m in re.finditer(r"\S{32}", dict(rows)[i]) if m[0] in mixed]
        assert f"format:{start}:{end}" in found[i]
    assert not [i for i in found if i >= 3000 and found[i]]


def test_states_are_merged_by_their_futures():
    rng = random.Random(2)
    automaton = secretscan.infer(keys(rng, 1000))
    assert 5 <= len(automaton.steps) < 25  # the fixed beginning, then one loop or a few
    state = 0
    for c in "AKIA":
        assert set(automaton.steps[state]) == {c}
        state = automaton.steps[state][c][0]
    loop = secretscan.infer(hexes(rng, 500))
    assert len(loop.steps) < 5
    good, bad = hexes(rng, 1)[0], "z" * 40
    assert loop.log_likelihood(good) > loop.log_likelihood(bad) + 50
    # an empty word and everything else of length 1 sum to no more than 1
    total = math.exp(loop.log_likelihood("")) + sum(math.exp(loop.log_likelihood(c)) for c in secretscan.CHARACTERS)
    assert total <= 1.0001


@pytest.mark.parametrize("alpha", [1e-6, 0.05, 0.9])
def test_merging_keeps_a_small_regular_language(alpha):
    rng = random.Random(7)
    words = ["ab" * rng.randrange(1, 6) for _ in range(2000)]
    automaton = secretscan.infer(words, alpha)
    assert automaton.log_likelihood("abab") > automaton.log_likelihood("aabb") + 5
