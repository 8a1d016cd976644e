"""Quality rules against loops over words and characters."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from adperf.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def brute(docs):
    """(id, counts..., base_failed, kept) of each (id, text, lang)."""
    def chars(t):
        out = [0] * 7
        for c in t:
            kind = (
                0 if c.islower() and c not in "ªº" else 1 if c in " \t\n\x0b\x0c\r" else 2 if c.isupper()
                else 3 if c.isdecimal() else 4 if c in ".,;:!?'\"()-" else 5 if c in "#*$%&|<>" else 6)
            out[kind] += 1
        return out

    def common(t, lang):
        listed = quality.COMMON_WORDS.get(lang)
        words = [w.lower() for w in WORD.findall(t)]
        if listed is None:
            return None
        count = Counter(words)
        return [count[w] for w in listed] + [len(words) - sum(count[w] for w in listed)]

    def js(p, q):
        if not p or not q or not sum(p) or not sum(q):
            return None
        p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
        m = [(a + b) / 2 for a, b in zip(p, q, strict=True)]
        return math.sqrt(max(0, sum(
            (a * math.log2(a / c) if a else 0) / 2 + (b * math.log2(b / c) if b else 0) / 2
            for a, b, c in zip(p, q, m, strict=True))))

    refs = {}
    docs = [(d, t, lang if lang in quality.COMMON_WORDS else "") for d, t, lang in docs]
    for _, t, lang in docs:
        c, w = refs.setdefault(lang, ([0] * 7, None))
        refs[lang] = (
            [a + b for a, b in zip(c, chars(t or ""), strict=True)],
            w if common(t or "", lang) is None else [a + b for a, b in zip(w or [0] * 21, common(t or "", lang), strict=True)])
    out = []
    for d, t, lang in docs:
        t = t or ""
        words = WORD.findall(t)
        runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        often = Counter(runs)
        covered = {i + k for i, r in enumerate(runs) if often[r] > 1 for k in range(5)}
        rows = [x for x in t.split("\n") if WORD.search(x)]
        n = len(words)
        failed = n < 10 or 100 * len(covered) > 20 * n
        a, b = js(chars(t), refs[lang][0]), js(common(t, lang), refs[lang][1])
        far = (len(t) >= quality.MIN_COMPARED_CHARS and a is not None
               and a > quality.MAX_CHARS + quality.MAX_CHARS_SHORT / math.sqrt(len(t)))
        far |= (n >= quality.MIN_COMPARED_WORDS and b is not None
                and b > quality.MAX_WORDS + quality.MAX_WORDS_SHORT / math.sqrt(n))
        out.append((
            d, n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(rows) - len(set(rows)), len(covered),
            failed, not failed and not far, a, b))
    return out


def check(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3)
    found = [tuple(r) for r in quality.judge(frame).collect()]
    want = brute(docs)
    key = lambda r: str(r[:8])
    found, want = sorted(found, key=key), sorted(want, key=key)
    assert [r[:8] for r in found] == [r[:8] for r in want]
    for a, b in zip(found, want, strict=True):
        assert a[8:] == pytest.approx(b[8:], abs=1e-6)


def test_documents_equal_brute_force(spark, tables):
    docs = [(d["doc_id"], d["text"], d["lang"]) for d in tables("documents")]
    check(spark, docs)


def test_nulls_empties_long_and_repeated_rows(spark):
    docs = [
        (1, None, "en"), (2, "", None), (3, " \n\t", "en"), (4, "a b c d e " * 4000, "en"), (None, "the of " * 60, "xx"),
        (5, "x1 X2 # é\x0b" + " ".join(f"w{i}" for i in range(50)), None), (5, "same same", "en"), (5, "same same", "en"),
        (6, "a b c d e f a b c d e", "en"), (7, "p\np\n\np q\n p", "de"),
    ]
    check(spark, docs)


def test_junk_goes_and_clean_documents_stay(spark, tables):
    docs = {d["doc_id"]: d for d in tables("documents")}
    labels = {r["doc_id"]: r["quality"] for r in tables("labels")}
    frame = spark.createDataFrame([(d, x["text"], x["lang"]) for d, x in docs.items()], "doc_id long, text string, lang string")
    verdict = {r.doc_id: r for r in quality.judge(frame).collect()}
    clean = [verdict[d] for d, q in labels.items() if q == 1 and not verdict[d].base_failed]
    junk = [verdict[d] for d, q in labels.items() if q == 0]
    assert all(v.kept for v in clean)
    assert sum(not v.kept for v in junk) >= 0.6 * len(junk)


def test_each_language_is_compared_with_itself(spark):
    rng = random.Random(2)

    def text(first: int, n: int, words: int) -> str:
        return " ".join("".join(chr(first + rng.randrange(n)) for _ in range(rng.randrange(3, 9))) for _ in range(words))

    docs = [(i, text(0x430, 32, 300), "ru") for i in range(95)] + [(100 + i, text(0x4E00, 5000, 300), "zh") for i in range(30)]
    docs += [(200, text(0x5D0, 22, 300), "he"), (201, text(0x4E00, 5000, 300), None)]  # too little text to compare with
    docs += [(300, text(0x4E00, 5000, 300), "ru"), (301, text(0x30, 10, 300), "zh")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3)
    found = {r.doc_id: r.kept for r in quality.judge(frame).collect()}
    assert found == {d: d < 300 for d, _, _ in docs}
    assert sorted(r.doc_id for r in quality.keep(frame).collect()) == sorted(d for d in found if d < 300)


def test_empty_table_and_clashing_names(spark):
    assert quality.judge(spark.createDataFrame([], "doc_id long, text string, lang string")).collect() == []
    frame = spark.createDataFrame(
        [(1, " ".join(f"w{i}" for i in range(20)), "en", 3, "k")], "doc_id long, text string, lang string, n_words int, _w string")
    kept = quality.keep(frame)
    assert kept.columns == frame.columns and kept.count() == 1
