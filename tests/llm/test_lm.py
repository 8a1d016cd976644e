"""The language model against one written with dictionaries and loops."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import pytest

from adperf.llm import lm

WORD = re.compile(r"[^\x20\x09-\x0d]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def brute(docs, order):
    texts = [(d, WORD.findall((t or "").translate(LOWER)) + [None]) for d, t in docs]
    fold = {d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 for d, _ in texts}

    def grams(words, n):
        padded = ["^"] * (n - 1) + words
        return [tuple(padded[i : i + n]) for i in range(len(words))]

    def counts(keep):
        found = [Counter() for _ in range(order + 1)]
        for d, words in texts:
            if keep(fold[d]):
                for n in range(1, order + 1):
                    found[n].update(grams(words, n))
                    if n > 1:
                        found[n - 1][("^",) * (n - 1)] += 1
        return found

    def cases(words, c, total):
        vocabulary = len([g for g in c[1] if g != ("^",)])
        for i in range(len(words)):
            estimates, context = [], total
            for n in range(1, order + 1):
                g = grams(words, n)[i]
                if n > 1:
                    context = c[n - 1][g[:-1]]
                estimates.insert(0, c[n][g] / context if context else 0.0)
            yield min(int(math.log2(context)) + 1, lm.CLASSES - 1) if context else 0, [*estimates, 1 / (vocabulary + 1)]

    def total(keep):
        return sum(len(w) for d, w in texts if keep(fold[d]))

    def kept(f):
        return f not in (2, 3)

    def train(f):
        return f != 2

    first, width = counts(kept), order + 1
    left = [x for d, w in texts if fold[d] == 3 for x in cases(w, first, total(kept))]
    weights = {k: [1 / width] * width for k in range(lm.CLASSES)}
    trace = []
    for _ in range(lm.MAX_STEPS):
        sums, likelihood = {}, 0.0
        for k, p in left:
            parts = [a * b for a, b in zip(weights[k], p, strict=True)]
            likelihood += math.log(sum(parts))
            s = sums.setdefault(k, [0.0] * width)
            for j, x in enumerate(parts):
                s[j] += x / sum(parts)
        for k, s in sums.items():
            weights[k] = [x / sum(s) for x in s]
        trace.append(likelihood)
        if len(trace) > 1 and trace[-1] - trace[-2] <= lm.TOLERANCE * abs(trace[-2]):
            break
    c, n = counts(train), total(train)
    v = len([g for g in c[1] if g != ("^",)])
    out = []
    for d, w in texts:
        base = sum(math.log10((c[1][(x,)] + 1) / (n + v + 1)) for x in w)
        score = sum(math.log10(sum(a * b for a, b in zip(weights[k], p, strict=True))) for k, p in cases(w, c, n))
        out.append((d, fold[d] == 2, len(w), sum(c[1][(x,)] > 0 for x in w), n, base, score))
    return out


def check(spark, docs, order):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = [tuple(r) for r in lm.score(frame, order=order).collect()]
    want = brute(docs, order)
    key = lambda r: (-1 if r[0] is None else r[0], r[2], r[6])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert [x for r in got for x in r[5:]] == pytest.approx([x for r in want for x in r[5:]], rel=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_brute_force(spark, tables, order):
    check(spark, [(d["doc_id"], d["text"][:600]) for d in tables("documents")[:60]], order)


def test_model_beats_the_base_on_held_out_texts(spark, tables):
    docs = [(d["doc_id"], d["text"]) for d in tables("documents")]
    rows = lm.score(spark.createDataFrame(docs, "doc_id long, text string")).filter("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_nulls_empties_repeats_and_clashing_names(spark):
    docs = [(1, "a b a"), (1, "a b a"), (None, "a B c"), (4, None), (5, ""), (6, " \t "), (7, "A b " * 3000), (9, "x")]
    check(spark, docs, 2)
    frame = spark.createDataFrame([(1, "a b", "x", 3)], "doc_id long, text string, rows string, chunk int")
    assert [r.n_tokens for r in lm.score(frame).collect()] == [3]


def test_empty_table(spark):
    assert lm.score(spark.createDataFrame([], "doc_id long, text string")).collect() == []
