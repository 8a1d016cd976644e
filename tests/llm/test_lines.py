"""Line de-duplication against all pairs of lines."""

from __future__ import annotations

import random
import re

import pytest

from adperf.llm import chunks, lines

WORD = re.compile(r"[^\x20\x09-\x0d]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def brute(docs):
    """(id, lines, removed, text) of each row; rows of one id in the order given."""
    order = sorted(range(len(docs)), key=lambda k: (docs[k][0] is None, docs[k][0] or 0, k))
    seen, out, index, sets = [], {}, {}, set()
    for k in order:
        d, t = docs[k]
        if t is None:
            out[k] = (d, 0, 0, None)
            continue
        kept, split = [], t.split("\n")
        for line in split:
            s = frozenset(WORD.findall(line.translate(LOWER)))
            if s and len(s) < lines.MIN_TOKENS:
                if s in sets:
                    continue
                sets.add(s)
            elif s:
                near = {i for w in s for i in index.get(w, ())}
                gone = any(7 * len(s & seen[i]) >= 3 * (len(s) + len(seen[i])) for i in near)
                if s not in seen:
                    for w in s:
                        index.setdefault(w, []).append(len(seen))
                    seen.append(s)
                if gone:
                    continue
            kept.append(line)
        out[k] = (d, len(split), len(split) - len(kept), "\n".join(kept))
    return [out[k] for k in range(len(docs))]


def got(spark, docs, parts=3):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    rows = lines.dedup(frame).select("doc_id", "_lines.n_lines", "_lines.n_removed", "text").collect()
    return sorted((tuple(r) for r in rows), key=str)


@pytest.fixture(scope="module")
def near_lines():
    """Lines near a common one, lines near those, and unlike ones, in many documents."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(300)}" for _ in range(25)]

    def line():
        kind = rng.random()
        if kind < 0.5:
            return " ".join(w if rng.random() > 0.12 else f"v{rng.randrange(400)}" for w in base)
        if kind < 0.6:
            return " ".join(rng.sample(["the", "of", "and", "to", "in", "is"], rng.randrange(2, 7)))
        return " ".join(f"w{rng.randrange(300)}" for _ in range(rng.randrange(1, 30)))

    return [(i, "\n".join(line() for _ in range(rng.randrange(1, 6)))) for i in range(150)]


def test_documents_equal_all_pairs(spark, tables):
    docs = [(d["doc_id"], d["text"]) for d in tables("documents")]
    assert got(spark, docs) == sorted(brute(docs), key=str)


def test_near_lines_equal_all_pairs(spark, near_lines):
    assert got(spark, near_lines) == sorted(brute(near_lines), key=str)


def test_second_pass_and_common_words_in_parts(spark, near_lines, monkeypatch):
    monkeypatch.setattr(lines, "NEAREST", 1)
    monkeypatch.setattr(lines, "WORD_ROWS", 20)
    monkeypatch.setattr(chunks, "RANGE_KEYS", 100)
    monkeypatch.setattr(chunks, "CHUNK_ROWS", 17)
    assert got(spark, near_lines) == sorted(brute(near_lines), key=str)


def test_nulls_empties_long_texts_and_repeated_rows(spark):
    many = "\n".join(f"a{i} b{i} c{i} d{i}" for i in range(3000))
    docs = [
        (1, None), (2, ""), (3, "\n\n"), (4, "one two three four\n\nOne two three FOUR\n"), (5, "x y"), (6, "x y"),
        (7, many), (8, many), (9, "four three two one"), (None, "a1 b1 c1 d1\nnew words stand here"),
    ]
    assert got(spark, docs) == sorted(brute(docs), key=str)
    twice = [(4, "one two three four\nz"), (4, "one two three four\nz")]
    assert got(spark, twice) == sorted(brute(twice), key=str)


def test_short_lines_go_only_if_equal(spark):
    docs = [(1, "Read more\nb c d"), (2, "more read\nb c\n\n"), (3, "b c d e\n\nread more now"), (4, "d c b")]
    assert got(spark, docs) == [
        (1, 2, 0, "Read more\nb c d"), (2, 4, 1, "b c\n\n"), (3, 3, 0, "b c d e\n\nread more now"), (4, 1, 1, "")]
    assert got(spark, docs) == sorted(brute(docs), key=str)


def test_columns_named_like_the_counts(spark):
    frame = spark.createDataFrame(
        [(1, "read more", 5, 6), (2, "Read more\nx", 7, 8)], "doc_id long, text string, _lines int, __LINES int")
    out = lines.deduplicated(frame)
    assert out.columns == frame.columns
    assert sorted(tuple(r) for r in out.collect()) == [(1, "read more", 5, 6), (2, "x", 7, 8)]
    assert lines.dedup(frame).columns == [*frame.columns, "___lines"]


def test_empty_table(spark):
    assert lines.dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_all_columns_stay_and_emptied_documents_go(spark):
    rows = [(1, "one two three four", 5, "p"), (2, "one two three four", 6, None), (3, "", 7, "q"), (4, "own text of four", 8, "r")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, chunk int, `rows` string")
    out = lines.deduplicated(frame)
    assert out.columns == frame.columns
    assert sorted(tuple(r) for r in out.collect()) == [rows[0], rows[2], rows[3]]


def test_unlike_long_lines_make_no_pairs(spark, monkeypatch):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(700)]
    docs = [(i, " ".join(rng.sample(vocabulary, 250))) for i in range(60)]
    tried, matched = [], lines._matched
    monkeypatch.setattr(lines, "_matched", lambda c, pairs, *at: tried.append(pairs.count()) or matched(c, pairs, *at))
    assert got(spark, docs) == sorted(brute(docs), key=str)
    assert tried == [0]


def test_long_lines_of_all_sizes_equal_all_pairs(spark):
    rng = random.Random(9)
    docs = []
    for size in (155, 158, 200, 300, 318, 330, 640, 1300):
        base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        for _ in range(5):
            kept = [w for w in base if rng.random() > rng.choice([0.0, 0.05, 0.12, 0.2])]
            docs.append((len(docs), " ".join([*kept, *[f"x{rng.randrange(10**6)}" for _ in range(rng.randrange(size // 8))]])))
    rng.shuffle(docs)
    want = sorted(brute(docs), key=str)
    assert 0 < sum(x[2] for x in want) < len(docs) - 8
    assert got(spark, docs) == want


def test_second_pass_reads_the_words_that_had_more(spark, near_lines, monkeypatch):
    monkeypatch.setattr(lines, "NEAREST", 1)
    monkeypatch.setattr(lines, "UNSURE", 1)
    monkeypatch.setattr(lines, "WORD_ROWS", 20)
    monkeypatch.setattr(chunks, "RANGE_KEYS", 100)
    monkeypatch.setattr(chunks, "CHUNK_ROWS", 17)
    filters, made = [], lines._filter_of
    monkeypatch.setattr(lines, "_filter_of", lambda words: filters.append(made(words)) or filters[-1])
    assert got(spark, near_lines) == sorted(brute(near_lines), key=str)
    assert len(filters) == 1 and filters[0].any()
