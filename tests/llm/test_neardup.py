"""Near duplicates against all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from adperf.llm import components, neardup, textvec

WORD = re.compile(r"[^\x20\x09-\x0d]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def shingle_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(docs):
    sets = {d: shingle_set(t) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    where = {}
    for d, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(d)
    pairs = {(a, b) for ds in where.values() for i, a in enumerate(ds) for b in ds[i + 1 :]}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return sorted((d, len(s), find(d), d == find(d)) for d, s in sets.items())


def got(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    return sorted(tuple(r) for r in neardup.groups(frame).collect())


def variant(words, share, rng):
    return " ".join(w if rng.random() > share else f"x{rng.randrange(10**9)}" for w in words)


@pytest.fixture(scope="module")
def large_group():
    """One base text, many texts near it, most of them not near each other."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(5000)}" for _ in range(150)]
    texts = [" ".join(base)] + [variant(base, rng.uniform(0, 0.08), rng) for _ in range(700)]
    other = [" ".join(f"u{rng.randrange(3000)}" for _ in range(80)) for _ in range(60)]
    rng.shuffle(texts)
    return [(i, t) for i, t in enumerate(texts + other)]


def test_large_group_equals_all_pairs(spark, large_group):
    assert got(spark, large_group) == brute(large_group)


def test_documents_equal_all_pairs(spark, tables):
    docs = [(d["doc_id"], d["text"]) for d in tables("documents")]
    assert got(spark, docs) == brute(docs)


def test_candidates_become_one_row_for_each_component_they_met(spark, large_group, monkeypatch):
    staged = []

    def kept(frame, name="part"):
        out = stage(frame, name)
        staged.append((name, out))
        return out

    stage = neardup.stage
    monkeypatch.setattr(neardup, "stage", kept)
    assert got(spark, large_group) == brute(large_group)
    outside = [frame for name, frame in staged if name == "outside"]
    assert outside
    for frame in outside:  # once for each component, whatever the number of candidates in it
        assert frame.columns == ["id", "root"] and frame.count() == frame.distinct().count()
        assert frame.filter("id = root").isEmpty()


def test_others_follow_the_components(spark):
    met = spark.createDataFrame([(1, 7), (1, 8), (1, 9), (2, 1), (9, 1), (5, 6)], "id long, other long")
    labels = spark.createDataFrame([(1, 1), (2, 1), (7, 7), (8, 7)], "node long, root long")
    others = neardup._others(met, labels)
    assert sorted(map(tuple, others.collect())) == [(1, 7), (1, 9), (5, 6), (9, 1)]
    joined = spark.createDataFrame([(1, 1), (2, 1), (7, 1), (8, 1), (9, 5), (5, 5)], "node long, root long")
    again = neardup._others(others.withColumnRenamed("root", "other"), joined)
    assert sorted(map(tuple, again.collect())) == [(1, 5), (5, 6), (9, 1)]


def test_full_regions_are_cut_and_still_found(spark, large_group, monkeypatch):
    monkeypatch.setattr(neardup, "REGION_ROWS", 16)
    assert got(spark, large_group) == brute(large_group)


@pytest.mark.parametrize("tail, common", [(54, (4, 5)), (67, (15, 16))])  # a crowd at 0.735 and at 0.69
def test_pairs_in_a_crowd_of_texts_that_do_not_link(spark, tail, common):
    rng = random.Random(tail)
    words = lambda k: [f"v{rng.randrange(10**12)}" for _ in range(k)]
    passage, texts = words(304), []
    for i in range(1500):
        if i % 15:
            texts.append(passage + words(tail))
        else:  # a pair at 0.75 to 0.76
            both = words(common[i % 2])
            texts += [passage + both + words(tail - len(both)) for _ in range(2)]
    rng.shuffle(texts)
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    sets = {d: shingle_set(t) for d, t in docs}
    everywhere = set.intersection(*sets.values())
    # two texts that share the passage alone do not link, so those that share more are all there is to try
    assert 100 * len(everywhere) < 75 * (2 * (len(everywhere) + tail) - len(everywhere))
    where, root = {}, {d: d for d in sets}
    for d, s in sets.items():
        for x in s - everywhere:
            where.setdefault(x, []).append(d)
    pairs = {(a, b) for ds in where.values() for i, a in enumerate(ds) for b in ds[i + 1 :]}
    for a, b in pairs:
        likeness = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
        assert 0.75 <= likeness <= 0.76
        root[b] = a
    assert len(pairs) == 100
    assert got(spark, docs) == sorted((d, len(s), root[d], d == root[d]) for d, s in sets.items())


def test_nulls_empties_short_and_repeated_rows(spark):
    long = " ".join(f"a{i}" for i in range(4000))
    docs = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one  TWO"), (6, "one two three"), (8, long), (9, long + " b")]
    assert got(spark, docs) == brute(docs)
    frame = spark.createDataFrame([*docs, (4, "One two"), (None, "one two")], "doc_id long, text string")
    assert sorted(tuple(r) for r in neardup.groups(frame).collect()) == brute(docs)


def test_empty_table(spark):
    assert neardup.groups(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_first_of_groups_keeps_all_columns(spark):
    rows = [(1, "a b c d e f", "p", 1), (1, "a b c d e f", "p", 1), (2, "A b c d e f", "q", 2), (3, "z", None, 3), (None, "z", None, 4)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, gone string, row int")
    kept = neardup.first_of_groups(frame)
    assert kept.columns == frame.columns
    assert sorted(tuple(r) for r in kept.collect() if r.doc_id) == [rows[0], rows[3]]
    assert [r.row for r in kept.filter("doc_id is null").collect()] == [4]


def test_unlike_texts_of_one_id_are_documents_of_their_own(spark):
    rows = [
        (1, "a b c d e f", 1), (1, "p q r s t u", 2), (2, "P q r s t u", 3), (3, "p q r s t u", 4), (1, "a B c d e f", 5),
        (4, "k l m n o", 6), (4, None, 7),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, row int").coalesce(1)
    assert sorted(tuple(r) for r in neardup.groups(frame).collect()) == [
        (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (4, 0, 4, True), (4, 1, 4, True)]
    assert sorted(r.row for r in neardup.first_of_groups(frame).collect()) == [1, 2, 6, 7]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_extended_by_links_equal_those_of_all_links(spark, seed):
    rng = random.Random(seed)
    links = [tuple(sorted(rng.sample(range(120), 2))) for _ in range(90)]
    schema = "a long, b long"
    old, new = links[: 30 * (seed - 1)], links[30 * (seed - 1) :]  # seed 1: no labels before
    labels = components.components(spark.createDataFrame(old, schema))
    for part in (new[:20], [], new[20:]):
        labels = components.extended(labels, spark.createDataFrame(part, schema))
    want = components.components(spark.createDataFrame(links, schema))
    assert sorted(map(tuple, labels.collect())) == sorted(map(tuple, want.collect()))


def test_components_of_a_long_chain_and_a_star(spark):
    rng = random.Random(1)
    names = rng.sample(range(10_000), 300)
    chain = list(zip(names, names[1:], strict=False))
    star = [(20_000, 20_001 + i) for i in range(50)]
    found = components.components(spark.createDataFrame(chain + star + [(5, 5)], "a long, b long"))
    roots = {r.node: r.root for r in found.collect()}
    assert {roots[x] for x in names} == {min(names)}
    assert {roots[20_001 + i] for i in range(50)} == {20_000}
    assert len(roots) == 351


def test_word_hashes_agree_with_words():
    texts = ["", "a b", "  Hello wORLD\n x", "é à b", None, "x\ty\x0bz ", " ", "w " * 50]
    hashes, counts = textvec.words(*textvec.text_bytes(pa.array(texts)))
    want = [WORD.findall((t or "").translate(LOWER)) for t in texts]
    assert counts.tolist() == [len(w) for w in want]
    flat = [x for w in want for x in w]
    assert len(set(zip(flat, hashes.tolist(), strict=True))) == len(set(flat)) == len(set(hashes.tolist()))


def test_packed_numbers_come_back():
    keys = np.unique(textvec.mix(np.arange(1000, dtype=np.uint64)))
    assert (textvec.unpack_sorted(textvec.pack_sorted(keys)) == keys).all()
    assert (textvec.unpack_counts(textvec.pack_counts(np.arange(9), np.uint32), np.uint32) == np.arange(9)).all()
