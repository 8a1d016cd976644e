"""The Merkle manifest against a tree built in plain Python."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest

from adperf.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def row_hash(doc_id, text, lang, source, n_chars):
    return h(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc_id, source, lang, n_chars, text)))


def levels_of(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def path_of(levels, i):
    path = []
    for level in levels[:-1]:
        run = level[i // 3 * 3 : i // 3 * 3 + 3]
        path.append((i % 3, run))
        i //= 3
    return path


def brute(rows):
    groups: dict = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, row_hash(*r)))
        trees[s] = levels_of([row_hash(*r) for r in groups[s]])
    if not names:
        return []
    top = levels_of([trees[s][-1][0] for s in names])
    root, out = top[-1][0], []
    for at, s in enumerate(names):
        for i, (doc_id, text, lang, source, n) in enumerate(groups[s]):
            path = path_of(trees[s], i) + path_of(top, at)
            tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0 and text is not None
            held = row_hash(doc_id, text.replace("\n", ""), lang, source, n) if tampered else trees[s][0][i]
            for place, run in path:
                held = h(*(held if j == place else x for j, x in enumerate(run)))
            proof = h(*(x for place, run in path for j, x in enumerate(run) if j != place))
            out.append((doc_id, trees[s][0][i], trees[s][-1][0], root, proof, held, held == root))
    return sorted(out, key=str)


def got(spark, rows, levels=merkle.LEVELS, schema=SCHEMA):
    manifest = merkle.build(merkle.without_newlines(spark.createDataFrame(rows, schema).repartition(3)), levels)
    return sorted((tuple(r) for r in merkle.verify(merkle.proofs(manifest), manifest.root).collect()), key=str)


def documents(n, sources):
    rng = np.random.default_rng(n)
    return [
        (int(i), "\n".join(["lä" * int(rng.integers(0, 4))] * int(rng.integers(1, 3))), "en", sources[int(rng.integers(len(sources)))], int(i) % 7)
        for i in rng.permutation(n)
    ]


def test_segments_of_few_levels(spark):
    # a third of the rows in one source, three rounds of two levels each
    rows = documents(300, [f"s{i}" for i in range(14)] + ["hot"] * 7)
    assert got(spark, rows, levels=2) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (1, None, None, None, None), (1, "a\nb", "", "", 0), (None, "a\nb", "en", None, 3), (None, None, None, "é", None),
        (5, "", "de", "é", -1), (5, "", "de", "é", -1), (5, "x\n", "de", "é", 9), (-7, "\n" * 50, "de", "Z", 1),
        (8, "long \n" * 200_000, "de", "Z", 1), (9, "-", "1", "0", 0),
    ]
    assert got(spark, rows) == brute(rows)
    assert got(spark, rows, levels=1) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(4, "a\nb", "en", "s", 3)], [(0, None, None, None, None)] * 40])
def test_none_one_and_equal_rows(spark, rows):
    assert got(spark, rows, levels=2) == brute(rows)


def test_other_columns_are_not_read(spark):
    rows = documents(30, ["a", "b"])
    names = "tree string, leaf int, claim int, idx string, part int, n int, local int, first int, block int"
    wide = [(*r, "x", 1, 1, "y", 1, 2, 3, 4, 5) for r in rows]
    assert got(spark, wide, schema=f"{SCHEMA}, {names}") == brute(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 26, 27, 28, 80])
def test_places_are_those_of_the_log(n):
    found = [h(str(i)) for i in range(n)]
    height = merkle.height_of(n)
    log = merkle.append_log(found, height)
    levels = levels_of(found)
    assert len(log) == sum(len(x) for x in levels)
    for level, digests in enumerate(levels):
        assert [log[p] for p in merkle.places(n, height)[level]] == digests


def test_log_of_several_rounds_is_one_postorder_log(spark):
    rows = documents(100, ["a", "b", "b", "b"])
    manifest = merkle.build(merkle.leaves(spark.createDataFrame(rows, SCHEMA)), levels=1)
    for s in "ab":
        mine = sorted((r for r in rows if r[3] == s), key=lambda r: r[0])
        want = merkle.append_log([row_hash(*r) for r in mine], merkle.height_of(len(mine)))
        log = merkle.nodes(manifest).filter(f"tree = '1{s}'").orderBy("position").collect()
        assert [r.position for r in log] == list(range(len(want)))
        assert [r.digest for r in log] == want


def test_any_change_is_found_and_nothing_else(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    manifest = merkle.build(merkle.without_newlines(docs))
    odd = merkle.verify(merkle.proofs(manifest), manifest.root).filter("NOT verified")
    want = docs.filter("crc32(cast(doc_id as string)) % 2 = 0 AND text LIKE '%\n%'").select("doc_id")
    assert sorted(r[0] for r in odd.select("doc_id").collect()) == sorted(r[0] for r in want.collect())
