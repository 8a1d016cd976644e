"""Mixing: the classifier on held-out labels, the rates against a plain solver."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from adperf.llm import mixing


def frames(spark, tables):
    docs = spark.createDataFrame([(d["doc_id"], d["text"]) for d in tables("documents")], "doc_id long, text string")
    labels = spark.createDataFrame(
        [(r["doc_id"], r["quality"], r["toxic"]) for r in tables("labels")], "doc_id long, quality int, toxic int")
    return docs, labels


def test_classifier_on_labels_it_has_not_seen(spark):
    import duckdb

    found = duckdb.connect().execute(
        "SELECT d.doc_id, d.text, l.quality, l.toxic FROM '/root/testdata/sf0.1/documents.parquet' d "
        "JOIN '/root/testdata/sf0.1/labels.parquet' l USING (doc_id)").fetchall()
    docs = spark.createDataFrame([r[:2] for r in found], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2], r[3]) for r in found], "doc_id long, quality int, toxic int")
    model = mixing.train(docs, labels.filter("doc_id % 2 = 0"))
    truth = {r[0]: 2 if r[3] else 1 - r[2] for r in found if r[0] % 2}
    rows = [r for r in mixing.posteriors(docs, model).collect() if r["_id"] in truth]
    right = [int(np.argmax(r["_p"])) == truth[r["_id"]] for r in rows]
    assert np.mean(right) > 0.85
    assert all(abs(sum(r["_p"]) - 1) < 1e-9 for r in rows)


def test_only_copies_are_counted_once(spark):
    """Texts that share a long word all count; equal and near-equal texts count once."""
    rng = np.random.default_rng(3)
    words = lambda k: [f"w{x}" for x in rng.integers(0, 10**6, k)]
    texts = [["extraordinary", *words(40)] for _ in range(40)]
    copy = ["extraordinary", *words(60)]
    texts += [copy, copy, copy[:-1] + ["other"]]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0 or i >= 40), 0) for i in range(len(texts))], "doc_id long, quality int, toxic int")
    model = mixing.train(docs, labels)
    assert model.filter("feature is not null").isEmpty()  # so the priors stand alone: 31 good, 10 poor
    prior = model.first()
    assert [np.exp(prior[d]) for d in mixing.DOMAINS] == pytest.approx([32 / 44, 11 / 44, 1 / 44])


def test_rates_equal_a_plain_projected_gradient(spark, tables):
    docs, labels = frames(spark, tables)
    weighed = mixing.posteriors(docs, mixing.train(docs, labels))
    weights = {"good": 0.5, "poor": 0.3, "toxic": 0.2}
    rate, trace = mixing.fit_rates(weighed, weights, total_tokens=15_000.0, max_rate=3.0)
    rows = weighed.select("_tokens", "_p", rate.alias("r")).collect()
    t = np.array([r["_tokens"] for r in rows], float)
    p = np.array([r["_p"] for r in rows])
    target = np.array([weights[d] for d in mixing.DOMAINS]) * 15_000
    mine, has = np.ones(len(t)), p.T @ t
    for _ in range(len(trace) - 1):
        mine = np.clip(mine - p @ (((p * t[:, None]).T @ mine - target) / has), 0, 3)
    assert np.array([r["r"] for r in rows]) == pytest.approx(mine, abs=1e-6)
    reached = (p * t[:, None]).T @ mine
    # few toxic documents: their rates end at the bound, so the targets are approached, not met
    assert np.abs(reached - target).sum() < 0.3 * np.abs(has - target).sum()


def test_toxic_documents_go_and_clean_ones_stay(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    decided = mixing.mix(docs, labels, weights=mixing.WEIGHTS).join(labels, "doc_id")
    kept = {(r.quality, r.toxic): r.k for r in decided.groupBy("quality", "toxic").agg(F.avg("copies").alias("k")).collect()}
    assert kept[1, 0] > 0.99 and kept[1, 1] < 0.4


def test_nulls_empties_repeats_and_clashing_names(spark):
    rows = [(1, "good words here", 4, "a"), (2, "bad stupid words", 5, None), (2, "bad stupid words", 5, None), (3, None, 6, "b"), (None, "", 7, "c"), (4, "x " * 30_000, 8, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rate int, copies string")
    labels = spark.createDataFrame([(1, 1, 0), (1, None, 0), (2, 0, 1), (2, 1, 0), (None, 1, 0), (77, 0, 0)], "doc_id long, quality int, toxic int")
    decided = mixing.mix(docs, labels, max_rate=3.0).collect()
    assert len(decided) == 6 and all(0 <= r.rate <= 3 and r.copies in (int(r.rate), int(r.rate) + 1) for r in decided)
    out = mixing.mixed(docs, labels, max_rate=3.0)
    assert out.columns == docs.columns
    want = sorted(str((r.doc_id, r.tokens)) for r in decided for _ in range(r.copies))
    assert sorted(str((r.doc_id, len((r.text or "").split()))) for r in out.collect()) == want


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert mixing.mix(docs, labels).collect() == [] and mixing.mixed(docs, labels).collect() == []
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert mixing.mix(some, labels).count() == 1


def test_very_long_texts(spark):
    rng = np.random.default_rng(8)
    six = lambda n: " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range(n))
    rows = [(1, six(20_000) + " again" * 20_000), (2, "A" * 3_000_000), (3, "#" * 3_000_000), (4, "a plain text"), (5, "another one here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 2), 0) for i in range(1, 6)], "doc_id long, quality int, toxic int")
    decided = {r.doc_id: r for r in mixing.mix(docs, labels).collect()}
    assert {i: r.tokens for i, r in decided.items()} == {1: 40_000, 2: 1, 3: 1, 4: 3, 5: 3}
    assert {r.doc_id: r.text for r in mixing.mixed(docs, labels, weights={"good": 1, "poor": 1}).collect()}.items() <= dict(rows).items()


def test_copies_among_many_rows_equal_all_pairs(spark):
    rng = np.random.default_rng(5)
    base = [[f"w{x}" for x in rng.integers(0, 10**6, 60)] for _ in range(30)]
    texts = [b if k == 0 else b[:-k] + [f"x{i}-{k}"] * k for i, b in enumerate(base) for k in (0, 1, 2, 30)] + [base[0]] * 40
    rows = [(i, "ab"[i % 7 == 0], [i], t) for i, t in enumerate(texts)]
    kept = mixing.without_copies(spark.createDataFrame(rows, "_id long, _domain string, _f array<long>, _words array<string>"))
    sets = [{tuple(t[j : j + 5]) for j in range(len(t) - 4)} for t in texts]
    near = lambda a, b: len(sets[a] & sets[b]) >= 0.75 * len(sets[a] | sets[b])
    # with these texts nearness is transitive, so the earliest of each group is what stays
    want = [i for i, d, _, _ in rows if not any(rows[j][1] == d and near(i, j) for j in range(i))]
    assert sorted(r._f[0] for r in kept.collect()) == want


def test_bounds_that_bind_are_told(spark, tables):
    docs, labels = frames(spark, tables)
    with pytest.warns(UserWarning, match="steps"):
        mixing.mix(docs, labels, steps=1)


def test_words_of_features_are_cut_in_one_pass(spark):
    texts = ["Don't stop, don't!", " (é) ÜBER2x  über2X ", "", None, "...", "a" * 9, "x́y 中文"]
    rows = mixing.with_features(spark.createDataFrame([(t,) for t in texts], "t string"), "t")
    words = [["don", "t", "stop", "don", "t"], ["é", "über2x", "über2x"], [], [], [], ["a" * 9], ["x", "y", "中文"]]
    want = spark.createDataFrame([(w,) for w in words], "w array<string>").select(F.transform("w", lambda w: F.xxhash64(w)))
    got = rows.select("_hashes", "_f").collect()
    assert [r[0] for r in got] == [r[0] for r in want.collect()]
    assert all(set(r._hashes) <= set(r._f) and len(set(r._f)) == len(r._f) for r in got)
    # two replacements are the marks of form; the words take none
    assert rows.select("_hashes", "_f")._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(") == 2


def test_features_outside_the_model_are_not_added_up(spark, monkeypatch):
    """A row keeps its place by one row, not by all of its words."""
    docs = spark.createDataFrame([(1, "some words"), (2, "other words"), (3, None)], "doc_id long, text string")
    model = spark.createDataFrame([(None, -1.0, -2.0, -3.0)], "feature long, good double, poor double, toxic double")
    plans = []
    monkeypatch.setattr(mixing, "stage", lambda df, name: plans.append(df) or df)
    rows = mixing.posteriors(docs, model).collect()
    e = np.exp([0.0, -1.0, -2.0])
    assert len(rows) == 3 and all(r._p == pytest.approx(e / e.sum()) for r in rows)
    assert "LeftOuter" not in plans[0]._jdf.queryExecution().optimizedPlan().toString()
