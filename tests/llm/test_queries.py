"""Registered queries against their SQL, and the pipeline stage by stage."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from adperf.llm import queries
from tests.llm.test_lines import brute as lines_brute
from tests.llm.test_neardup import brute as near_brute
from tests.llm.test_quality import brute as quality_brute
from tests.oracle_check import compare, connect


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(name, spark, sf_dir):
    con = connect(sf_dir)
    assert compare(queries.QUERIES[name](spark, sf_dir).toPandas(), con.execute(queries.ORACLES[name]).df()) == ""


def test_one_query_for_each_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


def test_native_queries_run_no_python(spark, sf_dir):
    for name in ("op5_chat", "op8_quality", "op10_mixing"):
        plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def test_pipeline_stages_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    kept = []
    for name, function in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        docs = function(spark, docs, sf_dir)
        assert docs.columns == columns
        after = {r.doc_id: r for r in docs.collect()}
        kept.append((name, before, after))
        docs = spark.createDataFrame(list(after.values()), docs.schema)
    (_, a0, a1), (_, b0, b1), (_, c0, c1), (_, d0, d1) = kept
    assert set(a1) == {r[0] for r in quality_brute([(d, r.text, r.lang) for d, r in a0.items()]) if r[7]}
    want = {d: t for d, _, n, t in lines_brute([(d, r.text) for d, r in b0.items()]) if not (n and not t.strip(" \t\n\x0b\x0c\r"))}
    assert {d: r.text for d, r in b1.items()} == want
    assert all(r.n_chars == len(r.text) for r in b1.values())
    assert set(c1) == {r[0] for r in near_brute([(d, r.text) for d, r in c0.items()]) if r[3]}
    assert set(d1) <= set(d0) and all(d1[d] == d0[d] for d in d1)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {p.doc_id for p in pieces} == set(d1)
    assert sum(p.length for p in pieces) == sum({p.doc_id: p.doc_tokens for p in pieces}.values())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "mix_domains", "packing"]


def test_pipeline_runs_as_registered(spark, sf_dir):
    assert entry.queries()["pipeline"](spark, sf_dir).count() > 0
