"""Physical plans: pushdown, early top-k, partial sums.  Joins are checked in test_oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

import __spark_entry__ as entry
from adperf.operators import cleanse, windows
from adperf.plans import layers

def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(entry.queries()["io3_parquet_scan"](spark, sf_dir))
    assert "GreaterThan(l_quantity,45.0)" in text
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string>" in text


def test_top_k_is_cut_before_the_shuffle(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    text = plan(windows.latest_per_key(orders, ["o_custkey"], [F.desc("o_orderdate"), F.asc("o_orderkey")]))
    assert text.count("WindowGroupLimit") == 2
    text = plan(cleanse.clean_clicks(layers.bronze_clicks(spark, sf_dir)))
    assert text.count("WindowGroupLimit") == 2


def test_global_top_k_needs_no_sort(spark, sf_dir):
    text = plan(windows.top_k(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), [F.desc("l_tax"), F.asc("l_orderkey")], 3))
    assert "TakeOrderedAndProject" in text


def test_rollup_sums_before_the_shuffle(spark, sf_dir):
    from adperf.operators import rollup

    text = plan(rollup.grain(layers.enriched(spark, sf_dir)))
    assert "partial_sum" in text and "ObjectHashAggregate" not in text and "SortAggregate" not in text
