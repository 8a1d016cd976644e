"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from adperf.llm import chat, html_text, lines, lm, merkle, mixing, neardup, packing, quality, secretscan, topk, vcodes, warc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.piece_digests(packing.pack(table(spark, sf_dir, "documents")))


@query("op2_near_duplicates", neardup.SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.groups(table(spark, sf_dir, "documents"))


@query("op3_html")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query("op4_language_model")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


@query("op5_chat", chat.SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    messages = chat.linear_messages(rows.unionByName(chat.control_conversation(spark)))
    return chat.digests(chat.format_paths(chat.conversations(messages)))


@query("op6_lines", lines.SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "_lines.n_lines", "_lines.n_removed", "text")


@query("op7_warc")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.summary(warc.derive(warc.responses(table(spark, sf_dir, "pages"))))


@query("op8_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


@query("op9_topk", topk.SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.whole_vectors(table(spark, sf_dir, "embeddings"))
    return topk.search(vectors.filter(topk.every(vectors["vec_id"], 100)), topk.build(vectors))


@query("op10_mixing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), max_rate=4.0).drop("text_hash")


@query("op11_codes", vcodes.SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vcodes.coded(vcodes.whole_vectors(table(spark, sf_dir, "embeddings")))


@query("op12_secrets")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.digests(secretscan.scan(table(spark, sf_dir, "documents")))


@query("op13_merkle", merkle.SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = merkle.build(merkle.without_newlines(table(spark, sf_dir, "documents")))
    return merkle.verify(merkle.proofs(manifest), manifest.root)
