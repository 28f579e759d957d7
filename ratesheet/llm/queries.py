"""The queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratesheet.llm import (
    decontamination,
    expected,
    html_extraction,
    language_id,
    license_scan,
    line_dedup,
    merkle_manifest,
    minhash_dedup,
    packing,
    quality_classifier,
    quality_rules,
    secret_scan,
    token_alignment,
    token_counts,
)
from ratesheet.llm.common import documents, written
from ratesheet.session import shared_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
#: DuckDB SQL of the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op5_benchmark_decontamination": expected.CONTAMINATED,
    "op9_minhash_dedup": expected.NEAR_DUPLICATES,
    "op12_merkle_manifest": expected.MERKLE,
}


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.summary(documents(spark, sf_dir), bits=None)


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language_id.train(docs, ~language_id.held_out())
    found = language_id.predicted(docs, model)
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


@query
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality_classifier.train(docs, _labels(spark, sf_dir), ~quality_classifier.held_out())
    found = quality_classifier.scored(docs, model)
    return found.select("doc_id", quality_classifier.held_out().alias("held_out"), "score", "predicted")


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four batches over all documents, one of them delivered twice.

    All documents come; a second tokenizer version, which ends each with an id, is counted beside
    the first; documents without a language move to the language "und"; empty documents go.
    """
    table = shared_dir(spark, "rollup")
    docs = documents(spark, sf_dir)
    first = written(token_counts.counted(docs, "byte-bpe-1"), "states")
    second = first.withColumns({"version": F.lit("byte-bpe-2"), "n_tokens": F.col("n_tokens") + 1})
    both = first.unionByName(second)
    unnamed = both.where("lang is null")
    moved = unnamed.withColumn("lang", F.lit("und"))
    empty = both.withColumn("lang", F.coalesce("lang", F.lit("und"))).where("n_chars = 0")
    token_counts.commit(token_counts.inserts(first), table, "1-load")
    token_counts.commit(token_counts.inserts(second), table, "2-version")
    token_counts.commit(token_counts.inserts(second), table, "2-version")
    token_counts.commit(token_counts.revisions(unnamed, moved), table, "3-language")
    token_counts.commit(token_counts.deletes(empty), table, "4-empty")
    return token_counts.totals(spark, table)


@query
def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.contaminated(documents(spark, sf_dir), items)


@query
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scanned(documents(spark, sf_dir))


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality_rules.judged(docs, quality_rules.train(docs, _labels(spark, sf_dir)))


@query
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return secret_scan.scanned(docs, secret_scan.train(docs))


@query
def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(documents(spark, sf_dir))


@query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir))


@query
def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.aligned(documents(spark, sf_dir))


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.audited(documents(spark, sf_dir))


@query
def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))
