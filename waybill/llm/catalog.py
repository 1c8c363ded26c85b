"""Registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, decontaminate, fingerprints, html_extract, interpolated_lm, licenses, ngram_join, ranked_search, repeats, sentencepiece_codec, token_counts, toxicity, url_filters
from .common import table

#: Folder of public vocabulary files.
TOKENIZERS = "/opt/tokenizers"


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_urls(table(spark, sf_dir, "pages"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.shingle_components(table(spark, sf_dir, "documents"), size=4, percent=85).drop("row", "keeper")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item found in it."""
    return decontaminate.search_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = sentencepiece_codec.UnigramModel.load(f"{TOKENIZERS}/piece_bpe_32k.model")
    return sentencepiece_codec.round_trips(table(spark, sf_dir, "documents"), model)


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_main_text(table(spark, sf_dir, "pages"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    index = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.with_score(docs, index)
    predicted = F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = token_counts.byte_vocabulary(f"{TOKENIZERS}/byte_bpe_50k.tiktoken")
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary)


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_versions(table(spark, sf_dir, "documents"))


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_digests(table(spark, sf_dir, "documents"), min_length=50)


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents have no paths; theirs are made of the source and the leading digits of the id."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", F.floor(F.col("doc_id") / 1000), F.floor(F.col("doc_id") / 100), "doc_id")
    return licenses.scan_licenses(docs.select("doc_id", path.alias("path"), "text"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolated_lm.score_texts(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [op1_url_filters, op2_ngram_join, op3_decontamination, op4_sentencepiece, op5_html_extraction, op6_toxicity, op7_token_counts, op8_fingerprints, op9_repeats, op10_licenses, op11_ranked_search, op12_collocations, op13_lm_scores]
    return {query.__name__: query for query in named}


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filters": url_filters.judge_urls_sql(), "op11_ranked_search": ranked_search.rank_documents_sql(), "op12_collocations": collocations.collocations_sql()}
