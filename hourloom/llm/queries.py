"""The registered queries: each operator with its production parameters over its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from hourloom.llm.common import read
from hourloom.llm.decontaminate import decontaminate
from hourloom.llm.jaccard_join import jaccard_join
from hourloom.llm.language_id import identify_languages
from hourloom.llm.lm_scoring import score_texts
from hourloom.llm.mixing import mix_sources
from hourloom.llm.near_dups import near_duplicates
from hourloom.llm.quality_knn import score_quality
from hourloom.llm.quality_rules import BASE, quality_rules
from hourloom.llm.ranked_search import ranked_search
from hourloom.llm.suffix_dedup import suffix_dedup
from hourloom.llm.token_alignment import align_tokenizers
from hourloom.llm.token_counts import token_counts
from hourloom.llm.url_filter import judge_urls, rule_table
from hourloom.session import scratch_root

TOKENIZER = "piece_bpe_32k.model"
OTHER_TOKENIZER = "byte_bpe_50k.json"

URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run has a cache of its own, so that no run profits from an earlier one."""
    import public_tokenizers

    cache = f"{scratch_root(spark)}/token-cache/{uuid.uuid4().hex}"
    return token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), cache)


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(read(spark, sf_dir, "documents")).drop("row", "kept")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(read(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read(spark, sf_dir, "pages"), rule_table(spark, URL_RULES))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.drop("n_near_items")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules(read(spark, sf_dir, "documents"))
    return found.select("doc_id", *BASE, "base_failed", "kept")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(read(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read(spark, sf_dir, "documents")).drop("row")


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles of four words, as the contract has it."""
    return near_duplicates(read(spark, sf_dir, "documents"), size=4)


def op11_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(read(spark, sf_dir, "documents"), size=5, percent=80)


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = [public_tokenizers.path(name) for name in (OTHER_TOKENIZER, TOKENIZER)]
    return align_tokenizers(read(spark, sf_dir, "documents"), *paths)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: query for name, query in list(globals().items()) if name.startswith("op")
}
