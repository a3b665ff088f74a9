"""The registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm import bpe, chat, embeddings, exact, language, packing, pii, simhash, substrings, toxicity, trie, urls, whitening
from medallion.llm.common import prepared, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_copies(table(spark, sf_dir, "embeddings"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.preference_turns(chat.answer_pairs(table(spark, sf_dir, "conversations")))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"), urls.fixed_rules(spark))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    counts = [f"n_{kind}" for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.drop_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(trie.regrouped(trie.turn_lists(table(spark, sf_dir, "conversations"))))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = (
    op1_best_fit_packing,
    op2_embedding_near_dedup,
    op3_simhash_near_dedup,
    op4_byte_bpe,
    op5_exact_dedup,
    op6_chat_formatting,
    op7_language_id,
    op8_url_filters,
    op9_personal_data,
    op10_substring_dedup,
    op11_prefix_trie,
    op12_embedding_whitening,
    op13_toxicity,
)


def _configured(function: Query) -> Query:
    return lambda spark, sf_dir: function(prepared(spark), sf_dir)


def queries() -> dict[str, Query]:
    return {function.__name__: _configured(function) for function in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_embedding_near_dedup": embeddings.EMBEDDINGS_SQL,
        "op5_exact_dedup": exact.EXACT_SQL,
        "op6_chat_formatting": chat.CHAT_SQL,
        "op8_url_filters": urls.URLS_SQL,
        "op10_substring_dedup": substrings.SUBSTRINGS_SQL,
        "op11_prefix_trie": trie.TRIE_SQL,
    }
