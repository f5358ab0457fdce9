"""The operators as queries over the standard tables."""
import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oppflow.llm import (
    host_rules, html_text, language_id, near_dedup, packing, secret_links, source_divergence, source_mix, surrogates,
    token_alignment, token_counts, url_filter, vector_search,
)
from oppflow.llm.shared import table
from oppflow.llm.sql import HOST_RULES_SQL, URL_FILTER_SQL
from oppflow.llm.sql_divergence import SOURCE_DIVERGENCE_SQL

HOST_RULES = [
    url_filter.HostRule("net", "/", "block"), url_filter.HostRule("example.net", "/en/", "allow"),
    url_filter.HostRule("example.com", "/de/", "block"), url_filter.HostRule("org", "/fr/", "allow"),
]
# a key of the test data; a real one comes from the environment and is kept secret
PII_KEY = os.environ.get("OPPFLOW_PII_KEY", "key of the test data")


def packing_settings(**more) -> packing.Packing:
    """The public vocabulary without its special tokens."""
    return packing.Packing(ranks=public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern=public_tokenizers.PATTERN, **more)


def contract_packing() -> packing.Packing:
    """What the queries pack with: the ids of byte_bpe_50k.json, added special token included."""
    return packing_settings(special_tokens=(("<|endoftext|>", 50256),))


def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, folder, "pages"), HOST_RULES)


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(table(spark, folder, "documents"))


def op3_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"), near_dedup.MinHash(words=4))


def op4_host_rules(spark: SparkSession, folder: str) -> DataFrame:
    return host_rules.judge(table(spark, folder, "documents"))


def op5_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return source_mix.mixed(table(spark, folder, "documents"))


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"), contract_packing())


def op7_vector_search(spark: SparkSession, folder: str) -> DataFrame:
    return vector_search.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return surrogates.pseudonymised(docs, PII_KEY, count="n_mentions")


def op10_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"))


def alignment_settings(**more) -> token_alignment.Tokenizers:
    """Byte-level BPE against BPE pieces with byte fallback."""
    return token_alignment.Tokenizers(ranks=public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern=public_tokenizers.PATTERN,
                                      pieces=public_tokenizers.path("piece_bpe_32k.model"), **more)


def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    digest = lambda groups: F.sha2(groups, 256)
    return token_alignment.aligned_documents(table(spark, folder, "documents"), alignment_settings(), digest).withColumnRenamed("groups", "groups_sha256")


def op12_secret_links(spark: SparkSession, folder: str) -> DataFrame:
    return secret_links.report(secret_links.find_secrets(table(spark, folder, "documents")))


def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return source_divergence.audit(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_url_filter, op2_language_id, op3_near_dedup, op4_host_rules, op5_source_mix, op6_packing, op7_vector_search,
    op8_token_counts, op9_surrogates, op10_html_text, op11_token_alignment, op12_secret_links, op13_source_divergence)}
ORACLES: dict[str, str] = {"op1_url_filter": URL_FILTER_SQL, "op4_host_rules": HOST_RULES_SQL, "op13_source_divergence": SOURCE_DIVERGENCE_SQL}
