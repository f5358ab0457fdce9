"""The corpus pipeline: language ID, near-dedup, PII, mixing, packing; each stage reads what the one before wrote."""
import uuid

from pyspark.sql import DataFrame, SparkSession

from oppflow.llm import language_id, near_dedup, packing, source_mix, surrogates
from oppflow.llm.queries import PII_KEY, contract_packing
from oppflow.session import shared_dir


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; the rest go."""
    return language_id.recognised(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: five-word shingles, similarity 0.8."""
    return near_dedup.without_copies(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return surrogates.pseudonymised(docs, PII_KEY)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return source_mix.apply_mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, contract_packing())


STAGES = [
    ("language_id", identify_languages), ("near_dedup", drop_near_copies), ("pii", replace_personal_data),
    ("source_mix", mix_sources), ("packing", pack),
]
ORACLE_SQL = None  # the stages learn, hash and tokenise; tests/llm holds them against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
