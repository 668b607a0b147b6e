"""A corpus pipeline over ``documents``, one operator a stage.

1. Documents without a language go.
2. One document of each group of near copies stays.
3. Documents that hold a benchmark item go.
4. Secrets are masked in the texts.
5. Texts become tokens: ids, their count, and hashes of ids and of the decoded text, beside all other columns.

Every stage takes all rows that its predecessor kept and passes other columns on as they are.

Defined cases: a null text, or one without a letter, has no language and goes in stage 1, as an empty one does; texts
of any length are read whole; of repeated rows and of equal texts one row stays, that of the least doc_id (ties stay
one row); an empty table gives no rows; columns that documents do not have pass through all stages, and where one
bears the name of a new column of the last stage, the new one gets an underscore.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spanloom.llm import bpe, bpe_codec, decontamination, language_id, near_dedup, secret_scan
from spanloom.storage import materialize


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    profiles = language_id.learn_profiles(docs.where(language_id.remainder("doc_id", 4) != 2))
    return language_id.reject_unknown(docs, profiles)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.one_of_each(docs)


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redacted(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_codec.with_tokens(docs, bpe.tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("language", keep_known_languages),
    ("near_copies", keep_one_of_near_copies),
    ("benchmark", drop_benchmark_copies),
    ("secrets", mask_secrets),
    ("tokens", encode_tokens),
]

#: SQL expresses neither the language, the near copies nor the tokens; the tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{name}")
    return docs
