"""From raw documents to packed training sequences: language, quality, near-duplicates, mixture, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from certweave.functions.nested import settled
from certweave.llm import jaccard, language, mixing, packing, quality

LANGUAGES = ["de", "en", "es", "fr"]
TOKENIZER = "word_bpe_49k.json"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is one of the four, whatever they declare; those without a letter go."""
    found = language.identify(docs, LANGUAGES, declared=F.col("lang"), host=F.col("source"))
    return settled(found).where("language_kept").select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and score as the trusted ones do."""
    judged = quality.judge(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return settled(judged).where("kept").select(*docs.columns)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return jaccard.without_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture has them: sources at their weights, none more than three times over."""
    return mixing.repeated(mixing.mix(docs)).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their token ids and their places in sequences of at most 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [("language_id", language_id), ("quality_rules", quality_rules), ("ngram_jaccard", ngram_jaccard), ("mix_sources", mix_sources), ("pack_sequences", pack_sequences)]
ORACLE_SQL = None  # trained models and a tokenizer; tests hold each stage against a plain version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the table of documents, one after another."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
