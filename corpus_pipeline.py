"""From documents to packed training sequences: five stages, each written before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowlens.llm import chunks, mixing, packing, setsketch, toxicity
from flowlens.llm.queries import vocabulary
from flowlens.session import bound_batches, stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.7; the classifier is fitted on the labels that are not held out."""
    bound_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.fit(docs, labels))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased) the document with the largest id."""
    bound_batches(spark)
    return chunks.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8)."""
    bound_batches(spark)
    return setsketch.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the targets of their sources ask for."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 4096 tokens."""
    bound_batches(spark)
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_exact_copies), ("near_dedup", drop_near_copies),
          ("mixing", mix_sources), ("packing", pack_sequences)]

# Training, tokenizers and sketches are not SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
