"""Cleans ``documents`` in stages, each one of the operators of ``listinglab.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and reread as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listinglab.llm import decontaminate, line_dedup, sentencepiece_codec, simhash_dedup, toxicity
from listinglab.llm.common import save, table


def _refresh(docs: DataFrame) -> DataFrame:
    """``n_chars`` again, where a stage may have changed the text."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a toxicity score of 0.5 and more go. Learnt from the labels outside the held-out fold."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"), toxicity.fold())


def stage_line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages stay where they occur first; every document stays, some with less text."""
    return _refresh(line_dedup.drop_repeated_chunks(docs))


def stage_simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays, the one with the smallest id. Shingles of 4 words, at most 4 bits apart."""
    return simhash_dedup.drop_near_copies(docs)


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages go; a document of which nothing else is left goes too."""
    return _refresh(decontaminate.remove(docs, table(spark, sf_dir, "benchmark")))


def stage_sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, token_ids, round_trip."""
    return sentencepiece_codec.encode(docs)


STAGES = [
    ("toxicity", stage_toxicity),
    ("line deduplication", stage_line_dedup),
    ("SimHash near-duplicates", stage_simhash),
    ("benchmark decontamination", stage_decontaminate),
    ("SentencePiece encoding", stage_sentencepiece),
]

#: Stages learn models and follow links to any depth: no SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
