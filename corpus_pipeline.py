"""From raw documents to token ids: toxicity, exact and near copies, benchmark passages, SentencePiece.

Each stage takes ``(spark, docs, sf_dir)``, works on all that its predecessor kept and is written as Parquet before the
next one reads it.  All but the last return the columns of ``documents``; the last adds ``pieces``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sparkwarden.llm import decontaminate, exact_dedup, sentencepiece_codec, simhash, toxicity
from sparkwarden.storage import discard, scratch, written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half stay.  Null and empty texts score as one empty word; ids do not matter."""
    return toxicity.drop_toxic(docs, _table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest id stays.  Null is the empty text; rows without an id stay, rows that repeat an id and its text stay together."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked at 0.8 or more the smallest id stays.  Texts without words are alike; rows without an id stay, rows that repeat one are one document."""
    return simhash.drop_near_copies(docs, shingle=5, similarity=0.8)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark stay.  Null and empty texts, and rows without an id, stay."""
    return decontaminate.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"), min_words=1)


def add_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with the ids of its text; null and empty texts have none."""
    return sentencepiece_codec.add_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("SentencePiece", add_pieces),
]

#: SQL can't express the network, the fingerprints or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before = docs
        with scratch() as keep:
            docs = keep(written(stage(spark, before, sf_dir), name.replace(" ", "-")))
        discard(before)  # the next stage reads this one's files only
    return docs
