"""Corpus pipeline: quality classifier, SimHash near-dedup, substring dedup, benchmark
decontamination, SentencePiece encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, ordinal, sentencepiece_codec, simhash, substring_dedup
from tidemark.llm.common import table
from tidemark.session import ensure_checkpoint_dir, materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier does not reject."""
    judged = ordinal.classify(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))
    return judged.filter(F.col("kept")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: the one with the smallest doc_id."""
    return simhash.keep_first(docs.select(*COLUMNS), shingle_words=4, max_bits=4)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that an earlier document has."""
    return substring_dedup.remove_passages(docs.select(*COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a benchmark item."""
    return decontaminate.clean_documents(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and whether decoding gives the text back, for every document left."""
    vocabulary = sentencepiece_codec.Vocabulary.load(sentencepiece_codec.MODEL)
    coded = sentencepiece_codec.encode_documents(docs.select("doc_id", "text"), vocabulary, check=True)
    return coded.select("doc_id", "n_tokens", "ids", "round_trip")


STAGES = [
    ("quality classifier", classify_quality),
    ("SimHash near-dedup", drop_near_duplicates),
    ("substring dedup", drop_repeated_passages),
    ("benchmark decontamination", drop_contaminated),
    ("SentencePiece encoding", encode_pieces),
]

# A fitted classifier, alignment and piece encoding have no SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over documents, each written and read again before the next."""
    ensure_checkpoint_dir(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
