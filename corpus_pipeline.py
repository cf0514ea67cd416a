"""A corpus pipeline over ``documents``: drop toxic texts, exact copies and near copies, mix the sources to
their targets, and encode what is left.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which :func:`run` writes and reads again for
the next stage. All stages but the last return the columns they got. Null and empty texts are harmless, equal to
each other, near to nothing, have no words (so the mix takes none of them) and no pieces. Documents that
the mix takes twice are there twice. Rows that repeat a doc_id are the same document and share its fate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatnorm.llm import exact_dedup, mixing, near_dup, piece_sampling, toxicity
from chatnorm.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn toxicity from the labelled documents, and drop what scores 0.5 or more."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_harmless(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similarities of 0.75 and more the one with the smallest id stays."""
    return near_dup.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of each document: ``doc_id, rank, n_pieces, pieces, log_prob, log_inclusion``."""
    samples = piece_sampling.sample_pieces(docs)
    return samples.select("doc_id", "rank", F.size("pieces").alias("n_pieces"), "pieces", "log_prob", "log_inclusion")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("encoding", encode),
]

#: SQL can't express the stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
