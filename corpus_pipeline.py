"""The corpus pipeline: quality rules, line dedup, near-dedup, mixing, packing.

Each stage works on all rows that the one before kept; between stages the rows
are written as Parquet in the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandwise.llm import line_dedup, mixing, near_dedup, packing, quality
from strandwise.llm.common import materialise, table

#: Words of a block of the mixture; most documents then stay in a piece or two.
MIX_BLOCK_WORDS = 512


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality.keep_good(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines, and repeated lines of 50 words, leave the texts; a document that loses all its words goes."""
    return line_dedup.without_repeats(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return near_dedup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mixture takes them: a row for each piece of a
    document in a block, as often as the block is taken, with the piece's text."""
    return mixing.mixed_documents(docs, MIX_BLOCK_WORDS)


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.documents_as_items(docs))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("near_dedup", near_duplicates),
    ("mixing", mix_sources),
    ("best_fit_packing", pack_bins),
]

#: SQL can't express the greedy packing; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            docs = materialise(docs)
    return docs
