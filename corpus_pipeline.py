"""A training-corpus pipeline: five stages, each applying one of the operators.

Documents that the quality classifier rejects go; of exact copies one stays; of
near copies one stays; the sources are mixed to their target weights; what is
left is packed into training sequences. Every stage works on all that the stage
before it kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from prismset.llm import exactdedup, mixing, packing, quality, simhash
from prismset.llm.common import materialize
from prismset.session import table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ranking places above its threshold."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, whatever the ids."""
    return exactdedup.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, the one with the smallest id: SimHash links (four bits), and five-word similarity of 0.8."""
    return simhash.drop_near(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources mixed to their weights: repeated, cut or left out by blocks."""
    return mixing.mixed(docs)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents in sequences of at most 4096 ids."""
    return packing.pack(docs, words_held=100_000)  # workers and heap are as large here as the stages before have left them


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mix", mix_stage),
    ("pack", pack_stage),
]

#: Learning, fingerprints and tokenizing are beyond SQL; tests/llm compare the
#: stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
