"""The pipeline: rules, near-duplicates, benchmark passages, personal data, pieces.

Each stage takes (spark, docs, sf_dir). All but the last return the columns of
``documents``; the last returns the pieces of each text that is left. SQL can't
express the stages' models, so there is no ``ORACLE_SQL``; the stages are tested
against brute force.

Null and empty texts fail the base rules and go in the first stage; a stage that gets
some by itself keeps them. Of repeated rows and of ties by id one row stays after the
second stage. Texts are read whole, however long. Columns of any name stay in all
stages but the last. Of an empty table every stage's result is empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loamline.llm import decontamination, near_dedup, pieces, pii, quality_rules
from loamline.llm.common import stored, table


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the learned list reject go."""
    return quality_rules.kept_rows(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of copies stays."""
    return near_dedup.one_of_each(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out; a document that is half of them goes."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are replaced by the name of their kind."""
    return pii.redacted(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every text: their number, the hash of their ids, and whether decoding gives the text."""
    return pieces.pieces_of(docs.select("doc_id", "text"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_passages),
    ("pii", personal_data),
    ("sentencepiece", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
