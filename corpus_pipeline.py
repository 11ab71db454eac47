"""Five stages over ``documents``: quality rules, near duplicates, repeated passages, benchmark
leaks, segmentation.  Each stage's result is written as Parquet and read again by the next.

Order and effect: texts that fail the rules go; one document of each near-duplicate group stays;
later copies of repeated passages are cut out of the texts; documents with benchmark passages
go; what is left is segmented.  All but the last stage return the columns of ``documents``.

Defined cases: a stage keeps rows with a null doc_id like any other; null texts fail the rules
of the first stage; rows repeated whole become one in the second; an empty table stays empty.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from barledger.llm import divergence, nbest, suffix_dedup, superminhash, templates  # noqa: E402
from barledger.llm.common import ship, staged, table  # noqa: E402

#: Bytes of a repeated passage: below the length of fifty words.
PASSAGE_BYTES = 200


def _rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return divergence.keep_good(docs)


def _near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return superminhash.keep_first(docs)


def _passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return suffix_dedup.remove_later_copies(docs, PASSAGE_BYTES)


def _leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return templates.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def _pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return nbest.encoded(docs)


STAGES = [
    ("quality rules", _rules),
    ("near duplicates", _near),
    ("repeated passages", _passages),
    ("benchmark leaks", _leaks),
    ("segmentation", _pieces),
]

#: Hash signatures, suffix order and lattices have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
