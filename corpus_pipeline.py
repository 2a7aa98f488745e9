"""A corpus from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and works on all documents that the one before it kept; its result is written and
read again as the next one's documents. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import read, written
from tripmill.llm.line_dedup import without_repeated_lines
from tripmill.llm.mixing import TARGETS, labelled_documents, mixed
from tripmill.llm.near_dedup import one_of_each
from tripmill.llm.packing import packing
from tripmill.llm.toxicity import toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the tagger predicts to be toxic go."""
    return toxicity(docs, read(spark, sf_dir, "labels"), carried=COLUMNS).where("predicted = 0").select(*COLUMNS)


def without_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, and with them documents that had nothing else; n_chars follows the text."""
    rows = without_repeated_lines(docs)
    return rows.where("n_removed < n_lines").withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity of 0.8 or more) the smallest doc_id stays."""
    return one_of_each(docs.select(*COLUMNS), n=5)


def at_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by their rate; no rate is below 1, so every document stays."""
    labelled = labelled_documents(docs, read(spark, sf_dir, "labels"))
    rows = mixed(docs, labelled, TARGETS, least=1.0)
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), "copies"))).select(*COLUMNS)


def into_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes."""
    return packing(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("line_dedup", without_lines),
    ("near_dedup", without_near_copies),
    ("mixing", at_target_weights),
    ("packing", into_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
