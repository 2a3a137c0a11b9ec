"""From raw documents to packed token sequences.

STAGES lists the stages in order; each takes (spark, docs, sf_dir), where docs is what the stage before kept, and
returns what it keeps. run() applies them to the table documents, each written and read again before the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm import decontamination, jaccard, langid, line_dedup, packing
from contrail.llm.common import written
from contrail.llm.queries import SITES, table, vocabulary

#: The least posterior at which a document's language counts as known.
LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters and those whose language stays open go."""
    model = langid.train(docs.where(~langid.held_out()))
    found = langid.identify(docs, model)
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, without the lines that stand on many sites; n_chars follows the text."""
    found = line_dedup.remove_boilerplate(docs, sites=SITES).select(*docs.columns)
    return found.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else found


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group that links of four fifths of their five-word shingles join."""
    return jaccard.keep_one(docs).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go of whose words a twentieth or more lies in benchmark passages."""
    found = decontamination.scan(docs, table(spark, sf_dir, "benchmark"), window=13)
    return found.where(~decontamination.contaminated()).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their ids."""
    return packing.pack(docs, vocabulary(), capacity=2048, end_id=1)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_boilerplate),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: Near-duplicate components and token ids have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
