"""A training corpus from raw documents: quality, near copies, benchmark passages, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gaugeline.llm.catalogue import table
from gaugeline.llm.decontaminate import remove_contaminated
from gaugeline.llm.packing import pack_documents
from gaugeline.llm.quality import quality_scores
from gaugeline.llm.sketch_dedup import remove_near_duplicates
from gaugeline.llm.storage import stored


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    scored = quality_scores(docs, table(spark, sf_dir, "labels"))
    return scored.where("predicted = 1").select(*docs.columns)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return remove_near_duplicates(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of the benchmark go."""
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences."""
    return pack_documents(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", keep_distinct),
    ("benchmark decontamination", keep_uncontaminated),
    ("best-fit packing", pack),
]

#: SQL can express neither the fitted network nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
