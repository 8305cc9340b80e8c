"""The corpus pipeline: from raw documents to a mixture for training.

Each stage reads all that its predecessor kept. The first four return the columns of `documents`, the last
one the mixture: one row per document and epoch with its block and place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paywatch.llm.common import table
from paywatch.llm.exact_dedup import drop_copies
from paywatch.llm.factorisation import drop_low_quality, train_machine
from paywatch.llm.mixing import mixture
from paywatch.llm.simhash import drop_near_copies
from paywatch.llm.wu_manber import drop_contaminated
from paywatch.session import Scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels outside its held-out fold."""
    return drop_low_quality(docs, train_machine(docs, table(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every content."""
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group linked by SimHash fingerprints of three-word shingles, two bits apart at most."""
    return drop_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture of sources; every document is shown once at least, none more often than the limit."""
    return mixture(docs)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("near-duplicate removal", near),
    ("benchmark decontamination", decontaminate),
    ("source mixing", mix),
]

#: A trained classifier decides first, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = scratch.write(docs, f"stage{number}")
    return docs
