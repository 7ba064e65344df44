"""Corpus preparation: the stages that turn ``documents`` into packed training sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm.exact_dedup import drop_copies
from lakeloom.llm.mix_sources import mixed_documents
from lakeloom.llm.packing import pack
from lakeloom.llm.quality import keep_good, train
from lakeloom.llm.simhash import drop_near_copies
from lakeloom.session import Scratch, discard

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier scores 0.7 or more, learned from the labels that are not held out."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), max_rows=20_000)
    return keep_good(docs, model, keep_from=0.7)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal without white space."""
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of SimHash fingerprints connect."""
    return drop_near_copies(docs, shingle=3, distance=2)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents with their places in sequences."""
    return pack(docs, capacity=2048)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("simhash near-dedup", near),
    ("mix sources", mixed),
    ("pack sequences", packed),
]

# The classifier is fitted and the packing solved in Python, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``; what one stage keeps is written and read by the next.

    What a stage wrote on its way, and what the stage before kept, is deleted as soon as its own result is written.
    """
    docs, kept = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        with Scratch(spark) as scratch:
            docs = scratch.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if kept is not None:
            discard(kept)
        kept = docs
    return STAGES[-1][1](spark, docs, sf_dir)
