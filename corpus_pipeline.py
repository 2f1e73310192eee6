"""The corpus pipeline: from raw documents to packed training sequences, each stage written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from msgstream.llm import linededup, mixing, neardup, registry, toxicity
from msgstream.llm.common import table
from msgstream.scratch import stored


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not reject."""
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand on many sites, however little is left; each such line stays where it is first."""
    return linededup.without_boilerplate(docs, least_left=0).select(*[f"`{c}`" for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: word runs of five, likeness 0.8."""
    return neardup.one_of_each(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences."""
    return registry.packed(docs)


STAGES = [
    ("toxicity", toxicity_filter),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", source_mixing),
    ("packing", packing),
]

# SQL expresses neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over all documents; what one returns is written to the shared folder and read as the next one's."""
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        rows = stored(stage(spark, rows, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, rows, sf_dir)
