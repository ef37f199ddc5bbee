"""From raw documents to token ids: rules, line and document deduplication, mix, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, lines, mixing, quality, simhash
from tidemark.llm.queries import VOCABULARY, table
from tidemark.session import materialise, ship_package


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, as they are."""
    ship_package(spark)
    return quality.passing(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that are equal or one word apart from earlier ones."""
    return lines.cleaned(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near duplicates."""
    ship_package(spark)
    return simhash.representatives(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them; one per source is cut at the budget."""
    return mixing.mix(docs)


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and hashes of the ids and of the decoded text of every row of the mix."""
    ship_package(spark)
    return bpe.digests(docs, VOCABULARY)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("source_mix", source_mix),
    ("bpe_encode", bpe_encode),
]

#: SimHash needs XXH64, which this SQL does not have; the tests run the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
