"""A corpus pipeline over ``documents``: quality rules, near-duplicates, source mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet in the shared folder and read again as the next one's ``docs``. All
but the last return the columns of ``documents``.

Defined cases, beside those of the operators: nulls in any column pass through
(a null text has no words and fails the quality rules; a row without ``doc_id``
is judged by its own text and gives way to a near-duplicate with an id; a null
``source`` is a source); repeated rows are near-duplicates, of which one stays;
texts of any length are used whole; columns beyond those of ``documents``,
whatever their names, are carried on and dropped by the last stage; an empty
table gives no rows in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rateforge.llm import mixing, packing, quality, simhash
from rateforge.llm.queries import digests, read
from rateforge.sources.shared import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the lines that are too frequent at their host."""
    return quality.clean(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: a row for each time that a document is taken."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in training sequences."""
    return digests(packing.pack(docs))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: SQL has no SimHash components and no tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after the other, over the whole ``documents`` table."""
    docs = read(spark, sf_dir, "documents")
    *first, (_, last) = STAGES
    for name, stage in first:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return last(spark, docs, sf_dir)
