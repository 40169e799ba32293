from __future__ import annotations

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs_of(spark):
    """A documents table of (doc_id, text, source) rows."""

    def make(rows):
        return spark.createDataFrame(
            [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], DOCS
        )

    return make


@pytest.fixture(scope="session")
def small_docs(spark):
    """The whole documents table of the smallest test data, with rows of the hard cases added."""
    base = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    longest = "the quick brown fox jumps over a lazy dog and " * 4000
    cases = [
        (10_000, None, "en", None, None),
        (10_001, "", "en", None, 0),
        (10_002, " \t\n\x0b\x0c\r ", "de", "src0", 7),
        (10_003, longest, "en", "src0", len(longest)),
        (10_003, longest, "en", "src0", len(longest)),
        (None, "a document without an id, kept like any other", "en", "src1", 45),
        (10_004, "x  y z   \U0001f600 <|endoftext|> SPDX-License-Identifier: MIT", None, "é", 50),
    ]
    return base.unionByName(spark.createDataFrame(cases, DOCS)).withColumn("label", F.lit(1)).withColumn("key", F.lit("clash"))
