"""The pipeline, its registration, and the SQL of the operators."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from oracle_compare import compare

import __spark_entry__
import corpus_pipeline
from rateforge.llm import queries

from .test_quality import brute_judge
from .test_simhash import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    ok, said = compare(spark, SF, name, queries.QUERIES[name], queries.ORACLE_SQL[name])
    assert ok, said


def test_registered():
    names = [*__spark_entry__.queries()]
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(bool(re.match(rf"op{n}_", x)) for x in names) == 1


def test_stages_in_order_against_brute_force(spark):
    """Each stage on all that its predecessor kept, checked against plain Python."""
    docs = queries.read(spark, SF, "documents")
    frame, rows = docs, docs.collect()
    (n1, quality), (n2, dedup), (n3, mix), (n4, pack) = corpus_pipeline.STAGES
    judged = brute_judge([(r.doc_id, r.text, r.source) for r in rows], 10, 50, 0.5)
    frame = quality(spark, frame, SF)
    assert frame.columns == COLUMNS and frame.dtypes == docs.dtypes
    kept = frame.collect()
    assert Counter(str(r.doc_id) for r in kept) == Counter(d for d, *_, ok in judged if ok)

    frame = dedup(spark, frame, SF)
    assert frame.columns == COLUMNS and frame.dtypes == docs.dtypes
    codes = [(r.doc_id, brute_fingerprint(r.text)) for r in kept]
    single = frame.collect()
    assert sorted(r.doc_id for r in single) == sorted(set(brute_components(codes, 4)))

    mixed_frame = mix(spark, frame, SF)
    assert mixed_frame.columns == COLUMNS and mixed_frame.dtypes == docs.dtypes
    mixed = mixed_frame.collect()
    texts = {r.doc_id: r.text for r in single}
    assert all(texts[r.doc_id].startswith(r.text) for r in mixed)
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    total = sum(words(t) for t in texts.values())
    assert abs(sum(words(r.text) for r in mixed) - 1.5 * total) <= 25

    pieces = pack(spark, mixed_frame, SF).collect()
    loads = defaultdict(int)
    for p in pieces:
        loads[p.sequence_id] += p.length
    assert max(loads.values()) <= 2048 and sum(p.start == 0 for p in pieces) == len(mixed)


def test_run_gives_the_last_stage(spark):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_stages_take_an_empty_table(spark):
    frame = queries.read(spark, SF, "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, frame, SF).count() == 0


def test_stages_take_hard_cases(spark, small_docs, docs_of):
    """Nulls, repeated rows, long texts and clashing columns, through all stages one after the other."""
    body = " ".join(f"word{i}" for i in range(80))
    long = " ".join(f"long{i % 9000}x{i}" for i in range(60_000))
    extra = docs_of([
        (20_000, body, "src0"), (20_000, body, "src0"), (None, body, "src1"), (20_001, long, None),
        (None, " ".join(f"other{i}" for i in range(70)), None), (20_002, None, "src0"),
    ])
    extra = extra.selectExpr("*", "1 AS label", "'clash' AS key")
    frame = small_docs.unionByName(extra)
    columns = frame.columns
    (_, quality), (_, dedup), (_, mix), (_, pack) = corpus_pipeline.STAGES

    frame = quality(spark, frame, SF)
    kept = frame.collect()
    assert frame.columns == columns
    assert sum(r.text == body for r in kept) == 3 and sum(r.text == long for r in kept) == 1
    assert all(r.text is not None for r in kept)

    frame = dedup(spark, frame, SF)
    single = frame.collect()
    assert frame.columns == columns
    # of the repeated rows and the one without an id, the row with the id, once
    assert [(r.doc_id, r.source) for r in single if r.text == body] == [(20_000, "src0")]
    assert sum(r.doc_id is None for r in single) == 1 and any(r.text == long for r in single)

    frame = mix(spark, frame, SF)
    mixed = frame.collect()
    assert frame.columns == columns and {r.key for r in mixed} == {"clash"}
    assert {r.source for r in mixed} == {r.source for r in single}

    pieces = pack(spark, frame, SF).collect()
    assert sum(p.start == 0 for p in pieces) == len(mixed)
