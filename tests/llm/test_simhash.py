"""SimHash near-duplicates against brute force."""

from __future__ import annotations

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from rateforge.llm import simhash
from rateforge.llm.components import components


def brute_fingerprint(text, n=4):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_components(rows, radius):
    """(id, fp) rows -> smallest id reachable, by comparing all pairs."""
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= radius:
                parent[root(i)] = root(j)
    out = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            out[root(i)] = min(out.get(root(i), doc), doc)
    return [out.get(root(i)) for i in range(len(rows))]


def test_whole_table_against_brute_force(small_docs):
    rows = [(r.doc_id, brute_fingerprint(r.text)) for r in small_docs.collect()]
    expected = sorted(zip([str(d) for d, _ in rows], [f"{f:016x}" for _, f in rows], map(str, brute_components(rows, 4))))
    got = simhash.near_duplicates(small_docs).select("doc_id", simhash.hex_digits(F.col("fp")).alias("f"), "component_id")
    assert sorted((str(r[0]), r[1], str(r[2])) for r in got.collect()) == expected


@pytest.mark.parametrize("limit", [2048, 8])
def test_links_of_dense_groups(spark, monkeypatch, limit):
    """Groups of near codes, with shards cut into parts: same components as all pairs."""
    monkeypatch.setattr(simhash, "SHARD_LIMIT", limit)
    rnd = random.Random(3)
    codes = {0, (1 << 64) - 1}
    for _ in range(6):
        centre = rnd.getrandbits(64)
        for _ in range(40):
            codes.add(centre ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 5))))
    codes = sorted(codes)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    frame = spark.createDataFrame([(c,) for c in signed], "fp long")
    labels = {r.node: r.label for r in components(simhash.links(frame, len(codes))).collect()}
    groups = {}
    for c, g in zip(signed, brute_components(list(enumerate(codes)), 4)):
        groups.setdefault(g, []).append(c)
    for members in groups.values():
        assert {labels.get(m, m) for m in members} == {min(members)}


def test_bk_tree_search():
    rnd = random.Random(5)
    codes = [rnd.getrandbits(12) for _ in range(300)]
    tree = simhash.BKTree()
    for c in set(codes):
        tree.add(c)
    for q in range(0, 4096, 37):
        assert {tree.codes[i] for i in tree.within(q, 2)} == {c for c in codes if (c ^ q).bit_count() <= 2}


def test_block_count_grows():
    assert simhash.key_blocks(0) == simhash.key_blocks(200_000) == 5
    assert simhash.key_blocks(10_000_000) == 6
    assert simhash.key_blocks(10**12) <= 16


def test_keep_first(small_docs):
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(small_docs).collect()}
    kept = simhash.keep_first(small_docs)
    assert kept.columns == small_docs.columns
    rows = kept.collect()
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == sorted({v for v in found.values() if v is not None})
    texts = {r.doc_id: r.text for r in small_docs.collect()}
    assert all(texts[r.doc_id] == r.text for r in rows)


def test_nulls_and_empty(spark, docs_of):
    rows = docs_of([(None, None, None), (None, "", "a"), (7, "alpha beta gamma delta epsilon", "a"), (7, "alpha beta gamma delta epsilon", "a")])
    kept = [r.doc_id for r in simhash.keep_first(rows).collect()]
    assert sorted(map(str, kept)) == ["7", "None"]
    assert simhash.near_duplicates(rows.limit(0)).count() == 0
    assert simhash.keep_first(rows.where("false")).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, i) for i in range(1001, 1300)]
    links = spark.createDataFrame([*chain, *star, (5000, 5000), (None, 3), (2, None)], "x long, y long")
    labels = {r.node: r.label for r in components(links).collect()}
    assert all(labels[i] == 0 for i in range(201))
    assert all(labels[i] == 1000 for i in range(1000, 1300))
    assert labels[5000] == 5000 and len(labels) == 201 + 300 + 1
