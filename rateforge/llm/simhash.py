"""SimHash near-duplicates: fingerprints, sharded BK-trees, connected components.

A fingerprint has a bit set where over half the hashes of a document's word
shingles have it. Equal fingerprints are made one first; a group of thousands
of copies is then a single entry. Two fingerprints of at most ``radius``
differing bits agree on at least ``blocks - radius`` of ``blocks`` bit blocks,
so each choice of that many blocks is a shard key and every linked pair meets
in some shard. The keys grow with the number of fingerprints (``key_blocks``),
which holds a shard's expected size; a shard above ``SHARD_LIMIT`` entries
(many near copies) is cut into parts, and every two parts meet in a cell.

In a cell, the entries of one part form a BK-tree: children are keyed by their
Hamming distance to the parent, and a search follows only the edges within the
radius of its own distance. A cell passes on a spanning forest of its links
(at most one link an entry), never all pairs of a group. Trees travel to the
tasks that hold their queries; none is broadcast to all, since together they
grow with the data.

Defined cases: a null or empty text, or one without words, has fingerprint 0
and is linked like any other; a null ``doc_id`` never names a component unless
all its documents have none (then null); repeated rows share fingerprint and
component; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from ..sources.shared import materialize
from .components import components

SHINGLE = 4
RADIUS = 4
BITS = 64
SEED = 42
#: Entries expected under one shard key, at most.
SHARD_SIZE = 64
#: Entries of a shard beyond which it is cut into parts.
SHARD_LIMIT = 2048
#: Shingles hashed at once.
CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a whole text (shingles with repeats; no words: 0)."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and the six ASCII spaces only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))
    n = max(1, len(words) - shingle + 1)
    last = ends[shingle - 1 :] - 1 if len(words) >= shingle else ends[-1:] - 1
    digest, seed = xxhash.xxh64_intdigest, SEED
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, CHUNK):
        spans = zip(starts[at : min(at + CHUNK, n)].tolist(), last[at : at + CHUNK].tolist())
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [fingerprint(t, shingle) for t in batch.column(2).to_pylist()]
        signed = pa.array(np.array(values, dtype=np.uint64).view(np.int64))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), signed], names=["doc_id", "key", "fp"])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, key, fp): fp is the fingerprint as a signed long, key a hash of the text."""
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(text).alias("key"), text.alias("text"))
    return rows.mapInArrow(lambda batches: _fingerprints(batches, shingle), "doc_id long, key long, fp long")


def text_key(text: Column) -> Column:
    return F.xxhash64(text)


def key_blocks(entries: int, radius: int = RADIUS, shard_size: int = SHARD_SIZE) -> int:
    """The least number of blocks whose shard keys hold ``shard_size`` entries or fewer on average."""
    blocks = radius + 1
    while blocks < BITS // 4 and entries >> (BITS // blocks * (blocks - radius)) > shard_size:
        blocks += 1
    return blocks


def shard_keys(fp: Column, blocks: int, radius: int = RADIUS) -> Column:
    """An array with a key for each choice of ``blocks - radius`` bit blocks."""
    bounds = [BITS * i // blocks for i in range(blocks + 1)]
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << bounds[b + 1]) - (1 << bounds[b])) for b in chosen)
        mask -= (mask >> 63) << 64
        keys.append(F.struct(F.lit(number).alias("choice"), fp.bitwiseAND(F.lit(mask).cast("long")).alias("value")))
    return F.array(*keys)


class BKTree:
    """Codes by Hamming distance: the children of a node are keyed by their distance to it."""

    def __init__(self) -> None:
        self.codes: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, code: int) -> None:
        number = len(self.codes)
        self.codes.append(code)
        self.children.append({})
        at = 0
        while at != number:
            at = self.children[at].setdefault((self.codes[at] ^ code).bit_count(), number)

    def within(self, code: int, radius: int) -> list[int]:
        """Numbers of the codes within ``radius``; only edges that may lead to one are followed."""
        found, todo = [], [0] if self.codes else []
        while todo:
            at = todo.pop()
            distance = (self.codes[at] ^ code).bit_count()
            if distance <= radius:
                found.append(at)
            for edge, child in self.children[at].items():
                if distance - radius <= edge <= distance + radius:
                    todo.append(child)
        return found


def cell_links(parts: dict[int, list[int]], radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links within a cell's part, or between its two parts."""
    first, *second = [sorted(parts[p]) for p in sorted(parts)]
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    tree, links = BKTree(), []

    def link(code: int) -> None:
        for hit in tree.within(code, radius):
            a, b = root(tree.codes[hit]), root(code)
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((tree.codes[hit], code))

    for code in first:
        if not second:  # a part with itself: search what came before
            link(code)
        tree.add(code)
    for code in second[0] if second else ():
        link(code)
    return links


def _cells(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links of the cells of a sorted partition; a cell is a run of equal (choice, value, low, high)."""
    cell, parts = None, {}
    out: list[tuple[int, int]] = []

    def flush() -> Iterator[pa.RecordBatch]:
        pairs = np.array(out, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        out.clear()
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    def close() -> None:
        # A cell of two parts needs both; a part with itself has its own cell.
        if cell is not None and (cell[2] == cell[3] or len(parts) == 2):
            out.extend(cell_links(parts, radius))

    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for choice, value, low, high, part, fp in zip(*columns):
            if (choice, value, low, high) != cell:
                close()
                cell, parts = (choice, value, low, high), {}
                if len(out) > 50_000:
                    yield from flush()
            parts.setdefault(part, []).append(fp & 0xFFFFFFFFFFFFFFFF)
    close()
    yield from flush()


def links(codes: DataFrame, entries: int, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that join all fingerprints of distinct ``codes`` (fp) within ``radius`` bits."""
    keyed = codes.select("fp", F.inline(shard_keys(F.col("fp"), key_blocks(entries, radius), radius)))
    large = (
        keyed.groupBy("choice", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > SHARD_LIMIT)
        .select("choice", "value", F.ceil(F.col("n") / SHARD_LIMIT).cast("int").alias("n_parts"))
    )
    cut = keyed.join(materialize(large, "large-shards"), ["choice", "value"], "left").withColumn(
        "n_parts", F.coalesce("n_parts", F.lit(1))
    )
    part = F.pmod(F.xxhash64("fp"), F.col("n_parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("n_parts") - 1))
    cells = (
        cut.withColumn("part", part)
        .withColumn("other", other)
        .select(
            "choice",
            "value",
            F.least("part", "other").alias("low"),
            F.greatest("part", "other").alias("high"),
            "part",
            "fp",
        )
    )
    dealt = cells.repartition(shuffle_partitions(codes.sparkSession), "choice", "value", "low", "high").sortWithinPartitions("choice", "value", "low", "high", "fp")
    return dealt.mapInArrow(lambda batches: _cells(batches, radius), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, key, fp, component, component_id) of each row of ``docs`` (doc_id, text).

    component is the component's label, component_id the smallest doc_id among
    the rows that links reach, itself included. Text is read once; fingerprints, links and components
    stay in tables.
    """
    rows = materialize(fingerprints(docs, shingle), "fingerprints")
    codes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprint-codes")
    linked = materialize(links(codes.select("fp"), codes.count(), radius), "fingerprint-links")
    labels = components(linked)
    grouped = codes.join(labels, codes.fp == labels.node, "left").select(
        "fp", "first_id", F.coalesce("label", "fp").alias("label")
    )
    grouped = materialize(grouped, "labelled-codes")
    first = materialize(grouped.groupBy("label").agg(F.min("first_id").alias("component_id")), "component-ids")
    by_code = materialize(
        grouped.join(first, "label").select(F.col("fp").alias("code"), F.col("label").alias("component"), "component_id"),
        "fingerprint-components",
    )
    return rows.join(by_code, rows.fp == by_code.code, "inner").select("doc_id", "key", "fp", "component", "component_id")


def hex_digits(fp: Column) -> Column:
    """A fingerprint as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_first(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates, that with the smallest doc_id.

    The rows to drop are found first (few against the table) and removed by an
    anti join. Rows of one id are told apart by their text's hash; equal rows
    stay once.
    """
    found = materialize(near_duplicates(docs, shingle, radius), "near-duplicates")
    # nulls last, so that a document with an id stays where there is one
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    winners = found.groupBy("component").agg(F.min(order).alias("w")).select(F.col("w.doc_id").alias("w_id"), F.col("w.key").alias("w_key"))
    per_row = found.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("n"))
    won = F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("key") == F.col("w_key"))
    judged = per_row.join(winners, won, "left").withColumn("stays", F.col("w_key").isNotNull())
    # Of rows to drop, and of equal rows that stay once.
    special = materialize(
        judged.where(~F.col("stays") | (F.col("n") > 1)).select(
            F.col("doc_id").alias("_s_id"), F.col("key").alias("_s_key"), F.col("stays").alias("_s_stays")
        ),
        "dropped-documents",
    )
    columns = docs.columns
    rows = docs.select(
        F.struct(*[F.col(c).alias(c) for c in columns]).alias("_row"),
        F.col("doc_id").cast("long").alias("_id"),
        text_key(F.col("text").cast("string")).alias("_key"),
    )
    same = F.col("_id").eqNullSafe(F.col("_s_id")) & (F.col("_key") == F.col("_s_key"))
    single = rows.join(special, same, "left_anti").select("_row")
    repeated = rows.join(special.where("_s_stays"), same, "left_semi")
    once = repeated.groupBy("_id", "_key").agg(F.min("_row").alias("_row")).select("_row")
    return single.unionAll(once).select(*[F.col("_row").getField(c).alias(c) for c in columns])
