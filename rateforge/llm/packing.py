"""Packing documents into training sequences by Karmarkar-Karp differencing.

Each task streams its partition: a document longer than a sequence fills whole
sequences at once, its rest is cut into pieces of at most ``piece`` tokens.
When the pieces of a batch reach ``batch_windows`` sequences, multiway
differencing spreads them over windows: the two partial partitions with the
largest imbalance are merged with opposing order until one is left. The number
of windows starts at the least possible and rises while one exceeds the
capacity. Work is narrow (no shuffle), memory is bounded by a batch and the
longest document, and a lost task is redone from its own input.

Defined cases: a null or empty text is the end id alone; repeated rows and null
``doc_id``s are packed like any other row; extra input columns are ignored; an
empty table gives no rows; equal sizes are merged in input order.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tokens import DEFAULT_TOKENIZER, encoder

CAPACITY = 2048
#: Largest piece of a document's rest, in tokens: about four pieces a window
#: leave the differencing enough freedom to balance.
PIECE = 512
#: Windows of a batch: one part-filled window in so many is padding.
BATCH_WINDOWS = 128
END_ID = 1

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)


def multiway_differencing(sizes: list[int], ways: int) -> list[int]:
    """The window (0 .. ways - 1) of each item; the sums come out near equal.

    A partial partition holds its ``ways`` sums in descending order. Merging
    adds one's largest sum to the other's smallest; ``order`` remembers where
    each sum came from, so that the windows of the items follow from the root.
    """
    heap: list[tuple[int, int, np.ndarray, object]] = []
    for i, size in enumerate(sizes):
        sums = np.zeros(ways, dtype=np.int64)
        sums[0] = size
        heap.append((-(size if ways > 1 else 0), i, sums, i))
    heapq.heapify(heap)
    serial = len(sizes)
    while len(heap) > 1:
        _, _, a, left = heapq.heappop(heap)
        _, _, b, right = heapq.heappop(heap)
        merged = a + b[::-1]
        order = np.argsort(-merged, kind="stable")
        merged = merged[order]
        heapq.heappush(heap, (int(merged[-1] - merged[0]), serial, merged, (left, right, order)))
        serial += 1
    windows = [0] * len(sizes)
    todo = [(heap[0][3], np.arange(ways))] if heap else []
    while todo:
        node, at = todo.pop()
        if isinstance(node, int):
            windows[node] = int(at[0])
            continue
        left, right, order = node
        from_left = np.empty(ways, dtype=np.int64)
        from_left[order] = at
        todo.append((left, from_left))
        todo.append((right, from_left[::-1]))
    return windows


def balanced_windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """Item indexes of each window; one window more whenever one is too full."""
    ways = max(1, -(-sum(sizes) // capacity))
    while True:
        loads = [0] * ways
        members: list[list[int]] = [[] for _ in range(ways)]
        for i, w in enumerate(multiway_differencing(sizes, ways)):
            loads[w] += sizes[i]
            members[w].append(i)
        if max(loads) <= capacity:
            return [m for m in members if m]
        ways += 1


def _pack_partition(
    batches: Iterator[pa.RecordBatch], tokenizer: str, capacity: int, piece: int, batch_windows: int, end_id: int
) -> Iterator[pa.RecordBatch]:
    encode = encoder(tokenizer).encode
    end = np.array([end_id], dtype="<u4").tobytes()
    sequence = TaskContext.get().partitionId() << 33
    schema = pa.schema(
        [(f.name, pa.binary() if f.name == "ids" else pa.int64()) for f in PIECES.fields]
    )
    rows: list[tuple] = []
    waiting: list[tuple] = []
    waiting_tokens = 0

    def packed() -> None:
        nonlocal sequence, waiting, waiting_tokens
        for members in balanced_windows([len(w[3]) // 4 for w in waiting], capacity):
            offset = 0
            for i in members:
                doc, start, total, ids = waiting[i]
                rows.append((doc, start, total, sequence, offset, ids))
                offset += len(ids) // 4
            sequence += 1
        waiting, waiting_tokens = [], 0

    def emit() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array(col, type=f.type) for col, f in zip(zip(*rows), schema)], schema=schema
        )
        rows.clear()
        return out

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids = encode(text) + end
            total = len(ids) // 4
            whole = total // capacity * capacity
            for start in range(0, whole, capacity):
                rows.append((doc, start, total, sequence, 0, ids[4 * start : 4 * (start + capacity)]))
                sequence += 1
            for start in range(whole, total, piece):
                cut = ids[4 * start : 4 * min(start + piece, total)]
                waiting.append((doc, start, total, cut))
                waiting_tokens += len(cut) // 4
            if waiting_tokens >= batch_windows * capacity - piece:
                packed()
            if len(rows) >= 2000:
                yield emit()
    if waiting:
        packed()
    if rows:
        yield emit()


def pack(
    docs: DataFrame,
    tokenizer: str = DEFAULT_TOKENIZER,
    capacity: int = CAPACITY,
    piece: int = PIECE,
    batch_windows: int = BATCH_WINDOWS,
    end_id: int = END_ID,
) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) in sequences of at most ``capacity`` tokens.

    Columns: doc_id, start (the document's ids before the piece), doc_tokens
    (all its ids, end id included), sequence_id, offset (place in the
    sequence), ids (little-endian unsigned 32-bit, as bytes).
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        lambda batches: _pack_partition(batches, tokenizer, capacity, piece, batch_windows, end_id), PIECES
    )
