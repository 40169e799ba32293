"""Token counts from flat, unindexed token files by a separator scan.

``write_token_files`` writes each partition of a table as one flat file of
unsigned 16-bit ids, each document closed by the end-of-document id; nothing in
the files records where a document begins. ``scan_token_files`` reads such
files in blocks of ids, finds the separators of a block with one vectorised
comparison, and stitches documents that cross blocks with a prefix scan over
the blocks of a file: a running maximum gives the last separator before a
block, a running sum the number of documents closed before it.

Files are plain or gzip streams, in any store that Arrow's file systems open
(shared mounts, HDFS, object stores). Plain files are dealt out by blocks, each
task reading only the bytes of its blocks, whatever the size of a file; a gzip
file is one stream, read by one task with one block in memory.

Defined cases: a null or empty text is a document of 0 tokens; a text of any
length is one document, across as many blocks as it takes; repeated rows and
null ``doc_id``s count like any other row, each in its own place; extra columns
are ignored; an empty table gives no rows; ids after a file's last separator
form a document with ``closed`` false; a file of odd length raises an error.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from ..sources.shared import materialize, shared_path
from .tokens import DEFAULT_TOKENIZER, encoder

END_ID = 50256
#: Ids of a block.
BLOCK = 1 << 20
#: Bytes of plain files that a task scans.
TASK_BYTES = 64 << 20


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str = DEFAULT_TOKENIZER, end_id: int = END_ID, compression: str | None = "gzip"
) -> DataFrame:
    """Write the ids of ``docs.text`` as flat files, and return (doc_id, file_name, document): where each row went.

    A task writes one file, its rows in order, and hands on each row's place in
    the same pass; so the places hold however ``docs`` is split when it is read
    again. A file's name is its attempt's own, and the places, a table written
    by Spark, name the files of the attempts that counted; a file left by a
    lost or repeated attempt is named by no row.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, 2, True).encode
        separator = int(end_id).to_bytes(2, "little")
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.ids"
        out, n = None, 0
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                if out is None:
                    system, folder = _open(path)
                    system.create_dir(folder, recursive=True)
                    out = system.open_output_stream(f"{folder}/{name}", compression=compression)
                for text in batch.column(1).to_pylist():
                    out.write(encode(text))
                    out.write(separator)
                places = pa.array(range(n, n + batch.num_rows), pa.int64())
                n += batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([name] * batch.num_rows), places], names=["doc_id", "file_name", "document"]
                )
        finally:
            if out is not None:
                out.close()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return materialize(rows.mapInArrow(write, "doc_id long, file_name string, document long"), "token-places")


def _blocks(stream: BinaryIO, block: int) -> Iterator[np.ndarray]:
    """The ids of a file in blocks, reading and decompressing as it goes."""
    gzipped = stream.read(2) == b"\x1f\x8b"
    stream.seek(0)
    inflate, rest, kept = zlib.decompressobj(31), b"", bytearray()
    while True:
        if not gzipped:
            kept += stream.read(2 * block)
        else:
            while len(kept) < 2 * block and (rest := rest or stream.read(1 << 20)):
                kept += inflate.decompress(rest, 2 * block - len(kept))
                rest = inflate.unused_data if inflate.eof else inflate.unconsumed_tail
                if inflate.eof:  # the next member of the stream
                    inflate = zlib.decompressobj(31)
        if len(kept) % 2:
            raise ValueError("a token file holds whole 16-bit ids")
        if not kept:
            return
        yield np.frombuffer(bytes(kept), dtype="<u2")
        kept.clear()


def _separator_row(file: str, number: int, ids: np.ndarray, end_id: int) -> pa.RecordBatch:
    found = np.flatnonzero(ids == end_id).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([file]),
            pa.array([number], type=pa.int64()),
            pa.array([len(ids)], type=pa.int64()),
            pa.array([found], type=pa.list_(pa.int32())),
        ],
        names=["file", "block", "n_ids", "found"],
    )


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path as Spark gives it, and the path there."""
    if path.startswith("file:") or "://" not in path:
        return pafs.LocalFileSystem(), re.sub("^file:(//(?=/))?", "", path)
    return pafs.FileSystem.from_uri(path)


def _block_counts(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """(file, blocks) of plain files, one block -1 for a gzip stream."""
    for batch in batches:
        files, lengths = (c.to_pylist() for c in batch.columns)
        counts = []
        for file, length in zip(files, lengths):
            system, at = _open(file)
            with system.open_input_file(at) as stream:
                gzipped = stream.read(2) == b"\x1f\x8b"
            if not gzipped and length % 2:
                raise ValueError("a token file holds whole 16-bit ids")
            counts.append(-1 if gzipped else -(-length // (2 * block)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(files, type=pa.string()), pa.array(counts, type=pa.int64())], names=["file", "blocks"]
        )


def _block_separators(batches: Iterator[pa.RecordBatch], end_id: int, block: int) -> Iterator[pa.RecordBatch]:
    """The separators of single blocks, of all blocks for block -1."""
    for batch in batches:
        for file, number in zip(*(c.to_pylist() for c in batch.columns)):
            system, at = _open(file)
            with system.open_input_file(at) as stream:
                if number < 0:
                    for k, ids in enumerate(_blocks(stream, block)):
                        yield _separator_row(file, k, ids, end_id)
                else:
                    stream.seek(2 * block * number)
                    yield _separator_row(file, number, np.frombuffer(stream.read(2 * block), dtype="<u2"), end_id)


def _file_blocks(spark: SparkSession, path: str, end_id: int, block: int) -> DataFrame:
    """(file, block, n_ids, found) of each block of each file, written.

    Blocks are dealt out one by one whatever the sizes of the files; a gzip
    stream is one row, read by one task block by block.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    total = files.agg(F.sum("length")).first()[0] or 0
    counts = files.mapInArrow(lambda batches: _block_counts(batches, block), "file string, blocks long")
    numbers = F.when(F.col("blocks") < 0, F.array(F.lit(-1).cast("long"))).otherwise(
        F.sequence(F.lit(1).cast("long"), F.col("blocks"))
    )
    some = counts.where(F.col("blocks") != 0).select("file", F.explode(numbers).alias("number"))
    block_number = F.when(F.col("number") < 0, F.col("number")).otherwise(F.col("number") - 1)
    tasks = max(shuffle_partitions(spark), 1 + total // TASK_BYTES)
    dealt = some.select("file", block_number.alias("block")).repartition(tasks)
    row = "file string, block long, n_ids long, found array<int>"
    return materialize(dealt.mapInArrow(lambda batches: _block_separators(batches, end_id, block), row), "separators")


def scan_token_files(spark: SparkSession, path: str, end_id: int = END_ID, block: int = BLOCK) -> DataFrame:
    """One row per document: file, document (0, 1, .. in the file), start, n_tokens, closed."""
    blocks = _file_blocks(spark, path, end_id, block)
    base = F.col("block") * block
    # Three numbers a block are scanned; the separators themselves stay where they are.
    narrow = blocks.select(
        "file", "block", (base + F.try_element_at("found", F.lit(-1))).alias("top"), F.size("found").alias("n_found")
    )
    in_file = Window.partitionBy("file").orderBy("block")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    scanned = narrow.select(
        "file",
        "block",
        F.coalesce(F.max("top").over(before), F.lit(-1)).alias("last"),
        F.coalesce(F.sum("n_found").over(before), F.lit(0)).alias("closed_before"),
        F.lead("block").over(in_file).isNull().alias("is_last"),
    )
    stitched = blocks.join(scanned, ["file", "block"])
    ends = F.transform("found", lambda x: base + x)
    # A file's ids after its last separator are a document without an end.
    last_end = F.coalesce(base + F.try_element_at("found", F.lit(-1)), F.col("last"))
    open_end = F.when(F.col("is_last") & (last_end < base + F.col("n_ids") - 1), F.array(base + F.col("n_ids"))).otherwise(
        F.array().cast("array<long>")
    )
    closed = F.col("at") < F.size("found")
    return (
        stitched.withColumn("ends", F.concat(ends, open_end))
        .select("*", F.concat(F.array("last"), "ends").alias("befores"))
        .select("file", "closed_before", "found", "befores", F.posexplode("ends").alias("at", "end"))
        .select(
            "file",
            (F.col("closed_before") + F.col("at")).alias("document"),
            (F.get("befores", F.col("at")) + 1).alias("start"),
            (F.col("end") - F.get("befores", F.col("at")) - 1).alias("n_tokens"),
            closed.alias("closed"),
        )
    )


def token_counts(docs: DataFrame, tokenizer: str = DEFAULT_TOKENIZER, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_tokens, file_name, document) of each row of ``docs``, counted in its token files."""
    path = shared_path(docs.sparkSession, "token-files")
    places = write_token_files(docs, path, tokenizer)
    if places.isEmpty():
        return docs.sparkSession.createDataFrame([], "doc_id long, n_tokens long, file_name string, document long")
    counted = scan_token_files(docs.sparkSession, path, block=block).select(
        F.regexp_extract("file", r"([^/]+)$", 1).alias("file_name"), "document", "n_tokens"
    )
    missing = F.raise_error(F.lit("a document is not in the token files")).cast("long")
    return places.join(counted, ["file_name", "document"], "left").select(
        "doc_id", F.coalesce("n_tokens", missing).alias("n_tokens"), "file_name", "document"
    )
