"""Token counts of documents in flat files of token ids that have no index.

A file is a run of unsigned little-endian numbers, of 16 bits or, for vocabularies of more ids, of 32, in which END_ID ends
each document. Blocks are searched for the
separator at once; a prefix sum of the separators before each block numbers the documents, and the parts of documents
that cross blocks are added up.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from onoma.llm.common import checkpoint, fresh_path, map_arrow
from onoma.llm.packing import _blocks, encoder

#: In files a tokenizer's id is one higher, so that 0 is free to end a document.
END_ID, SHIFT = 0, 1
#: Bytes of a block, and documents of a written file.
BLOCK_BYTES, FILE_DOCS = 1 << 20, 20_000
PART = "file string, block int, nth long, length long, ends boolean"


def width_of(vocabulary: str | None = None) -> int:
    """Bytes of an id in files of a vocabulary: 2 if that holds its ids, else 4."""
    return 2 if max(encoder(vocabulary).tokenizer.get_vocab().values(), default=0) + SHIFT < 1 << 16 else 4


def _encode(path: str | None, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in _blocks(batch.select([0, 0])):
                ids = [(x.astype(np.int64) + SHIFT).astype(f"<u{width}").tobytes() for x in encoder(path).encode_batch(b.column(0))]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], ["ids"])

    return run


def write_flat(docs: DataFrame, path: str, text_col: str = "text", vocabulary: str | None = None) -> int:
    """Token files of the documents: each text's ids, then END_ID; returns the bytes of an id, which the reader must know.

    Null and empty texts are empty documents, repeated rows are written each, an empty table writes none, other columns
    are ignored. Texts may be of any length and hold zero bytes, which are characters like any other. Part and file numbers follow the rows' places in the table, so reruns name the files alike.
    """
    width = width_of(vocabulary)
    ids = map_arrow(docs.select(F.col(text_col).cast("string").alias("text")), _encode(vocabulary, width), "ids binary")
    # The text writer puts a separator of zero bytes, which is END_ID, after each value.
    ids.select(F.col("ids").cast("string").alias("value")).write.option("lineSep", "\x00" * width).option("maxRecordsPerFile", FILE_DOCS).text(path)
    return width


def opened(path: str) -> pa.NativeFile:
    """A file of any store that Arrow knows, for reading at any place."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem().open_input_file("/" + unquote(path[5:]).lstrip("/"))
    store, inside = pafs.FileSystem.from_uri(path)
    return store.open_input_file(inside)


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, path, at, size) -> (file, block, content), a block at a time."""
    last, handle = None, None
    for b in batches:
        for r in b.to_pylist():
            if r["path"] != last:
                if handle is not None:
                    handle.close()
                last, handle = r["path"], opened(r["path"])
            content = handle.read_at(r["size"], r["at"])
            yield pa.RecordBatch.from_arrays([pa.array([r["file"]]), pa.array([r["block"]], pa.int32()), pa.array([content], pa.binary())], ["file", "block", "content"])


def _search(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """(file, block, content) -> (file, block, nth, length, ends): documents' parts in a block, in order."""
    for b in batches:
        for k in range(b.num_rows):
            ids = np.frombuffer(b.column(2)[k].as_buffer(), f"<u{width}")
            at = np.flatnonzero(ids == END_ID)
            lens = np.diff(np.concatenate([[-1], at])) - 1
            rest = len(ids) - (at[-1] + 1 if len(at) else 0)
            n = len(lens) + (rest > 0)
            ends = np.ones(n, bool)
            if rest > 0:
                lens, ends[-1] = np.append(lens, rest), False
            take = pa.array(np.full(n, k))
            yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), pa.array(np.arange(n)), pa.array(lens.astype(np.int64)), pa.array(ends)], ["file", "block", "nth", "length", "ends"])


def _known(path: str) -> bool:
    try:
        opened(path).close()
    except (OSError, pa.ArrowException):
        return False
    return True


def count_tokens(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES, width: int = 2) -> DataFrame:
    """(file, doc_no, n_tokens, complete): tokens of every document of the files under path, its separator not counted.

    file is the path below `path`, without the random part of Spark's names. Documents are numbered from 0 in each file.
    A last document without a separator is counted and not complete; a file without tokens gives no rows, nor does an
    empty folder; a torn last id is left out. width: bytes of an id, 2 or 4. Blocks of a file of any length are read by themselves, by tasks that
    share a file; where a store is one that only Spark can read, a task holds a whole file, up to Spark's 2 GiB.
    """
    block_bytes -= block_bytes % width
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).where(F.col("length") >= width)
    below = F.regexp_extract("path", "/" + re.escape(path.rstrip("/").rpartition("/")[2]) + "/(.+)$", 1)
    name = F.regexp_replace(F.coalesce(F.nullif(below, F.lit("")), F.regexp_extract("path", r"([^/]+)$", 1)), "-[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", "").alias("file")
    whole = F.col("length") - F.col("length") % width
    starts = F.posexplode(F.sequence(F.lit(0).cast("long"), whole - width, F.lit(block_bytes).cast("long"))).alias("block", "at")
    size = F.least(F.lit(block_bytes), whole - F.col("at")).alias("size")
    first = files.select("path").first()
    if first is None or _known(first.path):
        cut = files.select(name, "path", "length", starts).select("file", "block", "path", "at", size.cast("long").alias("size"))
        found = map_arrow(cut.repartition("path", "block"), lambda rows: _search(_ranges(rows), width), PART)
    else:
        cut = files.select(name, "content", "length", starts)
        found = map_arrow(cut.select("file", "block", F.substring("content", F.col("at").cast("int") + 1, size.cast("int")).alias("content")), lambda rows: _search(rows, width), PART)
    parts = checkpoint(found)
    # Documents that end in a block before this one: an exclusive prefix sum over a file's blocks.
    per = parts.groupBy("file", "block").agg(F.sum(F.col("ends").cast("long")).alias("ended"), F.max("nth").alias("last"))
    before = F.coalesce(F.sum("ended").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = parts.join(per.select("file", "block", before.alias("before"), "last"), ["file", "block"]).withColumn("doc_no", F.col("before") + F.col("nth"))
    edge = (F.col("nth") == 0) | (F.col("nth") == F.col("last"))
    stitched = numbered.where(edge).groupBy("file", "doc_no").agg(F.sum("length").alias("n_tokens"), F.max("ends").alias("complete"))
    return numbered.where(~edge).select("file", "doc_no", F.col("length").alias("n_tokens"), F.col("ends").alias("complete")).unionByName(stitched)


def corpus_counts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Counts of the documents' tokens, from flat files written in the shared folder."""
    path = fresh_path(docs.sparkSession, "tokens")
    width = write_flat(docs, path, vocabulary=vocabulary)
    return count_tokens(docs.sparkSession, path, width=width)
