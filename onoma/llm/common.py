"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from onoma.operators.storage import checkpoint, shared_dir  # noqa: F401  of the library, for all operators

#: A word: a run of anything but the ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of a batch that goes to Python: texts are long.
BYTES = 8 << 20
try:
    _libc = ctypes.CDLL("libc.so.6")
except OSError:  # another C library than GNU's
    _libc = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stash(df: DataFrame, name: str) -> DataFrame:
    """df written as a compressed table in the shared folder and read again."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, or others like them, that no column of df has in any case."""
    have, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in have:
            name = f"{name}_"
        have.add(name.lower())
        out.append(name)
    return out


def with_row_key(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """df with 128 bits of hash of all its columns, and the names of these two columns: only rows that are equal throughout share
    a key. Columns may have any names and types, those that hold maps or variants included."""
    key = unused(df, "row_a", "row_b")

    def hashable(f: T.StructField) -> Column:
        c, kind = F.col(f"`{f.name.replace('`', '``')}`"), f.dataType.simpleString()
        if "variant" in kind:
            return F.to_json(F.struct(c.alias("x")))
        return _entries(c, f.dataType) if "map<" in kind else c

    cols = [hashable(f) for f in df.schema.fields]
    of = lambda seed: F.xxhash64(F.lit(seed), *[c.isNull() for c in cols], *cols)
    return df.select("*", of(1).alias(key[0]), of(2).alias(key[1])), key


def _entries(c: Column, kind: T.DataType) -> Column:
    """A value as one that can be hashed, maps in it being their entries in order of their keys' text."""
    if isinstance(kind, T.MapType):
        entry = lambda e: F.struct(_entries(e["key"], kind.keyType).alias("key"), _entries(e["value"], kind.valueType).alias("value"))
        return F.array_sort(F.transform(F.map_entries(c), lambda e: F.to_json(F.struct(entry(e).alias("e")))))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _entries(x, kind.elementType))
    if isinstance(kind, T.StructType) and "map<" in kind.simpleString():
        return F.when(c.isNotNull(), F.struct(*[_entries(c[f.name], f.dataType).alias(f.name) for f in kind.fields]))
    return c


def release() -> None:
    """Gives freed memory back to the machine: a Python worker outlives its task, and idle ones add up."""
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    """df.mapInArrow in batches of about BYTES bytes at most, after which the worker gives its memory back.

    The limit is a setting of the session, which is lowered, never raised, and stays so: the plan runs later.
    """
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if not re.fullmatch(r"\d+b?", now := conf.get(key)) or not 0 < int(now.rstrip("b")) <= BYTES:
        conf.set(key, BYTES)

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return df.mapInArrow(tidy, schema)


def words(text: str | None) -> list[bytes]:
    """The words of WORD, as UTF-8: bytes.split() cuts at just these six characters."""
    return text.encode("utf-8", "replace").split() if text else []


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray]]:
    """For batches sorted by integer keys: columns and the bounds of runs of equal keys; no run is cut.

    Yields as often as it may, so that memory follows the longest run, not the partition.
    """
    rest: list[pa.RecordBatch] = []

    def columns(parts: list[pa.RecordBatch]) -> dict[str, pa.Array]:
        t = pa.Table.from_batches(parts)
        return {c: t.column(c).combine_chunks() for c in t.column_names}

    def bounds(cols: dict[str, pa.Array]) -> np.ndarray:
        change = None
        for k in keys:
            v = cols[k].to_numpy(zero_copy_only=False)
            d = v[1:] != v[:-1]
            change = d if change is None else change | d
        return np.concatenate([[0], np.flatnonzero(change) + 1, [len(v)]])

    for b in batches:
        if not b.num_rows:
            continue
        cols = columns([*rest, b])
        at = bounds(cols)
        if len(at) > 2:
            yield {c: v.slice(0, at[-2]) for c, v in cols.items()}, at[:-1]
        rest = [pa.RecordBatch.from_arrays([v.slice(at[-2]) for v in cols.values()], schema=b.schema)]
    if rest:
        cols = columns(rest)
        yield cols, bounds(cols)
