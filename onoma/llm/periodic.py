"""Periodic runs of words: a scan of every lag, by vectorised comparisons.

A run with period p is a stretch whose words equal those p places on, so each lag p up to n / EXPONENT is tried: the array
of word ids is compared with itself shifted by p, and true stretches are measured. A stretch that counts is at least
(EXPONENT - 1) * p long and thus holds three multiples of p in a row; every p-th place is compared first, and all places
only where three in a row are equal, so a lag costs n / p comparisons where nothing repeats. Texts of up to LONG bytes are
scanned whole, many of them as one array; the lags of a longer one are dealt out in ranges.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onoma.llm.common import map_arrow

#: A run holds at least LEAST words and EXPONENT periods.
LEAST, EXPONENT = 6, 4
#: Bytes of a text beyond which its lags are dealt out, and comparisons of one range of them.
LONG, WORK = 64 << 10, 1 << 20
FOUND = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
assert EXPONENT >= 4  # three multiples of p


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, and the bounds of each text's; null is a text without words."""
    bare = pc.ascii_trim_whitespace(pc.fill_null(texts, ""))
    n = np.where(pc.binary_length(bare).to_numpy(zero_copy_only=False) > 0, 1, 0)
    lists = pc.ascii_split_whitespace(bare)
    words, sizes = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False) * n
    if not n.all():
        words = words.filter(pc.not_equal(words, ""))
    return words, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def planted(words: pa.Array, at: np.ndarray, hashes: np.ndarray) -> pa.Array:
    """The words with a repeated passage in each text whose hash ends in 0; a negative hash is none."""
    order = None
    for d in np.flatnonzero((hashes >= 0) & (hashes % 10 == 0) & (np.diff(at) > 0)).tolist():
        n, g = int(at[d + 1] - at[d]), int(hashes[d]) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        order = np.arange(len(words)) if order is None else order
        order[at[d] + a : at[d + 1]] = at[d] + a + np.arange(n - a) % p
    return words if order is None else words.take(pa.array(order))


def scan(ids: np.ndarray, at: np.ndarray, lo: int = 1, hi: int | None = None) -> np.ndarray:
    """Rows (start in ids, length, period) of the runs with lags lo to hi, hi included.

    at: bounds of texts, the longest first; no two texts share an id. A stretch whose smallest period is below lo is left out.
    """
    sizes, found = np.diff(at), [np.zeros((0, 3), np.int64)]
    known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    most = int(sizes[0]) // EXPONENT if len(sizes) else 0
    for p in range(lo, min(most, most if hi is None else hi) + 1):
        end = int(at[np.searchsorted(-sizes, -max(LEAST, EXPONENT * p), side="right")])
        grid = ids[:end:p]
        same = grid[1:] == grid[:-1]
        hits = np.flatnonzero(same[:-2] & same[1:-1] & same[2:])
        for q in [q for q in known if p % q == 0] if len(hits) else ():  # what lies in a run of a divisor is no new run
            starts, ends = known[q]
            before = np.searchsorted(starts, hits * p, side="right") - 1
            hits = hits[(before < 0) | (hits * p + 3 * p >= ends[before])]
        if not len(hits):
            continue
        cut = np.flatnonzero(np.diff(hits) > 1)
        new = []
        for first, last in zip(hits[np.concatenate([[0], cut + 1])].tolist(), hits[np.concatenate([cut, [len(hits) - 1]])].tolist(), strict=True):
            a, b = max(0, (first - 1) * p + 1), min((last + 3) * p, end - p)
            turns = np.flatnonzero(np.diff(ids[a:b] == ids[a + p : b + p], prepend=False, append=False))
            starts, sizes_ = a + turns[::2], turns[1::2] - turns[::2] + p
            ok = sizes_ >= max(LEAST, EXPONENT * p)
            new.append(np.stack([starts[ok], sizes_[ok], np.full(ok.sum(), p)], axis=1))
        new = np.concatenate(new)
        if lo > 1:  # below lo there may be smaller periods, by which later lags know the stretch again
            least = np.array([smallest(ids, s, p) for s in new[:, 0].tolist()], np.int64)
            for q in np.unique(least[least < p]).tolist():
                old = known.get(q, (np.zeros(0, np.int64),) * 2)
                starts, ends = (np.concatenate(x) for x in zip(old, (new[least == q, 0], new[least == q, 0] + new[least == q, 1]), strict=True))
                known[q] = (starts[order := np.argsort(starts)], ends[order])
            new = new[least == p]
        if len(new):
            found.append(new)
            known[p] = (new[:, 0], new[:, 0] + new[:, 1])
    return np.concatenate(found)


def smallest(ids: np.ndarray, start: int, p: int) -> int:
    """The smallest period of a stretch of period p and at least two periods: it divides p."""
    low = [q for q in range(1, math.isqrt(p) + 1) if p % q == 0]
    block = ids[start : start + p]
    return next(q for q in sorted({*low, *(p // q for q in low)}) if np.array_equal(block, ids[start + q : start + q + p]))


def whole(words: pa.Array, at: np.ndarray) -> np.ndarray:
    """Rows (text, start in it, length, period) of all runs, in order; the texts are scanned as one array."""
    codes = words.dictionary_encode()
    n = np.diff(at)
    ids = codes.indices.to_numpy().astype(np.int64) + np.repeat(np.arange(len(n)) * len(codes.dictionary), n)
    by_size = np.argsort(-n, kind="stable")
    to = np.concatenate([[0], np.cumsum(n[by_size])])
    runs = scan(ids[np.repeat(at[by_size] - to[:-1], n[by_size]) + np.arange(len(ids))], to)
    text = np.searchsorted(to, runs[:, 0], side="right") - 1
    out = np.column_stack([by_size[text], runs[:, 0] - to[text], runs[:, 1:]])
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def digest(words: pa.Array, at: np.ndarray, runs: np.ndarray) -> list[pa.Array]:
    """Columns of FOUND; runs: as of `whole`."""
    docs, n_runs = len(at) - 1, np.bincount(runs[:, 0], minlength=len(at) - 1)
    last = np.cumsum(n_runs)
    hashes, best = np.full(docs, hashlib.sha256(b"").hexdigest(), object), np.zeros((docs, 3), np.int64)
    for d in np.flatnonzero(n_runs).tolist():
        own = runs[last[d] - n_runs[d] : last[d], 1:]
        hashes[d] = hashlib.sha256(b"".join(b"%d,%d,%d\n" % tuple(r) for r in own.tolist())).hexdigest()
        best[d] = own[np.argmax(own[:, 1])]  # the first of the longest
    if len(runs):
        edges = np.zeros(len(words) + 1, np.int64)
        from_ = at[runs[:, 0]] + runs[:, 1]
        np.add.at(edges, from_ + runs[:, 3], 1)
        np.add.at(edges, from_ + runs[:, 2], -1)
        keep = np.cumsum(edges)[:-1] == 0
        words = words.filter(pa.array(keep))
        at = np.concatenate([[0], np.cumsum(keep)])[at]
    text = pc.binary_join(pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), words), " ").cast(pa.binary())
    to, data = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + docs + 1].tolist(), memoryview(text.buffers()[2] or b"")
    collapsed = [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(to[:-1], to[1:], strict=True)]
    none = n_runs == 0
    longs = [*best.T, 1000 * best[:, 1] // np.maximum(best[:, 2], 1)]
    return [pa.array(n_runs, pa.int64()), *[pa.array(c, pa.int64(), mask=none) for c in longs], pa.array(hashes, pa.string()), pa.array(collapsed, pa.string())]


def ranges(n: int, work: int) -> list[tuple[int, int]]:
    """The lags of n words in ranges of about `work` comparisons, as lag p costs n / p: their bounds are powers."""
    most = n // EXPONENT
    if most < 1:
        return []
    parts = 1 + math.ceil(n * math.log(most + 1) / work)
    edges = sorted({min(most + 1, max(1, round((most + 1) ** (k / parts)))) for k in range(parts + 1)})
    return [(a, b - 1) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _words(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray]:
    words, at = split(batch.column("text"))
    return planted(words, at, batch.column("hash").fill_null(-1).to_numpy()), at


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            words, at = _words(b)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *digest(words, at, whole(words, at))], ["doc_id", *_NAMES])


def _dealt(work: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                words, at = _words(b.slice(k, 1))
                ids = words.dictionary_encode().indices.to_numpy().astype("<i4").tobytes()
                for lo, hi in ranges(int(at[1]), work):
                    yield pa.RecordBatch.from_arrays([b.column("key").slice(k, 1), pa.array([lo], pa.int64()), pa.array([hi], pa.int64()), pa.array([ids], pa.binary())], ["key", "lo", "hi", "ids"])

    return run


def _ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(b.num_rows):
            ids = np.frombuffer(b.column("ids")[k].as_py(), "<i4")
            runs = scan(ids, np.array([0, len(ids)]), b.column("lo")[k].as_py(), b.column("hi")[k].as_py())
            yield pa.RecordBatch.from_arrays([pa.array([b.column("key")[k].as_py()] * len(runs), pa.string()), *[pa.array(c, pa.int64()) for c in runs.T]], ["key", "start", "length", "period"])


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(b.num_rows):
            words, at = _words(b.slice(k, 1))
            got = b.column("runs").slice(k, 1).flatten()
            runs = np.column_stack([np.zeros(len(got), np.int64), *[got.field(c).to_numpy() for c in ("start", "length", "period")]])
            yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(k, 1), *digest(words, at, runs[np.lexsort((runs[:, 3], runs[:, 1]))])], ["doc_id", *_NAMES])


_NAMES = [x.split(" ")[0] for x in FOUND.split(", ")]


def periodic_runs(docs: DataFrame, plant: bool = False, long: int = LONG, work: int = WORK) -> DataFrame:
    """docs: (doc_id, text) -> (doc_id, FOUND), a row per row of docs.

    A run is a stretch of words of smallest period q, of max(LEAST, EXPONENT * q) words at least, that no neighbouring word
    extends; start, length and period are those of the longest, of equals the first, and null where there is none. The
    hashes are of all runs, a line `start,length,period` each, and of the words that no run holds behind its first q.
    plant: rows whose id's CRC-32 ends in 0 first get a passage repeated (the contract of op11).

    Null, empty and blank texts have no words and no runs. Null ids get no planted passage; repeated ids and repeated rows
    are rows of their own. Texts may be of any length, and other columns are ignored. An empty table gives no rows.
    """
    number = F.crc32(F.col("doc_id").cast("string").cast("binary")) if plant else F.lit(None)
    rows = docs.select("doc_id", "text", number.cast("long").alias("hash"))
    short = F.coalesce(F.octet_length("text") <= long, F.lit(True))
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = map_arrow(rows.where(short), _scanned, f"doc_id {kind}, {FOUND}")
    keyed = rows.where(~short).withColumn("key", F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.sha2("text", 256)))
    units = map_arrow(keyed.select("key", "hash", "text"), _dealt(work), "key string, lo long, hi long, ids binary")
    # Copies of one text come from many partitions of the table and are dealt out apart.
    units = units.withColumn("part", F.spark_partition_id()).repartition("key", "lo", "part").drop("part")
    runs = map_arrow(units, _ranged, "key string, start long, length long, period long")
    runs = runs.groupBy("key", "start", "length").agg(F.min("period").alias("period"))
    runs = runs.groupBy("key").agg(F.collect_list(F.struct("start", "length", "period")).alias("runs"))
    none = F.array().cast("array<struct<start:long,length:long,period:long>>")
    ranged = keyed.join(runs, "key", "left").select("doc_id", "hash", "text", F.coalesce("runs", none).alias("runs"))
    return out.unionByName(map_arrow(ranged, _finished, f"doc_id {kind}, {FOUND}"))
