"""Near-duplicates by SimHash, searched by the generalised pigeonhole principle.

The 64 bits are grouped into m parts, correlated bits together. A pair that differs in at most k bits differs in at
most T_i bits in some part i whenever the whole numbers T_i (-1: the part is not probed) add up to k - m + 1. The T_i
are allocated by dynamic programming on candidate counts estimated from all fingerprints. Buckets of one part's value
that grow too large are split by the same principle over the bits that are still free, so a bucket is bounded by its
last level and nothing is dropped.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onoma.llm.common import checkpoint, map_arrow, runs, with_row_key
from onoma.llm.components import connected_components

BITS, SHINGLE, MAX_DIFF, PARTS = 64, 3, 2, 3
#: Rows of a bucket that one task compares; larger buckets are split by their free bits.
BUCKET = 4096
_h64 = functools.partial(xxhash.xxh64_intdigest, seed=42)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the lower-cased (A-Z) text's word shingles, repeats included; unsigned. No word: 0."""
    w = text.encode("utf-8", "replace").lower().split() if text else []
    if not w:
        return 0
    grams = map(b" ".join, zip(*(w[i:] for i in range(shingle)))) if len(w) >= shingle else [b" ".join(w)]
    n = max(1, len(w) - shingle + 1)
    h = np.fromiter(map(_h64, grams), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):
        ones += np.unpackbits(h[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last column, a text, becomes its fingerprint; the others stay."""
    for b in batches:
        fps = np.fromiter((fingerprint(x.as_py()) for x in b.column(b.num_columns - 1)), np.uint64, b.num_rows).view(np.int64)
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fps)], [*b.schema.names[:-1], "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): fp as a signed long; null and wordless texts have 0."""
    return map_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), _fingerprints, "doc_id long, fp long")


def _co_occurrence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((BITS, BITS))
    for b in batches:
        f = np.unpackbits(b.column(0).to_numpy().view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
        total += f.T @ f
    i, j = np.divmod(np.arange(BITS * BITS), BITS)
    yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel().astype(np.int64))], ["i", "j", "s"])


def bit_groups(both: np.ndarray, n: int, parts: int = PARTS) -> list[list[int]]:
    """Bits in parts of nearly equal width; each part grows by the bit that correlates most with it.

    both: how many of n fingerprints have bits i and j.
    """
    p = np.diag(both) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd)
    np.fill_diagonal(corr, 0)
    free, groups = set(range(BITS)), []
    for k in range(parts):
        width = (BITS + k) // parts
        own = [max(sorted(free), key=lambda b: corr[b, sorted(free)].sum())]
        free.discard(own[0])
        while len(own) < width:
            b = max(sorted(free), key=lambda b: corr[b, own].sum())
            own.append(b)
            free.discard(b)
        groups.append(sorted(own))
    return groups


def within(p: np.ndarray, most: int) -> np.ndarray:
    """P(at most t of these bits differ) for t = 0..most, if bit i differs with probability 2 p_i (1 - p_i)."""
    dist = np.zeros(most + 1)
    dist[0] = 1
    for q in 2 * p * (1 - p):
        dist[1:], dist[0] = dist[1:] * (1 - q) + dist[:-1] * q, dist[0] * (1 - q)
    return np.cumsum(dist)


def allocate(costs: list[list[float]], max_diff: int = MAX_DIFF) -> list[int]:
    """Thresholds T_i >= -1 that add up to max_diff - m + 1 at the least total cost; costs[i][t] for t = 0..max_diff."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for total, (c, ts) in best.items():
            for t in range(-1, max_diff + 1):
                x = (c + (cost[t] if t >= 0 else 0.0), [*ts, t])
                if total + t not in step or x < step[total + t]:
                    step[total + t] = x
        best = step
    return best[max_diff - len(costs) + 1][1]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def mask_of(bits: list[int]) -> int:
    return _signed(sum(1 << b for b in bits))


def free_blocks(mask: int, max_diff: int = MAX_DIFF) -> list[int]:
    """The bits outside the mask, as max_diff + 1 masks of nearly equal width."""
    free = [b for b in range(BITS) if not (mask >> b) & 1]
    return [m for k in range(max_diff + 1) if (m := mask_of(free[k :: max_diff + 1]))]


def _verify(max_diff: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols, at in runs(batches, ["mask", "val"]):
            fp, rep, role = (cols[c].to_numpy() for c in ("fp", "rep", "role"))
            fp = fp.view(np.uint64)
            u: list[np.ndarray] = []
            v: list[np.ndarray] = []
            sizes = np.diff(at)
            for g in np.flatnonzero(sizes > 1):
                lo, hi = at[g], at[g + 1]
                left = np.arange(lo, hi)
                while len(left) > 1:  # each found node is linked to the one it was found from
                    queue, left = [left[0]], left[1:]
                    while queue and len(left):
                        x = queue.pop()
                        near = np.bitwise_count(fp[left] ^ fp[x]) <= max_diff
                        if role[x]:
                            near &= role[left] == 0
                        if near.any():
                            new = left[near]
                            u.append(np.full(len(new), rep[x]))
                            v.append(rep[new])
                            queue.extend(new.tolist())
                            left = left[~near]
            if u:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], ["u", "v"])

    return run


def links(classes: DataFrame, max_diff: int = MAX_DIFF, parts: int = PARTS, bucket: int = BUCKET) -> DataFrame:
    """classes: (fp, rep), distinct fingerprints -> (u, v) of reps: links that join just the pairs reachable by links of at most max_diff bits.

    Within a bucket only a spanning forest of the links is returned, so rows stay below the probes.
    """
    both = np.zeros((BITS, BITS))
    stats = map_arrow(classes.select("fp"), _co_occurrence, "i long, j long, s long").groupBy("i", "j").agg(F.sum("s").alias("s"))
    for i, j, s in stats.collect():  # 64 x 64 numbers
        both[i, j] = s
    n = classes.count()
    groups = bit_groups(both, n, parts)
    p = np.diag(both) / max(n, 1)
    masks = [mask_of(g) for g in groups]
    val = lambda m: F.col("fp").bitwiseAND(F.lit(m))
    equal = {
        r["part"]: float(r["pairs"] or 0)
        for r in classes.select(F.posexplode(F.array(*[val(m) for m in masks])).alias("part", "val"))
        .groupBy("part", "val").count().groupBy("part").agg(F.sum(F.col("count") * (F.col("count") - 1) / 2).alias("pairs")).collect()
    }
    costs = []
    for k, g in enumerate(groups):
        w = within(p[g], max_diff)
        costs.append([n * sum(_choose(len(g), d) for d in range(t + 1)) + equal.get(k, 0.0) * w[t] / max(w[0], 1e-12) for t in range(max_diff + 1)])
    thresholds = allocate(costs, max_diff)

    keys = None
    for g, m, t in zip(groups, masks, thresholds, strict=True):
        if t < 0:
            continue
        own = classes.select(F.lit(m).alias("mask"), val(m).alias("val"), "fp", "rep", F.lit(0).alias("role"))
        keys = own if keys is None else keys.unionByName(own)
        if t > 0:
            flips = F.array(*[F.lit(x) for x in _flips(g, t)])
            near = classes.select(F.lit(m).alias("mask"), F.explode(flips).alias("flip"), "fp", "rep", F.lit(1).alias("role"))
            keys = keys.unionByName(near.withColumn("val", val(m).bitwiseXOR(F.col("flip"))).drop("flip"))
    small = None
    known = sorted(masks)
    while True:
        # With so few free bits a bucket of distinct fingerprints is small, and too narrow to split.
        wide = [m for m in known if bin(~m & (1 << BITS) - 1).count("1") > max_diff + 1]
        big = checkpoint(keys.groupBy("mask", "val").count().where((F.col("count") > bucket) & F.col("mask").isin(wide)).select("mask", "val"))
        if big.isEmpty():
            small = keys if small is None else small.unionByName(keys)
            break
        ok = keys.join(big, ["mask", "val"], "left_anti")
        small = ok if small is None else small.unionByName(ok)
        blocks = {m: free_blocks(m, max_diff) for m in wide}
        known = sorted({_signed((m | x) & (1 << 64) - 1) for m, b in blocks.items() for x in b})
        of = F.create_map(*[x for m, b in blocks.items() for x in (F.lit(m), F.array(*[F.lit(y) for y in b]))])
        keys = (
            keys.join(big, ["mask", "val"], "left_semi")
            .withColumn("block", F.explode(of[F.col("mask")]))
            .select(F.col("mask").bitwiseOR(F.col("block")).alias("mask"), F.col("val").bitwiseOR(F.col("fp").bitwiseAND(F.col("block"))).alias("val"), "fp", "rep", "role")
            .distinct()
        )
    return map_arrow(small.repartition("mask", "val").sortWithinPartitions("mask", "val"), _verify(max_diff), "u long, v long")


def _choose(n: int, k: int) -> int:
    return functools.reduce(lambda x, i: x * (n - i) // (i + 1), range(k), 1)


def _flips(bits: list[int], t: int) -> list[int]:
    """XOR masks of 1 to t of the bits."""
    out, level = [], [(0, -1)]
    for _ in range(t):
        level = [(x | 1 << bits[k], k) for x, last in level for k in range(last + 1, len(bits))]
        out += [_signed(x) for x, _ in level]
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_diff: int = MAX_DIFF) -> DataFrame:
    """(doc_id, fp, component_id): documents grouped by links of fingerprints at most max_diff bits apart.

    Equal fingerprints are one class with one representative, its smallest id; only classes are compared, so copies
    never become pairs. Null and wordless texts have fingerprint 0 and link like any other; rows with a null id keep a
    fingerprint and a null component only if no id has that fingerprint; repeated rows are kept; an empty table gives an empty
    result; other columns are ignored.
    """
    fps = checkpoint(fingerprints(docs, id_col, text_col))
    classes = checkpoint(fps.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep")))
    comp = connected_components(links(classes, max_diff))
    label = classes.join(comp, classes.rep == comp.node, "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return fps.join(label, "fp", "left").select("doc_id", "fp", "component_id")


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_diff: int = MAX_DIFF) -> DataFrame:
    """One row of docs of each group of near-duplicates: that with the smallest id, null last, then by a hash of the row.

    Rows are told apart by all their columns, so differing texts of one id, or of none, are grouped each for itself; of
    rows equal throughout one stays; a rerun keeps the same rows.
    """
    keyed, key = with_row_key(docs)
    fps = map_arrow(keyed.select(F.col(id_col).cast("long").alias("doc_id"), F.col(key[0]).alias("row_a"), F.col(key[1]).alias("row_b"), F.col(text_col).alias("text")), _fingerprints, "doc_id long, row_a long, row_b long, fp long")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_a", "row_b")).alias("first")
    classes = checkpoint(fps.groupBy("fp").agg(first))
    comp = connected_components(links(classes.select("fp", F.col("fp").alias("rep")), max_diff))
    label = classes.join(comp, classes.fp == comp.node, "left").select(F.coalesce("component", "fp").alias("component"), "first")
    stay = label.groupBy("component").agg(F.min("first").alias("first")).select(F.col("first.row_a").alias(key[0]), F.col("first.row_b").alias(key[1]))
    return keyed.join(stay, key, "left_semi").dropDuplicates(key).drop(*key)


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
