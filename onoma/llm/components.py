"""Connected components of a graph whose links never leave the cluster."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onoma.llm.common import checkpoint, map_arrow

#: Links that one task contracts at once; bounds its memory.
CHUNK = 500_000
#: Rows from which on nodes with more than 1/SHARE of them are joined apart from the others.
MANY, SHARE = 1_000_000, 1000


def forest(u: np.ndarray, v: np.ndarray) -> tuple[list[int], list[int]]:
    """For links u-v: each node but the smallest of its component, with that smallest."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (p := parent.get(root, root)) != root:
            root = p
        while x != root:
            parent[x], x = root, parent.get(x, x)
        return root

    for a, b in zip(u.tolist(), v.tolist(), strict=True):
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
            parent.setdefault(min(a, b), min(a, b))
    nodes = [x for x in parent if find(x) != x]
    return nodes, [find(x) for x in nodes]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def out() -> pa.RecordBatch:
        nodes, roots = forest(np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]))
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(roots, pa.int64())], ["u", "v"])

    for b in batches:
        held.append((b.column(0).to_numpy(), b.column(1).to_numpy()))
        if sum(len(x[0]) for x in held) >= CHUNK:
            yield out()
            held = []
    if held:
        yield out()


def _told(rows: DataFrame, facts: DataFrame, total: int) -> DataFrame:
    """rows (u, v) with facts (u, m, n) of their u, n of which are the rows of u; rows are at most 2 * total.

    A node with more than total / SHARE rows would be one long task; there are under 2 * SHARE such nodes, so they are
    broadcast.
    """
    plain = facts.select("u", "m")
    if total < MANY:
        return rows.join(plain, "u")
    hubs = F.broadcast(facts.where(F.col("n") > total // SHARE).select("u", "m"))  # under 2 * SHARE rows
    others = rows.join(hubs.select("u"), "u", "left_anti").join(facts.where(F.col("n") <= total // SHARE).select("u", "m"), "u")
    return rows.join(hubs, "u").unionByName(others)


def connected_components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """links: (u, v) longs -> (node, component): every node with a link, component its smallest reachable node.

    Each task first contracts its own links to stars in bounded chunks; alternating large-star and small-star
    rounds then run until nothing changes, with a checkpoint after each. Rows stay at most twice the links.
    Null ends and self links are left out; repeated links count once; an empty table gives an empty result.
    """
    e = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v")
    e = checkpoint(map_arrow(e, _contract, "u long, v long").distinct())
    seen = None
    for _ in range(max_rounds):
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen or not now[0]:
            break
        seen = now
        sym = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sym.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
        large = _told(sym, low, now[0]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = _told(large, least, now[0]).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = checkpoint(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
    else:
        raise RuntimeError("the components did not settle")
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
