"""Near-duplicate embeddings by random-hyperplane signs in several tables.

A vector's key in a table is the signs of its products with seeded hyperplanes. Pairs that share a key in any table are
compared, each in the first table they share only. A bucket that is too large for one task is cut into blocks, and each pair
of blocks is one unit of work. Units first get the signs alone, of all tables and some more hyperplanes, a bit each: pairs
whose signs differ in more places than those of a pair at the threshold do are no links. Only vectors of which a pair is left
follow, and are compared by exact cosine in double precision.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onoma.llm.common import checkpoint, map_arrow, runs
from onoma.llm.components import connected_components

COSINE, RECALL, SEED = 0.93, 0.995, 93
#: Vectors that a bucket of the largest label has on average, and of one block of a bucket.
BUCKET, BLOCK = 512, 1024
#: Signs of a vector at least, and standard deviations by which those of a link may differ from what is expected.
SIGNS, SURE = 256, 6.0


def plan(largest: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """(bits, tables): bits so that the largest label spreads over buckets of some hundreds, tables so that a pair at the
    threshold meets with probability `recall` at least."""
    bits = min(30, max(4, math.ceil(math.log2(max(largest, 1) / BUCKET + 1))))
    same = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - same))


def most_apart(signs: int, cosine: float) -> int:
    """Signs in which a link may differ: more happen to one link at the threshold in a thousand million."""
    p = math.acos(cosine) / math.pi
    return math.floor(signs * p + SURE * math.sqrt(signs * p * (1 - p)))


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two, which keeps angles exactly; squares then neither overflow nor vanish."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True, initial=0.0))[1])


def _signatures(bits: int, tables: int, seed: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        power = 1 << np.arange(bits)
        for b in batches:
            lists, n = b.column(2), b.num_rows
            known = (b.column(0).is_valid().to_numpy(zero_copy_only=False)) & b.column(1).is_valid().to_numpy(zero_copy_only=False)
            at, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype("<f8")  # null: not a number
            dims = np.where(lists.is_valid().to_numpy(zero_copy_only=False) & known, np.diff(at), 0)
            same, raw, keys, packed = (np.full(n, None, object) for _ in range(4))
            for dim in np.unique(dims[dims > 0]).tolist():
                rows = np.flatnonzero(dims == dim)
                x = flat[at[rows][:, None] + np.arange(dim)] + 0.0  # -0 becomes 0
                fine = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
                rows, x = rows[fine], x[fine]
                if dim not in planes:
                    if len(planes) > 8:
                        planes.clear()
                    planes[dim] = np.random.default_rng([seed, dim]).standard_normal((dim, max(SIGNS, bits * tables)))
                signs = scaled(x) @ planes[dim] > 0
                k = (signs[:, : bits * tables].reshape(len(x), tables, bits) @ power).astype(np.int32)
                for r, v, key, p in zip(rows.tolist(), x, k, np.packbits(signs, axis=1), strict=True):
                    same[r] = hashlib.blake2b(b"%d " % dim + (b.column(1)[r].as_py() or "").encode() + b"\0" + v.tobytes(), digest_size=16).digest()
                    raw[r], keys[r], packed[r] = v.astype(kind).tobytes(), key, p.tobytes()
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array(x, pa.binary()) for x in (same, raw, packed)], pa.array(keys, pa.list_(pa.int32()))], ["vec_id", "label", "same", "vec", "signs", "keys"])

    return run


def _signs(column: pa.Array, lo: int, hi: int) -> np.ndarray:
    packed = np.frombuffer(b"".join(column.slice(lo, hi - lo).to_pylist()), np.uint8).reshape(hi - lo, -1)
    return np.unpackbits(packed, axis=1)


def _met_before(signs: np.ndarray, a: np.ndarray, b: np.ndarray, table: int, bits: int) -> np.ndarray:
    """Whether the pairs of rows a and b share a key in a table before this one, where they count."""
    keys = (signs[:, : table * bits].reshape(len(signs), table, bits) @ (1 << np.arange(bits))).astype(np.int32)
    met = np.zeros((len(a), len(b)), bool)
    for t in range(table):
        met |= keys[a, t][:, None] == keys[b, t][None, :]
    return met


def _sides(side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a unit to compare with each other: all with all, or those of one block with those of another."""
    return (np.arange(len(side)),) * 2 if side[0] == 0 else (np.flatnonzero(side == 1), np.flatnonzero(side != 1))


def _likely(cosine: float, bits: int):
    """The rows of a unit that have a pair there, not met before, whose signs are as close as a link's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols, at in runs(batches, ["unit", "dim"]):
            side, tab = cols["side"].to_numpy(), cols["tab"].to_numpy()
            stay = np.zeros(len(side), bool)
            for lo, hi in zip(at[:-1], at[1:], strict=True):
                if hi - lo < 2:
                    continue
                signs = _signs(cols["signs"], lo, hi)
                a, b = _sides(side[lo:hi])
                if not len(a) or not len(b):  # a block that got no vectors
                    continue
                x = 1.0 - 2.0 * signs.astype(np.float32)
                near = x[a] @ x[b].T >= x.shape[1] - 2 * most_apart(x.shape[1], cosine)
                if side[lo] == 0:
                    np.fill_diagonal(near, False)
                if near.any():
                    near &= ~_met_before(signs, a, b, int(tab[lo]), bits)
                    stay[lo + a] |= near.any(axis=1)
                    stay[lo + b] |= near.any(axis=0)
            if stay.any():
                yield pa.RecordBatch.from_arrays([cols[c].filter(pa.array(stay)) for c in ("unit", "dim", "side", "tab", "node")], ["unit", "dim", "side", "tab", "node"])

    return run


def _compare(cosine: float, kind: str, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols, at in runs(batches, ["unit", "dim"]):
            rep, n, side, tab, dims = (cols[c].to_numpy() for c in ("node", "n", "side", "tab", "dim"))
            vec = cols["vec"]
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for lo, hi in zip(at[:-1], at[1:], strict=True):
                if hi - lo < 2:
                    continue
                x = scaled(np.frombuffer(b"".join(vec.slice(lo, hi - lo).to_pylist()), kind).reshape(hi - lo, dims[lo]).astype("<f8"))
                x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
                whole, (a, b) = side[lo] == 0, _sides(side[lo:hi])
                if not len(a) or not len(b):  # a block that got no vectors
                    continue
                link = (x[a] @ x[b].T >= cosine) & ~_met_before(_signs(cols["signs"], lo, hi), a, b, int(tab[lo]), bits)
                if whole:
                    np.fill_diagonal(link, False)
                    ids, w = rep[lo:hi], n[lo:hi]
                    hit = link.any(axis=1)
                    out.append((ids[hit], (link @ w)[hit], np.minimum(ids, np.where(link, ids[None, :], np.iinfo(np.int64).max).min(axis=1))[hit]))
                    out += _tree(ids, link)
                else:
                    ia, ib, wa, wb = rep[lo:hi][a], rep[lo:hi][b], n[lo:hi][a], n[lo:hi][b]
                    for i, j, w, m in ((ia, ib, wb, link), (ib, ia, wa, link.T)):
                        hit = m.any(axis=1)
                        out.append((i[hit], (m @ w)[hit], j[m[hit].argmax(axis=1)]))
                    both = np.concatenate([ia, ib])
                    full = np.zeros((len(both), len(both)), bool)
                    full[: len(ia), len(ia) :] = link
                    full[len(ia) :, : len(ia)] = link.T
                    out += _tree(both, full)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[k] for o in out]).astype(np.int64)) for k in range(3)], ["u", "links", "v"])

    return run


def _tree(ids: np.ndarray, link: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Links of a spanning forest, with 0 to count."""
    left, out = link.any(axis=1), []
    while left.any():
        front = [int(np.argmax(left))]
        left[front] = False
        while front:
            i = front.pop()
            new = np.flatnonzero(link[i] & left)
            if len(new):
                left[new] = False
                front += new.tolist()
                out.append((ids[new], np.zeros(len(new), np.int64), np.full(len(new), ids[i])))
    return out


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """vectors: (vec_id, embedding array of numbers, label) -> (vec_id, n_links, component_id, kept).

    Only vectors of one label, not null, and of one length are compared; lengths may be as many as there are, and any. Null and
    zero vectors, vectors with null or non-finite components, and rows without an id link with nothing and are their own
    component. Equal vectors of a label are one class, whose size counts in n_links; so do repeated rows. Rows of one id
    whose vectors differ are vectors of their own. An empty table gives an empty result; other columns are ignored.
    """
    kind = "float" if dict(vectors.dtypes)["embedding"] == "array<float>" else "double"
    stored = "<f4" if kind == "float" else "<f8"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast(f"array<{kind}>").alias("embedding"))
    largest = rows.where("label is not null").groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = plan(largest, cosine, recall)
    signed = checkpoint(map_arrow(rows, _signatures(bits, tables, seed, stored), "vec_id long, label string, same binary, vec binary, signs binary, keys array<int>"))
    fine = signed.where("same is not null")
    # Nodes number the classes in the order of their smallest ids.
    order = fine.groupBy("same").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
    order = checkpoint(order.orderBy("rep", "same").withColumn("node", F.monotonically_increasing_id()))
    one = fine.groupBy("same").agg(F.first("label").alias("label"), F.first("vec").alias("vec"), F.first("signs").alias("signs"), F.first("keys").alias("keys"))
    classes = checkpoint(one.join(order, "same").withColumn("dim", (F.length("vec") / int(stored[2])).cast("int")))
    # Which buckets a class is in, without its vector. Those beyond one block are cut into blocks by a hash of the node;
    # each pair of blocks is a unit.
    dealt = classes.select("node", "label", "dim", F.posexplode("keys").alias("tab", "key")).select("node", "tab", F.xxhash64("label", "dim", "tab", "key").alias("bucket"))
    sizes = dealt.groupBy("bucket").count().where("count > 1").select("bucket", F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    dealt = dealt.join(sizes, "bucket").withColumn("own", F.pmod(F.xxhash64("node", F.lit(seed)), F.col("blocks")).cast("int"))
    units = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "node", "tab", F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("unit"),
        F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side"),  # 0: a block with itself
    )
    signed_units = units.join(classes.select("node", "dim", "signs"), "node").repartition("unit").sortWithinPartitions("unit", "dim")
    likely = checkpoint(map_arrow(signed_units, _likely(cosine, bits), "unit long, dim int, side int, tab int, node long"))
    full = likely.join(classes.select("node", "n", "vec", "signs"), "node").repartition("unit").sortWithinPartitions("unit", "dim")
    found = checkpoint(map_arrow(full, _compare(cosine, stored, bits), "u long, links long, v long"))
    linked = found.groupBy(F.col("u").alias("node")).agg(F.sum("links").alias("links"))
    comp = connected_components(found.select("u", "v"))
    comp = comp.join(order.select(F.col("node").alias("component"), F.col("rep").alias("component_id")), "component").select("node", "component_id")
    facts = order.join(linked, "node", "left").join(comp, "node", "left")
    facts = facts.select("same", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component_id", "rep").alias("component_id"))
    out = fine.select("vec_id", "same").join(facts, "same").select("vec_id", "n_links", "component_id")
    alone = signed.where("same is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
