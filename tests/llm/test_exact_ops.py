"""Periodic runs, centroid clustering and exact top-k search against plain Python."""

import hashlib
import math
import os
import random
import sys
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F

from onoma.llm import clustering, periodic, queries, topk
from oracle import connect, same

SF = "/root/testdata/sf0.001"
NASTY = float("nan"), float("inf"), None


@pytest.mark.parametrize("name", ["op12_centroid_clustering", "op13_exact_top_k"])
def test_query_matches_sql(spark, name):
    same(spark, queries.QUERIES[name], queries.ORACLE_SQL[name], SF, connect(SF))


# --- periodic runs


def plain_runs(w):
    """By the definition: a stretch that no neighbour extends, with its smallest period."""
    found = {}
    for p in range(1, len(w) // 4 + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j - i + p >= max(6, 4 * p):
                found.setdefault((i, j - i + p), p)
            i = max(j, i + 1)
    return sorted((s, n, p) for (s, n), p in found.items())


def plain_row(doc_id, text):
    w = text.encode().split() if text else []
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    runs = plain_runs(w)
    drop = {i for s, n, p in runs for i in range(s + p, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4), sha("".join("%d,%d,%d\n" % r for r in runs).encode()), sha(b" ".join(x for i, x in enumerate(w) if i not in drop)))


def made_up(rng, size, letters):
    out = []
    while len(out) < size:
        block = [rng.choice(letters) for _ in range(rng.randint(1, 9))]
        out += (block * rng.randint(1, 9))[: rng.randint(1, 50)] if rng.random() < 0.5 else block
    return out


def test_scan_finds_all_runs():
    rng = random.Random(5)
    for _ in range(150):
        docs = [made_up(rng, rng.randint(0, 150), "abcde"[: rng.randint(1, 5)]) for _ in range(rng.randint(1, 9))]
        got = periodic.whole(*periodic.split(pa.array([" ".join(d) for d in docs])))
        assert list(map(tuple, got.tolist())) == [(k, *r) for k, d in enumerate(docs) for r in plain_runs(d)]


def test_ranges_hold_each_lag_once():
    for n in (0, 3, 4, 24, 1000, 123_456):
        for work in (1, 50, 1 << 20):
            assert [p for lo, hi in periodic.ranges(n, work) for p in range(lo, hi + 1)] == list(range(1, n // 4 + 1))


def test_periodic_runs_of_any_text(spark):
    rng = random.Random(6)
    texts = [None, "", " \t\n", "one", "a a a a a", "a a a a a a", "a\x0ba\x0ca\ra a  a ", "\x85 \x85 \x85 \x85 \x85 \x85", "É é É é É é É é", "x y " * 4000, "ab " * 30_000, "w" * 100_000]
    texts += [" ".join(made_up(rng, rng.randint(0, 400), "abcdefgh"[: rng.randint(1, 8)])) for _ in range(200)]
    rows = [(k if k % 50 else None, t, "s") for k, t in enumerate(texts)] + [(7, texts[20], "s"), (7, texts[20], "s"), (7, texts[21], "s")]
    rows += [(10**15 + k, " ".join(str(rng.randint(0, 50)) for _ in range(k % 300)), "s") for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, hash string").selectExpr("doc_id", "text", "hash", "1 as n_runs", "2 as key").repartition(5)
    want = sorted((plain_row(i, t) for i, t, _ in rows), key=repr)
    for long, work in ((1 << 16, 1 << 20), (100, 300)):  # the lags of long texts are dealt out
        assert sorted(map(tuple, periodic.periodic_runs(df, plant=True, long=long, work=work).collect()), key=repr) == want
    assert periodic.periodic_runs(df.limit(0), plant=True).collect() == []
    assert {r.n_runs for r in periodic.periodic_runs(df.where("text is null or text = 'one'")).collect()} == {0}


def test_op11_equals_plain_python(spark):
    got = queries.op11_periodic_runs(spark, SF)
    want = [plain_row(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert sum(r[1] > 0 for r in want) > 5


# --- centroid clustering


def plain_kmeans(rows, clusters, rounds, dim, scale, seed):
    kept = [(i, [math.floor(scale * Fraction(x)) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(((i is None, "" if i is None else hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()), v) for i, v in kept)[:clusters]
    cents, far = [v for _, v in first], lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda v: min(range(len(cents)), key=lambda k: (far(v, cents[k]), k))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)].append(v)
        cents = [[sum(c) // len(groups[k]) for c in zip(*groups[k], strict=True)] if groups[k] else old for k, old in enumerate(cents)]
    got = [(i, k := nearest(v), far(v, cents[k])) for i, v in kept]
    inertia = defaultdict(int)
    for _, k, d in got:
        inertia[k] += d
    top = 2**63 - 1
    return sorted([(i, k, min(d, top), min(inertia[k], top), min(sum(inertia.values()), top), hashlib.sha256(",".join(map(str, cents[k])).encode()).hexdigest()) for i, k, d in got], key=repr)


@pytest.mark.parametrize("size", [1.0, 5e3, 3e5, 1e15, 1e300])
def test_clustering_in_any_arithmetic(spark, size):
    rng = np.random.default_rng(3)
    rows = [(int(k), (size * (rng.standard_normal(4) + 3 * (k % 3))).tolist()) for k in range(90)]
    rows += [(3, [0.0] * 4), (3, [1.0] * 4), (5, rows[5][1]), (5, rows[5][1]), (None, [2.0] * 4), (None, None), (200, [1.0] * 3), (201, []), (202, None)]
    rows += [(300 + k, [0.0, 1.0, bad, 0.0]) for k, bad in enumerate(NASTY)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, cluster int").repartition(5)
    got = clustering.cluster(df, clusters=5, rounds=4, dim=4)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_kmeans(rows, 5, 4, 4, 1024, 3)


def test_clustering_of_few_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None)], "vec_id long, embedding array<double>")
    rows = clustering.cluster(df, dim=2).collect()
    assert [(r.vec_id, r.cluster, r.distance) for r in sorted(rows)] == [(1, 0, 0), (2, 0, 0)]
    assert clustering.cluster(df.limit(0), dim=2).collect() == [] and clustering.cluster(df, dim=7).columns == clustering.cluster(df, dim=2).columns
    lone = spark.createDataFrame([(None, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert clustering.cluster(lone, dim=2).select("vec_id", "cluster").collect() == [(None, 0)]


def test_distances_switch_arithmetic_without_a_seam():
    rng = np.random.default_rng(4)
    for most in (2**20, 2**22, 2**23, 2**27, 2**28, 2**31, 2**40):
        x, c = rng.integers(-most, most + 1, (20, 64)), rng.integers(-most, most + 1, (3, 64))
        want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, w, strict=True)) for w in c] for v in x]
        assert clustering.distances(x, c).tolist() == want
        of = rng.integers(0, 3, 20)
        assert clustering.sums(x, of, 3) == [[sum(int(v[j]) for v, o in zip(x, of, strict=True) if o == k) for j in range(64)] for k in range(3)]


# --- top-k search


def plain_top_k(rows, k, scale, every):
    kept = [(i, [math.floor(scale * Fraction(x)) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, q) in enumerate(kept):
        if i is not None and i % every == 0:
            score = lambda v, q=q: min(max(sum(a * b for a, b in zip(q, v, strict=True)), -(2**63)), 2**63 - 1)
            found = sorted((-score(v), j is None, j or 0) for m, (j, v) in enumerate(kept) if m != n and len(v) == len(q))
            out += [(i, r + 1, None if none else j, -s) for r, (s, none, j) in enumerate(found[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [1.0, 1e6, 1e9, 1e14])
def test_top_k_equals_all_products(spark, size):
    rng = np.random.default_rng(8)
    rows = [(int(k), (size * rng.standard_normal(6)).tolist()) for k in range(-20, 300)]
    rows += [(400 + k, rows[10][1]) for k in range(12)] + [(10, rows[30][1]), (None, rows[30][1]), (None, rows[33][1])]
    rows += [(500 + k, [1.0, 2.0, 3.0]) for k in range(4)] + [(510, [7.0]), (520, []), (521, []), (530, None)]
    rows += [(600 + 10 * k, [bad, *[1.0] * 5]) for k, bad in enumerate(NASTY)] + [(700, [0.0] * 6)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, row int, cell int").repartition(4)
    for block in (None, 40):
        got = topk.top_k(df, F.col("vec_id") % 10 == 0, block=block)
        assert sorted(map(tuple, got.collect()), key=repr) == plain_top_k(rows, 5, 256, 10)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 10 == 0).collect() == []
    assert topk.top_k(df, F.lit(False)).collect() == []


def test_pivots_spare_candidates_and_lose_none():
    rng = np.random.default_rng(9)
    middles = rng.standard_normal((40, 32)) * 300
    x = np.floor(middles[rng.integers(0, 40, 4000)] + rng.standard_normal((4000, 32)) * 5).astype(np.int64)
    block = topk.Block(np.arange(4000), np.arange(4000), np.zeros(4000, bool), x)
    scores, seen = x[:50] @ x.T, 0
    for k, bound in enumerate(block.bounds(x[:50])):
        assert (bound >= scores[k]).all()
        found, n = block.best(k, x[k], bound, 5)
        seen += n
        others = sorted((-int(s), j) for j, s in enumerate(scores[k]) if j != k)[:5]
        assert [(s, j) for s, j, _, _ in found] == others
    assert seen < 0.5 * 50 * 4000
