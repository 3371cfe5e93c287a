"""Very long urls, vectors and texts, and the learned rules against a second implementation."""

import math
import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from onoma.llm import clustering, embeddings, periodic, quality, tokencount, topk, urls
from pyspark.sql import functions as F


def test_very_long_urls(spark):
    long = "x" * 1_000_000
    rows = [(1, f"http://{long}.example.com/en/7{long}?q"), (2, f"https://EXAMPLE.com/en/{long}#{long}"), (3, long), (4, f"a://{'b.' * 50_000}net/de/")]
    got = {r.page_id: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame([], "page_id long, bad int"), ["block com/en/", "allow example.com/en/7", "block net/de/"]).collect()}
    assert got[1].host == f"{long}.example.com" and got[1].path == f"/en/7{long}" and (got[1].rule, got[1].verdict) == ("example.com/en/7", "allow")
    assert (got[2].rule, got[2].verdict, len(got[2].path)) == ("com/en/", "block", 1_000_004) and got[3].host == got[3].path == ""
    assert got[4].rule == "net/de/" and got[4].host.endswith("b.net")


def test_very_long_vectors(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((6, 20_000))
    x[1] = x[0] + rng.standard_normal(20_000) * 0.1
    df = spark.createDataFrame([(k, v.tolist(), 1) for k, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(df).collect()}
    assert got == {0: (1, 0), 1: (1, 0), **{k: (0, k) for k in range(2, 6)}}
    top = topk.top_k(df, F.col("vec_id") == 0, k=1).first()
    assert (top.vec_id, top.score) == (1, sum(math.floor(256 * a) * math.floor(256 * b) for a, b in zip(x[0].tolist(), x[1].tolist(), strict=True)))
    assert clustering.cluster(df, clusters=2, rounds=1, dim=20_000).count() == 6


def test_very_long_texts(spark, tmp_path):
    texts = ["\0 nul\0 " * 200_000, "word " * 400_000, "a" * 2_000_000, "\0" * 9]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)] * 2, "doc_id long, text string").repartition(3)
    out = str(tmp_path / "flat")
    tokencount.write_flat(df, out)
    assert tokencount.count_tokens(spark, out).where("complete").count() == 8
    runs = {r.doc_id: (r.n_runs, r.start, r.length, r.period) for r in periodic.periodic_runs(df).collect()}
    assert runs == {0: (1, 0, 400_000, 2), 1: (1, 0, 400_000, 1), 2: (0, None, None, None), 3: (0, None, None, None)}


def plain_rules(x, bad, precision=0.9, most=12):
    """Sequential covering with lists alone: of equal gains the first condition stays, of equal worths the longer rule."""
    n, names, rules, left = len(bad), list(x), [], set(range(len(bad)))
    holds = lambda c, i: x[c[0]][i] > c[2] if c[1] else x[c[0]][i] <= c[2]
    covered = lambda rule, rows: [i for i in rows if all(holds(c, i) for c in rule)]
    while len(rules) < most:
        grow, prune = [i for i in sorted(left) if i % 3 != 2], [i for i in sorted(left) if i % 3 == 2]
        if sum(bad[i] for i in grow) < 3:
            break
        rule, inside = [], grow
        while len(rule) < LONGEST:
            p0, n0 = sum(bad[i] for i in inside), len(inside)
            if p0 in (0, n0):
                break
            best, chosen = 1e-9, None
            for name in names:
                own = sorted(x[name][i] for i in inside)
                for at in sorted({own[math.floor((n0 - 1) * q / 64)] for q in range(65)}):
                    for above in (True, False):
                        m = [i for i in inside if holds((name, above, at), i)]
                        p = sum(bad[i] for i in m)
                        if p and (gain := p * (math.log2(p / len(m)) - math.log2(p0 / n0))) > best + 1e-12:
                            best, chosen = gain, (name, above, at)
            if chosen is None:
                break
            rule.append(chosen)
            inside = covered([chosen], inside)
        if not rule:
            break
        worth = lambda r: (lambda c: (2 * sum(bad[i] for i in c) - len(c)) / max(len(c), 1))(covered(r, prune))
        rule = max((rule[:k] for k in range(len(rule), 0, -1)), key=worth)
        if (worth(rule) + 1) / 2 < precision:
            break
        rules.append(rule)
        left -= set(covered(rule, range(n)))
    return rules


LONGEST = 4


@pytest.mark.parametrize("seed", range(4))
def test_learned_rules_equal_plain_ones(seed):
    rng = np.random.default_rng(seed)
    n = 900
    words = rng.integers(50, 300, n)
    c = {"n_words": words, "word_chars": words * rng.integers(3, 8, n), "n_symbols": rng.integers(0, 40, n), "n_dup_lines": rng.integers(0, 9, n), "n_repeat_words": rng.integers(0, 60, n)}
    c |= {k: rng.integers(0, 50, n) for k in quality.COUNTS if k not in c}
    x = quality.ratios(c)
    bad = (x["symbols_per_word"] > 0.2) | (x["repeat_share"] > 0.35) & (words < 150)
    bad = bad ^ (rng.random(n) < 0.01)
    got = quality.learn(c, bad)
    want = plain_rules({k: v.tolist() for k, v in quality.ratios(c).items()}, bad.tolist())
    assert [[(x.name, x.above, x.at) for x in r] for r in got] == want and got
