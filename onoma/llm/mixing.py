"""Mixing sources to target weights by fitting each source's budget as a subset sum.

Documents are counted by source and exact size. A source's budget is first met by whole passes over it, then by the
same share of every size; the rest of the budget is filled exactly (or as nearly as the sizes allow) by a
bounded-knapsack dynamic programme over the sizes that are left. Which documents of a size are taken follows a seeded hash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from onoma.llm.common import checkpoint, word_count

WEIGHTS, SHARE, MOST, SEED = (3, 1, 2), 1.5, 2, 20_24
#: Hash buckets within one (source, size); the ranking of equals never meets in one task.
BUCKETS = 1024
#: Equal rows that one task writes.
ALIKE = 10_000
#: Words of a budget that the dynamic programme fills; the equal shares leave them.
RESERVE = 1 << 16


def knapsack(sizes: list[int], counts: list[int], budget: int) -> list[int]:
    """How many of each size to take, at most counts, so that the sum comes as near the budget from below as it can."""
    items: list[tuple[int, int, int]] = []  # (k, copies, weight), copies in powers of two
    for k, (s, c) in enumerate(zip(sizes, counts, strict=True)):
        c, step = min(c, budget // s) if s > 0 else 0, 1
        while c > 0:
            step = min(step, c)
            items.append((k, step, step * s))
            c -= step
            step *= 2
    reach, full, by = 1, (1 << (budget + 1)) - 1, np.zeros(budget + 1, np.int32)
    for no, (_, _, w) in enumerate(items):
        new = (reach << w) & full & ~reach
        if not new:
            continue
        reach |= new
        bits = np.unpackbits(np.frombuffer(new.to_bytes(budget // 8 + 1, "little"), np.uint8), bitorder="little")
        by[np.flatnonzero(bits)] = no
        if reach >> budget & 1:
            break
    take, at = [0] * len(sizes), reach.bit_length() - 1
    while at:
        k, n, w = items[by[at]]
        take[k] += n
        at -= w
    return take


def fit(sizes: np.ndarray, counts: np.ndarray, budget: int) -> tuple[int, np.ndarray]:
    """(whole passes, further documents of each size), for distinct sizes with counts.

    After whole passes each size gives the same share of what is left but RESERVE, from the largest on, and what
    rounding down leaves of one size's share the smaller ones give. So the programme always has RESERVE words to fill,
    or the whole budget if that is less, and hardly ever more; it runs whatever they are.
    """
    own = [(int(s), int(c)) for s, c in zip(sizes, counts, strict=True)]
    total = sum(s * c for s, c in own)
    extra = np.zeros(len(own), np.int64)
    if total == 0 or budget <= 0:
        return 0, extra
    passes, left = divmod(budget, total)
    share, due, taken = max(0, left - RESERVE), 0, 0
    for k in sorted(range(len(own)), key=lambda k: -own[k][0]):
        s, c = own[k]
        if s:
            due += s * c * share
            extra[k] = min(c, (due // total - taken) // s)
            taken += s * int(extra[k])
    left -= taken
    usable = sorted((k for k, (s, c) in enumerate(own) if 0 < s <= left and c > extra[k]), key=lambda k: own[k][0])
    for k, n in zip(usable, knapsack([own[k][0] for k in usable], [own[k][1] - int(extra[k]) for k in usable], left), strict=True):
        extra[k] += n
    return passes, extra


def targets(hist: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """hist: (source, size, n) -> (source, source_size, target): share of all sizes, dealt by weight, none above most times its source.

    Sources in code point order, null last, take the weights in turn. The level is found by rounds of one small
    aggregate, each of which closes the sources that reach their bound, as resharing the excess does.
    """
    per = hist.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    per = checkpoint(per.orderBy(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()))
    starts, so_far = {}, 0
    for part, n in sorted(per.groupBy("part").count().collect()):  # one row per partition
        starts[part] = so_far
        so_far += n
    if not so_far:
        return per.select("source", "source_size", F.lit(0.0).alias("target"))
    base = F.create_map(*[F.lit(x) for kv in starts.items() for x in kv])
    rank = base[F.col("part")] + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    weight = F.array(*[F.lit(float(w)) for w in weights])[(rank % len(weights)).cast("int")]
    per = checkpoint(per.select("source", "source_size", weight.alias("w"), (F.lit(float(most)) * F.col("source_size")).alias("bound")))
    budget = share * (per.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:
        closed, w, _ = per.agg(F.sum(F.when(F.col("bound") <= F.lit(level) * F.col("w"), F.col("bound")).otherwise(0.0)), F.sum(F.when(F.col("bound") <= F.lit(level) * F.col("w"), 0.0).otherwise(F.col("w"))), F.count("*")).first()
        new = (budget - closed) / w if w else level
        if new <= level * (1 + 1e-12):
            break
        level = new
    return per.select("source", "source_size", F.least("bound", F.lit(level) * F.col("w")).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = SEED, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, copies, *carry): taken is a whole number of the document's copies times its size.

    No document is taken more than `most` times. Null and wordless texts have size 0 and take 0; null sources are one
    source, last; repeated rows count each; an empty table gives an empty result; a rerun takes the same documents.
    carry names further columns that tell rows of one id apart; they are hashed with it.
    """
    sized = checkpoint(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), *carry))
    hist = checkpoint(sized.groupBy("source", "size").agg(F.count("*").alias("n")))
    goal = checkpoint(targets(hist, weights, share, most))

    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        passes, extra = fit(pdf["size"].to_numpy(), pdf["n"].to_numpy(), int(np.floor(pdf["target"].iloc[0] + 1e-6)))
        return pdf[["source", "size", "source_size", "target"]].assign(passes=passes, extra=extra)

    named = hist.join(goal, hist.source.eqNullSafe(goal.source)).select(hist.source, "size", "n", "source_size", "target")
    plans = named.groupBy("source").applyInPandas(plan, "source string, size long, source_size long, target double, passes long, extra long")
    plans = checkpoint(plans.withColumn("key", F.coalesce(F.concat(F.lit("="), "source"), F.lit("-"))))
    # The first `extra` of a (source, size) by hash bucket, hash and id; ranks are taken within a bucket. Rows that are equal here
    # are one row with its number, so that an id which very many rows share is no long task.
    dealt = sized.withColumn("key", F.coalesce(F.concat(F.lit("="), "source"), F.lit("-"))).withColumn("h", F.xxhash64("doc_id", *carry, F.lit(seed)))
    dealt = dealt.withColumn("bucket", F.pmod("h", F.lit(BUCKETS)).cast("int"))
    alike = dealt.groupBy("key", "size", "bucket", "h", "doc_id", "source", *carry).agg(F.count("*").alias("c"))
    counted = alike.groupBy("key", "size", "bucket").agg(F.sum("c").alias("all"))
    before = F.sum("all").over(Window.partitionBy("key", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    buckets = counted.withColumn("before", F.coalesce(before, F.lit(0))).join(plans.drop("source"), ["key", "size"])
    within = F.sum("c").over(Window.partitionBy("key", "size", "bucket").orderBy("h", "doc_id", *carry).rowsBetween(Window.unboundedPreceding, -1))
    placed = alike.withColumn("within", F.coalesce(within, F.lit(0))).join(buckets.drop("all"), ["key", "size", "bucket"])
    more = F.least(F.col("c"), F.greatest(F.col("extra") - F.col("before") - F.col("within"), F.lit(0)))
    kinds = F.array(F.struct(more.alias("n"), (F.col("passes") + 1).alias("copies")), F.struct((F.col("c") - more).alias("n"), F.col("passes").alias("copies")))
    facts = ["doc_id", "source", "size", "source_size", "target", *carry]
    each = placed.select(*facts, F.explode(F.filter(kinds, lambda k: k["n"] > 0)).alias("k")).select(*facts, "k.n", "k.copies")
    rows = each.where(F.col("n") <= ALIKE).withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    parts = each.where(F.col("n") > ALIKE).withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(ALIKE).cast("long"))))
    many = parts.repartition("i", "doc_id", "copies").withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(ALIKE).cast("long"), F.col("n") - F.col("i")))))
    return rows.unionByName(many).select("doc_id", "source", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", *carry)
