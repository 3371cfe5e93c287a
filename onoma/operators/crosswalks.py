"""Crosswalks by parts: which records of the left have one pair, several or none, without a row for every pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from onoma.operators import relational as R

#: About so many records of a name, or of a cell, lie in one array; they are there once for each share of the left.
BLOCK, SHARES = 4096, 16
_ONE = ("right_id", "b_lat", "b_lon")


def _placed(side: str) -> Column:
    return F.col(f"{side}_lat").isNotNull() & F.col(f"{side}_lon").isNotNull()


def _quarter(side: str, band: float) -> dict[str, Column]:
    """Half a band wide, so that records of one quarter are near each other; none for positions too large to tell."""
    at = lambda c: F.when(F.abs(c) < band * 2**40, F.floor(c / (band / 2)))
    return {"x": at(F.col(f"{side}_lat")), "y": at(F.col(f"{side}_lon"))}


def _expand(a: DataFrame, b: DataFrame, keys: list[str], shares: int) -> DataFrame:
    """a.join(b, keys), b coming in arrays of bounded size and a in shares, so that a common key is many groups."""
    sizes = b.groupBy(keys).agg(F.count("*").alias("_n"))
    block = F.pmod(F.xxhash64(*_ONE), F.ceil(F.col("_n") / BLOCK))
    items = b.join(sizes, keys).groupBy(*keys, block.alias("_k")).agg(F.collect_list(F.struct(*_ONE)).alias("_items"))
    shared = items.select(*keys, "_items", F.explode(F.sequence(F.lit(0), F.lit(shares - 1)).cast("array<long>")).alias("_s"))
    a = a.withColumn("_s", F.pmod(F.xxhash64("row"), F.lit(shares)))
    tasks = R.tasks(a.sparkSession)
    got = a.repartition(tasks, *keys, "_s").join(shared.repartition(tasks, *keys, "_s"), [*keys, "_s"])
    return got.select(*[c for c in a.columns if c != "_s"], F.inline("_items"))


def _corners(u: DataFrame, keys: list[str]) -> DataFrame:
    """Of each group's placed records those than which, towards one of four corners, at most one other lies as far in both directions."""
    cols, kept = u.columns, F.lit(False)
    for k, (s, t) in enumerate([(1, 1), (1, -1), (-1, 1), (-1, -1)]):
        lon = F.col("b_lon") * t
        before = Window.partitionBy(keys).orderBy((F.col("b_lat") * s).desc(), lon.desc(), "right_id").rowsBetween(Window.unboundedPreceding, -1)
        u = u.withColumn(f"_m{k}", F.max(lon).over(before))
        second = F.max(F.when(F.col(f"_m{k}").isNotNull(), F.least(lon, f"_m{k}"))).over(before)
        u = u.withColumn(f"_m{k}", second)
        kept = kept | F.col(f"_m{k}").isNull() | (lon > F.col(f"_m{k}"))
    return u.where(kept).select(cols)


def _telling(u: DataFrame, band: float) -> DataFrame:
    """The placed records of the right that tell of any record of the left whether it has no pair, one or several, and which the one is.

    A record of the left lies in a quarter or beside it, so what its band takes of the quarter is all that is beyond some latitude, some
    longitude, or both. The two records furthest towards its corner are in it if any two are. Shares of quarters come first, so that no
    quarter is one task.
    """
    u = u.withColumns(_quarter("b", band)).withColumn("_s", F.pmod(F.xxhash64("right_id"), F.lit(64)))
    cell, known = ["name", "x", "y"], F.col("x").isNotNull() & F.col("y").isNotNull()
    few = _corners(_corners(u.where(known), [*cell, "_s"]), cell)
    return few.unionByName(u.where(~known)).drop("x", "y", "_s")


def parts(left: DataFrame, right: DataFrame, band: float = 0.5) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What `crosswalk_split` makes of `crosswalk`'s pairs: (matched pairs, ambiguous pairs, one row of counts).

    A record of one name meets a record that stands once on the right in that name alone, so these pairs need not be grouped. They
    are counted by name and by quarters of cells, and only records of which that tells too little are compared with those of their
    neighbours that tell more; all pairs are made for ambiguous records alone.
    """
    a, b = R.crosswalk_sides(left, right)
    plain, once = F.col("row_n") == 1, F.col("id_n") == 1
    if band <= 0:
        plain = F.lit(False)
    p, u = a.where(plain), b.where(once)
    rest = R.grouped_pairs(R.near_pairs(a.where(~plain), b, band).unionByName(R.near_pairs(p, b.where(~once), band)))
    rest = rest.where("row is not null").select("row", F.struct("left_id", "right_id", "method", "d_lat", "d_lon", "name").alias("r"))
    p, u = p.select("row", "left_id", "a_lat", "a_lon", "name"), u.select("name", *_ONE)
    pair = F.struct("left_id", "right_id", *R.pair_columns())

    one = F.struct(*_ONE)
    names = u.groupBy("name").agg(F.count("*").alias("n"), F.max(one).alias("one"), F.count_if(~_placed("b")).alias("lost_n"), F.max(F.when(~_placed("b"), one)).alias("lost"))
    counted = lambda rows: rows.select("*", "one.*").select("row", "n", pair.alias("r"))
    by_name = counted(p.where(~_placed("a")).join(names.select("name", "n", "one"), "name"))
    lost = counted(p.where(_placed("a")).join(names.where("lost_n > 0").select("name", F.col("lost_n").alias("n"), F.col("lost").alias("one")), "name"))
    full = u.where(_placed("b")).select("name", *[c.alias(k) for k, c in _quarter("b", band or 1).items()]).groupBy("name", "x", "y").count().where("count > 1").drop("count")
    here = p.where(_placed("a")).withColumns(_quarter("a", band or 1)).join(full.withColumn("sure", F.lit(True)), ["name", "x", "y"], "left").drop("x", "y")
    none = F.lit(None).cast(by_name.schema["r"].dataType)
    sure = here.where("sure").select("row", F.lit(2).cast("long").alias("n"), none.alias("r"))
    placed, cells = R.by_cells(u.where(_placed("b")), band) if band > 0 else (None, None)
    telling = R.by_cells(_telling(u.where(_placed("b")), band), band)[1] if band > 0 else None
    found = [by_name, lost, sure, rest.select("row", F.lit(1).cast("long").alias("n"), "r")]
    if band > 0:
        near = R.in_band(placed(here.where("sure is null").drop("sure")).join(telling, ["name", "x", "y"]), band)
        found.append(near.select("row", F.lit(1).cast("long").alias("n"), pair.alias("r")))
    marks = R.union_all(found).groupBy("row").agg(F.sum("n").alias("n"), F.max("r").alias("r"))

    several = marks.where("n > 1").select("row")
    pa = p.join(several, "row", "left_semi")
    every = [_expand(pa.where(~_placed("a")), u, ["name"], SHARES), _expand(pa.where(_placed("a")), u.where(~_placed("b")), ["name"], SHARES)]
    if band > 0:
        every.append(R.in_band(_expand(placed(pa.where(_placed("a"))), cells, ["name", "x", "y"], SHARES // 4).drop("x", "y"), band))
    ambiguous = R.union_all([e.select("row", "left_id", "right_id", *R.pair_columns()) for e in every] + [rest.join(several, "row", "left_semi").select("row", "r.*")])
    return marks.where("n = 1").select("row", "r.*"), ambiguous, R.crosswalk_stats(left, marks)
