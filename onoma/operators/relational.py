"""Joins, groupings and orders that the compilers are made of. Where order matters, it is a column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F


#: Places of one name up to which all of them are compared with each record of that name.
COMMON = 1000


def tasks(spark: SparkSession) -> int:
    """Tasks for rows that are few bytes but much work, which neither scans nor adaptive execution spread."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt over many tasks; a small file is one task however much each of its rows is made into."""
    return df.repartition(tasks(df.sparkSession))


def with_once(df: DataFrame, name: str, c: Column) -> DataFrame:
    """withColumn of a costly expression: a generator puts it, through which no filter on it is pushed to work it out again."""
    return df.withColumn(name, c).select(*df.columns, F.explode(F.array(name)).alias(name))


def last_wins(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, that of the highest order."""
    return df.groupBy(key).agg(F.max_by(F.struct(*[c for c in df.columns if c != key]), order).alias("r")).select(key, "r.*")


def override(base: DataFrame, over: DataFrame, key: str) -> DataFrame:
    """Rows of both by key, those of `over` replacing those of `base`."""
    return last_wins(base.withColumn("_p", F.lit(0)).unionByName(over.withColumn("_p", F.lit(1))), key, "_p").drop("_p")


def nest(df: DataFrame, key: str, order: str, *cols: str, into: str = "items") -> DataFrame:
    """The rows of each key as an ordered array."""
    return df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, *cols))).alias(into))


def ambiguity(names: DataFrame, least: int = 2) -> DataFrame:
    """(surface, id) -> (surface, n): strings that name several ids. Pairs are first made distinct, so no hot string is one task."""
    return names.select("surface", "id").distinct().groupBy("surface").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def ambiguity_rows(names: DataFrame, sample: int = 8) -> DataFrame:
    """(surface, id, name, ord) -> surfaces of several ids with the first `sample` ids and their last-seen names.

    Ids are ranked within hash groups first, so that a hot string's ids never meet unranked.
    """
    per = names.groupBy("surface", "id").agg(F.min("ord").alias("first"), F.max_by("name", "ord").alias("name"))
    part = per.withColumn("g", F.pmod(F.xxhash64("id"), F.lit(64))).groupBy("surface", "g")
    item = F.struct("first", "id", "name")
    some = part.agg(F.count("*").alias("n"), F.slice(F.array_sort(F.collect_list(item)), 1, sample).alias("s"))
    out = some.groupBy("surface").agg(F.sum("n").alias("n"), F.slice(F.array_sort(F.flatten(F.collect_list("s"))), 1, sample).alias("s")).where("n > 1")
    joined = lambda f: F.array_join(F.transform("s", lambda x: x[f].cast("string")), "; ")
    return out.select("surface", "n", joined("id").alias("ids"), joined("name").alias("names"))


def ambiguity_stats(cands: DataFrame) -> DataFrame:
    """(id, strings) -> entities, strings, unique strings, ambiguous strings."""
    one = cands.agg(F.count("*").alias("entities"), F.coalesce(F.sum(F.size("strings")), F.lit(0)).cast("long").alias("total_strings"))
    per = cands.select("id", F.explode("strings").alias("surface")).distinct().groupBy("surface").count()
    return one.crossJoin(per.agg(F.count("*").alias("unique_strings"), F.count_if(F.col("count") > 1).alias("ambiguous_strings")))  # two single rows


def crosswalk(left: DataFrame, right: DataFrame, band: float = 0.5) -> DataFrame:
    """Pairs of records that share a normalised name and lie close.

    left: (row, id, names array, lat, lon), right: (id, names, lat, lon) -> (row, left_id, right_id, method, d_lat,
    d_lon, name). Both known positions must differ by at most the band; without one the pair is by name only. Of a
    pair's names the first counts, by position the last.
    """
    return grouped_pairs(near_pairs(*crosswalk_sides(left, right), band))


def crosswalk_sides(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides a row per name, with row_n, 1 for rows that stand once and have one name, and id_n, how often an id stands on the right."""
    rows, ids = Window.partitionBy("row"), Window.partitionBy("right_id")
    names = F.array_compact(F.array_distinct("names"))
    row_n = F.when(F.col("row").isNotNull(), F.sum(F.greatest(F.size(names), F.lit(1))).over(rows))
    a = left.select("row", F.col("id").alias("left_id"), F.col("lat").alias("a_lat"), F.col("lon").alias("a_lon"), F.array_distinct("names").alias("_names"), F.coalesce(row_n, F.lit(0)).alias("row_n"))
    b = right.select(F.col("id").alias("right_id"), F.col("lat").alias("b_lat"), F.col("lon").alias("b_lon"), F.array_distinct("names").alias("_names")).withColumn("id_n", F.count("*").over(ids))
    return a.select(*a.columns[:4], "row_n", F.posexplode("_names").alias("name_ord", "name")), b.select("right_id", "b_lat", "b_lon", "id_n", F.explode("_names").alias("name"))


def _distances() -> tuple[Column, Column, Column]:
    """Differences of a pair's positions, and whether both are known."""
    d_lat, d_lon = F.abs(F.col("a_lat") - F.col("b_lat")), F.abs(F.col("a_lon") - F.col("b_lon"))
    return d_lat, d_lon, d_lat.isNotNull() & d_lon.isNotNull()


def in_band(pairs: DataFrame, band: float) -> DataFrame:
    d_lat, d_lon, known = _distances()
    return pairs.where(~known | ((d_lat <= band) & (d_lon <= band)))


def pair_columns() -> list[Column]:
    d_lat, d_lon, known = _distances()
    return [F.when(known, "name+geo").otherwise("name-only").alias("method"), d_lat.alias("d_lat"), d_lon.alias("d_lon"), F.col("name")]


def near_pairs(a: DataFrame, b: DataFrame, band: float) -> DataFrame:
    return in_band(_near(a, b, band), band)


def grouped_pairs(pairs: DataFrame) -> DataFrame:
    """One row per pair, with the name that counts."""
    known = _distances()[2]
    pairs = pairs.withColumn("geo", known.cast("int")).withColumn("pick", F.when(known, F.col("name_ord")).otherwise(-F.col("name_ord")))
    item = F.struct(*pair_columns())
    return pairs.groupBy("row", "left_id", "right_id").agg(F.max_by(item, F.struct("geo", "pick")).alias("r")).select("row", "left_id", "right_id", "r.*")


def by_cells(b: DataFrame, band: float):  # noqa: ANN201
    """(what puts cells x, y to placed records of the left, the right's records in their own and all neighbouring cells)."""
    cell = lambda c: F.floor(F.greatest(F.lit(-9e18), F.least(F.lit(9e18), F.col(c) / (band * (1 + 1e-9)))))
    around = lambda c: F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda k: cell(c) + k))
    return lambda a: a.withColumns({"x": cell("a_lat"), "y": cell("a_lon")}), b.withColumn("x", around("b_lat")).withColumn("y", around("b_lon"))


def _near(a: DataFrame, b: DataFrame, band: float) -> DataFrame:
    """Pairs of one name of which a position is missing, or whose positions lie in the same or in neighbouring cells.

    Cells are in the key, so that a name of very many places is many groups; they are a little wider than the band. Where no
    name is that common on the right, one join by name does.
    """
    if band <= 0 or (b.groupBy("name").count().agg(F.max("count")).first()[0] or 0) <= COMMON:
        return a.join(b, "name")
    placed = lambda df, side: df.where(F.col(f"{side}_lat").isNotNull() & F.col(f"{side}_lon").isNotNull())
    lost = lambda df, side: df.where(F.col(f"{side}_lat").isNull() | F.col(f"{side}_lon").isNull())
    at, by_cell = by_cells(placed(b, "b"), band)
    near = at(placed(a, "a")).join(by_cell, ["name", "x", "y"]).drop("x", "y")
    return near.unionByName(lost(a, "a").join(b, "name")).unionByName(placed(a, "a").join(lost(b, "b"), "name"))


def crosswalk_split(left: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(matched pairs, ambiguous pairs, one row of counts); records without a pair count too."""
    n = pairs.groupBy("row").agg(F.count("*").alias("n"))
    with_n = pairs.join(n, "row")
    return with_n.where("n = 1").drop("n"), with_n.where("n > 1").drop("n"), crosswalk_stats(left, n)


def crosswalk_stats(left: DataFrame, n: DataFrame) -> DataFrame:
    """One row of counts from the numbers (row, n) of pairs of the rows that have any."""
    all_n = left.select("row").join(n.select("row", "n"), "row", "left")
    return all_n.agg(F.count_if(F.col("n") == 1).alias("matched"), F.count_if(F.col("n") > 1).alias("ambiguous"), F.count_if(F.col("n").isNull()).alias("no_match"), F.count("*").alias("total"))


def closure(edges: DataFrame, roots: DataFrame, max_depth: int = 1000) -> DataFrame:
    """edges (child, parent), roots (root, node) -> (root, node) of all descendants, the start included; cycles end."""
    return depths(edges, roots, max_depth).select("root", "node")


def depths(edges: DataFrame, roots: DataFrame, max_depth: int = 1000) -> DataFrame:
    """closure with depth, the fewest edges from the root's start. Each round is written once and never again."""
    from onoma.operators.storage import checkpoint

    edges = checkpoint(edges.select("child", "parent").distinct())  # once, not in each round
    front = checkpoint(roots.select("root", "node").distinct().withColumn("depth", F.lit(0)))
    seen = front
    for depth in range(1, max_depth + 1):
        new = front.join(edges, front.node == edges.parent).select("root", F.col("child").alias("node")).distinct()
        front = checkpoint(new.join(seen, ["root", "node"], "left_anti").withColumn("depth", F.lit(depth)))
        if front.isEmpty():
            return seen
        seen = seen.unionByName(front)
    raise RuntimeError("the hierarchy is deeper than the bound")


def extend_depths(known: DataFrame, edges: DataFrame, added: DataFrame, max_depth: int = 1000) -> DataFrame:
    """What `depths` gives once `added` edges are there, from what it gave before; edges: all, the added included.

    Only what the new edges reach, or reach by fewer edges, is followed; new pairs and shorter depths are appended, and the
    least depth of each pair counts.
    """
    from onoma.operators.storage import checkpoint

    edges = checkpoint(edges.select("child", "parent").distinct())  # once, not in each round
    step = lambda front, by: front.join(by, front.node == by.parent).groupBy("root", F.col("child").alias("node")).agg((F.min("depth") + 1).alias("depth"))
    seen, new = known, step(known, added.select("child", "parent").distinct())
    for _ in range(max_depth):
        new = checkpoint(new)
        best = seen.join(new.select("root", "node"), ["root", "node"], "left_semi").groupBy("root", "node").agg(F.min("depth").alias("best"))
        front = checkpoint(new.join(best, ["root", "node"], "left").where("best is null or depth < best").drop("best"))
        if front.isEmpty():
            return seen.groupBy("root", "node").agg(F.min("depth").alias("depth"))
        seen, new = seen.unionByName(front), step(front, edges)
    raise RuntimeError("the hierarchy is deeper than the bound")


def shrink_depths(known: DataFrame, edges: DataFrame, removed: DataFrame, roots: DataFrame, max_depth: int = 1000) -> DataFrame:
    """What `depths` gives once `removed` edges are gone: only roots that reach one of them are reckoned anew; edges: those that are left."""
    hit = known.join(removed.select(F.col("parent").alias("node")).distinct(), "node", "left_semi").select("root").distinct()
    again = depths(edges, roots.join(hit, "root", "left_semi"), max_depth)
    return known.join(hit, "root", "left_anti").unionByName(again)


def running_total(df: DataFrame, order: list[str], value: Column) -> DataFrame:
    """df with total, the sum of `value` over the rows before it in a unique order; no task holds more than its range of rows."""
    from onoma.operators.storage import checkpoint

    ranged = checkpoint(df.withColumn("_v", value).repartitionByRange(*order).withColumn("_p", F.spark_partition_id()))
    part = ranged.groupBy("_p").agg(F.sum("_v").alias("_s"))
    before = part.select("_p", (F.sum("_s").over(Window.orderBy("_p")) - F.col("_s")).alias("_b"))  # a row per partition
    inner = F.sum("_v").over(Window.partitionBy("_p").orderBy(*order)) - F.col("_v")
    return ranged.withColumn("_i", inner).join(before, "_p").withColumn("total", F.col("_b") + F.col("_i")).drop("_v", "_p", "_b", "_i")


def place_of_total(rows: DataFrame, most: int) -> Row | None:
    """The place (file, block, line) of the row by whose hits the sum, in the order of places, reaches `most`; None if it never does.

    rows: (file, block, line, hits). Blocks are summed side by side, and only the one where the bound lies is looked into.
    """
    blocks = rows.groupBy("file", "block").agg(F.sum("hits").alias("hits"))
    total = F.sum("hits").over(Window.orderBy("file", "block"))  # a row per block of the input
    at = blocks.withColumn("total", total).where(F.col("total") >= most).orderBy("file", "block").first()
    if at is None:
        return None
    inside = rows.where((F.col("file") == at.file) & (F.col("block") == at.block))
    total = F.lit(at.total - at.hits) + F.sum("hits").over(Window.partitionBy("file", "block").orderBy("line"))
    return inside.withColumn("total", total).where(F.col("total") >= most).orderBy("line").select("file", "block", "line").first()


def merge_rows(rows: DataFrame, key: str, order: str, first: list[str], union: list[str]) -> DataFrame:
    """One row per key: the first value that is not empty of some columns, all distinct values in order of others."""
    aggs = [F.min_by(F.nullif(F.col(c).cast("string"), F.lit("")), F.when(F.nullif(F.col(c).cast("string"), F.lit("")).isNotNull(), F.col(order))).alias(c) for c in first]
    for c in union:
        aggs.append(F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(c).alias("v")))), lambda x: F.coalesce(x["v"], F.array().cast("array<string>"))))).alias(c))
    return rows.groupBy(key).agg(*aggs)


def most_specific(df: DataFrame, items: Column, dims: DataFrame, default: tuple, key: str) -> DataFrame:
    """df with period: the shortest dimension (qid, label, start, end, ord) among the items, else the default."""
    hits = df.select(key, F.explode(items).alias("qid")).join(F.broadcast(dims), "qid")  # the dimension is a fixed list
    best = hits.groupBy(key).agg(F.min_by(F.struct("label", "start", "end"), F.struct(F.col("end") - F.col("start"), "ord")).alias("period"))
    return df.join(best, key, "left").withColumn("period", F.coalesce("period", F.struct(*[F.lit(x).alias(n) for x, n in zip(default, ("label", "start", "end"), strict=True)])))


def keyset_page(df: DataFrame, key: str, after, limit: int) -> DataFrame:  # noqa: ANN001
    """Rows after a key, in its order: `limit` of them and what else the last key has, so no key is cut; null keys come with the first page.

    The last key is worked out at once, so that both bounds reach the scan.
    """
    rows = df if after is None else df.where(F.col(key) > after)
    last = rows.where(F.col(key).isNotNull()).select(key).orderBy(key).limit(limit).agg(F.max(key)).first()[0]
    return rows.where(F.col(key).isNull() | (F.col(key) <= F.lit(last).cast(df.schema[key].dataType))).orderBy(key)


def include_exclude(items: Column, include: list[str], exclude: list[str]) -> Column:
    """Any of the items included and none excluded."""
    has = lambda ids: F.coalesce(F.arrays_overlap(items, F.array(*[F.lit(i) for i in ids])), F.lit(False)) if ids else F.lit(False)
    return has(include) & ~has(exclude)


def same_set(a: Column, b: Column) -> Column:
    return F.sort_array(a) == F.sort_array(b)


def coalesce_text(*cols: Column) -> Column:
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
