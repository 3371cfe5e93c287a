"""Graph patterns over a table of triples (s, p, o, lang): what remote endpoints answer, answered locally.

A required pattern is a join, an optional one a left join, a MINUS an anti join, a property path a closure.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onoma.operators.relational import ambiguity, closure

TYPE, CLASS, SUBCLASS, LABEL, ALIAS = "type", "P31", "P279", "label", "altLabel"


def objects(triples: DataFrame, predicate: str, name: str, lang: str | None = None) -> DataFrame:
    """(s, name) of one predicate, in one language or in all."""
    rows = triples.where(F.col("p") == predicate)
    return (rows if lang is None else rows.where(F.col("lang") == lang)).select("s", F.col("o").alias(name))


def of_type(triples: DataFrame, kind: str, predicate: str = TYPE) -> DataFrame:
    """The distinct subjects of a type."""
    return triples.where((F.col("p") == predicate) & (F.col("o") == kind)).select("s").distinct()


def instances(triples: DataFrame, roots: list[str]) -> DataFrame:
    """Distinct items of the roots or of any class below them; cycles of classes end."""
    spark = triples.sparkSession
    edges = objects(triples, SUBCLASS, "parent").withColumnRenamed("s", "child")
    start = spark.createDataFrame([(r, r) for r in roots], "root string, node string")
    below = closure(edges, start).select(F.col("node").alias("o")).distinct()
    return triples.where(F.col("p") == CLASS).join(below, "o", "left_semi").select("s").distinct()


def minus_classes(items: DataFrame, triples: DataFrame, roots: list[str]) -> DataFrame:
    """Items that are no instance of the roots or of a class below them."""
    return items.join(instances(triples, roots), "s", "left_anti") if roots else items


def page(items: DataFrame, triples: DataFrame, required: dict[str, str], optional: dict[str, str], after: str | None = None, limit: int = 1000, keep: Column | None = None) -> DataFrame:
    """One page of rows by subject: required and optional map names to predicates; keep tests the required columns.

    Every subject has a row at least, so the first `limit` subjects are chosen before the optional patterns are joined.
    """
    rows = items if after is None else items.where(F.col("s") > after)
    for name, p in required.items():
        rows = rows.join(objects(triples, p, name), "s")
    rows = rows if keep is None else rows.where(keep)
    first = rows.select("s").distinct().orderBy("s").limit(limit)
    rows = rows.join(first, "s", "left_semi")
    for name, p in optional.items():
        rows = rows.join(objects(triples, p, name).join(first, "s", "left_semi"), "s", "left")
    return rows.orderBy("s", *[F.col(c).asc_nulls_first() for c in (*required, *optional)]).limit(limit)


def sample_by_prefix(items: DataFrame, triples: DataFrame, predicate: str, prefix: str, limit: int) -> DataFrame:
    """(s, value) of the first values that match the pattern at their start."""
    return items.join(objects(triples, predicate, "value"), "s").where(F.col("value").rlike(f"^{prefix}")).orderBy("value", "s").limit(limit)


def count(items: DataFrame) -> DataFrame:
    return items.agg(F.countDistinct("s").alias("n"))


def ambiguous_labels(items: DataFrame, triples: DataFrame, lang: str | None = None, limit: int = 100) -> DataFrame:
    """(surface, n): labels and other labels that name several items, most first."""
    rows = triples.where(F.col("p").isin(LABEL, ALIAS))
    rows = rows if lang is None else rows.where(F.col("lang") == lang)
    named = rows.join(items, "s", "left_semi").select(F.col("o").alias("surface"), F.col("s").alias("id"))
    return ambiguity(named).orderBy(F.desc("n"), "surface").limit(limit)


def count_matrix(triples: DataFrame, predicate: str, values: DataFrame, items: DataFrame) -> DataFrame:
    """(value, n) for every value of the dimension, 0 where no item has it."""
    rows = triples.where(F.col("p") == predicate).join(items, "s", "left_semi").groupBy(F.col("o").alias("value")).agg(F.countDistinct("s").alias("n"))
    return values.select("value").join(rows, "value", "left").select("value", F.coalesce("n", F.lit(0)).alias("n"))


def closure_document(triples: DataFrame, kinds: dict[str, list[str]]) -> DataFrame:
    """(kind, roots, closure): each kind's classes in the order of their numbers."""
    edges = objects(triples, SUBCLASS, "parent").withColumnRenamed("s", "child")
    start = triples.sparkSession.createDataFrame([(k, r) for k, rs in kinds.items() for r in rs], "root string, node string")
    number = F.expr("try_cast(substring(node, 2) as bigint)")
    rows = closure(edges, start).groupBy(F.col("root").alias("kind")).agg(F.array_sort(F.collect_list(F.struct(number.alias("k"), F.col("node").alias("q")))).alias("c"))
    roots = start.groupBy(F.col("root").alias("kind")).agg(F.array_sort(F.collect_set("node")).alias("roots"))
    return roots.join(rows, "kind").select("kind", "roots", F.transform("c", lambda x: x["q"]).alias("closure"))
