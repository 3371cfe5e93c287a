"""Writers of packs with manifests, reports and bundles."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from onoma.functions.text import csv_cell, tsv_cell
from onoma.operators.storage import join_files
from onoma.sources.files import usable_files


def write_ndjson(df: DataFrame, path: str, single: bool = False) -> None:
    (df.repartition(1) if single else df).write.mode("overwrite").json(path)


def write_pack(cands: DataFrame, path: str, source: str, policy: dict | None = None, facts: dict | None = None, **counts: Column) -> dict:
    """Writes candidates and a manifest beside them, with counts, facts and the policy; returns the manifest."""
    seen = Observation()
    write_ndjson(cands.observe(seen, F.count(F.lit(1)).alias("entityCount"), F.coalesce(F.sum(F.size("searchStrings")), F.lit(0)).alias("stringCount"), *[c.alias(k) for k, c in counts.items()]), path)
    row = seen.get
    manifest = {"source": source, **row, **(facts or {}), **({"policy": policy} if policy else {})}
    cands.sparkSession.createDataFrame([(json.dumps(manifest, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}.manifest")
    return manifest


def write_fan_out(df: DataFrame, path: str, *by: str) -> None:
    """One scan, one folder for each value of the columns."""
    df.write.mode("overwrite").partitionBy(*by).json(path)


def _write_lines(lines: DataFrame, path: str, head: str | None) -> None:
    """One file of lines (column value) in their order, below the head: tasks write parts, which the driver's JVM joins as they are."""
    spark = lines.sparkSession
    parts = f"{path}.parts-{uuid.uuid4().hex}"
    lines.select("value").write.text(parts)
    join_files(spark, parts, f"{path}/part-00000.txt", head)


def write_text(spark: SparkSession, lines: list[str], path: str) -> None:
    """A short report, as one file."""
    _write_lines(spark.createDataFrame(list(enumerate(lines)), "k int, value string").orderBy("k").select("value"), path, None)


def write_tsv(df: DataFrame, path: str, header: bool = True) -> None:
    lines = df.select(F.concat_ws("\t", *[tsv_cell(F.col(c).cast("string")) for c in df.columns]).alias("value"))
    _write_lines(lines, path, "\t".join(df.columns) if header else None)


def write_csv(df: DataFrame, path: str, always: bool = False) -> None:
    lines = df.select(F.concat_ws(",", *[csv_cell(F.col(c).cast("string"), always) for c in df.columns]).alias("value"))
    _write_lines(lines, path, ",".join(df.columns))


def layer_counts(df: DataFrame, layers: DataFrame) -> DataFrame:
    """Rows of each layer, layers without rows included."""
    return layers.join(df.groupBy("layer").count(), "layer", "left").select("layer", F.coalesce("count", F.lit(0)).alias("n"))


def bundle_index(spark: SparkSession, path: str, prefixes: dict[str, str] | None = None) -> DataFrame:
    """(bundle, path, bytes, sha256) of usable files; a file belongs to each bundle whose prefix its name has."""
    files = usable_files(spark, path)
    name = F.regexp_extract("path", "([^/]+)$", 1)
    groups = F.array_compact(F.array(*[F.when(name.startswith(p), F.lit(b)) for b, p in (prefixes or {"all": ""}).items()]))
    return files.select(F.explode(groups).alias("bundle"), "path", "bytes", "sha256")


def compact_date(c: Column) -> Column:
    return F.coalesce(F.date_format(F.try_to_timestamp(c), "yyyyMMdd"), F.lit("local"))


def region_of(path: Column, prefixes: dict[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for bundle, prefix in prefixes.items():
        out = F.when(path.startswith(prefix), bundle).otherwise(out)
    return out
