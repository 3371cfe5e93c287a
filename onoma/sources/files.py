"""Line, JSON, TSV and CSV sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from onoma.functions.text import split_semicolons, strip

ENTITY = (
    "type string, id string, labels map<string,struct<language:string,value:string>>, "
    "aliases map<string,array<struct<language:string,value:string>>>, "
    "claims map<string,array<struct<mainsnak:struct<snaktype:string,datavalue:struct<type:string,value:string>>>>>"
)


def ndjson(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Our own line JSON: a malformed line is an error, a blank one is not."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def dump_entities(lines: DataFrame) -> DataFrame:
    """Entities of a dump's text lines (column value), beside the lines' other columns: array brackets, blank and malformed lines are passed over."""
    more = [c for c in lines.columns if c != "value"]
    body = lines.select(*more, F.regexp_replace(strip(F.col("value")), ",$", "").alias("_body"))
    entity = F.from_json(F.when(F.col("_body").startswith("{"), F.col("_body")), ENTITY)
    return body.select(*more, F.inline(F.array(entity))).where("id is not null")  # a generator's, so that no filter parses a line again


def dump(spark: SparkSession, path: str) -> DataFrame:
    """Plain, gzip or bzip2 dump; bzip2 splits."""
    return dump_entities(spark.read.text(path))


def placed_dump(spark: SparkSession, path: str) -> DataFrame:
    """The entities of a dump with the place of their lines: file, block (its start in the file) and line (rising within the block)."""
    m = F.col("_metadata")
    return dump_entities(spark.read.text(path).select("value", m["file_path"].alias("file"), m["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("line")))


def tsv(spark: SparkSession, path: str) -> DataFrame:
    """With header, all strings; missing cells are empty."""
    got = spark.read.option("sep", "\t").option("header", True).option("quote", "").csv(path)
    return got.select([F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in got.columns])


def csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("escape", '"').option("multiLine", False).csv(path)


def works(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Headerless rows id, title, variants;, creators;, created, updated; rows of fewer than two cells go.

    limit: rows after which the reader may stop.
    """
    cell = F.split(strip(F.col("value")), "\t")
    at = lambda k: strip(F.coalesce(F.get(cell, F.lit(k)), F.lit("")))
    rows = spark.read.text(path).where((strip(F.col("value")) != "") & (F.size(cell) >= 2))
    empty = F.lit("")
    got = rows.select(
        at(0).alias("id"), at(1).alias("title"), split_semicolons(at(2)).alias("variants"), split_semicolons(at(3)).alias("creators"),
        F.nullif(at(4), empty).alias("created"), F.nullif(at(5), empty).alias("updated"),
    )
    got = got.where("id != '' and title != ''")
    return got if limit is None else got.limit(limit)


def bindings(results: DataFrame, column: str = "value") -> DataFrame:
    """Rows of SPARQL result JSON texts: b map<string, struct<type, value>>; an error payload fails."""
    return ordered_bindings(results, column).select("b")


def ordered_bindings(results: DataFrame, column: str = "value") -> DataFrame:
    """Rows of `bindings` with their order in their text, ord."""
    text = F.when(F.col(column).rlike('"status"\\s*:\\s*"error"'), F.raise_error(F.lit("the endpoint reports an error"))).otherwise(F.col(column))
    parsed = F.from_json(text, "results struct<bindings:array<map<string,struct<type:string,value:string>>>>")
    return results.select(F.posexplode(parsed["results"]["bindings"]).alias("ord", "b"))


def usable(files: DataFrame) -> DataFrame:
    """Rows of the binaryFile format without pointers to large-file storage."""
    head = F.substring("content", 1, 40).cast("string")
    return files.where(~F.coalesce(head.startswith("version https://git-lfs"), F.lit(False)))


def usable_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, bytes, sha256) of files that are not pointers to large-file storage."""
    kept = usable(spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path))
    return kept.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def count_lines(spark: SparkSession, path: str) -> int:
    return spark.read.text(path).where(F.trim("value") != "").count()
