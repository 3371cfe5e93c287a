"""TEI-XML lists, record by record; fragments need not be well-formed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from onoma.functions.text import strip
from onoma.functions.years import number_prefix


#: Endings of compressed files, whose sizes say nothing about their texts.
_PACKED = r"\.(gz|bz2|zst|lz4|snappy|deflate|xz)$"


def records(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """(xml) of each <tag xml:id=…>…</tag>, ending at the first closing tag.

    Closing tags part a file, so it splits at any byte and a task holds one record at a time; a record runs from the first
    opening tag behind the closing tag before. What follows a file's last closing tag is no record. A compressed file is
    read by one task.
    """
    end, file = f"</{tag}>", F.col("_metadata.file_path")
    parts = spark.read.option("lineSep", end).text(path).where(~file.rlike(_PACKED))
    parts = parts.select("value", file.alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("size"), F.monotonically_increasing_id().alias("n"))
    # With a closing tag for each part, a file that lacks the last one would be larger than it is.
    blocks = parts.groupBy("file", "block", "size").agg(F.max("n").alias("n"), F.sum(F.octet_length("value") + len(end)).alias("bytes"))
    cut = blocks.groupBy("file", "size").agg(F.max_by("n", "block").alias("n"), F.sum("bytes").alias("bytes")).where("bytes > size").select("n")
    xml = F.regexp_extract("value", f"(?s)<{tag}\\s+xml:id=.*", 0)
    whole = parts.select("n", xml.alias("xml")).where("xml != ''").join(cut, "n", "left_anti")
    packed = spark.read.text(path, wholetext=True).where(file.rlike(_PACKED))
    return whole.select(F.concat("xml", F.lit(end)).alias("xml")).unionByName(fragments(packed, "value", tag, "xml:id=").select("xml"))


def fragments(df: DataFrame, column: str, tag: str, first_attribute: str = "") -> DataFrame:
    """df with (xml_ord, xml), a row for each fragment of the column, numbered from 0."""
    lead = f"<{tag}\\s+{first_attribute}" if first_attribute else f"<{tag}\\b"
    return df.select("*", F.posexplode(F.regexp_extract_all(F.col(column), F.lit(f"(?s){lead}.*?</{tag}>"), F.lit(0))).alias("xml_ord", "xml"))


def attribute(xml: Column, name: str) -> Column:
    return F.nullif(F.regexp_extract(xml, f'^<[^>]*?\\s{name}="([^"]*)"', 1), F.lit(""))


def own_text(xml: Column) -> Column:
    """The element's own text: children and their content are left out."""
    inner = F.regexp_replace(xml, "(?s)^<[^>]*>|</[^<>]*>$", "")
    bare = F.regexp_replace(F.regexp_replace(inner, "(?s)<(\\w+)[^>]*>.*?</\\1>", ""), "<[^>]*>", "")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(entity), F.lit(char))
    return strip(bare)


def elements(xml: Column, tag: str) -> Column:
    """array<struct<text, lang, type, key>> of the elements of this name."""
    found = F.regexp_extract_all(xml, F.lit(f"(?s)<{tag}(?:\\s[^>]*)?>.*?</{tag}>|<{tag}(?:\\s[^>]*)?/>"), F.lit(0))
    return F.transform(found, lambda x: F.struct(own_text(x).alias("text"), attribute(x, "xml:lang").alias("lang"), attribute(x, "type").alias("type"), attribute(x, "key").alias("key")))


def persons(spark: SparkSession, path: str) -> DataFrame:
    rows = records(spark, path, "person")
    x = F.col("xml")
    return rows.select(
        attribute(x, "xml:id").alias("id"), attribute(x, "ana").alias("ana"), elements(x, "persName").alias("names"),
        F.get(elements(x, "birth"), F.lit(0))["text"].alias("birth"), F.get(elements(x, "death"), F.lit(0))["text"].alias("death"),
        elements(x, "note").alias("notes"), elements(x, "occupation").alias("occupation"), elements(x, "idno").alias("idnos"),
    )


def places(spark: SparkSession, path: str) -> DataFrame:
    rows = records(spark, path, "place")
    x = F.col("xml")
    number = lambda tag: number_prefix(F.regexp_extract(x, f"<{tag}>\\s*([^<]*?)\\s*</{tag}>", 1))
    pair = F.split(F.coalesce(F.nullif(F.regexp_extract(x, '<geo[^>]*\\scoordinates="([^"]*)"', 1), F.lit("")), strip(F.regexp_extract(x, "<geo[^>]*>([^<]*)</geo>", 1))), "\\s+")
    lat, lon = F.coalesce(number("lat"), number_prefix(F.get(pair, F.lit(0)))), F.coalesce(number("long"), number("lon"), number_prefix(F.get(pair, F.lit(1))))
    return rows.select(
        attribute(x, "xml:id").alias("id"), elements(x, "placeName").alias("names"), elements(x, "note").alias("notes"),
        F.get(elements(x, "district"), F.lit(0))["text"].alias("district"), F.nullif(F.regexp_extract(x, '<location[^>]*>\\s*<place[^>]*\\skey="([^"]*)"', 1), F.lit("")).alias("district_key"),
        F.when(lat.isNotNull() & lon.isNotNull(), F.struct(lat.alias("lat"), lon.alias("lon"))).alias("geo"),
    )


def districts(spark: SparkSession, path: str) -> DataFrame:
    """(id, name): the first Chinese name of a place, else its first."""
    names = F.col("names")
    chinese = F.filter(names, lambda n: n["lang"].startswith("zho"))
    return places(spark, path).select("id", F.coalesce(F.get(chinese, F.lit(0))["text"], F.get(names, F.lit(0))["text"]).alias("name")).where("name is not null")


def han_names(names: Column) -> Column:
    ok = F.filter(names, lambda n: n["lang"].isNull() | n["lang"].startswith("zho"))
    return F.filter(F.transform(ok, lambda n: n["text"]), lambda t: t != "")


def note(notes: Column, kind: str) -> Column:
    return F.get(F.filter(notes, lambda n: n["type"] == kind), F.lit(0))["text"]


def untyped_note(notes: Column) -> Column:
    return F.get(F.filter(notes, lambda n: n["type"].isNull()), F.lit(0))["text"]
