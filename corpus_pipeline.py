"""The corpus pipeline: language, quality, near-duplicates, mixing, packing.

A stage takes documents with any further columns, of any names and types, and all but the last return them unchanged; repeated
rows are judged alike, and an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from onoma.llm import langid, mixing, packing, quality, simhash
from onoma.llm.common import stash, table, with_row_key


def under_own_names(docs: DataFrame) -> DataFrame:
    """docs whose columns but those that stages read are numbered, so that no name of theirs clashes; toDF gives them back."""
    return docs.toDF(*[c if c in ("doc_id", "text", "lang", "source") else f"other_{k}" for k, c in enumerate(docs.columns)])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Only texts that are null or have no letter go; without a labelled text no language is told and the others stay too."""
    rows = under_own_names(docs)
    model = langid.fit(rows)
    kept = langid.identify(rows, model).where(F.col("lang_pred") != langid.UNDETERMINED) if model.texts else langid.lettered(rows)
    return kept.select(rows.columns).toDF(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the learned decision list keep: null and empty texts go, as do all texts under 50 words."""
    rows = under_own_names(docs)
    rules = quality.fit(rows, table(spark, sf_dir, "labels"))
    return quality.judge(rows, rules).where("kept").select(rows.columns).toDF(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that with the smallest id, of each group of near-duplicates; ids may be null or repeated."""
    return simhash.survivors(under_own_names(docs)).toDF(*docs.columns)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as many times as the mix takes it, whether its id is null or repeated; equal rows share their copies."""
    rows = under_own_names(docs)
    keyed, key = with_row_key(rows)
    taken = mixing.mix(keyed.select("doc_id", "source", "text", *key), carry=tuple(key))
    copies = taken.groupBy(key).agg(F.sum("copies").cast("int").alias("copies")).where("copies > 0")
    each = keyed.join(copies, key).dropDuplicates(key).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return each.select(rows.columns).toDF(*docs.columns)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full windows, with their token ids; a null text is an empty one, and repeated rows are packed each."""
    return packing.pack(docs.select("doc_id", "text"))


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("mixing_sources", mixing_sources),
    ("packing", pack_documents),
]
#: The stages learn, hash by XXH64 and tokenise, which SQL cannot express; tests hold them against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
