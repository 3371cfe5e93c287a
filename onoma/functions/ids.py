"""Identifiers of other authorities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from onoma.functions.text import strip


def normalize_identifier(c: Column, mode: str) -> Column:
    t = strip(c)
    if mode == "digits":
        return F.coalesce(F.nullif(F.regexp_replace(t, "[^0-9]", ""), F.lit("")), t)
    if mode == "no_zeros":
        return F.coalesce(F.nullif(F.regexp_replace(t, "^0+", ""), F.lit("")), t)
    return t


def qid_of_uri(c: Column) -> Column:
    got = F.regexp_extract(c, "/(Q[0-9]+)$", 1)
    return F.when(got != "", got).otherwise(c)


def authority_id_of_uri(c: Column) -> Column:
    return F.regexp_extract(c, "/([^/]+)$", 1)
