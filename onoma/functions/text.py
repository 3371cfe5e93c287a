"""Surface strings: normalisation, validity and splitting."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed value: the white space that normalisation collapses, as a character class body.
WS = "\\t\\n\\x0B\\f\\r \\u00A0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000\\uFEFF"
BLANKS = "".join(map(chr, [9, 10, 11, 12, 13, 32, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF]))
LATIN_ONLY = f"^[\\u0000-\\u024F{WS}\\-'.]*$"
#: Ranges without a character that composition changes, moves, or joins to the one before it.
SAFE = "\\u0000-\\u02FF\\u0388-\\u0482\\u1E00-\\u1F70\\u2002-\\u20CF\\u2E00-\\u3029\\u3030-\\u3098\\u309B-\\uA66E\\uABEE-\\uD7FF\\uFE30-\\uFFFF"
CJK = "\\u4E00-\\u9FFF"


@F.pandas_udf(T.StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def nfc(c: Column) -> Column:
    """Canonical composition; strings of SAFE characters alone, which are composed as they are, don't leave the JVM.

    By Python's table, since the installed Arrow's utf8_normalize leaves decomposed strings as they are.
    """
    return F.coalesce(_nfc(F.when(_unsafe(c), c)), c)


def _unsafe(c: Column) -> Column:
    """Whether a string has a character that is not of SAFE; those of plain Latin are told by the first range alone."""
    return c.rlike("[^\\u0000-\\u02FF]") & c.rlike(f"[^{SAFE}]")


@F.pandas_udf(T.ArrayType(T.StringType()))
def _nfc_array(s: pd.Series) -> pd.Series:
    return s.map(lambda xs: None if xs is None else [None if x is None else unicodedata.normalize("NFC", x) for x in xs])


def nfc_array(c: Column) -> Column:
    """nfc of each string; taken before higher-order functions, whose bodies cannot call Python."""
    return F.coalesce(_nfc_array(F.when(_unsafe(F.array_join(c, "")), c)), c)


def collapse(c: Column) -> Column:
    """Runs of white space are one blank, and none at the ends."""
    return F.trim(F.regexp_replace(F.translate(c, BLANKS, " " * len(BLANKS)), " {2,}", " "))


def normalize_surface(c: Column, compose: bool = True) -> Column:
    c = F.coalesce(c, F.lit(""))
    return collapse(nfc(c) if compose else c)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def code_points(c: Column) -> Column:
    return F.char_length(c)


def min_length(c: Column, script: str | None = None) -> Column:
    return F.lit(3) if script == "latn" else F.when(c.rlike(LATIN_ONLY), 3).otherwise(2)


def is_valid(c: Column, script: str | None = None) -> Column:
    n = F.char_length(c)
    if script == "latn":
        return n >= 3
    return (n >= 3) | ((n == 2) & ~c.rlike(LATIN_ONLY))  # as min_length has it, but few strings are looked into


def search_strings(arr: Column, script: str | None = None) -> Column:
    """Normalised, valid, distinct, in order of first occurrence."""
    return F.array_distinct(F.filter(F.transform(nfc_array(arr), lambda x: normalize_surface(x, compose=False)), lambda x: is_valid(x, script)))


def split_alt_names(c: Column) -> Column:
    return F.filter(F.transform(nfc_array(F.split(c, "[;\\uFF1B]")), lambda x: normalize_surface(x, compose=False)), lambda x: x != "")


def split_semicolons(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, ";"), strip), lambda x: x != "")


def names_from_pipe(c: Column) -> Column:
    return F.filter(F.transform(nfc_array(F.split(F.coalesce(c, F.lit("")), "\\|")), lambda x: normalize_surface(x, compose=False)), lambda x: x != "")


def label_key(c: Column) -> Column:
    return F.regexp_replace(c, f"[{WS}]+", "")


def is_blocked(c: Column, surname: Column | None = None) -> Column:
    """Person strings that name no person: symbols, Latin letters, placeholders, birth order."""
    out = (c == "") | c.rlike("[*(\\[\\-]|[A-Za-z]") | c.rlike(f"^[{CJK}]某$") | c.rlike(f"^[{CJK}]{{1,3}}(?:[0-9]+|[一二三四五六七八九十廿卅卌]+)$")
    if surname is not None:
        known = F.coalesce(surname, F.lit("")) != ""
        out = out | (known & ((c == F.concat(surname, F.lit("氏"))) | (c == F.concat(surname, F.lit("某")))))
    return F.coalesce(out, F.lit(True))


def infer_surname(c: Column) -> Column:
    return F.when(c.rlike(f"^[{CJK}]") & F.char_length(c).between(2, 4), F.substring(c, 1, 1)).otherwise("")


def courtesy_body(c: Column) -> Column:
    return F.regexp_replace(c, f"^子([{CJK}]{{1,2}})$", "$1")


def stem(name: Column, kind: Column) -> Column:
    """The name without its administrative suffix, if two characters remain."""
    size = F.char_length(name) - F.char_length(kind)
    return F.when((F.char_length(kind) > 0) & (F.char_length(name) > 2) & name.endswith(kind) & (size >= 2), F.left(name, size))


def first_clause(c: Column) -> Column:
    """The text before its first stop, or its first 40 characters; of more than 60 the first 57."""
    c = strip(c)
    got = F.regexp_extract(c, "^([^。.]+[。.])", 1)
    got = F.regexp_replace(F.when(got != "", got).otherwise(F.substring(c, 1, 40)), "[。.]$", "")
    return F.when(F.char_length(got) > 60, F.concat(F.substring(got, 1, 57), F.lit("…"))).otherwise(got)


def tsv_cell(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), "[\\t\\r\\n]+", " ")


def csv_cell(c: Column, always: bool = False) -> Column:
    c = F.coalesce(c, F.lit(""))
    quoted = F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    return quoted if always else F.when(c.rlike('[",\\r\\n]'), quoted).otherwise(c)
