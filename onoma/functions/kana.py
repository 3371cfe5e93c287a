"""Japanese readings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from onoma.functions.text import WS, collapse

KATAKANA = "".join(map(chr, [*range(0x30A1, 0x30F7), 0x30FD, 0x30FE]))
HIRAGANA = "".join(chr(ord(c) - 0x60) for c in KATAKANA)
KANA = "\\u3040-\\u309F\\u30A0-\\u30FF\\u31F0-\\u31FF"


def to_hiragana(c: Column) -> Column:
    return F.translate(c, KATAKANA, HIRAGANA)


def hiragana_reading(c: Column) -> Column:
    """The text in hiragana with single blanks; null where it has no kana."""
    return F.when(c.rlike(f"[{KANA}]"), collapse(to_hiragana(c)))


def is_kana_dominant(c: Column) -> Column:
    """Four fifths of the characters that are not blank, at least, are kana."""
    n = F.char_length(F.regexp_replace(c, f"[{WS}]+", ""))
    return (n > 0) & (F.char_length(F.regexp_replace(c, f"[^{KANA}]", "")) >= 0.8 * n)


def segments(c: Column) -> Column:
    bare = F.regexp_replace(c, "[0-9]{1,4}(-[0-9]{1,4})?", " ")
    return F.filter(F.split(bare, "[\\s,、，]+"), lambda x: x.rlike(f"[{KANA}]"))


def _forms(c: Column) -> Column:
    s = segments(c)
    return F.when(F.size(s) > 0, F.concat(F.array(F.array_join(s, " "), F.array_join(s, "")), s)).otherwise(F.array().cast("array<string>"))


def readings(yomi: Column, alt: Column) -> Column:
    """All katakana forms of the readings, distinct: joined by blanks, joined, and each segment."""
    sources = F.filter(F.concat(F.array(yomi), F.coalesce(alt, F.array().cast("array<string>"))), lambda x: F.coalesce(x, F.lit("")) != "")
    return F.array_distinct(F.flatten(F.transform(sources, _forms)))


def readings_hiragana(yomi: Column, alt: Column) -> Column:
    return F.array_distinct(F.transform(readings(yomi, alt), to_hiragana))
