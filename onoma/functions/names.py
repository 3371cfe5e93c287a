"""Which of an entity's names may be searched for."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from onoma.functions.text import CJK, infer_surname, is_blocked, is_valid, nfc, nfc_array, normalize_surface, search_strings, strip

#: Alternative-name codes that are never used, and the type that each other code yields.
EXCLUDED = [0, 7, 9, 10]
NAME_TYPES = {3: "variant", 4: "courtesy", 5: "art", 6: "posthumous", 8: "variant", 11: "variant", 14: "temple", 19: "dharma", 20: "dharma", 15: "variant", 18: "variant"}
ENTRY = "array<struct<text:string,type:string>>"


def _composed(body, **cols: Column) -> Column:  # noqa: ANN001
    """body of the columns, which are worked out once, before any higher-order function of the body."""
    return F.get(F.transform(F.array(F.struct(*[c.alias(k) for k, c in cols.items()])), lambda r: body(*[r[k] for k in cols])), F.lit(0))


def typed_entries(primary: Column, surname: Column, given: Column, alts: Column) -> Column:
    """Entries (text, type) of a person, alts being array<struct<type:int,value:string>> in source order.

    Candidates come in rule order; blocked and short ones go; of equal texts the first stays.
    """
    pair = lambda p, s, g, a, v: _typed_entries(p, s, g, F.zip_with(a, v, lambda x, y: F.struct(x["type"].alias("type"), y.alias("value"))))
    return _composed(pair, primary=nfc(primary), surname=nfc(surname), given=nfc(given), alts=alts, values=nfc_array(alts["value"]))


def _typed_entries(primary: Column, surname: Column, given: Column, alts: Column) -> Column:
    primary, surname, given = (normalize_surface(c, compose=False) for c in (primary, surname, given))
    values = lambda code: F.filter(F.transform(F.filter(alts, lambda a: a["type"] == code), lambda a: normalize_surface(a["value"], compose=False)), lambda v: v != "")
    longer = lambda v: F.char_length(v) > F.char_length(primary)
    as_type = lambda arr, t: F.transform(arr, lambda v: F.struct(v.alias("text"), F.lit(t).alias("type")))
    blocks = [
        as_type(F.array(primary), "primary"),
        as_type(F.filter(values(3), longer), NAME_TYPES[3]),
        as_type(F.transform(values(4), lambda v: F.concat(surname, v)), NAME_TYPES[4]),
        *[as_type(F.filter(values(k), longer), NAME_TYPES[k]) for k in (5, 6)],
        *[as_type(values(k), NAME_TYPES[k]) for k in (8, 11, 14, 19, 20)],
        as_type(F.filter(values(15), lambda v: F.char_length(v) >= F.char_length(primary)), NAME_TYPES[15]),
        as_type(F.flatten(F.transform(values(12), lambda s: F.transform(values(13), lambda g: F.concat(s, g)))), "variant"),
        as_type(F.transform(values(18), lambda v: F.when((given != "") & (F.char_length(v) <= F.char_length(surname)), F.concat(v, given)).otherwise(v)), NAME_TYPES[18]),
    ]
    entries = F.filter(F.concat(*[b.cast(ENTRY) for b in blocks]), lambda e: ~is_blocked(e["text"], surname) & is_valid(e["text"]))
    texts = F.transform(entries, lambda e: e["text"])
    return F.filter(entries, lambda e, i: F.array_position(texts, e["text"]) == i + 1)


def person_strings(label: Column, aliases: Column, family: Column | None = None) -> Column:
    """The label, and aliases longer than it, unless blocked."""
    return _composed(_person_strings, label=nfc(label), aliases=nfc_array(aliases), family=F.lit("") if family is None else nfc(family))


def _person_strings(label: Column, aliases: Column, family: Column) -> Column:
    label = normalize_surface(label, compose=False)
    surname = F.coalesce(F.nullif(normalize_surface(family, compose=False), F.lit("")), infer_surname(label))
    more = F.filter(F.transform(aliases, lambda a: normalize_surface(a, compose=False)), lambda a: F.char_length(a) > F.char_length(label))
    return F.array_distinct(F.filter(F.concat(F.array(label), more), lambda s: ~is_blocked(s, surname) & is_valid(s)))


def kind_strings(label: Column, aliases: Column, script: str | None = None) -> Column:
    return search_strings(F.concat(F.array(label), F.coalesce(aliases, F.array().cast("array<string>"))), script)


def is_usable_native_name(c: Column) -> Column:
    """Has a Han character and neither Latin letters nor digits; for persons and organisations."""
    t = strip(F.coalesce(c, F.lit("")))
    return t.rlike(f"[{CJK}]") & ~t.rlike("[A-Za-z0-9]")


def without_qualifier(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, "^(.*?) \\([^)]+\\)$", 1), F.lit(""))


def heading_strings(name: Column, heading: Column, readings: Column, hiragana: Column, usable=None) -> Column:
    """Name, heading, name without its qualifier, readings; each once. Where the name is not usable there are none."""
    own = F.array_compact(F.array(strip(name), strip(heading), without_qualifier(strip(name))))
    out = F.array_distinct(F.concat(F.filter(own, lambda s: s != ""), readings, hiragana))
    return F.when(usable(name), out).otherwise(F.array().cast("array<string>")) if usable else out


def title_strings(title: Column, variants: Column) -> Column:
    return F.array_distinct(F.filter(F.concat(F.array(strip(title)), F.transform(variants, strip)), lambda s: s != ""))
