"""Short descriptive texts that tell namesakes apart; the exact wording matters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _some(c: Column) -> Column:
    return F.nullif(c.cast("string"), F.lit(""))


def _bracketed(name: Column, *parts: Column) -> Column:
    inside = F.concat_ws(", ", *parts)
    return F.when(inside == "", name).otherwise(F.concat(name, F.lit(" ("), inside, F.lit(")")))


def life_dates(birth: Column, death: Column, first: Column, last: Column, index: Column) -> Column:
    dash = F.lit("–")
    return (
        F.when(birth.isNotNull() & death.isNotNull(), F.concat(birth.cast("string"), dash, death.cast("string")))
        .when(birth.isNotNull(), F.concat(F.lit("b. "), birth.cast("string")))
        .when(death.isNotNull(), F.concat(F.lit("d. "), death.cast("string")))
        .when(first.isNotNull() & last.isNotNull(), F.concat(F.lit("fl. "), first.cast("string"), dash, last.cast("string")))
        .when(index.isNotNull(), F.concat(F.lit("fl. "), index.cast("string")))
    )


def dynasty(chinese: Column, english: Column) -> Column:
    return F.nullif(F.concat_ws(" ", _some(chinese), _some(english)), F.lit(""))


def person(name: Column, pinyin: Column, dates: Column, dynasty_text: Column, extra: Column) -> Column:
    return _bracketed(name, _some(pinyin), dates, _some(dynasty_text), _some(extra))


def listed_person(name: Column, birth: Column, death: Column, dynasty_text: Column, occupation: Column, clause: Column) -> Column:
    none = F.lit(None).cast("int")
    return _bracketed(name, life_dates(birth, death, none, none, none), _some(dynasty_text), F.coalesce(_some(occupation), _some(clause)))


def place(name: Column, subtype: Column, dynasty_text: Column, start: Column, end: Column) -> Column:
    return _bracketed(name, _some(subtype), _some(dynasty_text), F.concat(start.cast("string"), F.lit("–"), end.cast("string")))


def listed_place(name: Column, category: Column, district: Column) -> Column:
    inside = F.concat_ws(" — ", _some(category), _some(district))
    return F.when(inside == "", name).otherwise(F.concat(name, F.lit(" ("), inside, F.lit(")")))


def mapped_place(name: Column, kind: Column, start: Column, end: Column, location: Column, pinyin: Column) -> Column:
    years = (
        F.when(start.isNotNull() & end.isNotNull(), F.concat(start.cast("string"), F.lit("–"), end.cast("string")))
        .when(start.isNotNull(), F.concat(F.lit("from "), start.cast("string")))
        .when(end.isNotNull(), F.concat(F.lit("to "), end.cast("string")))
    )
    inside = F.concat_ws(", ", _some(kind), years, _some(location))
    return F.when(inside == "", _bracketed(name, _some(pinyin))).otherwise(F.concat(name, F.lit(" ("), inside, F.lit(")")))


def office(name: Column, translation: Column, dynasty_text: Column) -> Column:
    t, d = _some(translation), _some(dynasty_text)
    return (
        F.when(t.isNotNull() & d.isNotNull(), F.concat(name, F.lit(" ("), t, F.lit(", "), d, F.lit(")")))
        .when(t.isNotNull(), F.concat(name, F.lit(" ("), t, F.lit(", )")))
        .when(d.isNotNull(), F.concat(name, F.lit(", "), d, F.lit(")")))
        .otherwise(name)
    )


def graph_person(name: Column, period: Column, fictional: Column, qid: Column) -> Column:
    return F.concat(name, F.lit(" ("), F.concat_ws(", ", period, F.when(fictional, "fictional"), F.concat(F.lit("Wikidata "), qid)), F.lit(")"))


def graph_entity(name: Column, qid: Column) -> Column:
    return F.concat(name, F.lit(" (Wikidata "), qid, F.lit(")"))


def catalogue_entry(name: Column, ident: Column, creators: Column | None = None) -> Column:
    by = F.array_join(creators, "; ") if creators is not None else F.lit("")
    return _bracketed(name, _some(by), F.concat(F.lit("NDL "), ident))
