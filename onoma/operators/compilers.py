"""From each authority's raw rows to candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onoma.functions import clues, ids, kana, names, text, years
from onoma.operators import config
from onoma.operators.relational import coalesce_text, include_exclude, last_wins, merge_rows, most_specific, nest, with_once
from onoma.sources import tei

EMPTY = "array<string>"
#: Included and excluded classes by kind, each with all classes below it.
Closure = dict[str, tuple[list[str], list[str]]]


def _none(kind: str) -> Column:
    return F.lit(None).cast(kind)


def _candidate(df: DataFrame, source: str, kind: str | Column, ident: Column, name: Column, strings: Column, metadata: Column, *more: Column) -> DataFrame:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return df.select(F.lit(source).alias("source"), ident.cast("string").alias("authorityId"), kind.alias("kind"), name.alias("primaryName"), strings.alias("searchStrings"), metadata.alias("metadata"), *more)


# --- relational snapshot ---------------------------------------------------------------------------------------------


def snapshot_persons(main: DataFrame, alts: DataFrame, dynasties: DataFrame) -> DataFrame:
    """Persons with typed names; years fall back from birth to floruit to dynasty."""
    nested = nest(alts.select("c_personid", "_ord", F.col("c_alt_name_type_code").cast("int").alias("type"), F.col("c_alt_name_chn").alias("value")), "c_personid", "_ord", "type", "value", into="alts")
    d = dynasties.select(F.col("c_dy").alias("d_dy"), "c_dynasty", "c_dynasty_chn", "c_start", "c_end")
    df = main.where(F.trim(F.coalesce("c_name_chn", F.lit(""))) != "").join(nested, "c_personid", "left").join(d, F.col("c_dy") == F.col("d_dy"), "left")
    alt = F.transform(F.coalesce("alts", F.array().cast("array<struct<_ord:bigint,type:int,value:string>>")), lambda a: F.struct(a["type"].alias("type"), a["value"].alias("value")))
    df = with_once(df, "names", names.typed_entries(F.col("c_name_chn"), F.col("c_surname_chn"), F.col("c_mingzi_chn"), alt)).where(F.size("names") > 0)
    dates = clues.life_dates(F.col("c_birthyear"), F.col("c_deathyear"), F.col("c_fl_earliest_year"), F.col("c_fl_latest_year"), F.col("c_index_year"))
    meta = F.struct(
        coalesce_text(F.col("c_dynasty_chn"), F.col("c_dynasty")).alias("dynasty"), F.coalesce("c_birthyear", "c_fl_earliest_year", "c_start").cast("int").alias("startYear"),
        F.coalesce("c_deathyear", "c_fl_latest_year", "c_end").cast("int").alias("endYear"), F.col("c_name").alias("pinyin"),
        clues.person(F.col("c_name_chn"), F.col("c_name"), dates, clues.dynasty(F.col("c_dynasty_chn"), F.col("c_dynasty")), _none("string")).alias("description"),
    )
    return _candidate(df, "CBDB", "person", F.col("c_personid"), F.col("c_name_chn"), F.transform("names", lambda n: n["text"]), meta, F.col("names"))


def snapshot_places(places: DataFrame) -> DataFrame:
    df = places.where(F.trim(F.coalesce("c_name_chn", F.lit(""))) != "")
    strings = text.search_strings(F.concat(F.array("c_name_chn"), text.split_alt_names(F.coalesce("c_alt_names", F.lit("")))))
    meta = F.struct(F.col("c_admin_type").alias("subtype"), F.col("c_firstyear").cast("int").alias("startYear"), F.col("c_lastyear").cast("int").alias("endYear"), clues.place(F.col("c_name_chn"), F.col("c_admin_type"), _none("string"), F.col("c_firstyear"), F.col("c_lastyear")).alias("description"))
    return _candidate(with_once(df, "s", strings).where(F.size("s") > 0), "CBDB", "place", F.col("c_addr_id"), F.col("c_name_chn"), F.col("s"), meta)


def snapshot_offices(offices: DataFrame, dynasties: DataFrame) -> DataFrame:
    d = dynasties.select(F.col("c_dy").alias("d_dy"), "c_dynasty", "c_dynasty_chn", "c_start", "c_end")
    df = offices.where(F.trim(F.coalesce("c_office_chn", F.lit(""))) != "").join(d, F.col("c_dy") == F.col("d_dy"), "left")
    strings = text.search_strings(F.concat(F.array("c_office_chn"), text.split_alt_names(F.coalesce("c_office_chn_alt", F.lit("")))))
    label = coalesce_text(F.col("c_dynasty_chn"), F.col("c_dynasty"))
    meta = F.struct(label.alias("dynasty"), F.col("c_start").cast("int").alias("startYear"), F.col("c_end").cast("int").alias("endYear"), F.col("c_office_trans").alias("translation"), clues.office(F.col("c_office_chn"), F.col("c_office_trans"), label).alias("description"))
    return _candidate(with_once(df, "s", strings).where(F.size("s") > 0), "CBDB", "office", F.col("c_office_id"), F.col("c_office_chn"), F.col("s"), meta)


def crosswalk_of_points(places: DataFrame) -> DataFrame:
    """(chgis, cbdb): of equal point ids the last place counts."""
    rows = places.select(F.trim(F.col("CHGIS_PT_ID").cast("string")).alias("chgis"), F.col("c_addr_id").cast("string").alias("cbdb"), "_ord").where("chgis != ''")
    return last_wins(rows, "chgis", "_ord").select("chgis", "cbdb")


# --- TEI lists -------------------------------------------------------------------------------------------------------


def listed_persons(rows: DataFrame, labels: DataFrame) -> DataFrame:
    han = tei.han_names(F.col("names"))
    df = rows.withColumn("han", han).where("id is not null").where(F.size("han") > 0).withColumn("dyn", tei.note(F.col("notes"), "dynasty"))
    df = df.withColumn("dyn_key", text.label_key(F.col("dyn"))).join(labels.select(text.label_key(F.col("label")).alias("dyn_key"), F.col("start").alias("d_start"), F.col("end").alias("d_end")), "dyn_key", "left")
    birth, death = years.year_of_date(F.col("birth")), years.year_of_date(F.col("death"))
    ident = lambda kind: F.transform(F.filter("idnos", lambda i: (F.lower(i["type"]) == kind) & (i["text"] != "")), lambda i: i["text"])
    cbdb, viaf, items = F.get(F.reverse(ident("cbdb")), F.lit(0)), F.get(F.reverse(ident("viaf")), F.lit(0)), ident("wikidata")
    occupation = F.get(F.col("occupation"), F.lit(0))["text"]
    meta = F.struct(
        F.col("dyn").alias("dynasty"), F.coalesce(birth, "d_start").alias("startYear"), F.coalesce(death, "d_end").alias("endYear"), F.col("ana"),
        clues.listed_person(F.get("han", F.lit(0)), birth, death, F.col("dyn"), occupation, text.first_clause(tei.note(F.col("notes"), "concise"))).alias("description"),
        tei.note(F.col("notes"), "disambiguation").alias("disambiguation"),
        F.when(F.coalesce(cbdb, viaf, F.get(items, F.lit(0))).isNotNull(), F.struct(ids.normalize_identifier(cbdb, "no_zeros").alias("cbdb"), viaf.alias("viaf"), F.when(F.size(items) > 0, items).alias("wikidata"))).alias("crosswalk"),
    )
    return _candidate(df, "DILA", "person", F.col("id"), F.get("han", F.lit(0)), text.search_strings(F.col("han")), meta)


def listed_places(rows: DataFrame, districts: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """districts: (id, name); crosswalk: (dila, chgis)."""
    df = rows.withColumn("han", tei.han_names(F.col("names"))).where("id is not null").where(F.size("han") > 0)
    df = df.join(districts.select(F.col("id").alias("district_key"), F.col("name").alias("mapped")), "district_key", "left").join(crosswalk.withColumnRenamed("dila", "id"), "id", "left")
    category, remark = tei.note(F.col("notes"), "category"), tei.untyped_note(F.col("notes"))
    name, span = F.get("han", F.lit(0)), years.year_range(remark)
    where = F.coalesce("mapped", "district")
    description = F.when(F.coalesce(remark, F.lit("")) != "", text.first_clause(remark)).otherwise(clues.listed_place(name, category, where))
    meta = F.struct(category.alias("subtype"), description.alias("description"), span["start"].alias("startYear"), span["end"].alias("endYear"), F.col("geo"), F.struct(F.col("chgis")).alias("crosswalk"))
    return _candidate(df, "DILA", "place", F.col("id"), name, text.search_strings(F.col("han")), meta)


# --- point layers ----------------------------------------------------------------------------------------------------


def mapped_places(rows: DataFrame, cbdb: DataFrame, dila: DataFrame) -> DataFrame:
    """rows: (layer, lat, lon, attributes map); cbdb: (chgis, cbdb); dila: (chgis, dila)."""
    at = lambda k: text.strip(F.col("attributes")[k])
    df = rows.withColumn("obj", F.upper(F.coalesce(at("OBJ_TYPE"), at("obj_type"), F.lit("")))).where("obj in ('', 'POINT')")
    simple = F.coalesce(at("NAME_CH"), at("NAM_CHN"), at("NAME_CHN"), F.lit(""))
    df = df.withColumn("name", coalesce_text(at("NAME_FT"), simple)).withColumn("chgis", F.coalesce(at("SYS_ID"), at("PT_ID"), at("sys_id")))
    df = df.where("name is not null and coalesce(chgis, '') != ''").withColumn("type", coalesce_text(at("TYPE_CH"), at("TYPE")))
    strings = text.search_strings(F.array_compact(F.array("name", text.stem(F.col("name"), F.coalesce("type", F.lit(""))))))
    df = with_once(df, "s", strings).where(F.size("s") > 0).join(cbdb, "chgis", "left").join(dila, "chgis", "left")
    start, end = years.int_prefix(at("BEG_YR")), years.int_prefix(at("END_YR"))
    geo = F.when(F.col("lat").isNotNull() & F.col("lon").isNotNull() & ~F.isnan("lat") & ~F.isnan("lon"), F.struct("lat", "lon"))
    meta = F.struct(
        F.col("type").alias("subtype"), start.alias("startYear"), end.alias("endYear"), at("NAME_PY").alias("pinyin"), at("NAME_FT").alias("nameFt"), F.nullif(simple, F.lit("")).alias("nameCh"), F.col("layer"), geo.alias("geo"),
        F.struct("chgis", "cbdb", "dila").alias("crosswalk"), clues.mapped_place(F.col("name"), F.col("type"), start, end, at("PRES_LOC"), at("NAME_PY")).alias("description"),
    )
    return _candidate(df, "CHGIS", "place", F.col("chgis"), F.col("name"), F.col("s"), meta)


# --- paged catalogue -------------------------------------------------------------------------------------------------


def catalogue(raw: DataFrame, kind: str) -> DataFrame:
    """persons, places and orgs: (authorityId, name, heading, yomi, yomiAlt, birthYear, deathYear); works: (id, title, variants, creators)."""
    if kind == "work":
        df = with_once(raw, "s", names.title_strings(F.col("title"), F.col("variants"))).where(F.size("s") > 0)
        return _candidate(df, "NDL", kind, F.col("id"), F.col("title"), F.col("s"), F.struct(clues.catalogue_entry(F.col("title"), F.col("id"), F.col("creators")).alias("description")))
    yomi, alt = F.col("yomi"), F.col("yomiAlt")
    if kind == "person":
        strings = F.when(names.is_usable_native_name(F.col("name")), F.array(text.strip(F.col("name")))).otherwise(F.array().cast(EMPTY))
    else:
        strings = names.heading_strings(F.col("name"), F.col("heading"), kana.readings(yomi, alt), kana.readings_hiragana(yomi, alt), names.is_usable_native_name if kind == "org" else None)
    df = with_once(raw, "s", strings).where(F.size("s") > 0)
    more = [] if kind == "person" else [F.get(kana.readings(yomi, alt), F.lit(0)).alias("yomi"), F.get(kana.readings_hiragana(yomi, alt), F.lit(0)).alias("yomiHiragana")]
    span = [F.col("birthYear").alias("startYear"), F.col("deathYear").alias("endYear")] if kind == "person" else []
    meta = F.struct(F.lit("historical").alias("ana"), clues.catalogue_entry(F.col("name"), F.col("authorityId")).alias("description"), *span, *more)
    return _candidate(df, "NDL", kind, F.col("authorityId"), F.col("name"), F.col("s"), meta)


def raw_of_bindings(rows: DataFrame, kind: str, order: str) -> DataFrame:
    """Raw rows of `catalogue`'s persons, places and orgs from result bindings (b, a map by variable, and an order column).

    Several bindings of one authority are one row: its first name, heading, first reading and years that are not empty,
    and all its other readings, each once, in order. Bindings without an authority or a name go.
    """
    v = lambda k: F.coalesce(F.col("b")[k]["value"], F.lit(""))
    years_ = ("birth", "death") if kind == "person" else ()
    got = rows.select(v("auth").alias("authUri"), ids.authority_id_of_uri(v("auth")).alias("authorityId"), *[v(k).alias(k) for k in ("name", "heading", "yomi", "yomiAlt", *years_)], F.col(order).alias("_ord"))
    got = got.where("authorityId != '' and name != ''")
    first = lambda k, c=None: F.min_by(F.col(k) if c is None else c, F.when((F.col(k) != "") if c is None else c.isNotNull(), F.col("_ord"))).alias(k)
    spans = [first(k, years.leading_year(F.col(k))) for k in years_]
    readings = F.array_sort(F.collect_list(F.struct("_ord", "yomi", "yomiAlt"))).alias("readings")
    one = got.groupBy("authUri", "authorityId").agg(first("name"), first("heading"), first("yomi"), readings, *spans)
    others = F.flatten(F.transform("readings", lambda r: F.array(F.when(r["yomi"] != F.col("yomi"), r["yomi"]), r["yomiAlt"])))
    others = F.array_distinct(F.filter(others, lambda x: x != ""))
    some = F.when(F.size(others) > 0, others).alias("yomiAlt")
    return one.select("authorityId", "authUri", "name", "heading", "yomi", some, *[F.col(k).alias(f"{k}Year") for k in years_])


def sampled_persons(rows: DataFrame, order: str) -> DataFrame:
    """(qid, primaryLabel, aliases, familyName) of the bindings (b, a map by variable, and an order column) of a sample of persons.

    Several bindings of one item are one row: its first label, all its different other names in order, its first family name.
    """
    v = lambda k: F.coalesce(text.strip(F.col("b")[k]["value"]), F.lit(""))
    got = rows.select(ids.qid_of_uri(v("item")).alias("qid"), v("itemLabel").alias("primaryLabel"), v("familyName").alias("familyName"), F.array_compact(F.array(F.nullif(v("alias"), F.lit("")))).alias("aliases"), F.col(order).alias("_ord"))
    one = merge_rows(got, "qid", "_ord", ["primaryLabel", "familyName"], ["aliases"])
    return one.select("qid", F.coalesce("primaryLabel", F.lit("")).alias("primaryLabel"), "aliases", F.coalesce("familyName", F.lit("")).alias("familyName"))


def dropped_names() -> Column:
    """The strings of a raw person, label first, that the person name policy drops."""
    return F.array_except(text.nfc_array(F.concat(F.array("primaryLabel"), "aliases")), names.person_strings(F.col("primaryLabel"), F.col("aliases"), F.col("familyName")))


def ime_rows(raw: DataFrame, ident: str, name: str) -> DataFrame:
    """(id, surface, kana, hiragana, birthYear, deathYear): a row per reading."""
    rows = raw.select(F.col(ident).alias("id"), F.col(name).alias("surface"), F.explode(kana.readings(F.col("yomi"), F.col("yomiAlt"))).alias("kana"), "birthYear", "deathYear")
    return rows.select("id", "surface", "kana", kana.to_hiragana(F.col("kana")).alias("yomiHiragana"), "birthYear", "deathYear")


def graph_ime_rows(raw: DataFrame) -> DataFrame:
    """(id, surface, kana, hiragana, birthYear, deathYear): a row per reading of a person of the graph, beside the first."""
    return raw.select(F.col("qid").alias("id"), F.col("primaryLabel").alias("surface"), F.explode("nameInKana").alias("kana"), "yomiHiragana", "birthYear", "deathYear")


# --- knowledge graph -------------------------------------------------------------------------------------------------


def _values(prop: str, kind: str | None = None) -> Column:
    snaks = F.coalesce(F.col("claims")[prop], F.array().cast("array<struct<mainsnak:struct<snaktype:string,datavalue:struct<type:string,value:string>>>>"))
    ok = F.filter(snaks, lambda c: (c["mainsnak"]["snaktype"] == "value") & ((c["mainsnak"]["datavalue"]["type"] == kind) if kind else F.lit(True)))
    return F.transform(ok, lambda c: c["mainsnak"]["datavalue"]["value"])


def entity_ids(prop: str) -> Column:
    return F.array_compact(F.transform(_values(prop, "wikibase-entityid"), lambda v: F.get_json_object(v, "$.id")))


def string_values(prop: str) -> Column:
    return F.array_distinct(F.filter(F.transform(_values(prop, "string"), text.strip), lambda v: v != ""))


def label_of(languages: list[str]) -> Column:
    return coalesce_text(*[F.col("labels")[lang]["value"] for lang in languages])


def aliases_of(languages: list[str]) -> Column:
    """Aliases and the native name, in the first language that has a label."""
    own = lambda lang: F.transform(F.coalesce(F.col("aliases")[lang], F.array().cast("array<struct<language:string,value:string>>")), lambda a: a["value"])
    out = F.array().cast(EMPTY)
    for lang in reversed(languages):
        out = F.when(F.coalesce(F.col("labels")[lang]["value"], F.lit("")) != "", own(lang)).otherwise(out)
    return F.array_distinct(F.concat(out, F.filter(string_values("P1705"), lambda v: v != label_of(languages))))


def crosswalk() -> Column:
    per: dict[str, list[Column]] = {}
    for prop, key, mode in config.IDENTIFIERS:
        per.setdefault(key, []).append(F.get(F.filter(F.transform(string_values(prop), _normaliser(mode)), lambda v: v != ""), F.lit(0)))
    return F.struct(*[F.coalesce(*cols).alias(key) for key, cols in per.items()])


def _normaliser(mode: str):  # noqa: ANN202
    return lambda v: ids.normalize_identifier(v, mode)


def kana_of() -> Column:
    """Readings in hiragana: claims, labels in kana, aliases and last the label itself, if they are mostly kana."""
    label = lambda lang: F.col("labels")[lang]["value"]
    aliases = F.transform(F.coalesce(F.col("aliases")["ja"], F.array().cast("array<struct<language:string,value:string>>")), lambda a: a["value"])
    own = F.when(kana.is_kana_dominant(label("ja")), label("ja"))
    sources = F.concat(string_values("P1814"), F.array(label("ja-Hira"), label("ja-Kana")), F.filter(aliases, kana.is_kana_dominant), F.array(own))
    return F.array_distinct(F.filter(F.array_compact(F.transform(F.array_compact(sources), kana.hiragana_reading)), lambda v: v != ""))


def first_claim_year(prop: str) -> Column:
    """Of the first claim alone, whether or not it has a value."""
    first = F.get(F.col("claims")[prop], F.lit(0))["mainsnak"]["datavalue"]["value"]
    return years.claim_year(F.get_json_object(first, "$.time"))


def raw_fields(language: str) -> list[Column]:
    """The fields that any kind needs, for one language pack."""
    langs = config.LANGUAGES[language][0]
    return [
        F.col("id").alias("qid"), label_of(langs).alias("primaryLabel"), aliases_of(langs).alias("aliases"), F.coalesce(F.get(string_values("P734"), F.lit(0)), F.lit("")).alias("familyName"),
        F.coalesce(F.get(string_values("P735"), F.lit(0)), F.lit("")).alias("givenName"), entity_ids("P27").alias("p27"), entity_ids("P2348").alias("p2348"), entity_ids("P31").alias("p31"),
        first_claim_year("P569").alias("birthYear"), first_claim_year("P570").alias("deathYear"), entity_ids("P50").alias("authorQids"), first_claim_year("P577").alias("publicationYear"),
        first_claim_year("P571").alias("inceptionYear"), first_claim_year("P576").alias("dissolvedYear"), F.get(entity_ids("P4711"), F.lit(0)).alias("chgisId"), kana_of().alias("nameInKana"),
        F.get(kana_of(), F.lit(0)).alias("yomiHiragana"), crosswalk().alias("crosswalk"),
    ]


def raw_entities(entities: DataFrame, language: str) -> DataFrame:
    """raw_fields of every item; entities without a label in the language go."""
    return entities.where(F.col("type") == "item").select(*raw_fields(language)).where("primaryLabel is not null")


#: Ways in which a person belongs to a pack: by label alone, by a dynasty's or country's items, by living before the Ming.
MEMBERSHIPS = ("label-only", "dynasty-p27", "country-p27", "pre-ming")


def is_member(mode: str, qids: list[str] | None = None) -> Column:
    """Whether an entity, as a person, belongs; without qids a dynasty or country takes all."""
    if mode not in MEMBERSHIPS:
        raise ValueError(f"unknown membership {mode}; known are {MEMBERSHIPS}")
    if mode == "pre-ming":
        return early_authority(entity_ids("P27"), entity_ids("P2348")) | years.before(config.PRE_MING_LAST, first_claim_year("P569"), first_claim_year("P570"))
    return _overlap(entity_ids("P27"), qids) if qids and mode != "label-only" else F.lit(True)


def _overlap(items: Column, qids: list[str]) -> Column:
    return F.coalesce(F.arrays_overlap(items, F.array(*[F.lit(q) for q in qids])), F.lit(False))


def early_dynasties() -> list[tuple]:
    return [d for d in config.DYNASTIES if d[4] <= config.PRE_MING_LAST and d[1] not in config.POST]


def early_authority(p27: Column, p2348: Column) -> Column:
    own = [d[1] for d in early_dynasties()]
    return _overlap(p27, own) | _overlap(p2348, own)


def has_kind(p31: Column, kind: str, closure: Closure | None = None) -> Column:
    """By the classes themselves or in a closure, an empty side of which falls back on the roots; a person is a human, and no
    disambiguation page."""
    include, exclude = (closure or {}).get(kind) or config.KINDS[kind]
    ok = include_exclude(p31, include or config.KINDS[kind][0], exclude or config.KINDS[kind][1])
    return ok & F.array_contains(p31, config.HUMAN) & ~F.array_contains(p31, config.DISAMBIGUATION) if kind == "person" else ok


def of_kind(raw: DataFrame, kind: str, closure: Closure | None = None) -> DataFrame:
    """Rows of a kind by their classes, directly or in a closure; what is excluded goes first."""
    return raw.where(has_kind(F.col("p31"), kind, closure))


def pack_slices(languages: list[str], kinds: list[str], closure: Closure | None = None, membership: str = "label-only", qids: list[str] | None = None) -> Column:
    """array<(lang, kind)> of the packs that an entity belongs to; only items belong to any."""
    p31, person = entity_ids("P31"), is_member(membership, qids)
    ok = {k: has_kind(p31, k, closure) & (person if k == "person" else F.lit(True)) for k in kinds}
    slices = [F.when(label_of(config.LANGUAGES[la][0]).isNotNull() & ok[k], F.struct(F.lit(la).alias("lang"), F.lit(k).alias("kind"))) for la in languages for k in kinds]
    return F.when(F.col("type") == "item", F.array_compact(F.array(*slices)))


def _sliced(entities: DataFrame, languages: list[str], kinds: list[str], closure: Closure | None, membership: str, qids: list[str] | None) -> DataFrame:
    """The entities with s: (lang, kind), a row for every pack that an entity belongs to; one scan."""
    return entities.withColumn("s", F.explode(pack_slices(languages, kinds, closure, membership, qids)))


def one_scan(entities: DataFrame, languages: list[str], kinds: list[str], closure: Closure | None = None, membership: str = "label-only", qids: list[str] | None = None) -> DataFrame:
    """(lang, kind, qid): every pack that an entity belongs to, from one scan."""
    return _sliced(entities, languages, kinds, closure, membership, qids).select("s.lang", "s.kind", F.col("id").alias("qid"))


def raw_packs(entities: DataFrame, languages: list[str], kinds: list[str], closure: Closure | None = None, membership: str = "label-only", qids: list[str] | None = None) -> DataFrame:
    """(lang, kind, raw_fields of that language): the raw rows of every pack, from one scan and one parse."""
    rows = _sliced(entities, languages, kinds, closure, membership, qids)
    raw = F.coalesce(*[F.when(F.col("s.lang") == la, F.struct(*raw_fields(la))) for la in languages])
    return rows.select("s.lang", "s.kind", raw.alias("r")).select("lang", "kind", "r.*")


def in_dynasty(raw: DataFrame, qids: list[str]) -> DataFrame:
    return raw.where(F.arrays_overlap("p27", F.array(*[F.lit(q) for q in qids])))


def pre_ming(raw: DataFrame) -> DataFrame:
    """Persons of early dynasties or years, with the shortest period that holds them."""
    early = early_dynasties()
    overlap = years.before(config.PRE_MING_LAST, F.col("birthYear"), F.col("deathYear"))
    only_post = (F.size("p27") > 0) & F.forall("p27", lambda q: q.isin(config.POST))
    authority = early_authority(F.col("p27"), F.col("p2348"))
    df = raw.where(~(only_post & ~overlap) & (authority | overlap))
    dims = df.sparkSession.createDataFrame([(k, d[1], d[2], d[3], d[4]) for k, d in enumerate(early)], "ord int, qid string, label string, start int, end int")
    keyed = df.withColumnRenamed("qid", "entity")
    return most_specific(keyed, F.array_union("p27", "p2348"), dims, config.PRE_MING, "entity").withColumnRenamed("entity", "qid")


def compiled_crosswalk(raw: DataFrame) -> Column:
    """A raw row's identifiers and its own number."""
    kept = [f.name for f in raw.schema["crosswalk"].dataType.fields if f.name != "wikidata"] if "crosswalk" in raw.columns else []
    return F.struct(*[F.col(f"crosswalk.{k}") for k in kept], F.array(F.regexp_replace("qid", "^Q", "")).alias("wikidata")).alias("crosswalk")


def graph_persons(raw: DataFrame, period: Column, start: Column, end: Column) -> DataFrame:
    fictional = F.coalesce(F.arrays_overlap("p31", F.array(*[F.lit(q) for q in config.FICTIONAL])), F.lit(False))
    df = with_once(raw, "s", names.person_strings(F.col("primaryLabel"), F.col("aliases"), F.col("familyName"))).where(F.size("s") > 0)
    meta = F.struct(period.alias("dynasty"), F.coalesce("birthYear", start).alias("startYear"), F.coalesce("deathYear", end).alias("endYear"), F.when(fictional, "fictional").alias("ana"), clues.graph_person(F.col("primaryLabel"), period, fictional, F.col("qid")).alias("description"), compiled_crosswalk(raw))
    return _candidate(df, "Wikidata", "person", F.col("qid"), F.col("primaryLabel"), F.col("s"), meta)


def graph_kind(raw: DataFrame, kind: str, language: str) -> DataFrame:
    script = None if kind == "work" else config.LANGUAGES[language][1]
    df = with_once(raw, "s", names.kind_strings(F.col("primaryLabel"), F.col("aliases"), script)).where(F.size("s") > 0)
    meta = F.struct(F.coalesce("inceptionYear", "publicationYear").alias("startYear"), F.col("dissolvedYear").alias("endYear"), clues.graph_entity(F.col("primaryLabel"), F.col("qid")).alias("description"), compiled_crosswalk(raw))
    return _candidate(df, "Wikidata", kind, F.col("qid"), F.col("primaryLabel"), F.col("s"), meta)


def filter_stats(raw: DataFrame) -> DataFrame:
    """How much the person name policy drops."""
    every = F.array_distinct(text.nfc_array(F.concat(F.array("primaryLabel"), "aliases")))
    kept = names.person_strings(F.col("primaryLabel"), F.col("aliases"), F.col("familyName"))
    got = raw.agg(F.sum(F.size(every)).alias("raw"), F.sum(F.size(F.array_intersect(every, kept))).alias("kept"), F.sum(F.size(F.array_except(every, kept))).alias("dropped"))
    return got.withColumn("dropped_pct", F.round(100 * F.col("dropped") / F.col("raw"), 1))
