"""Entry points: from sources to published packs, one function per command."""

from __future__ import annotations

import os
import re
from threading import Event

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from onoma.functions import names
from onoma.functions.text import label_key, nfc_array
from onoma.operators import compilers as C
from onoma.operators import config, crosswalks, patterns, triples
from onoma.operators import relational as R
from onoma.operators.storage import checkpoint, exists
from onoma.sinks import bundles, packs
from onoma.sources import binary, files, sqlite, tei
from onoma.streaming import resumable

SNAPSHOT_POLICY = {"minLength": 2, "minLengthLatin": 3, "excludedNameTypes": names.EXCLUDED}


#: What the compilers read of a snapshot's tables.
SNAPSHOT_COLUMNS = {
    "BIOG_MAIN": ["c_personid", "c_name_chn", "c_name", "c_surname_chn", "c_mingzi_chn", "c_birthyear", "c_deathyear", "c_index_year", "c_fl_earliest_year", "c_fl_latest_year", "c_dy"],
    "ALTNAME_DATA": ["c_personid", "c_alt_name_chn", "c_alt_name_type_code"], "DYNASTIES": ["c_dy", "c_dynasty", "c_dynasty_chn", "c_start", "c_end"],
    "ADDR_CODES": ["c_addr_id", "c_name_chn", "c_alt_names", "c_firstyear", "c_lastyear", "c_admin_type"], "OFFICE_CODES": ["c_office_id", "c_office_chn", "c_office_chn_alt", "c_office_trans", "c_dy"],
}


def compile_snapshot(spark: SparkSession, sqlite_path: str, out: str) -> dict[str, dict]:
    """Packs of persons, places and offices of a relational snapshot; manifests by kind."""
    sqlite.register(spark)
    t = lambda name: sqlite.table(spark, sqlite_path, name, *SNAPSHOT_COLUMNS[name])
    dynasties = t("DYNASTIES")
    made = {"persons": C.snapshot_persons(t("BIOG_MAIN"), t("ALTNAME_DATA"), dynasties), "places": C.snapshot_places(t("ADDR_CODES")), "offices": C.snapshot_offices(t("OFFICE_CODES"), dynasties)}
    return {k: packs.write_pack(df, f"{out}/{k}", "CBDB", SNAPSHOT_POLICY) for k, df in made.items()}


def snapshot_sample(spark: SparkSession, sqlite_path: str, out: str, persons: list[int], more: int = 5) -> dict[str, int]:
    """A small database from a snapshot: all dynasties, and some persons with their other names; returns the rows of each table.

    Besides the persons named, it takes the `more` first others that have another name of one character.
    """
    sqlite.register(spark)
    t = lambda name: sqlite.table(spark, sqlite_path, name)
    named = F.col("c_personid").isin(persons)
    alts = t("ALTNAME_DATA")
    others = alts.where((F.char_length(F.trim("c_alt_name_chn")) == 1) & ~named).select("c_personid").distinct().orderBy("c_personid").limit(more)
    chosen = persons + [r.c_personid for r in others.collect()]
    rows = {"DYNASTIES": t("DYNASTIES"), "BIOG_MAIN": t("BIOG_MAIN").where(F.col("c_personid").isin(chosen)), "ALTNAME_DATA": alts.where(F.col("c_personid").isin(chosen))}
    for name, df in rows.items():
        sqlite.write(df.drop("_ord"), out, name, mode="overwrite")
    return {name: sqlite.table(spark, out, name).count() for name in rows}


def compile_lists(spark: SparkSession, persons: str, places: str, out: str, districts: str | None = None, crosswalk: DataFrame | None = None, dynasties: DataFrame | None = None) -> dict[str, dict]:
    """Packs of TEI lists; crosswalk: (dila, chgis), of repeated ids the last row counts; dynasties: a snapshot's table."""
    known = tei.districts(spark, districts) if districts else spark.createDataFrame([], "id string, name string")
    known = known.groupBy("id").agg(F.max("name").alias("name"))
    pairs = spark.createDataFrame([], "dila string, chgis string") if crosswalk is None else R.last_wins(crosswalk.select("dila", "chgis", F.monotonically_increasing_id().alias("_ord")), "dila", "_ord").select("dila", "chgis")
    labels = config.static_labels(spark).select(label_key(F.col("label")).alias("label"), "start", "end")
    if dynasties is not None:  # rows of the table replace those of equal labels
        named = dynasties.select(F.explode(F.array("c_dynasty_chn", "c_dynasty")).alias("label"), F.col("c_start").cast("int").alias("start"), F.col("c_end").cast("int").alias("end"), F.monotonically_increasing_id().alias("_ord"))
        named = named.where("label != ''").withColumn("label", label_key(F.col("label")))
        labels = R.override(labels, R.last_wins(named, "label", "_ord").select("label", "start", "end"), "label")
    got = {"persons": packs.write_pack(C.listed_persons(tei.persons(spark, persons), labels), f"{out}/persons", "DILA")}
    linked = F.count_if(F.col("metadata.crosswalk.chgis").isNotNull())
    got["places"] = packs.write_pack(C.listed_places(tei.places(spark, places), known, pairs), f"{out}/places", "DILA", crosswalkChgisCount=linked)
    return got


def point_rows(spark: SparkSession, folder: str) -> tuple[DataFrame, list[str]]:
    """The records of all point layers below a folder, and the layers' names."""
    binary.register(spark)
    layers = sorted({os.path.splitext(os.path.basename(p))[0] for p in binary.discover(folder)})
    return spark.read.format("shapefile").option("path", folder).load(), layers


def mapped(rows: DataFrame, cbdb: DataFrame | None = None, dila: DataFrame | None = None) -> DataFrame:
    """Candidates of the records of point layers."""
    none = lambda c: rows.sparkSession.createDataFrame([], f"chgis string, {c} string")
    return C.mapped_places(rows, none("cbdb") if cbdb is None else cbdb, none("dila") if dila is None else dila)


def compile_points(spark: SparkSession, folder: str, out: str, cbdb: DataFrame | None = None, dila: DataFrame | None = None, snapshot: str | None = None) -> dict:
    """A pack of point layers, whose manifest counts the places of each layer, also where there are none, and the links of each crosswalk.

    cbdb: (chgis, cbdb), or else a snapshot's path, whose places name their points; dila: (chgis, dila).
    """
    link = lambda c: F.count_if(F.col(f"metadata.crosswalk.{c}").isNotNull())
    rows, layers = point_rows(spark, folder)
    if cbdb is None and snapshot is not None:
        sqlite.register(spark)
        cbdb = C.crosswalk_of_points(sqlite.table(spark, snapshot, "ADDR_CODES", "c_addr_id", "CHGIS_PT_ID").where("CHGIS_PT_ID is not null"))
    found = mapped(rows, cbdb, dila)
    known = spark.createDataFrame([(x,) for x in layers], "layer string")
    counts = packs.layer_counts(found.select("metadata.layer"), known)  # a row per file
    return packs.write_pack(found, f"{out}/places", "CHGIS", facts={"layerCounts": {r.layer: r.n for r in counts.orderBy("layer").collect()}}, crosswalkCbdbCount=link("cbdb"), crosswalkDilaCount=link("dila"))


def places_tsv(places: DataFrame, out: str) -> None:
    """Places as a table for crosswalks: id, primary name, position, names joined by |; places of layers also with type, years and layer."""
    m, geo = "metadata", F.col("metadata.geo")
    position = [geo["lat"].alias("lat"), geo["lon"].alias("lon")]
    names = F.array_join("searchStrings", "|").alias("search_strings")
    if "layer" in places.schema[m].dataType.names:
        about = [F.col(f"{m}.subtype").alias("type_ch"), F.col(f"{m}.startYear").alias("beg_yr"), F.col(f"{m}.endYear").alias("end_yr")]
        rows = places.select(F.col("authorityId").alias("sys_id"), F.col("primaryName").alias("name_ft"), *about, *position, F.col(f"{m}.layer").alias("layer"), names)
    else:
        rows = places.select(F.col("authorityId").alias("pl_id"), F.col("primaryName").alias("primary_name"), *position, names)
    packs.write_tsv(rows, out)


def crosswalk_places(left: DataFrame, right: DataFrame, out: str | None = None, band: float = 0.5) -> dict[str, int]:
    """Matches two place packs by name and position; writes matched and ambiguous pairs; returns the counts."""
    side = lambda df: df.select(F.col("authorityId").alias("id"), nfc_array(F.col("searchStrings")).alias("names"), F.col("metadata.geo.lat").alias("lat"), F.col("metadata.geo.lon").alias("lon"))
    a = checkpoint(side(left).withColumn("row", F.monotonically_increasing_id()))
    one, many, stats = crosswalks.parts(a, checkpoint(side(right)), band)
    if out:
        ids = [F.col("left_id").alias("chgis_sys_id"), F.col("right_id").alias("dila_pl_id")]
        packs.write_tsv(one.orderBy("row").select(*ids, F.col("method").alias("match_method"), F.col("d_lat").alias("delta_lat"), F.col("d_lon").alias("delta_lon"), "name"), f"{out}/matched")
        packs.write_tsv(many.orderBy("row", "right_id").select(*ids, F.lit("multiple_dila_candidates").alias("reason"), "name"), f"{out}/ambiguous")
    return stats.first().asDict()


def parse_kinds(kinds: str) -> list[str]:
    """'person, place' -> kinds, each once; an unknown one is an error."""
    got = list(dict.fromkeys(k.strip() for k in kinds.split(",") if k.strip()))
    unknown = [k for k in got if k not in config.KINDS]
    if unknown or not got:
        raise ValueError(f"unknown kinds {unknown}; known are {sorted(config.KINDS)}")
    return got


def kind_closure(graph: DataFrame) -> C.Closure:
    """Every kind's included and excluded classes with all classes below them, from triples (s, p, o, lang)."""
    parts = {f"{kind} {at}": roots for kind, both in config.KINDS.items() for at, roots in enumerate(both) if roots}
    found = {r.kind: list(r.closure) for r in triples.closure_document(graph, parts).select("kind", "closure").collect()}
    return {kind: (found.get(f"{kind} 0", []), found.get(f"{kind} 1", [])) for kind in config.KINDS}


def extract(spark: SparkSession, dump: str, kinds: str, languages: list[str], out: str, closure: C.Closure | None = None, membership: str = "label-only", qids: list[str] | None = None, most: int | None = None) -> DataFrame:
    """Raw rows of every kind and language of a dump, under lang=…/kind=…, from one scan; returns how many matched.

    closure, as of kind_closure, also lets in items of subclasses and keeps out those of excluded subclasses. Persons
    belong by `membership` (see C.MEMBERSHIPS) and its qids. most: the extraction ends with the entity, in the dump's order, by
    whose rows there are so many; as all of its rows count, there may be some more.
    """
    kinds_, seen = parse_kinds(kinds), Observation()
    entities = files.dump(spark, dump)
    if most is not None:
        entities = files.placed_dump(spark, dump)
        hits = F.coalesce(F.size(C.pack_slices(languages, kinds_, closure, membership, qids)), F.lit(0))
        end = R.place_of_total(entities.select("file", "block", "line", hits.alias("hits")).where("hits > 0"), most)
        if end is not None:
            entities = entities.where(F.struct("file", "block", "line") <= F.struct(F.lit(end.file).alias("file"), F.lit(end.block).cast("long").alias("block"), F.lit(end.line).cast("long").alias("line")))
    rows = C.raw_packs(entities, languages, kinds_, closure, membership, qids)
    slices = {f"{la} {k}": (la, k) for la in languages for k in kinds_}
    rows = rows.observe(seen, *[F.count_if((F.col("lang") == la) & (F.col("kind") == k)).alias(name) for name, (la, k) in slices.items()])
    packs.write_fan_out(rows, out, "lang", "kind")
    counts = [(*slices[name], n) for name, n in seen.get.items() if n]
    return spark.createDataFrame(counts, "lang string, kind string, count long")


def compile_graph_persons(raw: DataFrame, dynasty: str, out: str) -> dict:
    """A pack of the persons of one dynasty of config, by its id; an unknown id is an error."""
    _, qid, label, start, end = config.selected_dynasties([dynasty])[0]
    return packs.write_pack(C.graph_persons(C.in_dynasty(raw, [qid]), F.lit(label), F.lit(start), F.lit(end)), out, "Wikidata")


def compile_graph_pre_ming(raw: DataFrame, out: str) -> dict:
    """A pack of the persons before the Ming, each with its most specific period."""
    p = F.col("period")
    return packs.write_pack(C.graph_persons(C.pre_ming(raw), p["label"], p["start"], p["end"]), out, "Wikidata")


def compile_graph_kind(raw: DataFrame, kind: str, language: str, out: str) -> dict:
    return packs.write_pack(C.graph_kind(raw, kind, language), out, "Wikidata")


def compile_graph_country(raw: DataFrame, qid: str, label: str, out: str) -> dict:
    """A pack of the persons of one country, by its item."""
    none = F.lit(None).cast("int")
    return packs.write_pack(C.graph_persons(C.in_dynasty(raw, [qid]), F.lit(label), none, none), out, "Wikidata")


def compile_graph_all(raw: DataFrame, language: str, out: str, dynasties: list[str] | None = None, pre_ming: bool = True) -> dict[str, dict]:
    """A pack of each dynasty's persons (those of priority, if none is named) and of those before the Ming, from one table of raw persons."""
    raw = checkpoint(raw)  # every pack reads it
    made = {d: compile_graph_persons(raw, d, f"{out}/person-{language}-{d}") for d in (config.PRIORITY if dynasties is None else dynasties)}
    return made | ({"pre-ming": compile_graph_pre_ming(raw, f"{out}/person-{language}-pre-ming")} if pre_ming else {})


def compile_graph_language(raw: dict[str, DataFrame], language: str, out: str) -> dict[str, dict]:
    """Packs of one language by label alone, a kind each; persons have the language as their period, and no years of it."""
    none, made = F.lit(None).cast("int"), {}
    for kind, rows in raw.items():
        cands = C.graph_persons(rows, F.lit(language), none, none) if kind == "person" else C.graph_kind(rows, kind, language)
        made[kind] = packs.write_pack(cands, f"{out}/{kind}-{language}", "Wikidata", facts={"language": language, "membership": "label-only"})
    return made


def extract_selection(spark: SparkSession, dump: str, kinds: str, languages: list[str], out: str, membership: str, dynasties: list[str] | None = None, priority: bool = False, country: str | None = None, **more) -> DataFrame:  # noqa: ANN003
    """`extract` of persons by the ids of dynasties or of a country in config, under a folder named after them."""
    if unknown := [la for la in languages if la not in config.LANGUAGES]:
        raise ValueError(f"unknown languages {unknown}; known are {sorted(config.LANGUAGES)}")
    qids, slug = config.selection(membership, dynasties, priority, country)
    return extract(spark, dump, kinds, languages, f"{out}/{slug}", membership=membership, qids=qids or None, **more)


def extract_resumable(
    spark: SparkSession, folder: str, kinds: str, languages: list[str], out: str, checkpoint: str, closure: C.Closure | None = None, membership: str = "label-only", qids: list[str] | None = None,
    files_per_batch: int = 100, bytes_per_batch: int | None = None, stop: Event | None = None,
) -> dict:
    """`extract` of what is new in a folder of dump files, into one Parquet table of all packs (lang, kind, raw rows); returns the run's figures.

    It goes on where the checkpoint stands, with the same kinds, languages, classes and membership only; stop ends it after its batch.
    """
    kinds_ = parse_kinds(kinds)
    settings = {"kinds": kinds_, "languages": languages, "membership": membership, "qids": qids, "closure": {k: [sorted(x) for x in v] for k, v in (closure or {}).items()}}
    rows = lambda lines: C.raw_packs(files.dump_entities(lines.select("value")), languages, kinds_, closure, membership, qids)
    return resumable.extract(spark, folder, rows, out, checkpoint, settings, files_per_batch, bytes_per_batch=bytes_per_batch, stop=stop)


def raw_of(spark: SparkSession, out: str, language: str, kind: str) -> DataFrame:
    """The raw rows of one pack, of `extract` or of `extract_resumable`."""
    if exists(spark, f"{out}/lang={language}/kind={kind}"):
        return spark.read.schema(raw_schema(spark, language)).json(f"{out}/lang={language}/kind={kind}")
    return spark.read.parquet(out).where((F.col("lang") == language) & (F.col("kind") == kind)).drop("lang", "kind")


def raw_schema(spark: SparkSession, language: str):  # noqa: ANN201
    """The columns of raw rows."""
    return C.raw_entities(files.dump_entities(spark.createDataFrame([], "value string")), language).schema


def parse_works(spark: SparkSession, path: str, out: str, limit: int | None = None) -> int:
    """Lines of works as raw rows of JSON; returns their number."""
    rows = files.works(spark, path, limit)
    packs.write_ndjson(rows, out)
    return spark.read.schema(rows.schema).json(out).count()


def policy_report(raw: DataFrame, out: str, facts: dict[str, str], examples: int = 25) -> dict[str, str]:
    """Writes what the person name policy does to raw persons, as lines of text: facts, counts, and some of the strings that it drops."""
    raw = checkpoint(raw)
    stats = C.filter_stats(raw).first()
    share = 100 * stats.dropped / stats.raw if stats.raw else 0
    dropped = raw.select("qid", F.posexplode(C.dropped_names()).alias("at", "s")).groupBy("s").agg(F.min(F.struct(F.length("qid"), "qid", "at")).alias("first"))
    some = [r.s for r in dropped.orderBy("first").limit(examples).collect()]
    told = {**facts, "entities": raw.count(), "raw_strings": stats.raw or 0, "filtered_strings": stats.kept or 0, "dropped_pct": f"{share:.1f}"}
    packs.write_text(raw.sparkSession, [*(f"{k}: {v}" for k, v in told.items()), "", "sample_dropped:", *(f"- {s}" for s in some)], out)
    return told


def sampled_policy_report(spark: SparkSession, endpoint: str, dynasty: str, language: str, out: str, excluded: list[str] | None = None, limit: int = 500, **options: str) -> dict[str, str]:
    """policy_report of a sample of a dynasty's persons, asked of an endpoint."""
    binary.register(spark)
    ident, qid, *_ = config.selected_dynasties([dynasty])[0]
    query = patterns.select(patterns.persons_of(qid, config.LANGUAGES[language][0][0], excluded, details=True), "item", "itemLabel", "alias", "familyName", limit="{limit}")
    rows = files.ordered_bindings(spark.read.format("sparql").options(endpoint=endpoint, query=query, limit=limit, **options).load())
    return policy_report(C.sampled_persons(rows, "ord"), out, {"dynasty": f"{ident} ({qid})", "language": language})


def harvest_catalogue(
    spark: SparkSession, kind: str, endpoint: str, out: str, checkpoint: str, limit: int = 1000, ranges: int = 4, delay: float = 0.3, batches: int = 0, stop: Event | None = None, **options: str,
) -> dict:
    """Harvests a catalogue's persons, places or orgs from an endpoint as raw rows, on from where the checkpoint stands; returns the run's figures.

    limit: authorities of a request's range; ranges: of a batch, which are read side by side; batches: after which the run ends;
    options: others of sources.sparql.Endpoint. `harvested` reads what is there.
    """
    query = patterns.select(patterns.authorities(kind), *patterns.asked(kind), order="auth", limit="{limit}", bounds=True)
    given = {"endpoint": endpoint, "query": query, "key": "auth", "limit": limit, "ranges": ranges, "delay": delay, **options}
    merge = lambda batch: C.raw_of_bindings(files.ordered_bindings(batch), kind, "ord")
    return resumable.harvest_stream(spark, "sparql", given, out, checkpoint, merge, {"kind": kind, "endpoint": endpoint}, batches, stop)


def harvested(spark: SparkSession, out: str) -> DataFrame:
    """The raw rows of a harvest."""
    return spark.read.parquet(out).drop("batch")


def compile_catalogue(raw: DataFrame, kind: str, out: str) -> dict:
    return packs.write_pack(C.catalogue(raw, kind), f"{out}/{kind}s", "NDL")


def report(cands: DataFrame, out: str, sample: int = 8, limit: int = 100, order: str | None = None) -> dict[str, int]:
    """Writes the strings that name most entities, with the first samples, as quoted CSV; returns the counts.

    order: a column in whose order entities count as seen; without it, their ids' order is, in which 9 comes before 10.
    """
    seen = F.col(order) if order else F.struct(F.length("authorityId"), F.col("authorityId"))
    named = cands.select(F.col("authorityId").alias("id"), F.col("primaryName").alias("name"), seen.alias("ord"), F.explode(nfc_array(F.col("searchStrings"))).alias("surface"))
    rows = R.ambiguity_rows(named, sample).orderBy(F.desc("n"), F.collate("surface", "zh_Hant"), "surface").limit(limit)
    rows = rows.select("surface", F.col("n").alias("authority_count"), F.col("ids").alias("sample_qids"), F.col("names").alias("sample_names"))
    packs.write_csv(rows, out, always=True)
    return R.ambiguity_stats(cands.select(F.col("authorityId").alias("id"), nfc_array(F.col("searchStrings")).alias("strings"))).first().asDict()


def export_ime(raw: DataFrame, ident: str, name: str, out: str) -> None:
    """Readings as CSV for input methods."""
    packs.write_csv(C.ime_rows(raw, ident, name).withColumnRenamed("id", "authorityId"), out)


def export_graph_ime(raw: DataFrame, out: str) -> None:
    """Readings of persons of the graph as CSV for input methods."""
    packs.write_csv(C.graph_ime_rows(raw).withColumnRenamed("id", "qid"), out)


def bundle(spark: SparkSession, folder: str, out: str, prefixes: dict[str, str] | None = None) -> DataFrame:
    """Writes the index of a folder's files by bundle, with sizes and hashes; returns bytes and files of each bundle."""
    packs.write_ndjson(packs.bundle_index(spark, folder, prefixes), out)
    rows = spark.read.schema("bundle string, path string, bytes long, sha256 string").json(out)
    return rows.groupBy("bundle").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))


def build_bundles(spark: SparkSession, folder: str, out: str, regions: dict[str, list[str]] | None = None, dates: dict[str, str | None] | None = None, facts: dict | None = None) -> dict:
    """Archives of a folder of packs, one for each region (name -> prefixes of files) or one of all, and their index.

    dates: of the sources, by name, which make the version: name and date each, or `local` where there is no date.
    """
    named = spark.createDataFrame([(k, d) for k, d in (dates or {}).items()], "name string, at string")
    version = named.agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("-", "name", packs.compact_date(F.col("at"))))), "-")).first()[0]
    chosen = {f"packs-{r}-{version}" if version else f"packs-{r}": p for r, p in (regions or {"all": [""]}).items()}
    return bundles.build(spark, folder, out, chosen, {"bundleVersion": version or "local", **(facts or {})})


def stored_closure(spark: SparkSession, path: str, edges: DataFrame, roots: DataFrame, added: DataFrame | None = None, removed: DataFrame | None = None) -> DataFrame:
    """(root, node, depth) of a hierarchy, kept at a path: the first call reckons it; later ones take it on from added and removed edges.

    edges: (child, parent) as they are now; roots: (root, node). Each call that changes something writes a generation of its own, and
    the newest that was written whole counts.
    """
    n = 0
    while exists(spark, f"{path}/gen={n + 1}/_SUCCESS"):
        n += 1
    if n and added is None and removed is None:
        return spark.read.parquet(f"{path}/gen={n}")
    if not n:
        made = R.depths(edges, roots)
    else:
        made = spark.read.parquet(f"{path}/gen={n}")
        if removed is not None:
            made = R.shrink_depths(made, edges if added is None else edges.join(added, ["child", "parent"], "left_anti"), removed, roots)
        if added is not None:
            made = R.extend_depths(made, edges, added)
    made.write.mode("overwrite").parquet(f"{path}/gen={n + 1}")
    return spark.read.parquet(f"{path}/gen={n + 1}")


def validate_config(
    dynasties: list[tuple] | None = None, kinds: dict | None = None, closure: dict[str, tuple[list[str], list[str]]] | None = None, languages: dict | None = None,
    identifiers: list[tuple] | None = None, countries: list[tuple] | None = None,
) -> list[str]:
    """What is wrong with the dimensions: repeated ids, malformed items and properties, reversed years, parts that are missing,
    a country's item among the dynasties, roots outside their closure."""
    dynasties, kinds, out = config.DYNASTIES if dynasties is None else dynasties, kinds or config.KINDS, []
    countries, item = config.COUNTRIES if countries is None else countries, r"Q[1-9]\d*"
    for what, rows in (("dynasty", dynasties), ("country", countries)):
        seen = set()
        for ident, qid, label, *span in rows:
            if ident in seen:
                out.append(f"{what} {ident} is repeated")
            seen.add(ident)
            if not re.fullmatch(item, qid):
                out.append(f"{what} {ident}: {qid} is no item")
            if not label:
                out.append(f"{what} {ident} has no label")
            if span and span[0] > span[1]:
                out.append(f"{what} {ident} ends before it starts")
            if what == "dynasty" and qid == config.CHINA:
                out.append(f"dynasty {ident} has the item of the region")
    for kind, parts in kinds.items():
        out += [f"kind {kind}: {q} is no item" for part in parts for q in part if not re.fullmatch(item, q)]
        if not parts[0]:
            out.append(f"kind {kind} includes nothing")
        for roots, below in zip(parts, (closure or {}).get(kind, ()), strict=False):
            out += [f"kind {kind}: root {q} is not in its closure" for q in roots if q not in below]
    languages = config.LANGUAGES if languages is None else languages
    out += [f"language {k} has no labels" for k, (labels, *_) in languages.items() if not labels]
    out += [f"language {k} is missing" for k in ("zh-hant", "zh-hans") if k not in languages]
    identifiers = config.IDENTIFIERS if identifiers is None else identifiers
    out += [f"identifier {key}: {p} is no property" for p, key, *_ in identifiers if not re.fullmatch(r"P[1-9]\d*", p)]
    return out + [f"identifier {k} is missing" for k in ("cbdb", "viaf") if k not in [i[1] for i in identifiers]]
