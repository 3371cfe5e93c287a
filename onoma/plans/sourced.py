"""Queries that write the tables in a source's format, and read them back through the library's readers and compilers."""

from __future__ import annotations

from pyspark.sql import functions as F

from onoma.functions import kana, names, text
from onoma.operators import compilers as C
from onoma.operators import config, triples
from onoma.operators import relational as R
from onoma.plans import api
from onoma.plans.catalogue import _database, _joined, _scratch, literals, query, t
from onoma.plans.compiled import _HAN, _KANA, _P, _V, _W1, _W2, _as, _as_sql, _people
from onoma.sinks import packs
from onoma.sources import files, tei

_DYNASTY = "CASE n_regionkey WHEN 0 THEN '唐' WHEN 1 THEN '宋' ELSE '明' END"


@query(f"""WITH c AS (SELECT *, {_P} AS p, {_V} AS v, {_DYNASTY} AS d FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT CAST(c_custkey AS VARCHAR) AS id, p AS name, p || '|' || v AS strings, p || ' (' || c_name || ', ' || CASE WHEN c_custkey % 2 = 0 THEN (c_nationkey + 700) || '–' || (c_nationkey + 760) || ', ' ELSE '' END || d || ' D' || n_regionkey || ')' AS description,
       CAST(CASE WHEN c_custkey % 2 = 0 THEN c_nationkey + 700 ELSE 600 + n_regionkey END AS INTEGER) AS born FROM c""")
def compile_snapshot_persons(spark, d):
    """A snapshot's database of customers, their other names and dynasties, compiled."""
    c = R.spread(t(spark, d, "customer")).join(t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    none, year = F.lit(None).cast("int"), lambda n: F.when(F.col("c_custkey") % 2 == 0, F.col("c_nationkey") + n).cast("int")
    p = _as(F.right("c_name", F.lit(3)), _HAN)
    main = c.select(F.col("c_custkey").alias("c_personid"), p.alias("c_name_chn"), F.col("c_name").alias("c_name"), F.left(p, F.lit(1)).alias("c_surname_chn"), F.right(p, F.lit(2)).alias("c_mingzi_chn"), year(700).alias("c_birthyear"), year(760).alias("c_deathyear"), none.alias("c_index_year"), none.alias("c_fl_earliest_year"), none.alias("c_fl_latest_year"), F.col("n_regionkey").alias("c_dy"))
    alts = c.select(F.col("c_custkey").alias("c_personid"), _as(F.right("c_name", F.lit(4)), _HAN).alias("c_alt_name_chn"), F.lit(3).alias("c_alt_name_type_code"))
    r = t(spark, d, "region").select(F.col("r_regionkey").alias("c_dy"), F.concat(F.lit("D"), F.col("r_regionkey")).alias("c_dynasty"), F.when(F.col("r_regionkey") == 0, "唐").when(F.col("r_regionkey") == 1, "宋").otherwise("明").alias("c_dynasty_chn"), (F.col("r_regionkey") + 600).alias("c_start"), (F.col("r_regionkey") + 900).alias("c_end"))
    empty = lambda *cols: spark.createDataFrame([], ", ".join(f"{x} string" for x in cols))
    base = _scratch(spark, "snapshot")
    db = _database(spark, base, BIOG_MAIN=main, ALTNAME_DATA=alts, DYNASTIES=r, ADDR_CODES=empty(*api.SNAPSHOT_COLUMNS["ADDR_CODES"]), OFFICE_CODES=empty(*api.SNAPSHOT_COLUMNS["OFFICE_CODES"]))
    api.compile_snapshot(spark, db, f"{base}/out")
    got = spark.read.json(f"{base}/out/persons")
    return got.select(F.col("authorityId").alias("id"), F.col("primaryName").alias("name"), F.array_join("searchStrings", "|").alias("strings"), F.col("metadata.description").alias("description"), F.col("metadata.startYear").cast("int").alias("born"))


@query("SELECT CAST(p_partkey AS VARCHAR) AS id, array_to_string(list_sort(list_distinct([p_name, p_type || ' ' || p_size, p_brand])), '|') AS strings, p_name || ' (' || p_brand || '; ' || p_type || ', NDL ' || p_partkey || ')' AS description FROM part WHERE p_size % 10 <> 0")
def works_from_lines(spark, d):
    """Headerless lines of works, some of them broken, read and compiled."""
    base, size = _scratch(spark, "works"), F.col("p_size")
    line = F.concat_ws("\t", F.concat(F.lit("  "), F.col("p_partkey")), "p_name", F.concat(F.col("p_type"), F.lit(" "), size, F.lit("; "), F.col("p_brand")), F.concat_ws(";", "p_brand", "p_type"), F.lit("2020"), F.lit(""))
    t(spark, d, "part").select(F.when(size % 10 == 0, F.col("p_name")).otherwise(line).alias("value")).write.text(base)
    got = C.catalogue(files.works(spark, base), "work")
    return got.select(F.col("authorityId").alias("id"), _joined("searchStrings").alias("strings"), F.col("metadata.description").alias("description"))


@query("SELECT CAST(doc_id AS VARCHAR) AS doc_id, coalesce(source, '') AS source, md5(regexp_replace(left(text, 200), '[\\t\\r\\n]+', ' ', 'g')) AS cell FROM documents")
def tsv_round_trip(spark, d):
    path = _scratch(spark, "tsv")
    packs.write_tsv(t(spark, d, "documents").select("doc_id", "source", F.left("text", F.lit(200)).alias("text")), path)
    return files.tsv(spark, path).select("doc_id", "source", F.md5(F.col("text").cast("binary")).alias("cell"))


@query("SELECT CAST(page_id AS VARCHAR) AS page_id, url, md5(coalesce(quoted, '')) AS quoted FROM (SELECT page_id, url, replace('\"' || url || '\", x', chr(10), ' ') AS quoted FROM pages) WHERE url <> ''")
def csv_round_trip(spark, d):
    path, url = _scratch(spark, "csv"), F.col("url")
    packs.write_csv(t(spark, d, "pages").select("page_id", "url", F.replace(F.concat(F.lit('"'), url, F.lit('", x')), F.lit("\n"), F.lit(" ")).alias("quoted")), path)
    return files.csv(spark, path).select("page_id", "url", F.md5(F.col("quoted").cast("binary")).alias("quoted")).where("url != ''")


@query("SELECT conv_id, CAST(turn AS BIGINT) AS turn, md5(coalesce(text, '')) AS said FROM conversations")
def ndjson_round_trip(spark, d):
    path = _scratch(spark, "ndjson")
    packs.write_ndjson(t(spark, d, "conversations").select("conv_id", "turn", "text"), path)
    return files.ndjson(spark, path, "conv_id long, turn long, text string").select("conv_id", "turn", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("said"))


@query(f"SELECT 'Q' || c_custkey AS qid, {_P} AS label, {_as_sql('right(c_name, 5)', _HAN)} || '|' || {_as_sql('right(c_name, 2)', _HAN)} AS aliases, CAST(c_nationkey + 700 AS INTEGER) AS born FROM customer")
def compressed_dump(spark, d):
    """A dump as bzip2, which splits, with its brackets and some broken lines."""
    path, rows = _scratch(spark, "bz2"), _people(spark, d).select("value")
    more = literals(spark, [("[",), ("]",), ("",), ('{"type": "item", "id": ',)], "value string")
    rows.unionByName(more).write.option("compression", "bzip2").text(path)
    got = C.raw_entities(files.dump(spark, path), "ja")
    return got.select("qid", F.col("primaryLabel").alias("label"), F.array_join("aliases", "|").alias("aliases"), F.col("birthYear").alias("born"))


@query(f"SELECT 'P' || s_suppkey AS id, n AS strings, CASE WHEN s_suppkey % 3 = 0 THEN s_nationkey || '年置' ELSE n || ' (寺 — ' || CASE WHEN s_suppkey % 2 = 0 THEN 'NATION_' || s_nationkey ELSE 'x' || s_nationkey END || ')' END AS description, CASE WHEN s_suppkey % 4 = 0 THEN 'c' || s_suppkey END AS chgis, s_nationkey + 0.5 AS lat FROM (SELECT *, {_as_sql('right(s_name, 4)', _HAN)} AS n FROM supplier)")
def compile_listed_places(spark, d):
    """Places of a list, with their districts by key or by text, remarks, positions and links."""
    base, s = _scratch(spark, "places"), t(spark, d, "supplier")
    key, own = F.col("s_suppkey"), F.col("s_nationkey").cast("string")
    parts = [
        F.lit('<place xml:id="P'), key, F.lit('"><placeName xml:lang="zho-Hant">'), _as(F.right("s_name", F.lit(4)), _HAN), F.lit('</placeName><note type="category">寺</note>'),
        F.when(key % 3 == 0, F.concat(F.lit("<note>"), own, F.lit("年置。後改</note>"))).otherwise(F.lit("")), F.lit("<district>x"), own, F.lit("</district><geo>"), own, F.lit(".5N 100.25</geo>"),
        F.when(key % 2 == 0, F.concat(F.lit('<location><place key="D'), own, F.lit('">y</place>'))).otherwise(F.lit("</place>")),
    ]
    s.select(F.concat(*parts).alias("value")).write.text(f"{base}/places")
    n = t(spark, d, "nation")
    n.select(F.concat(F.lit('<place xml:id="D'), F.col("n_nationkey"), F.lit('"><placeName xml:lang="eng">no</placeName><placeName xml:lang="zho">'), F.col("n_name"), F.lit("</placeName></place>")).alias("value")).write.text(f"{base}/districts")
    links = s.where("s_suppkey % 4 = 0").select(F.concat(F.lit("P"), key).alias("dila"), F.concat(F.lit("c"), key).alias("chgis"))
    got = C.listed_places(tei.places(spark, f"{base}/places"), tei.districts(spark, f"{base}/districts"), links)
    return got.select(F.col("authorityId").alias("id"), F.array_join("searchStrings", "|").alias("strings"), F.col("metadata.description").alias("description"), F.col("metadata.crosswalk.chgis").alias("chgis"), F.col("metadata.geo.lat").alias("lat"))


@query("SELECT o_orderkey, 'Q' || o_custkey AS qid, CAST(o_orderkey AS VARCHAR) AS authority, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS label FROM orders")
def result_pages(spark, d):
    """Orders as pages of query results, a page a customer, taken apart again."""
    from onoma.functions import ids

    said = lambda v, kind="literal": F.struct(F.lit(kind).alias("type"), v.alias("value"))
    k = F.col("o_orderkey")
    b = F.struct(said(k.cast("string")).alias("k"), said(F.concat(F.lit("http://www.wikidata.org/entity/Q"), F.col("o_custkey")), "uri").alias("item"), said(F.concat(F.lit("http://a.invalid/auth/"), k), "uri").alias("auth"), F.when(k % 2 == 0, said(F.col("o_orderpriority"))).alias("label"))
    pages = t(spark, d, "orders").groupBy("o_custkey").agg(F.collect_list(b).alias("bindings")).select(F.to_json(F.struct(F.struct("bindings").alias("results"))).alias("value"))
    v = lambda x: F.col("b")[x]["value"]
    return files.bindings(pages).select(v("k").cast("long").alias("o_orderkey"), ids.qid_of_uri(v("item")).alias("qid"), ids.authority_id_of_uri(v("auth")).alias("authority"), v("label").alias("label"))


@query(f"SELECT id, surface, r AS kana, translate(r, '{kana.KATAKANA}', '{kana.HIRAGANA}') AS hiragana FROM (SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS surface, unnest(list_distinct([{_W1} || ' ' || {_W2}, {_W1} || {_W2}, {_W1}, {_W2}])) AS r FROM part)")
def ime_rows(spark, d):
    w = F.split("p_name", " ")
    raw = t(spark, d, "part").select(F.col("p_partkey").cast("string").alias("authorityId"), F.col("p_name").alias("name"), F.concat(_as(w[0], _KANA), F.lit(", "), _as(w[1], _KANA), F.lit(", 1901")).alias("yomi"), F.lit(None).cast("array<string>").alias("yomiAlt"), F.lit(1).alias("birthYear"), F.lit(2).alias("deathYear"))
    return C.ime_rows(raw, "authorityId", "name").select("id", "surface", "kana", F.col("yomiHiragana").alias("hiragana"))


@query(f"SELECT 'Q' || p_partkey AS qid, CASE WHEN p_size % 2 = 0 AND h1 <> h2 THEN h1 || '|' || h2 ELSE h2 END AS n, CAST(p_partkey AS VARCHAR) AS viaf, CASE WHEN p_size % 3 = 0 THEN 'A' || p_size ELSE 'B' || p_size END AS dila FROM (SELECT *, translate({_W1}, '{kana.KATAKANA}', '{kana.HIRAGANA}') AS h1, translate({_W2}, '{kana.KATAKANA}', '{kana.HIRAGANA}') AS h2 FROM part)")
def readings_and_identifiers(spark, d):
    """Items with readings as claims and labels, and identifiers under one of two properties."""
    w, size = F.split("p_name", " "), F.col("p_size")
    snak = lambda v: F.array(F.struct(F.struct(F.lit("value").alias("snaktype"), F.struct(F.lit("string").alias("type"), v.alias("value")).alias("datavalue")).alias("mainsnak")))
    said = lambda lang, v: F.struct(F.lit(lang).alias("language"), v.alias("value"))
    claims = F.struct(
        F.when(size % 2 == 0, snak(F.concat(F.lit(" "), _as(w[0], _KANA)))).alias("P1814"), snak(F.concat(F.lit("viaf/"), F.col("p_partkey"))).alias("P214"),
        F.when(size % 3 == 0, snak(F.concat(F.lit("A"), size))).alias("P1187"), snak(F.concat(F.lit("B"), size, F.lit(" "))).alias("P1188"),
    )
    labels = F.struct(said("ja", F.col("p_name")).alias("ja"), said("ja-Kana", _as(w[1], _KANA)).alias("ja-Kana"))
    lines = R.spread(t(spark, d, "part")).select(F.to_json(F.struct(F.lit("item").alias("type"), F.concat(F.lit("Q"), F.col("p_partkey")).alias("id"), labels.alias("labels"), claims.alias("claims"))).alias("value"))
    raw = C.raw_entities(files.dump_entities(lines), "ja")
    return raw.select("qid", F.array_join("nameInKana", "|").alias("n"), F.col("crosswalk.viaf").alias("viaf"), F.col("crosswalk.dila").alias("dila"))


@query("SELECT kind, side, count(*) AS n FROM (SELECT 'place' AS kind, 'in' AS side, 'N' || n_nationkey FROM nation WHERE n_regionkey = 1 UNION SELECT 'place', 'in', unnest([" + ", ".join(f"'{q}'" for q in config.KINDS["place"][0]) + "]) UNION SELECT 'work', 'in', 'N' || n_nationkey FROM nation WHERE n_regionkey = 2 UNION SELECT 'work', 'in', unnest([" + ", ".join(f"'{q}'" for q in config.KINDS["work"][0]) + "])) GROUP BY ALL")
def kind_closures(spark, d):
    """Nations as classes below a place's or a work's: what a kind takes in."""
    below = F.when(F.col("n_regionkey") == 1, config.KINDS["place"][0][0]).when(F.col("n_regionkey") == 2, config.KINDS["work"][0][0]).otherwise("Qother")
    graph = t(spark, d, "nation").select(F.concat(F.lit("N"), F.col("n_nationkey")).alias("s"), F.lit(triples.SUBCLASS).alias("p"), below.alias("o"), F.lit(None).cast("string").alias("lang"))
    found = api.kind_closure(graph)
    return literals(spark, [(k, "in", len(found[k][0])) for k in ("place", "work")], "kind string, side string, n long")


@query(f"SELECT p_partkey, replace(p_name, ' ', '|') AS piped, CASE WHEN p_size % 2 = 0 THEN {_as_sql('p_name', _HAN)} END AS bare, p_size % 3 > 0 AS usable FROM part WHERE string_split(p_name, ' ')[1] <> string_split(p_name, ' ')[2]")
def name_parts(spark, d):
    """Names from a piped cell, without a qualifier, and whether a name is a native one."""
    p = t(spark, d, "part").where("split(p_name, ' ')[0] != split(p_name, ' ')[1]")
    han = _as(F.col("p_name"), _HAN)
    qualified = F.when(F.col("p_size") % 2 == 0, F.concat(han, F.lit(" (x)"))).otherwise(han)
    own = F.when(F.col("p_size") % 3 == 0, F.col("p_name")).otherwise(han)
    return p.select("p_partkey", F.array_join(text.names_from_pipe(F.replace("p_name", F.lit(" "), F.lit(" | |"))), "|").alias("piped"), names.without_qualifier(qualified).alias("bare"), names.is_usable_native_name(own).alias("usable"))


@query("SELECT 'Q' || p_partkey AS id, array_to_string(list_sort(list_distinct([p_name, p_type || ' ' || p_size])), '|') AS strings, CAST(CASE WHEN p_size % 2 = 0 THEN p_size + 1000 ELSE p_size + 1900 END AS INTEGER) AS started, CAST(CASE WHEN p_size % 3 = 0 THEN p_size + 1950 END AS INTEGER) AS ended, p_name || ' (Wikidata Q' || p_partkey || ')' AS description FROM part WHERE p_size % 5 > 0")
def compile_graph_works(spark, d):
    """Parts as works of a dump, with a native name, inception before publication, and some that are of an excluded class, too."""
    size = F.col("p_size")
    snak = lambda kind, v: F.struct(F.struct(F.lit("value").alias("snaktype"), F.struct(F.lit(kind).alias("type"), v.alias("value")).alias("datavalue")).alias("mainsnak"))
    item = lambda q: snak("wikibase-entityid", F.struct(F.lit(q).alias("id")))
    year = lambda n: F.array(snak("time", F.struct(F.concat(F.lit("+"), size + n, F.lit("-00-00T00:00:00Z")).alias("time"))))
    include, exclude = config.KINDS["work"][0][0], config.KINDS["work"][1][0]
    classes = F.struct(F.when(size % 5 > 0, F.array(item(include))).otherwise(F.array(item(include), item(exclude))).alias("P31"))
    spans = F.struct(F.when(size % 2 == 0, year(1000)).alias("P571"), year(1900).alias("P577"), F.when(size % 3 == 0, year(1950)).alias("P576"))
    native = F.struct(F.array(snak("string", F.concat_ws(" ", "p_type", size))).alias("P1705"))
    body = lambda s: F.regexp_replace(F.to_json(s), "^\\{|\\}$", "")
    head = F.concat(F.lit('{"type":"item","id":"Q'), F.col("p_partkey"), F.lit('","labels":{"en":{"language":"en","value":"'), F.col("p_name"), F.lit('"}},"aliases":{},"claims":{'))
    lines = R.spread(t(spark, d, "part")).select(F.concat(head, F.array_join(F.array(body(classes), body(spans), body(native)), ","), F.lit("}},")).alias("value"))
    got = C.graph_kind(C.of_kind(C.raw_entities(files.dump_entities(lines), "en"), "work"), "work", "en")
    return got.select(F.col("authorityId").alias("id"), _joined("searchStrings").alias("strings"), F.col("metadata.startYear").alias("started"), F.col("metadata.endYear").alias("ended"), F.col("metadata.description").alias("description"))


@query(f"SELECT CAST(p_partkey AS VARCHAR) AS id, {_as_sql('p_name', _HAN)} AS strings, CAST(p_size + 1800 AS INTEGER) AS born FROM part WHERE p_size % 3 > 0")
def compile_catalogue_persons(spark, d):
    """Persons of a catalogue, of whom those with Latin names go."""
    name = F.when(F.col("p_size") % 3 == 0, F.concat(_as(F.col("p_name"), _HAN), F.lit(" II"))).otherwise(F.concat(F.lit(" "), _as(F.col("p_name"), _HAN)))
    none = F.lit(None).cast("string")
    raw = t(spark, d, "part").select(F.col("p_partkey").cast("string").alias("authorityId"), name.alias("name"), none.alias("heading"), none.alias("yomi"), F.lit(None).cast("array<string>").alias("yomiAlt"), (F.col("p_size") + 1800).cast("int").alias("birthYear"), F.lit(None).cast("int").alias("deathYear"))
    got = C.catalogue(raw, "person")
    return got.select(F.col("authorityId").alias("id"), F.array_join("searchStrings", "|").alias("strings"), F.col("metadata.startYear").alias("born"))


@query(f"SELECT CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_size % 2 = 0 THEN n || ' (' || p_type || ')|' || p_brand || '|' || n ELSE n || '|' || p_brand END AS strings FROM (SELECT *, {_as_sql('p_name', _HAN)} AS n FROM part)")
def compile_catalogue_places(spark, d):
    """Places of a catalogue with and without a qualifier."""
    n, none = _as(F.col("p_name"), _HAN), F.lit(None).cast("string")
    name = F.when(F.col("p_size") % 2 == 0, F.concat(n, F.lit(" ("), F.col("p_type"), F.lit(")"))).otherwise(n)
    raw = t(spark, d, "part").select(F.col("p_partkey").cast("string").alias("authorityId"), name.alias("name"), F.col("p_brand").alias("heading"), none.alias("yomi"), F.lit(None).cast("array<string>").alias("yomiAlt"))
    return C.catalogue(raw, "place").select(F.col("authorityId").alias("id"), F.array_join("searchStrings", "|").alias("strings"))


@query("SELECT 'Q' || o_orderkey AS qid, CASE WHEN o_orderkey % 4 = 0 THEN '唐' WHEN o_orderkey % 4 = 1 THEN '明前' ELSE '北宋' END AS period FROM orders WHERE o_orderkey % 4 < 3 AND NOT (o_orderkey % 4 = 1 AND o_orderkey % 3 = 0)")
def persons_before_the_ming(spark, d):
    """Orders as persons: of the Tang; of no dynasty but early, or late; of the Song and the Northern Song; of the Ming alone."""
    k, ids = F.col("o_orderkey") % 4, {d_[0]: d_[1] for d_ in config.DYNASTIES}
    none = F.array().cast("array<string>")
    p27 = F.when(k == 0, F.array(F.lit(ids["tang"]))).when(k == 1, none).when(k == 2, F.array(F.lit(ids["song"]))).otherwise(F.array(F.lit(ids["ming"])))
    p2348 = F.when(k == 2, F.array(F.lit(ids["northern-song"]))).otherwise(none)
    birth = F.when(k == 1, F.when(F.col("o_orderkey") % 3 == 0, 1500).otherwise(900)).otherwise(F.lit(None)).cast("int")
    raw = t(spark, d, "orders").select(F.concat(F.lit("Q"), F.col("o_orderkey")).alias("qid"), p27.alias("p27"), p2348.alias("p2348"), birth.alias("birthYear"), F.lit(None).cast("int").alias("deathYear"))
    return C.pre_ming(raw).select("qid", F.col("period.label").alias("period"))
