"""Queries of the compilers, the extraction and their sinks, over names, urls and kinds of the tables; the catalogue lists them too."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onoma.functions import kana, names, text, years
from onoma.operators import compilers as C
from onoma.operators import config
from onoma.operators import relational as R
from onoma.plans import api
from onoma.plans.catalogue import _joined, _PERIODS, _scratch, literals, query, t
from onoma.sinks import bundles, packs
from onoma.sources import files, tei

#: Letters and digits of the tables' names, and the Han characters and kana that stand for them.
_FROM = "abcdefghijklmnopqrstuvwxyz0123456789"
_HAN = "趙錢孫李周吳鄭王馮陳褚衛蔣沈韓楊朱秦尤許何呂施張孔曹甲乙丙丁戊己庚辛壬癸"
_KANA = "アイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミムメモヤユ"


def _as(c: Column, to: str) -> Column:
    return F.translate(F.lower(c), _FROM, to)


def _as_sql(c: str, to: str) -> str:
    return f"translate(lower({c}), '{_FROM}', '{to}')"


_P, _V, _S = (_as_sql(x, _HAN) for x in ("right(c_name, 3)", "right(c_name, 4)", "substr(c_name, 16, 1)"))


@query(f"""WITH c AS (SELECT c_custkey, {_P} AS p, {_V} AS v, {_S} AS s, {_as_sql("n_name[8:]", _HAN)} AS n FROM customer JOIN nation ON c_nationkey = n_nationkey),
e AS (SELECT c_custkey, unnest([p, v, s || left(p, 2), n]) AS x, unnest(['primary', 'variant', 'courtesy', 'variant']) AS k, unnest([0, 1, 2, 3]) AS o FROM c)
SELECT c_custkey, string_agg(x || ':' || k, '|' ORDER BY x) AS names, max(x) FILTER (k = 'primary') AS name FROM (SELECT c_custkey, x, arg_min(k, o) AS k FROM e WHERE length(x) >= 2 GROUP BY 1, 2) GROUP BY c_custkey""")
def typed_names(spark, d):
    c = R.spread(t(spark, d, "customer")).join(t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    alts = [(3, F.right("c_name", F.lit(4))), (4, F.substr("c_name", F.lit(16), F.lit(2))), (5, F.right("c_name", F.lit(2))), (8, F.substr("n_name", F.lit(8)))]
    main = c.select("c_custkey", _as(F.right("c_name", F.lit(3)), _HAN).alias("p"), F.array(*[F.struct(F.lit(k).alias("type"), _as(v, _HAN).alias("value")) for k, v in alts]).alias("alts"))
    got = main.select("c_custkey", "p", names.typed_entries(F.col("p"), F.left("p", F.lit(1)), F.right("p", F.lit(2)), F.col("alts")).alias("e"))
    return got.select("c_custkey", _joined(F.transform("e", lambda x: F.concat(x["text"], F.lit(":"), x["type"]))).alias("names"), F.col("p").alias("name"))


def _people(spark, d) -> DataFrame:
    """Customers as entities of a dump, with Han names, longer other names, countries and years."""
    k = F.col("c_custkey")
    snak = lambda kind, v: F.struct(F.struct(F.lit("value").alias("snaktype"), F.struct(F.lit(kind).alias("type"), v.alias("value")).alias("datavalue")).alias("mainsnak"))
    item = lambda v: F.array(snak("wikibase-entityid", F.struct(v.alias("id"))))
    said = lambda v: F.struct(F.lit("ja").alias("language"), v.alias("value"))
    born = F.array(snak("time", F.struct(F.concat(F.lit("+"), F.col("c_nationkey") + 700, F.lit("-01-01T00:00:00Z")).alias("time"))))
    claims = F.struct(item(F.when(k % 3 == 0, "Q515").otherwise("Q5")).alias("P31"), item(F.when(k % 2 == 0, "Q17").otherwise("Q148")).alias("P27"), born.alias("P569"))
    name = _as(F.right("c_name", F.lit(3)), _HAN)
    labels, aliases = F.struct(said(name).alias("ja")), F.struct(F.array(said(_as(F.right("c_name", F.lit(5)), _HAN)), said(_as(F.right("c_name", F.lit(2)), _HAN))).alias("ja"))
    whole = F.struct(F.lit("item").alias("type"), F.concat(F.lit("Q"), k).alias("id"), labels.alias("labels"), aliases.alias("aliases"), claims.alias("claims"))
    return R.spread(t(spark, d, "customer")).select("c_custkey", F.concat(F.to_json(whole), F.lit(",")).alias("value"))


_L5 = _as_sql("right(c_name, 5)", _HAN)


@query(f"SELECT 'Q' || c_custkey AS id, p AS name, p || '|' || v AS strings, CAST(c_nationkey + 700 AS INTEGER) AS born, p || ' (日本, Wikidata Q' || c_custkey || ')' AS description FROM (SELECT *, {_P} AS p, {_L5} AS v FROM customer) WHERE c_custkey % 3 <> 0 AND c_custkey % 2 = 0")
def compile_graph_country(spark, d):
    raw = C.of_kind(C.raw_entities(files.dump_entities(_people(spark, d).select("value")), "ja"), "person")
    none = F.lit(None).cast("int")
    got = C.graph_persons(C.in_dynasty(raw, ["Q17"]), F.lit("日本"), none, none)
    return got.select(F.col("authorityId").alias("id"), F.col("primaryName").alias("name"), F.array_join("searchStrings", "|").alias("strings"), F.col("metadata.startYear").alias("born"), F.col("metadata.description").alias("description"))


@query("SELECT CASE WHEN c_custkey % 3 = 0 THEN 'place' ELSE 'person' END AS kind, 'ja' AS lang, count(*) AS count FROM customer GROUP BY ALL")
def extract_counts(spark, d):
    base = _scratch(spark, "extract")
    _people(spark, d).select("value").write.text(f"{base}/dump")
    return api.extract(spark, f"{base}/dump", "person,place", ["ja"], f"{base}/raw")


@query("SELECT 'Q' || c_custkey AS qid FROM (SELECT c_custkey, count(*) FILTER (c_custkey % 3 <> 0) OVER (ORDER BY c_custkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n, (SELECT count(*) // 2 FROM customer) AS most FROM customer) WHERE c_custkey % 3 <> 0 AND n <= most")
def extract_limit(spark, d):
    """As many of a dump's first persons as half the customers are."""
    base, people = _scratch(spark, "limit"), _people(spark, d)
    people.orderBy("c_custkey").select("value").write.text(f"{base}/dump")
    api.extract(spark, f"{base}/dump", "person", ["ja"], f"{base}/raw", most=people.count() // 2)
    return spark.read.json(f"{base}/raw").select("qid")


@query(f"SELECT count(*) * 3 AS raw, count(*) * 2 AS kept, count(*) AS dropped, 33.3 AS dropped_pct FROM (SELECT {_P} AS p FROM customer WHERE c_custkey % 3 <> 0)")
def name_policy_stats(spark, d):
    return C.filter_stats(C.of_kind(C.raw_entities(files.dump_entities(_people(spark, d).select("value")), "ja"), "person"))


_CLUE = "p || ' (' || (c_nationkey + 600) || '–' || (c_nationkey + 650) || ', 唐, ' || c_mktsegment || ')'"


@query(f"SELECT 'A' || c_custkey AS id, p AS strings, {_CLUE} AS description, CAST(c_nationkey + 600 AS INTEGER) AS born, CAST(c_custkey AS VARCHAR) AS cbdb FROM (SELECT *, {_P} AS p FROM customer) WHERE c_custkey > 0")
def compile_listed_persons(spark, d):
    base, c = _scratch(spark, "persons"), t(spark, d, "customer").where("c_custkey > 0")
    put = lambda tag, v, more="": F.concat(F.lit(f"<{tag}{more}>"), v.cast("string"), F.lit(f"</{tag}>"))
    year = lambda n: F.lpad((F.col("c_nationkey") + n).cast("string"), 4, "0")
    body = [
        put("persName", _as(F.right("c_name", F.lit(3)), _HAN), ' xml:lang="zho-Hant"'), put("persName", F.col("c_name"), ' xml:lang="eng"'), put("birth", year(600)), put("death", year(650)),
        put("note", F.lit("唐"), ' type="dynasty"'), put("occupation", F.col("c_mktsegment")), put("idno", F.lpad(F.col("c_custkey").cast("string"), 12, "0"), ' type="CBDB"'),
    ]
    c.select(F.concat(F.lit('<person xml:id="A'), F.col("c_custkey"), F.lit('">'), *body, F.lit("</person>")).alias("value")).write.text(base)
    got = C.listed_persons(tei.persons(spark, base), config.static_labels(spark))
    return got.select(F.col("authorityId").alias("id"), F.array_join("searchStrings", "|").alias("strings"), F.col("metadata.description").alias("description"), F.col("metadata.startYear").alias("born"), F.col("metadata.crosswalk.cbdb").alias("cbdb"))


@query(f"SELECT CAST(s_suppkey AS VARCHAR) AS id, n || '縣|' || n AS strings, n || '縣 (縣, ' || (s_nationkey + 100) || '–' || (s_nationkey + 900) || ')' AS description, CASE WHEN s_suppkey % 2 = 0 THEN 'c' || s_nationkey END AS cbdb FROM (SELECT *, {_as_sql('right(s_name, 4)', _HAN)} AS n FROM supplier)")
def compile_mapped_places(spark, d):
    s = t(spark, d, "supplier")
    cells = {"NAME_FT": F.concat(_as(F.right("s_name", F.lit(4)), _HAN), F.lit("縣")), "TYPE_CH": F.lit("縣"), "SYS_ID": F.col("s_suppkey"), "BEG_YR": F.col("s_nationkey") + 100, "END_YR": F.col("s_nationkey") + 900, "OBJ_TYPE": F.lit("point")}
    rows = s.select(F.lit("county").alias("layer"), F.lit(1).alias("shape"), F.col("s_acctbal").alias("lat"), F.col("s_acctbal").alias("lon"), F.create_map(*[x for k, v in cells.items() for x in (F.lit(k), v.cast("string"))]).alias("attributes"))
    links = s.where("s_suppkey % 2 = 0").select(F.col("s_suppkey").cast("string").alias("CHGIS_PT_ID"), F.concat(F.lit("c"), F.col("s_nationkey")).alias("c_addr_id"), F.col("s_suppkey").alias("_ord"))
    got = api.mapped(rows, C.crosswalk_of_points(links))
    return got.select(F.col("authorityId").alias("id"), F.array_join("searchStrings", "|").alias("strings"), F.col("metadata.description").alias("description"), F.col("metadata.crosswalk.cbdb").alias("cbdb"))


_W1, _W2 = (_as_sql(f"string_split(p_name, ' ')[{k}]", _KANA) for k in (1, 2))
_TO_HIRAGANA = f"lambda x: translate(x, '{kana.KATAKANA}', '{kana.HIRAGANA}')"


@query(f"SELECT CAST(p_partkey AS VARCHAR) AS id, array_to_string(list_sort(list_distinct(list_concat([{_as_sql('p_name', _HAN)}, p_name], list_concat(r, list_transform(r, {_TO_HIRAGANA}))))), '|') AS strings, r[1] AS yomi FROM (SELECT *, [{_W1} || ' ' || {_W2}, {_W1} || {_W2}, {_W1}, {_W2}] AS r FROM part)")
def compile_catalogue_orgs(spark, d):
    w = F.split("p_name", " ")
    raw = R.spread(t(spark, d, "part")).select(F.col("p_partkey").cast("string").alias("authorityId"), _as(F.col("p_name"), _HAN).alias("name"), F.col("p_name").alias("heading"), F.concat(_as(w[0], _KANA), F.lit("、"), _as(w[1], _KANA), F.lit(", 1990-1995")).alias("yomi"), F.array(F.lit("")).alias("yomiAlt"))
    got = C.catalogue(raw, "org")
    return got.select(F.col("authorityId").alias("id"), _joined("searchStrings").alias("strings"), F.col("metadata.yomi").alias("yomi"))


@query("""WITH w AS (SELECT p_partkey AS id, unnest(list_distinct(string_split(p_name, ' '))) AS surface, p_brand AS name FROM part), r AS (SELECT *, row_number() OVER (PARTITION BY surface ORDER BY length(CAST(id AS VARCHAR)), CAST(id AS VARCHAR)) AS k, count(*) OVER (PARTITION BY surface) AS n FROM w)
SELECT '"' || surface || '","' || n || '","' || string_agg(CAST(id AS VARCHAR), '; ' ORDER BY k) || '","' || string_agg(name, '; ' ORDER BY k) || '"' AS line FROM r WHERE k <= 8 AND n > 1 GROUP BY surface, n UNION ALL SELECT 'surface,authority_count,sample_qids,sample_names'""")
def ambiguity_report(spark, d):
    out = _scratch(spark, "report")
    cands = t(spark, d, "part").select(F.col("p_partkey").cast("string").alias("authorityId"), F.col("p_brand").alias("primaryName"), F.array_distinct(F.split("p_name", " ")).alias("searchStrings"))
    api.report(cands, out)
    return spark.read.text(out).withColumnRenamed("value", "line")


@query("SELECT count(*) AS entities, CAST(sum(len(list_distinct(string_split(p_name, ' ')))) AS BIGINT) AS strings, count(*) FILTER (p_size > 25) AS large FROM part")
def pack_manifest(spark, d):
    cands = t(spark, d, "part").select(F.col("p_partkey").cast("string").alias("authorityId"), F.array_distinct(F.split("p_name", " ")).alias("searchStrings"), "p_size")
    m = packs.write_pack(cands, _scratch(spark, "pack"), "parts", large=F.count_if(F.col("p_size") > 25))
    return literals(spark, [(m["entityCount"], m["stringCount"], m["large"])], "entities long, strings long, large long")


@query("SELECT doc_id, sha256(text) AS digest, CAST(strlen(text) AS BIGINT) AS bytes FROM documents WHERE NOT starts_with(text, 'version https://git-lfs')")
def usable_hashes(spark, d):
    rows = files.usable(t(spark, d, "documents").select("doc_id", F.col("text").cast("binary").alias("content")))
    return rows.select("doc_id", F.sha2("content", 256).alias("digest"), F.octet_length("content").cast("long").alias("bytes"))


@query("SELECT CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'made' ELSE 'other' END AS bundle, c_mktsegment AS folder FROM customer GROUP BY ALL")
def bundle_members(spark, d):
    """Customers written a folder each segment, and archived in two bundles; which folders are in which, by the index."""
    base = _scratch(spark, "bundles")
    packs.write_fan_out(t(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment"), f"{base}/packs", "c_mktsegment")
    made = ["c_mktsegment=BUILDING/", "c_mktsegment=MACHINERY/"]
    segments = [r[0] for r in t(spark, d, "customer").select("c_mktsegment").distinct().collect()]  # five
    index = bundles.build(spark, f"{base}/packs", f"{base}/out", {"made": made, "other": [f"c_mktsegment={s}/" for s in segments if s not in ("BUILDING", "MACHINERY")]})
    rows = [(b["id"], f["path"]) for b in index["bundles"] for f in b["files"]]
    return literals(spark, rows, "bundle string, path string").select("bundle", F.regexp_extract("path", "=([^/]*)/", 1).alias("folder")).distinct()


@query(f"SELECT o_orderkey, coalesce(arg_min(label, (e - s) * 100 + ord), 'none') AS period FROM orders LEFT JOIN (VALUES {', '.join(map(str, _PERIODS))}) v(ord, label, s, e) ON year(o_orderdate) BETWEEN s AND e GROUP BY o_orderkey")
def period_of_items(spark, d):
    dims = literals(spark, [(label, label, s, e, k) for k, label, s, e in _PERIODS], "qid string, label string, start int, end int, ord int")
    items = F.array_compact(F.array(*[F.when(F.year("o_orderdate").between(s, e), F.lit(label)) for _, label, s, e in _PERIODS]))
    return R.most_specific(t(spark, d, "orders").select("o_orderkey", "o_orderdate"), items, dims, ("none", None, None), "o_orderkey").select("o_orderkey", F.col("period.label").alias("period"))


@query("SELECT total - p_size AS total, p_partkey FROM (SELECT p_partkey, p_size, CAST(sum(p_size) OVER (ORDER BY p_partkey) AS BIGINT) AS total FROM part)")
def running_totals(spark, d):
    return R.running_total(t(spark, d, "part").select("p_partkey", F.col("p_size").cast("long").alias("p_size")), ["p_partkey"], F.col("p_size")).select("total", "p_partkey")


@query("WITH RECURSIVE c(root, node, depth) AS (SELECT p_partkey, p_partkey, 0 FROM part WHERE p_partkey BETWEEN 1 AND 3 UNION SELECT c.root, p_partkey, depth + 1 FROM c JOIN part ON p_partkey // 2 = c.node AND p_partkey > 1) SELECT root, node, depth FROM c")
def closure_with_updates(spark, d):
    """A hierarchy kept with some edges gone, and taken on as they come."""
    p = t(spark, d, "part")
    edges = p.where("p_partkey > 1").select(F.col("p_partkey").alias("child"), F.expr("p_partkey div 2").alias("parent"))
    roots = p.where("p_partkey between 1 and 3").select(F.col("p_partkey").alias("root"), F.col("p_partkey").alias("node"))
    path, late = _scratch(spark, "closure"), F.col("child") % 7 == 0
    api.stored_closure(spark, path, edges.where(~late), roots)
    return api.stored_closure(spark, path, edges, roots, added=edges.where(late)).select("root", "node", "depth")


@query(f"SELECT p_partkey, remark, CASE WHEN p_size % 4 > 0 THEN CAST(p_size + 200 AS INTEGER) END AS start_year, CASE WHEN p_size % 4 > 0 THEN CAST(-p_size AS INTEGER) END AS end_year FROM (SELECT *, {_as_sql('p_name', _HAN)} || CASE WHEN p_size % 4 = 0 THEN '尼' ELSE '' END || '(' || (p_size + 200) || ' ~ -' || p_size || ')' AS remark FROM part)")
def year_ranges_of_remarks(spark, d):
    size = F.col("p_size")
    remark = F.concat(_as(F.col("p_name"), _HAN), F.when(size % 4 == 0, "尼").otherwise(""), F.lit("("), size + 200, F.lit(" ~ -"), size, F.lit(")"))
    span = years.year_range(F.col("remark"))
    return t(spark, d, "part").withColumn("remark", remark).select("p_partkey", "remark", span["start"].alias("start_year"), span["end"].alias("end_year"))


@query(f"SELECT p_partkey, {_as_sql('p_name', _HAN)} AS name, length(p_name) BETWEEN 2 AND 4 AS short, CASE WHEN length(p_name) BETWEEN 2 AND 4 THEN left({_as_sql('p_name', _HAN)}, 1) ELSE '' END AS surname, {_W1} || '・' AS word, translate({_W1}, '{kana.KATAKANA}', '{kana.HIRAGANA}') || '・' AS hiragana FROM part")
def surnames_and_kana(spark, d):
    p = t(spark, d, "part").withColumn("name", _as(F.col("p_name"), _HAN)).withColumn("word", F.concat(_as(F.split("p_name", " ")[0], _KANA), F.lit("・")))
    return p.select("p_partkey", "name", F.char_length("name").between(2, 4).alias("short"), text.infer_surname(F.col("name")).alias("surname"), "word", kana.hiragana_reading(F.col("word")).alias("hiragana"))


_SURNAME, _GIVEN = _as_sql("left(p_name, 1)", _HAN), _as_sql("p_brand[7:]", _HAN)
_PERSON = f"CASE p_size % 7 WHEN 0 THEN {_SURNAME} || '某' WHEN 1 THEN {_SURNAME} || '氏' WHEN 2 THEN {_SURNAME} || '三十' WHEN 3 THEN {_SURNAME} || p_size WHEN 4 THEN p_name WHEN 5 THEN {_SURNAME} || {_GIVEN} || '縣' ELSE {_SURNAME} || {_GIVEN} END"


@query(f"""SELECT p_partkey, name, (regexp_matches(name, '[*(\\[\\-]|[A-Za-z]') OR regexp_matches(name, '^[一-鿿]某$') OR regexp_matches(name, '^[一-鿿]{{1,3}}(?:[0-9]+|[一二三四五六七八九十廿卅卌]+)$') OR name IN (surname || '氏', surname || '某')) AS blocked,
CASE WHEN regexp_matches(name, '^[一-鿿]') AND length(name) BETWEEN 2 AND 4 THEN substr(name, 1, 1) ELSE '' END AS inferred,
CASE WHEN length(name) > 2 AND ends_with(name, '縣') AND length(name) >= 3 THEN substr(name, 1, length(name) - 1) END AS stem FROM (SELECT p_partkey, {_PERSON} AS name, {_SURNAME} AS surname FROM part)""")
def cjk_literals(spark, d):
    """Names of parts as those of persons and places: placeholders, clans, birth orders, Latin ones, and usual ones."""
    surname, given, size = _as(F.left("p_name", F.lit(1)), _HAN), _as(F.substr("p_brand", F.lit(7)), _HAN), F.col("p_size") % 7
    forms = [F.concat(surname, F.lit("某")), F.concat(surname, F.lit("氏")), F.concat(surname, F.lit("三十")), F.concat(surname, F.col("p_size")), F.col("p_name"), F.concat(surname, given, F.lit("縣"))]
    name = F.coalesce(*[F.when(size == k, form) for k, form in enumerate(forms)], F.concat(surname, given))
    p = t(spark, d, "part").select("p_partkey", name.alias("name"), surname.alias("surname"))
    n, s = F.col("name"), F.col("surname")
    return p.select("p_partkey", "name", text.is_blocked(n, s).alias("blocked"), text.infer_surname(n).alias("inferred"), text.stem(n, F.lit("縣")).alias("stem"))


@query("SELECT doc_id, CASE WHEN doc_id < 10000 THEN CAST(n_chars % 2000 AS INTEGER) END AS start_year, CASE WHEN doc_id < 10000 THEN CAST(doc_id AS INTEGER) END AS end_year FROM documents")
def year_range(spark, d):
    """Sources of documents, with a range in wide brackets whose numbers may be too long for years."""
    remark = F.concat(F.coalesce("source", F.lit("")), F.lit("（ "), F.col("n_chars") % 2000, F.lit("～"), F.col("doc_id"), F.lit("）等"))
    docs = t(spark, d, "documents").select("doc_id", years.year_range(remark).alias("span"))
    return docs.select("doc_id", F.col("span.start").alias("start_year"), F.col("span.end").alias("end_year"))


@query(f"SELECT p_partkey, translate({_as_sql('p_name', _KANA)}, '{kana.KATAKANA}', '{kana.HIRAGANA}') AS hiragana FROM part")
def kana_translate(spark, d):
    return t(spark, d, "part").select("p_partkey", kana.to_hiragana(_as(F.col("p_name"), _KANA)).alias("hiragana"))


@query(f"SELECT p_partkey, w1 || ' ' || w2 || '|' || w1 || w2 || '|' || CASE WHEN w1 = w2 THEN w1 ELSE w1 || '|' || w2 END AS readings FROM (SELECT p_partkey, {_W1} AS w1, {_W2} AS w2 FROM part)")
def kana_segments(spark, d):
    """Readings with years and Latin words between them."""
    w = F.split("p_name", " ")
    yomi = F.concat(_as(w[0], _KANA), F.lit("、"), F.col("p_type"), F.lit(", "), _as(w[1], _KANA), F.lit(", 18"), F.col("p_size"), F.lit("-1916"))
    return t(spark, d, "part").select("p_partkey", F.array_join(kana.readings(yomi, F.lit(None).cast("array<string>")), "|").alias("readings"))
