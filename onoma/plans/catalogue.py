"""One query per operator family over the driver's tables, with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from onoma.functions import clues, ids, text, years
from onoma.operators import compilers as C
from onoma.operators import crosswalks
from onoma.operators import relational as R
from onoma.operators import triples
from onoma.sinks import packs
from onoma.sources import files, tei

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
_WS = "[\\x{0009}-\\x{000D} \\x{00A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}\\x{FEFF}]+"
_LATIN = "^[\\x{0000}-\\x{024F}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}\\x{FEFF}]*$"


def query(sql: str | None):  # noqa: ANN201
    def put(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def literals(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def _words(df: DataFrame) -> DataFrame:
    return df.select(F.col("doc_id").alias("id"), "lang", F.posexplode(F.split(text.normalize_surface(F.col("text")), " ")).alias("ord", "surface"))


_WORDS = f"SELECT doc_id AS id, lang, unnest(string_split(trim(regexp_replace(nfc_normalize(coalesce(text, '')), '{_WS}', ' ', 'g'), ' '), ' ')) AS surface FROM documents"
_VALID = f"length(surface) >= CASE WHEN regexp_matches(surface, '{_LATIN}') THEN 3 ELSE 2 END"


@query(f"SELECT doc_id, md5(s) AS surface_md5, CAST(length(s) AS BIGINT) AS n FROM (SELECT doc_id, trim(regexp_replace(nfc_normalize(coalesce(text, '')), '{_WS}', ' ', 'g'), ' ') AS s FROM documents)")
def norm_surface(spark, d):
    s = text.normalize_surface(F.col("text"))
    return t(spark, d, "documents").select("doc_id", s.alias("s")).select("doc_id", F.md5(F.col("s").cast("binary")).alias("surface_md5"), F.char_length("s").cast("long").alias("n"))


@query(f"SELECT lang, count(*) AS n, count(DISTINCT surface) AS n_distinct FROM ({_WORDS}) WHERE {_VALID} GROUP BY lang")
def valid_strings(spark, d):
    w = _words(t(spark, d, "documents")).where(text.is_valid(F.col("surface")))
    return w.groupBy("lang").agg(F.count("*").alias("n"), F.countDistinct("surface").alias("n_distinct"))


@query("SELECT p_partkey, CAST(i AS BIGINT) AS ord, s AS alt FROM (SELECT p_partkey, unnest(l) AS s, unnest(range(1, len(l) + 1)) AS i FROM (SELECT p_partkey, list_filter(list_transform(string_split(replace(p_name, ' ', ';'), ';'), lambda x: trim(x)), lambda x: x <> '') AS l FROM part))")
def split_alt_names(spark, d):
    alts = text.split_alt_names(F.replace("p_name", F.lit(" "), F.lit(";")))
    return t(spark, d, "part").select("p_partkey", F.posexplode(alts).alias("i", "alt")).select("p_partkey", (F.col("i") + 1).cast("long").alias("ord"), "alt")


@query(f"SELECT lang, count(*) FILTER (surface = '' OR regexp_matches(surface, '[*(\\[\\-]|[A-Za-z]')) AS blocked, count(*) FILTER (NOT (surface = '' OR regexp_matches(surface, '[*(\\[\\-]|[A-Za-z]'))) AS kept FROM ({_WORDS}) GROUP BY lang")
def blocked_names(spark, d):
    b = text.is_blocked(F.col("surface"))
    return _words(t(spark, d, "documents")).groupBy("lang").agg(F.count_if(b).alias("blocked"), F.count_if(~b).alias("kept"))


@query("SELECT p_partkey, CAST(len(list_filter(string_split(p_name, ' '), lambda x: length(x) > length(p_brand))) AS BIGINT) AS n_longer, array_to_string(list_filter(string_split(p_name, ' '), lambda x: length(x) > length(p_brand)), '|') AS longer FROM part")
def longer_than_primary(spark, d):
    longer = F.filter(F.split("p_name", " "), lambda x: F.char_length(x) > F.char_length("p_brand"))
    return t(spark, d, "part").select("p_partkey", F.size(longer).cast("long").alias("n_longer"), F.array_join(longer, "|").alias("longer"))


@query("SELECT l_orderkey, l_suppkey, arg_min(l_returnflag, l_linenumber * 1000 + ascii(l_returnflag)) AS first_flag, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_suppkey")
def typed_names_first_wins(spark, d):
    return t(spark, d, "lineitem").groupBy("l_orderkey", "l_suppkey").agg(F.min_by("l_returnflag", F.struct("l_linenumber", "l_returnflag")).alias("first_flag"), F.count("*").alias("n"))


@query("SELECT a.l_orderkey, count(*) AS n_pairs, min(CAST(a.l_suppkey AS VARCHAR) || '-' || CAST(b.l_partkey AS VARCHAR)) AS first_pair FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_returnflag = 'A' AND b.l_returnflag = 'R' GROUP BY a.l_orderkey")
def cross_pairs(spark, d):
    of = lambda f, c: F.collect_list(F.when(F.col("l_returnflag") == f, F.col(c)))
    g = t(spark, d, "lineitem").where("l_returnflag in ('A', 'R')").groupBy("l_orderkey").agg(of("A", "l_suppkey").alias("a"), of("R", "l_partkey").alias("b"))
    pairs = F.flatten(F.transform("a", lambda x: F.transform("b", lambda y: F.concat(x.cast("string"), F.lit("-"), y.cast("string")))))
    return g.where((F.size("a") > 0) & (F.size("b") > 0)).select("l_orderkey", F.size(pairs).cast("long").alias("n_pairs"), F.array_min(pairs).alias("first_pair"))


@query("SELECT c_custkey, coalesce(nullif(r_name, ''), n_name, 'none') AS label, coalesce(n_regionkey, -1) AS region FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey % 5 <> 0 LEFT JOIN region ON n_regionkey = r_regionkey")
def dim_left_join_coalesce(spark, d):
    n = t(spark, d, "nation").where("n_nationkey % 5 != 0")
    j = t(spark, d, "customer").join(n, F.col("c_nationkey") == n.n_nationkey, "left").join(t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return j.select("c_custkey", F.coalesce(R.coalesce_text(F.col("r_name"), F.col("n_name")), F.lit("none")).alias("label"), F.coalesce("n_regionkey", F.lit(-1)).alias("region"))


@query("SELECT key, arg_max(name, p) AS name FROM (SELECT n_nationkey AS key, n_name AS name, 0 AS p FROM nation UNION ALL SELECT * FROM (VALUES (1, 'one', 1), (3, 'three', 1), (99, 'new', 1))) GROUP BY key")
def dim_override_last_wins(spark, d):
    base = t(spark, d, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"))
    return R.override(base, literals(spark, [(1, "one"), (3, "three"), (99, "new")], "key int, name string"), "key").select("key", "name")


@query("SELECT c_mktsegment, n_name, count(*) AS n FROM customer JOIN nation ON replace(upper(n_name), ' ', '') = replace(upper((SELECT any_value(m.n_name) FROM nation m WHERE m.n_nationkey = c_nationkey)), ' ', '') GROUP BY ALL")
def label_key_join(spark, d):
    n = t(spark, d, "nation")
    own = n.select(F.col("n_nationkey").alias("c_nationkey"), text.label_key(F.upper("n_name")).alias("key"))
    j = t(spark, d, "customer").join(own, "c_nationkey").join(n.select("n_name", text.label_key(F.upper("n_name")).alias("key")), "key")
    return j.groupBy("c_mktsegment", "n_name").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, string_agg(CAST(l_linenumber AS VARCHAR) || ':' || l_returnflag, ',' ORDER BY l_linenumber, l_partkey, l_returnflag) AS items FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey")
def nested_collect(spark, d):
    items = R.nest(t(spark, d, "lineitem"), "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    joined = F.array_join(F.transform("items", lambda x: F.concat_ws(":", x["l_linenumber"].cast("string"), x["l_returnflag"])), ",")
    return t(spark, d, "orders").join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", joined.alias("items"))


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM nation WHERE n_nationkey = c_nationkey AND n_regionkey = 1)")
def semi_membership(spark, d):
    return t(spark, d, "customer").join(t(spark, d, "nation").where("n_regionkey = 1"), F.col("c_nationkey") == F.col("n_nationkey"), "left_semi").select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def anti_exclude(spark, d):
    return t(spark, d, "customer").join(t(spark, d, "orders").where("o_orderstatus = 'F'"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("SELECT l_orderkey, bool_or(l_returnflag IN ('A', 'N')) AND NOT bool_or(l_linestatus = 'F' AND l_returnflag = 'R') AS matches FROM lineitem GROUP BY l_orderkey")
def include_exclude(spark, d):
    g = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_set(F.when((F.col("l_returnflag") != "R") | (F.col("l_linestatus") == "F"), F.col("l_returnflag"))).alias("flags"))
    return g.select("l_orderkey", R.include_exclude(F.col("flags"), ["A", "N"], ["R"]).alias("matches"))


def _xwalk(spark, d):
    left = t(spark, d, "customer").select(F.col("c_custkey").alias("row"), F.col("c_custkey").alias("id"), F.array(F.col("c_nationkey").cast("string")).alias("names"), F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal") / 100).alias("lat"), F.lit(0.0).alias("lon"))
    right = t(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.array(F.col("s_nationkey").cast("string")).alias("names"), (F.col("s_acctbal") / 100).alias("lat"), F.lit(0.0).alias("lon"))
    return crosswalks.parts(left, right, 2.0)


_XWALK = "SELECT c_custkey, s_suppkey, CASE WHEN c_custkey % 7 = 0 THEN 'name-only' ELSE 'name+geo' END AS method FROM customer JOIN supplier ON c_nationkey = s_nationkey AND (c_custkey % 7 = 0 OR abs(c_acctbal / 100 - s_acctbal / 100) <= 2.0)"


@query(f"WITH p AS ({_XWALK}) SELECT c_custkey AS left_id, s_suppkey AS right_id, method FROM p WHERE c_custkey IN (SELECT c_custkey FROM p GROUP BY 1 HAVING count(*) = 1)")
def crosswalk_match(spark, d):
    return _xwalk(spark, d)[0].select("left_id", "right_id", "method")


@query(f"WITH p AS ({_XWALK}) SELECT c_custkey AS left_id, s_suppkey AS right_id FROM p WHERE c_custkey IN (SELECT c_custkey FROM p GROUP BY 1 HAVING count(*) > 1)")
def crosswalk_ambiguous(spark, d):
    return _xwalk(spark, d)[1].select("left_id", "right_id")


@query(f"WITH n AS (SELECT customer.c_custkey, count(s_suppkey) AS n FROM customer LEFT JOIN ({_XWALK}) p ON p.c_custkey = customer.c_custkey GROUP BY 1) SELECT count(*) FILTER (n = 1) AS matched, count(*) FILTER (n > 1) AS ambiguous, count(*) FILTER (n = 0) AS no_match, count(*) AS total FROM n")
def crosswalk_stats(spark, d):
    return _xwalk(spark, d)[2]


_PERIODS = [(0, "all", 1990, 2010), (1, "early", 1992, 1994), (2, "mid", 1993, 1996), (3, "late", 1996, 1999), (4, "mid2", 1993, 1996)]


@query(f"SELECT o_orderkey, coalesce(arg_min(label, (e - s) * 100 + ord), 'none') AS period FROM orders LEFT JOIN (VALUES {', '.join(map(str, _PERIODS))}) v(ord, label, s, e) ON year(o_orderdate) BETWEEN s AND e GROUP BY o_orderkey")
def most_specific_period(spark, d):
    dims = literals(spark, _PERIODS, "ord int, label string, start int, end int")
    j = t(spark, d, "orders").join(F.broadcast(dims), F.year("o_orderdate").between(F.col("start"), F.col("end")), "left")  # five fixed rows
    return j.groupBy("o_orderkey").agg(F.coalesce(F.min_by("label", F.struct(F.col("end") - F.col("start"), "ord")), F.lit("none")).alias("period"))


@query("SELECT o_orderkey, coalesce(death <= 1995 OR (death IS NULL AND birth <= 1995), false) AS early FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN year(o_orderdate) END AS birth, CASE WHEN o_orderkey % 2 = 0 THEN year(o_orderdate) + 1 END AS death FROM orders)")
def period_overlap(spark, d):
    y = F.year("o_orderdate")
    return t(spark, d, "orders").select("o_orderkey", years.before(1995, F.when(F.col("o_orderkey") % 3 > 0, y), F.when(F.col("o_orderkey") % 2 == 0, y + 1)).alias("early"))


@query("SELECT event_id, coalesce(nullif(json_extract_string(props, '$.name'), ''), nullif(json_extract_string(props, '$.k'), ''), event_type) AS label FROM events")
def first_label_fallback(spark, d):
    return t(spark, d, "events").select("event_id", R.coalesce_text(F.get_json_object("props", "$.name"), F.get_json_object("props", "$.k"), F.col("event_type")).alias("label"))


@query("SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS k, count(*) AS n, count(DISTINCT user_id) AS users FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL GROUP BY 1")
def json_claims(spark, d):
    e = t(spark, d, "events").select("user_id", F.from_json("props", "map<string,string>")["k"].try_cast("long").alias("k")).where("k is not null")
    return e.groupBy((F.col("k") % 10).alias("k")).agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"))


@query("SELECT c_custkey, coalesce(nullif(regexp_replace(c_name, '[^0-9]', '', 'g'), ''), c_name) AS digits, coalesce(nullif(regexp_replace(regexp_replace(c_name, '[^0-9]', '', 'g'), '^0+', ''), ''), nullif(regexp_replace(c_name, '[^0-9]', '', 'g'), ''), c_name) AS bare FROM customer")
def identifier_normalise(spark, d):
    digits = ids.normalize_identifier(F.col("c_name"), "digits")
    return t(spark, d, "customer").select("c_custkey", digits.alias("digits"), ids.normalize_identifier(digits, "no_zeros").alias("bare"))


@query("SELECT l_partkey, string_agg(DISTINCT CAST(l_suppkey AS VARCHAR), ',' ORDER BY CAST(l_suppkey AS VARCHAR)) AS suppliers FROM lineitem GROUP BY l_partkey")
def crosswalk_map_many(spark, d):
    return t(spark, d, "lineitem").groupBy("l_partkey").agg(F.array_join(F.array_sort(F.collect_set(F.col("l_suppkey").cast("string"))), ",").alias("suppliers"))


@query("SELECT c_custkey, c_name || CASE WHEN b IS NULL AND dd IS NULL AND c_mktsegment = '' THEN '' ELSE ' (' || concat_ws(', ', CASE WHEN b IS NOT NULL AND dd IS NOT NULL THEN b || '–' || dd WHEN b IS NOT NULL THEN 'b. ' || b WHEN dd IS NOT NULL THEN 'd. ' || dd END, nullif(c_mktsegment, '')) || ')' END AS clue FROM (SELECT *, CASE WHEN c_custkey % 2 = 0 THEN c_nationkey + 1000 END AS b, CASE WHEN c_custkey % 3 = 0 THEN c_nationkey + 1050 END AS dd FROM customer)")
def clue_person(spark, d):
    none = F.lit(None)
    b, e = F.when(F.col("c_custkey") % 2 == 0, F.col("c_nationkey") + 1000), F.when(F.col("c_custkey") % 3 == 0, F.col("c_nationkey") + 1050)
    dates = clues.life_dates(b, e, none.cast("int"), none.cast("int"), none.cast("int"))
    return t(spark, d, "customer").select("c_custkey", clues.person(F.col("c_name"), none.cast("string"), dates, F.col("c_mktsegment"), none.cast("string")).alias("clue"))


@query("SELECT p_partkey, p_name || ' (' || concat_ws(', ', nullif(p_type, ''), CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS VARCHAR) || '–' || CAST(p_size + 9 AS VARCHAR) END) || ')' AS clue FROM part")
def clue_place(spark, d):
    start = F.when(F.col("p_size") % 2 == 0, F.col("p_size"))
    return t(spark, d, "part").select("p_partkey", clues.place(F.col("p_name"), F.col("p_type"), F.lit(None).cast("string"), start, F.col("p_size") + 9).alias("clue"))


@query("SELECT o_orderkey, CASE WHEN tr <> '' AND dy <> '' THEN 'o (' || tr || ', ' || dy || ')' WHEN tr <> '' THEN 'o (' || tr || ', )' WHEN dy <> '' THEN 'o, ' || dy || ')' ELSE 'o' END AS clue FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE '' END AS tr, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus ELSE '' END AS dy FROM orders)")
def clue_office(spark, d):
    tr, dy = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).otherwise(""), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderstatus")).otherwise("")
    return t(spark, d, "orders").select("o_orderkey", clues.office(F.lit("o"), tr, dy).alias("clue"))


@query(f"SELECT doc_id, CASE WHEN length(c) > 60 THEN substr(c, 1, 57) || '…' ELSE c END AS clause FROM (SELECT doc_id, regexp_replace(coalesce(nullif(regexp_extract(t, '^([^。.]+[。.])', 1), ''), substr(t, 1, 40)), '[。.]$', '') AS c FROM (SELECT doc_id, regexp_replace(regexp_replace(text, '^{_WS}', ''), '{_WS}$', '') AS t FROM documents))")
def first_clause(spark, d):
    return t(spark, d, "documents").select("doc_id", text.first_clause(F.col("text")).alias("clause"))


@query("SELECT page_id, TRY_CAST(nullif(regexp_extract(url, '([+\\-]?[0-9]{3,4})', 1), '') AS INTEGER) AS year, TRY_CAST(nullif(regexp_extract(regexp_extract(url, '/([^/]*)$', 1), '^(-?[0-9]{1,4})', 1), '') AS INTEGER) AS lead FROM pages")
def year_extract(spark, d):
    return t(spark, d, "pages").select("page_id", years.year_of_date(F.col("url")).alias("year"), years.leading_year(F.regexp_extract("url", "/([^/]*)$", 1)).alias("lead"))


@query("SELECT page_id, CAST(i AS BIGINT) AS ord, x AS item FROM (SELECT page_id, unnest(l) AS x, unnest(range(1, len(l) + 1)) AS i FROM (SELECT page_id, regexp_extract_all(html, '(?s)<li\\b.*?</li>') AS l FROM pages))")
def tei_fragments(spark, d):
    found = tei.fragments(t(spark, d, "pages").select("page_id", "html"), "html", "li")
    return found.select("page_id", (F.col("xml_ord") + 1).cast("long").alias("ord"), F.col("xml").alias("item"))


@query("SELECT doc_id, md5(regexp_replace(text, '[\\t\\r\\n]+', ' ', 'g')) AS cell FROM documents")
def tsv_escape(spark, d):
    return t(spark, d, "documents").select("doc_id", F.md5(text.tsv_cell(F.col("text")).cast("binary")).alias("cell"))


@query("""SELECT doc_id, md5(CASE WHEN regexp_matches(text, '[",\\r\\n]') THEN '"' || replace(text, '"', '""') || '"' ELSE text END) AS cell, md5('"' || replace(text, '"', '""') || '"') AS quoted FROM documents""")
def csv_escape(spark, d):
    c = F.col("text")
    return t(spark, d, "documents").select("doc_id", F.md5(text.csv_cell(c).cast("binary")).alias("cell"), F.md5(text.csv_cell(c, True).cast("binary")).alias("quoted"))


@query(f"SELECT surface, count(DISTINCT id) AS n FROM ({_WORDS}) WHERE {_VALID} GROUP BY surface HAVING count(DISTINCT id) > 1 ORDER BY n DESC, surface LIMIT 100")
def ambiguity_top100(spark, d):
    w = _words(t(spark, d, "documents")).where(text.is_valid(F.col("surface")))
    return R.ambiguity(w).orderBy(F.desc("n"), "surface").limit(100)


@query("WITH w AS (SELECT p_partkey AS id, unnest(string_split(p_name, ' ')) AS surface, p_brand AS name FROM part), p AS (SELECT DISTINCT surface, id, name FROM w), r AS (SELECT *, row_number() OVER (PARTITION BY surface ORDER BY id) AS k, count(*) OVER (PARTITION BY surface) AS n FROM p) SELECT surface, n, string_agg(CAST(id AS VARCHAR), '; ' ORDER BY k) AS ids, string_agg(name, '; ' ORDER BY k) AS names FROM r WHERE k <= 8 AND n > 1 GROUP BY surface, n")
def ambiguity_sample(spark, d):
    w = t(spark, d, "part").select(F.explode(F.split("p_name", " ")).alias("surface"), F.col("p_partkey").alias("id"), F.col("p_brand").alias("name"), F.col("p_partkey").alias("ord"))
    return R.ambiguity_rows(w)


@query("WITH w AS (SELECT p_partkey AS id, unnest(string_split(p_name, ' ')) AS surface FROM part), p AS (SELECT surface, count(DISTINCT id) AS n FROM w GROUP BY 1) SELECT (SELECT count(*) FROM part) AS entities, (SELECT count(*) FROM w) AS total_strings, (SELECT count(*) FROM p) AS unique_strings, (SELECT count(*) FROM p WHERE n > 1) AS ambiguous_strings")
def ambiguity_stats(spark, d):
    return R.ambiguity_stats(t(spark, d, "part").select(F.col("p_partkey").alias("id"), F.split("p_name", " ").alias("strings")))


@query("SELECT p_partkey, CASE WHEN length(p_name) > 2 AND length(p_name) - length(k) >= 2 THEN substr(p_name, 1, length(p_name) - length(k)) END AS stem FROM (SELECT p_partkey, p_name, ' ' || regexp_extract(p_name, '([^ ]*)$', 1) AS k FROM part) WHERE ends_with(p_name, k)")
def stem_strings(spark, d):
    k = F.concat(F.lit(" "), F.regexp_extract("p_name", "([^ ]*)$", 1))
    return t(spark, d, "part").withColumn("k", k).where(F.col("p_name").endswith(F.col("k"))).select("p_partkey", text.stem(F.col("p_name"), F.col("k")).alias("stem"))


@query("SELECT lang, sum(r) AS raw, sum(k) AS kept, sum(r - k) AS dropped, round(100.0 * sum(r - k) / sum(r), 1) AS dropped_pct FROM (SELECT lang, len(list_distinct(string_split(text, ' '))) AS r, len(list_filter(list_distinct(string_split(text, ' ')), lambda x: length(x) >= 4)) AS k FROM documents) GROUP BY lang")
def filter_stats(spark, d):
    raw = F.array_distinct(F.split("text", " "))
    kept = F.filter(raw, lambda x: F.char_length(x) >= 4)
    g = t(spark, d, "documents").groupBy("lang").agg(F.sum(F.size(raw)).alias("raw"), F.sum(F.size(kept)).alias("kept"), F.sum(F.size(F.array_except(raw, kept))).alias("dropped"))
    return g.withColumn("dropped_pct", F.round(F.lit(100.0) * F.col("dropped") / F.col("raw"), 1))


@query("SELECT n_name AS layer, count(c_custkey) AS n FROM nation LEFT JOIN customer ON n_nationkey = c_nationkey AND c_acctbal > 9500 GROUP BY n_name")
def layer_counts(spark, d):
    n = t(spark, d, "nation")
    rows = t(spark, d, "customer").where("c_acctbal > 9500").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("layer"))
    return packs.layer_counts(rows, n.select(F.col("n_name").alias("layer")))


@query("SELECT n_name, seg AS segment, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey AND c_mktsegment = seg AND c_acctbal > 9000) AS n FROM nation, (SELECT DISTINCT c_mktsegment AS seg FROM customer)")
def matrix_zero_fill(spark, d):
    c = t(spark, d, "customer")
    counts = c.where("c_acctbal > 9000").groupBy("c_nationkey", "c_mktsegment").count()
    cells = t(spark, d, "nation").crossJoin(c.select("c_mktsegment").distinct())  # nations by segments: two fixed dimensions
    return cells.join(counts, (F.col("n_nationkey") == counts.c_nationkey) & (cells.c_mktsegment == counts.c_mktsegment), "left").select("n_name", cells.c_mktsegment.alias("segment"), F.coalesce("count", F.lit(0)).alias("n"))


@query("SELECT kind, event_type, count(*) AS n FROM (SELECT event_type, unnest(list_filter([CASE WHEN value > 50 THEN 'high' END, CASE WHEN user_id % 2 = 0 THEN 'even' END, 'all'], lambda x: x IS NOT NULL)) AS kind FROM events) GROUP BY ALL")
def one_scan_fanout(spark, d):
    kinds = F.array_compact(F.array(F.when(F.col("value") > 50, F.lit("high")), F.when(F.col("user_id") % 2 == 0, F.lit("even")), F.lit("all")))
    return t(spark, d, "events").select("event_type", F.explode(kinds).alias("kind")).groupBy("kind", "event_type").agg(F.count("*").alias("n"))


@query("SELECT label, count(DISTINCT id) AS n FROM (SELECT c_custkey AS id, c_mktsegment AS label FROM customer UNION ALL SELECT s_suppkey + 1000000000, substr(s_name, 1, 8) FROM supplier) GROUP BY label HAVING count(DISTINCT id) > 1")
def union_labels(spark, d):
    a = t(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("surface"))
    b = t(spark, d, "supplier").select((F.col("s_suppkey") + 1000000000).alias("id"), F.substring("s_name", 1, 8).alias("surface"))
    return R.ambiguity(a.unionByName(b)).withColumnRenamed("surface", "label")


@query("SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R'")
def minus_set(spark, d):
    return t(spark, d, "orders").select("o_orderkey").distinct().join(t(spark, d, "lineitem").where("l_returnflag = 'R'"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti")


@query("SELECT p_partkey, CAST(len(list_distinct(list_concat(a, b))) AS BIGINT) AS n_union, CAST(len(list_filter(list_distinct(a), lambda x: NOT list_contains(b, x))) AS BIGINT) AS n_minus, list_sort(a) = list_sort(b) AS same FROM (SELECT p_partkey, string_split(p_name, ' ') AS a, string_split(p_type, ' ') AS b FROM part)")
def array_set_ops(spark, d):
    a, b = F.split("p_name", " "), F.split("p_type", " ")
    return t(spark, d, "part").select("p_partkey", F.size(F.array_union(a, b)).cast("long").alias("n_union"), F.size(F.array_except(a, b)).cast("long").alias("n_minus"), R.same_set(a, b).alias("same"))


@query("SELECT conv_id, arg_min(text, turn) FILTER (role = 'assistant' AND text <> '') AS first_answer, arg_min(role, turn) AS opener, CAST(count(DISTINCT role) AS BIGINT) AS n_roles FROM conversations GROUP BY conv_id")
def merge_page_rows(spark, d):
    c = t(spark, d, "conversations").select("conv_id", "turn", F.when(F.col("role") == "assistant", F.col("text")).alias("first_answer"), F.col("role").alias("opener"), F.array("role").alias("roles"))
    return R.merge_rows(c, "conv_id", "turn", ["first_answer", "opener"], ["roles"]).select("conv_id", "first_answer", "opener", F.size("roles").cast("long").alias("n_roles"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 500 ORDER BY o_orderkey LIMIT 100")
def keyset_page(spark, d):
    return R.keyset_page(t(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 500, 100)


@query("SELECT event_id, event_type FROM events WHERE value > 50 ORDER BY event_id LIMIT 200")
def max_matches(spark, d):
    return t(spark, d, "events").where("value > 50").select("event_id", "event_type").orderBy("event_id").limit(200)


@query("WITH RECURSIVE c(root, node) AS (SELECT p_partkey, p_partkey FROM part WHERE p_partkey BETWEEN 1 AND 3 UNION SELECT c.root, p_partkey FROM c JOIN part ON p_partkey // 2 = c.node AND p_partkey > 1) SELECT root, count(*) AS n, max(node) AS largest FROM c GROUP BY root")
def closure_descendants(spark, d):
    p = t(spark, d, "part")
    edges = p.where("p_partkey > 1").select(F.col("p_partkey").alias("child"), F.expr("p_partkey div 2").alias("parent"))
    roots = p.where("p_partkey between 1 and 3").select(F.col("p_partkey").alias("root"), F.col("p_partkey").alias("node"))
    return R.closure(edges, roots).groupBy("root").agg(F.count("*").alias("n"), F.max("node").alias("largest"))


@query("SELECT 'duplicate' AS problem, CAST(count(*) AS BIGINT) AS n FROM (SELECT n_name FROM nation GROUP BY n_name HAVING count(*) > 1) UNION ALL SELECT 'orphan', count(*) FROM nation WHERE n_regionkey NOT IN (SELECT r_regionkey FROM region) UNION ALL SELECT 'format', count(*) FROM nation WHERE NOT regexp_matches(n_name, '^[A-Z ]+$')")
def config_validate(spark, d):
    n = t(spark, d, "nation")
    found = [
        ("duplicate", n.groupBy("n_name").count().where("count > 1")),
        ("orphan", n.join(t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left_anti")),
        ("format", n.where(~F.col("n_name").rlike("^[A-Z ]+$"))),
    ]
    return R.union_all([f.agg(F.count("*").alias("n")).select(F.lit(k).alias("problem"), "n") for k, f in found])


@query("SELECT c_mktsegment, count(*) AS entities, sum(len(string_split(c_name, '#'))) AS strings, count(*) FILTER (c_acctbal < 0) AS negative FROM customer GROUP BY c_mktsegment")
def manifest_counts(spark, d):
    return t(spark, d, "customer").groupBy("c_mktsegment").agg(F.count("*").alias("entities"), F.sum(F.size(F.split("c_name", "#"))).alias("strings"), F.count_if(F.col("c_acctbal") < 0).alias("negative"))


@query("SELECT doc_id, sha256(text) AS digest, CAST(strlen(text) AS BIGINT) AS bytes FROM documents WHERE NOT starts_with(text, 'version https://git-lfs')")
def bundle_hashes(spark, d):
    c = F.col("text").cast("binary")
    return t(spark, d, "documents").where(~F.col("text").startswith("version https://git-lfs")).select("doc_id", F.sha2(c, 256).alias("digest"), F.octet_length("text").cast("long").alias("bytes"))


_REGIONS = {"one": "src1", "five": "src5", "seven": "src7"}


@query(f"SELECT bundle, count(*) AS n, sum(strlen(text)) AS bytes FROM (SELECT text, CASE {' '.join(f"WHEN starts_with(source, '{p}') THEN '{b}'" for b, p in _REGIONS.items())} END AS bundle FROM documents) WHERE bundle IS NOT NULL GROUP BY bundle")
def regional_bundles(spark, d):
    rows = t(spark, d, "documents").select(packs.region_of(F.col("source"), _REGIONS).alias("bundle"), F.octet_length("text").alias("b")).where("bundle is not null")
    return rows.groupBy("bundle").agg(F.count("*").alias("n"), F.sum("b").alias("bytes"))


@query("SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events WHERE value > 10 GROUP BY event_type")
def stream_extract(spark, d):
    from onoma.streaming import resumable

    base = _scratch(spark, "stream")
    one = lambda: resumable.extract(spark, f"{d}/events.parquet*", lambda df: df.where("value > 10").select("event_type", "user_id"), f"{base}/sink", f"{base}/checkpoint", {"least": 10}, schema=_ddl(t(spark, d, "events")), fmt="parquet")
    one()
    one()  # a second run finds nothing new
    return spark.read.parquet(f"{base}/sink").groupBy("event_type").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{n}` {k}" for n, k in df.dtypes)


def _scratch(spark: SparkSession, name: str) -> str:
    import uuid

    from onoma.operators.storage import shared_dir

    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("SELECT o_orderkey, o_totalprice FROM orders")
def harvest_resume(spark, d):
    from onoma.streaming import resumable

    sink, o = _scratch(spark, "harvest"), t(spark, d, "orders").select("o_orderkey", "o_totalprice")
    n = o.count()
    resumable.harvest(lambda after, k: R.keyset_page(o, "o_orderkey", after, k), "o_orderkey", sink, max(1000, n // 4))
    return spark.read.parquet(sink)


@query("SELECT o_custkey, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS quantity, min(l_returnflag) AS first_mode, max(l_returnflag) AS last_mode FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_custkey")
def harvest_stream(spark, d):
    """Orders' lines go into a database, and are harvested from it by customer in two runs, the first of which stops half-way."""
    from onoma.streaming import resumable

    base = _scratch(spark, "by-key")
    lines = t(spark, d, "orders").join(t(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).select("o_custkey", "l_quantity", "l_returnflag")
    db = _database(spark, base, index={"lines": "o_custkey"}, lines=lines)
    n = lines.agg(F.countDistinct("o_custkey")).first()[0]
    merge = lambda rows: rows.groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"), F.min("l_returnflag").alias("first_mode"), F.max("l_returnflag").alias("last_mode"))
    options = {"path": db, "dbtable": "lines", "key": "o_custkey", "limit": str(n // 12 + 1), "ranges": "4"}
    for batches in (2, 0):
        resumable.harvest_stream(spark, "sqlite", options, f"{base}/sink", f"{base}/checkpoint", merge, batches=batches)
    return spark.read.parquet(f"{base}/sink").drop("batch")


def _database(spark: SparkSession, base: str, index: dict[str, str] | None = None, **tables: DataFrame) -> str:
    """A SQLite database of some tables, with an index of some, in a folder of the shared one, which must be a path that all machines mount."""
    import os

    from onoma.sources import sqlite

    sqlite.register(spark)
    os.makedirs(sqlite.local(base), exist_ok=True)
    for name, df in tables.items():
        sqlite.write(df, f"{base}/tables.db", name, index=(index or {}).get(name, ""))
    return f"{base}/tables.db"


@query("SELECT c_custkey, c_name, c_acctbal, CAST(row_number() OVER (ORDER BY c_custkey) AS BIGINT) AS ord FROM customer QUALIFY c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_acctbal >= 500 AND c_name LIKE '%7'")
def sqlite_filters(spark, d):
    """Customers written to a database, and read back by filters that reach it."""
    from onoma.sources import sqlite

    c = t(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    db = _database(spark, _scratch(spark, "filters"), customer=c.orderBy("c_custkey"))
    rows = sqlite.table(spark, db, "customer", "c_custkey", "c_name", "c_mktsegment", "c_acctbal").where("c_mktsegment in ('BUILDING', 'MACHINERY') and c_acctbal >= 500 and c_name like '%7'")
    return rows.select("c_custkey", "c_name", "c_acctbal", F.col("_ord").alias("ord"))


@query("SELECT o_custkey, CAST(min(o_orderkey) AS BIGINT) AS first_order FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey")
def sqlite_insert_or_ignore(spark, d):
    """Two appends to one table with a key: the rows that came first stay."""
    from onoma.sources import sqlite

    o = t(spark, d, "orders").where("o_custkey is not null").select("o_custkey", F.col("o_orderkey").alias("first_order"))
    first = o.groupBy("o_custkey").agg(F.min("first_order").alias("first_order"))
    base = _scratch(spark, "ignore")
    db = _database(spark, base, firsts=spark.createDataFrame([], first.schema))
    sqlite.write(first, db, "firsts", "o_custkey")
    sqlite.write(o.join(first, ["o_custkey", "first_order"], "left_anti"), db, "firsts", "o_custkey")
    return sqlite.table(spark, db, "firsts").drop("_ord")


@query("SELECT 'N' || n_nationkey || '-' || c_custkey AS id, c_name AS name, trim(n_name) AS note FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 10 <> 0")
def tei_records(spark, d):
    """Customers written as a list of records, and read back by byte ranges; records without an id are none."""
    c = t(spark, d, "customer").join(t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    ident = F.when(F.col("c_custkey") % 10 == 0, F.lit("n")).otherwise(F.lit("xml:id"))
    line = F.concat(F.lit("<person "), ident, F.lit('="N'), F.col("n_nationkey"), F.lit("-"), F.col("c_custkey"), F.lit('">\n<persName xml:lang="zho-Hant">'), F.col("c_name"), F.lit('</persName><note type="concise"> '), F.col("n_name"), F.lit("</note></person>"))
    path = _scratch(spark, "list")
    c.select(line.alias("value")).write.text(path)
    rows = tei.persons(spark, path)
    return rows.select("id", F.get("names", F.lit(0))["text"].alias("name"), tei.note(F.col("notes"), "concise").alias("note"))


@query("SELECT o_custkey, o_orderkey, o_totalprice, k AS rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS k FROM orders) WHERE k <= 3")
def top_k_per_key(spark, d):
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return t(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice", F.row_number().over(w).cast("long").alias("rank")).where("rank <= 3")


@query("SELECT lang, arg_min(source, (source)) AS first_source, count(DISTINCT source) AS n FROM documents GROUP BY lang")
def sources_by_lang(spark, d):
    return t(spark, d, "documents").groupBy("lang").agg(F.min("source").alias("first_source"), F.countDistinct("source").alias("n"))


@query("SELECT c_custkey, c_name || ' (' || c_mktsegment || ', Wikidata Q' || CAST(c_custkey AS VARCHAR) || ')' AS graph, c_name || ' (NDL ' || CAST(c_custkey AS VARCHAR) || ')' AS entry FROM customer")
def clue_graph(spark, d):
    q = F.col("c_custkey").cast("string")
    return t(spark, d, "customer").select("c_custkey", clues.graph_person(F.col("c_name"), F.col("c_mktsegment"), F.lit(False), F.concat(F.lit("Q"), q)).alias("graph"), clues.catalogue_entry(F.col("c_name"), q).alias("entry"))



# --- compilers over rows made of the tables -----------------------------------------------------------------------------


def _joined(c: str | Column) -> Column:
    return F.array_join(F.array_sort(c), "|")


@query("SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, array_to_string(list_sort(list_distinct(list_filter(list_concat([p_name], string_split(p_type, ' ')), lambda x: length(x) >= 3))), '|') AS strings, p_name || ' (' || p_brand || ', ' || p_size || '–' || (p_size + 100) || ')' AS description FROM part")
def compile_places(spark, d):
    rows = t(spark, d, "part").select(F.col("p_partkey").alias("c_addr_id"), F.col("p_name").alias("c_name_chn"), F.replace("p_type", F.lit(" "), F.lit(";")).alias("c_alt_names"), F.col("p_brand").alias("c_admin_type"), F.col("p_size").alias("c_firstyear"), (F.col("p_size") + 100).alias("c_lastyear"))
    got = C.snapshot_places(rows)
    return got.select(F.col("authorityId").alias("id"), F.col("primaryName").alias("name"), _joined("searchStrings").alias("strings"), F.col("metadata.description").alias("description"))


@query("SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, coalesce(nullif(r_name, 'ASIA'), 'East') AS dynasty, array_to_string(list_sort(list_distinct([c_name, c_mktsegment])), '|') AS strings, c_name || ' (' || c_mktsegment || ', ' || coalesce(nullif(r_name, 'ASIA'), 'East') || ')' AS description FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def compile_offices(spark, d):
    dynasties = t(spark, d, "region").select(F.col("r_regionkey").alias("c_dy"), F.when(F.col("r_name") == "ASIA", "East").otherwise("other").alias("c_dynasty"), F.nullif("r_name", F.lit("ASIA")).alias("c_dynasty_chn"), F.col("r_regionkey").alias("c_start"), (F.col("r_regionkey") + 9).alias("c_end"))
    rows = t(spark, d, "customer").join(t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.select(F.col("c_custkey").alias("c_office_id"), F.col("c_name").alias("c_office_chn"), F.col("c_mktsegment").alias("c_office_chn_alt"), F.col("c_mktsegment").alias("c_office_trans"), F.col("n_regionkey").alias("c_dy"))
    got = C.snapshot_offices(rows, dynasties)
    return got.select(F.col("authorityId").alias("id"), F.col("primaryName").alias("name"), F.col("metadata.dynasty").alias("dynasty"), _joined("searchStrings").alias("strings"), F.col("metadata.description").alias("description"))


@query("SELECT CAST(p_partkey AS VARCHAR) AS id, array_to_string(list_sort(list_distinct([p_name, p_brand])), '|') AS strings, p_name || ' (' || p_type || ', NDL ' || p_partkey || ')' AS description FROM part")
def compile_works(spark, d):
    raw = t(spark, d, "part").select(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("title"), F.array("p_brand", "p_name").alias("variants"), F.array("p_type").alias("creators"))
    return C.catalogue(raw, "work").select(F.col("authorityId").alias("id"), _joined("searchStrings").alias("strings"), F.col("metadata.description").alias("description"))


_READING = "'y' || (l_linenumber % 3)"


@query(f"SELECT CAST(o_orderkey AS VARCHAR) AS id, max('n' || o_orderkey) AS name, max(first_reading) AS yomi, array_to_string(list_sort(list_distinct(list_concat(coalesce(list({_READING}) FILTER ({_READING} <> first_reading), []), list(l_returnflag)))), '|') AS others, CAST(max(year(o_orderdate)) AS INTEGER) AS born FROM (SELECT *, first_value({_READING}) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS first_reading FROM orders JOIN lineitem ON o_orderkey = l_orderkey) GROUP BY o_orderkey")
def harvest_bindings(spark, d):
    rows = t(spark, d, "orders").join(t(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    said = lambda *kv: F.create_map(*[x for k, v in kv for x in (F.lit(k), F.struct(F.lit("literal").alias("type"), v.cast("string").alias("value")))])
    b = said(("auth", F.concat(F.lit("http://a.invalid/x/"), F.col("o_orderkey"))), ("name", F.concat(F.lit("n"), F.col("o_orderkey"))), ("yomi", F.concat(F.lit("y"), F.col("l_linenumber") % 3)), ("yomiAlt", F.col("l_returnflag")), ("birth", F.date_format("o_orderdate", "yyyy-MM-dd")))
    got = C.raw_of_bindings(rows.select(b.alias("b"), "l_linenumber"), "person", "l_linenumber")
    return got.select(F.col("authorityId").alias("id"), "name", "yomi", F.array_join(F.array_sort("yomiAlt"), "|").alias("others"), F.col("birthYear").alias("born"))


def _dump_lines(spark, d):
    """Customers as entities of a dump: humans, cities, or disambiguation pages; some have no English label."""
    k = F.col("c_custkey")
    snak = lambda kind, v: F.struct(F.struct(F.lit("value").alias("snaktype"), F.struct(F.lit(kind).alias("type"), v.alias("value")).alias("datavalue")).alias("mainsnak"))
    item = lambda v: F.struct(v.alias("id"))
    kinds = F.when(k % 3 == 0, F.lit("Q515")).otherwise(F.lit("Q5"))
    classes = F.when(k % 7 == 0, F.array(snak("wikibase-entityid", item(kinds)), snak("wikibase-entityid", item(F.lit("Q4167410"))))).otherwise(F.array(snak("wikibase-entityid", item(kinds))))
    born = F.array(snak("time", F.struct(F.concat(F.lit("+"), (F.col("c_nationkey") + 1355).cast("string"), F.lit("-01-01T00:00:00Z")).alias("time"))))
    claims = F.struct(classes.alias("P31"), F.array(snak("wikibase-entityid", item(F.concat(F.lit("Q"), F.col("c_nationkey") + 9680)))).alias("P27"), born.alias("P569"))
    language = F.when(k % 5 == 0, "ja").otherwise("en")
    named = F.concat(F.lit('{"'), language, F.lit('":{"language":"'), language, F.lit('","value":"'), F.col("c_name"), F.lit('"}}'))
    body = F.concat(F.lit('{"type":"item","id":"Q'), k.cast("string"), F.lit('","labels":'), named, F.lit(',"aliases":{},"claims":'), F.to_json(claims), F.lit("},"))
    return t(spark, d, "customer").select(body.alias("value"))


@query("SELECT CASE WHEN c_custkey % 5 = 0 THEN 'ja' ELSE 'en' END AS lang, CASE WHEN c_custkey % 3 = 0 THEN 'place' ELSE 'person' END AS kind, 'Q' || c_custkey AS qid, c_name AS label, CAST(c_nationkey + 1355 AS INTEGER) AS born FROM customer WHERE c_custkey % 7 <> 0 AND (c_custkey % 3 = 0 OR c_nationkey + 9680 IN (9685, 9683) OR c_nationkey + 1355 <= 1367)")
def dump_packs(spark, d):
    got = C.raw_packs(files.dump_entities(_dump_lines(spark, d)), ["en", "ja"], ["person", "place"], membership="pre-ming")
    return got.select("lang", "kind", "qid", F.col("primaryLabel").alias("label"), F.col("birthYear").alias("born"))


# --- graph patterns ---------------------------------------------------------------------------------------------------

_TRIPLES = (
    "SELECT 'c' || c_custkey AS s, 'type' AS p, c_mktsegment AS o FROM customer UNION ALL SELECT 'c' || c_custkey, 'label', c_name FROM customer "
    "UNION ALL SELECT 'c' || c_custkey, 'altLabel', n_name FROM customer JOIN nation ON n_nationkey = c_nationkey UNION ALL SELECT 'c' || c_custkey, 'P31', 'N' || c_nationkey FROM customer "
    "UNION ALL SELECT 'N' || n_nationkey, 'P279', 'R' || n_regionkey FROM nation UNION ALL SELECT 'c' || o_custkey, 'order', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'F'"
)


def _triples(spark, d):
    c, n, o = t(spark, d, "customer"), t(spark, d, "nation"), t(spark, d, "orders").where("o_orderstatus = 'F'")
    row = lambda df, head, s, p, x, tail="": df.select(F.concat(F.lit(head), F.col(s).cast("string")).alias("s"), F.lit(p).alias("p"), F.concat(F.lit(tail), F.col(x).cast("string")).alias("o"))
    named = c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = [
        row(c, "c", "c_custkey", "type", "c_mktsegment"), row(c, "c", "c_custkey", "label", "c_name"), row(named, "c", "c_custkey", "altLabel", "n_name"),
        row(c, "c", "c_custkey", "P31", "c_nationkey", "N"), row(n, "N", "n_nationkey", "P279", "n_regionkey", "R"), row(o, "c", "o_custkey", "order", "o_orderkey"),
    ]
    return R.union_all(rows)


@query(f"WITH t AS ({_TRIPLES}) SELECT l.s, l.o AS name, x.o AS item FROM t l LEFT JOIN t x ON x.s = l.s AND x.p = 'order' WHERE l.p = 'label' AND l.s > 'c2' AND l.s IN (SELECT s FROM t WHERE p = 'type' AND o = 'BUILDING') ORDER BY l.s, name, item NULLS FIRST LIMIT 200")
def graph_page(spark, d):
    g = _triples(spark, d)
    return triples.page(triples.of_type(g, "BUILDING"), g, {"name": "label"}, {"item": "order"}, "c2", 200)


_TREE = f"{_TRIPLES} UNION ALL SELECT o_orderkey || '', 'priority', o_orderpriority FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey || '', 'clerk', CAST(o_orderdate AS VARCHAR) FROM orders WHERE o_orderstatus = 'F'"


@query(f"WITH t AS ({_TREE}), r AS (SELECT a.s AS auth, l.o AS name FROM t a JOIN t l ON l.s = a.s AND l.p = 'label' WHERE a.p = 'type' AND a.o IN ('BUILDING', 'MACHINERY') AND l.o NOT LIKE '%7' AND a.s > 'c1' AND a.s NOT IN (SELECT x.s FROM t x JOIN t b ON b.s = x.o AND b.p = 'P279' AND b.o = 'R1' WHERE x.p = 'P31') ORDER BY a.s LIMIT 150) "
       "SELECT auth, name, i.item, i.priority, n.other FROM r LEFT JOIN (SELECT x.s, x.o AS item, c.o AS clerk, p.o AS priority FROM t x JOIN t c ON c.s = x.o AND c.p = 'clerk' LEFT JOIN t p ON p.s = x.o AND p.p = 'priority' AND p.o NOT LIKE '4%' WHERE x.p = 'order') i ON i.s = auth LEFT JOIN (SELECT s, o AS other FROM t WHERE p = 'altLabel') n ON n.s = auth")  # fmt: skip
def graph_tree(spark, d):
    """A page of a tree with fixed values, a MINUS over a path, a test that must fail, and an optional group in an optional group."""
    from onoma.operators.patterns import Group, Triple, page

    o = t(spark, d, "orders").where("o_orderstatus = 'F'")
    of_order = lambda p, c, df: df.select(F.col("o_orderkey").cast("string").alias("s"), F.lit(p).alias("p"), F.col(c).cast("string").alias("o"))
    g = R.union_all([_triples(spark, d), of_order("priority", "o_orderpriority", o.where("o_orderkey % 2 = 0")), of_order("clerk", "o_orderdate", o)]).withColumn("lang", F.when(F.col("o").startswith("4"), "x").otherwise("en"))
    priority = Group((Triple("?item", "priority", "?priority", "en"),))
    tree = Group(
        (Triple("?auth", "type", "?segment"), Triple("?auth", "label", "?name")), values=(("segment", ("BUILDING", "MACHINERY")),), lacks=(("name", "7$"),),
        minus=(Group((Triple("?auth", "P31/P279*", "R1"),)),), optional=(Group((Triple("?auth", "order", "?item"), Triple("?item", "clerk", "?clerk")), (priority,)), Group((Triple("?auth", "altLabel", "?other"),))),
    )
    return page(g, tree, "auth", "c1", 150).select("auth", "name", "item", "priority", "other")


@query(f"WITH t AS ({_TRIPLES}) SELECT s, o AS value FROM t WHERE p = 'label' AND regexp_matches(o, '^Customer#0000000[0-4]') AND s IN (SELECT s FROM t WHERE p = 'type' AND o = 'BUILDING') ORDER BY value, s LIMIT 20")
def graph_sample(spark, d):
    g = _triples(spark, d)
    return triples.sample_by_prefix(triples.of_type(g, "BUILDING"), g, "label", "Customer#0000000[0-4]", 20)


@query(f"WITH t AS ({_TRIPLES}) SELECT count(DISTINCT s) AS n FROM t WHERE p = 'type' AND o = 'BUILDING' AND s NOT IN (SELECT a.s FROM t a JOIN t b ON b.s = a.o AND b.p = 'P279' AND b.o = 'R1' WHERE a.p = 'P31')")
def graph_minus_count(spark, d):
    g = _triples(spark, d)
    return triples.count(triples.minus_classes(triples.of_type(g, "BUILDING"), g, ["R1"]))


@query(f"WITH t AS ({_TRIPLES}) SELECT o AS surface, count(DISTINCT s) AS n FROM t WHERE p IN ('label', 'altLabel') AND s IN (SELECT s FROM t WHERE p = 'type' AND o = 'BUILDING') GROUP BY o HAVING count(DISTINCT s) > 1 ORDER BY n DESC, surface LIMIT 100")
def graph_ambiguity(spark, d):
    g = _triples(spark, d)
    return triples.ambiguous_labels(triples.of_type(g, "BUILDING"), g)


@query(f"WITH t AS ({_TRIPLES}) SELECT n_name AS value, (SELECT count(DISTINCT s) FROM t WHERE p = 'altLabel' AND o = n_name AND s IN (SELECT s FROM t WHERE p = 'type' AND o = 'BUILDING')) AS n FROM nation")
def graph_matrix(spark, d):
    g = _triples(spark, d)
    return triples.count_matrix(g, "altLabel", t(spark, d, "nation").select(F.col("n_name").alias("value")), triples.of_type(g, "BUILDING"))


@query("WITH k(kind, root) AS (VALUES ('a', 'R1'), ('b', 'R0'), ('b', 'R2')), c AS (SELECT kind, root AS q FROM k UNION SELECT kind, 'N' || n_nationkey FROM k JOIN nation ON 'R' || n_regionkey = root) SELECT kind, string_agg(q, ',' ORDER BY CAST(substr(q, 2) AS BIGINT), q) AS classes FROM c GROUP BY kind")
def graph_closure(spark, d):
    return triples.closure_document(_triples(spark, d), {"a": ["R1"], "b": ["R0", "R2"]}).select("kind", F.array_join("closure", ",").alias("classes"))


from onoma.plans import compiled, sourced  # noqa: E402, F401  they add their queries
