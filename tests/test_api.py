"""Entry points from sources to packs."""

import json
import sqlite3
import unicodedata

import pytest
from pyspark.sql import functions as F

from onoma.operators import compilers as C
from onoma.operators import config, triples
from onoma.plans import api
from onoma.sinks import packs
from onoma.sources import files


def test_snapshot_and_report(spark, tmp_path):
    db = sqlite3.connect(tmp_path / "s.db")
    db.executescript("""
        CREATE TABLE BIOG_MAIN(c_personid INT, c_name_chn TEXT, c_name TEXT, c_surname_chn TEXT, c_mingzi_chn TEXT, c_birthyear INT, c_deathyear INT, c_index_year INT, c_fl_earliest_year INT, c_fl_latest_year INT, c_dy INT);
        CREATE TABLE DYNASTIES(c_dy INT, c_dynasty TEXT, c_dynasty_chn TEXT, c_start INT, c_end INT);
        CREATE TABLE ALTNAME_DATA(c_personid INT, c_alt_name_chn TEXT, c_alt_name_type_code INT);
        CREATE TABLE ADDR_CODES(c_addr_id INT, c_name_chn TEXT, c_alt_names TEXT, c_firstyear INT, c_lastyear INT, c_admin_type TEXT, CHGIS_PT_ID INT);
        CREATE TABLE OFFICE_CODES(c_office_id INT, c_office_chn TEXT, c_office_chn_alt TEXT, c_office_trans TEXT, c_dy INT);
        INSERT INTO BIOG_MAIN VALUES (1, '王安石', 'Wang Anshi', '王', '安石', 1021, 1086, 1080, NULL, NULL, 15), (2, '王安石', NULL, '王', '安石', NULL, NULL, NULL, NULL, NULL, 15);
        INSERT INTO DYNASTIES VALUES (15, 'Song', '宋', 960, 1279);
        INSERT INTO ADDR_CODES VALUES (7, '開封', '汴京;汴梁', 960, 1127, '府', 3), (8, ' ', NULL, NULL, NULL, NULL, NULL);
        INSERT INTO OFFICE_CODES VALUES (9, '知縣', NULL, 'Magistrate', 15);
    """)  # fmt: skip
    db.commit()
    db.close()
    got = api.compile_snapshot(spark, str(tmp_path / "s.db"), str(tmp_path / "out"))
    assert {k: (m["entityCount"], m["stringCount"]) for k, m in got.items()} == {"persons": (2, 2), "places": (1, 3), "offices": (1, 1)}
    cands = spark.read.json(str(tmp_path / "out/persons"))
    assert api.report(cands, str(tmp_path / "report")) == {"entities": 2, "total_strings": 2, "unique_strings": 1, "ambiguous_strings": 1}
    assert [r.value for r in spark.read.text(str(tmp_path / "report")).collect()][1:] == ['"王安石","2","1; 2","王安石; 王安石"']
    assert api.bundle(spark, str(tmp_path / "out/persons"), str(tmp_path / "index"), {"b": "part-"}).first().bundle == "b"


def test_extract_and_compile(spark, tmp_path):
    snak = lambda q: {"mainsnak": {"snaktype": "value", "datavalue": {"type": "wikibase-entityid", "value": {"id": q}}}}
    rows = [{"type": "item", "id": q, "labels": {"zh-hant": {"language": "zh-hant", "value": n}}, "aliases": {}, "claims": {"P31": [snak(k)], "P27": [snak("Q9683")]}} for q, n, k in (("Q1", "李白", "Q5"), ("Q2", "長安", "Q515"))]
    (tmp_path / "dump.json").write_text("[\n" + ",\n".join(json.dumps(r) for r in rows) + "\n]\n")
    got = api.extract(spark, str(tmp_path / "dump.json"), "person, place", ["zh-hant", "ja"], str(tmp_path / "raw"))
    assert {(r.lang, r.kind): r["count"] for r in got.collect()} == {("zh-hant", "person"): 1, ("zh-hant", "place"): 1}
    raw = spark.read.schema("qid string, primaryLabel string, aliases array<string>, familyName string, p27 array<string>, p2348 array<string>, p31 array<string>, birthYear int, deathYear int").json(str(tmp_path / "raw/lang=zh-hant/kind=person"))
    assert api.compile_graph_persons(raw, "tang", str(tmp_path / "tang"))["entityCount"] == 1
    assert api.compile_graph_pre_ming(raw, str(tmp_path / "early"))["entityCount"] == 1
    assert api.compile_graph_country(raw, "Q9683", "唐", str(tmp_path / "country"))["entityCount"] == 1
    assert api.extract(spark, str(tmp_path / "dump.json"), "person, place", ["zh-hant"], str(tmp_path / "one"), most=1).first()["count"] == 1
    with pytest.raises(ValueError):
        api.compile_graph_persons(raw, "atlantis", str(tmp_path / "x"))
    with pytest.raises(ValueError):
        api.parse_kinds("person,comet")


def test_crosswalk_of_packs(spark):
    place = lambda i, n, lat: spark.createDataFrame([(i, [n], ((lat, 110.0),))], "authorityId string, searchStrings array<string>, metadata struct<geo:struct<lat:double,lon:double>>")
    assert api.crosswalk_places(place("a", "保德", 30.0), place("b", "保德", 30.5)) == {"matched": 1, "ambiguous": 0, "no_match": 0, "total": 1}
    assert api.crosswalk_places(place("a", "保德", 30.0), place("b", "保德", 30.6))["no_match"] == 1


def test_extract_with_subclasses(spark, tmp_path):
    snak = lambda q: {"mainsnak": {"snaktype": "value", "datavalue": {"type": "wikibase-entityid", "value": {"id": q}}}}
    classes = {"Q1": ["Q515"], "Q2": ["Q9001"], "Q3": ["Q515", "Q9003"], "Q4": ["Q9004"]}
    rows = [{"type": "item", "id": q, "labels": {"ja": {"language": "ja", "value": "長安"}}, "aliases": {}, "claims": {"P31": [snak(k) for k in ks]}} for q, ks in classes.items()]
    (tmp_path / "dump.json").write_text("[\n" + ",\n".join(json.dumps(r) for r in rows) + "\n]\n")
    below = [("Q9001", "P279", "Q9002"), ("Q9002", "P279", "Q515"), ("Q9003", "P279", "Q4167410")]  # two levels below a root; below an excluded one
    closure = api.kind_closure(spark.createDataFrame(below, "s string, p string, o string").withColumn("lang", F.lit(None).cast("string")))
    api.extract(spark, str(tmp_path / "dump.json"), "place", ["ja"], str(tmp_path / "raw"), closure)
    assert {r.qid for r in spark.read.json(str(tmp_path / "raw/lang=ja/kind=place")).collect()} == {"Q1", "Q2"}
    entities = files.dump(spark, str(tmp_path / "dump.json"))
    assert {r.qid for r in C.one_scan(entities, ["ja"], ["place"], closure).collect()} == {"Q1", "Q2"}
    assert {r.qid for r in C.one_scan(entities, ["ja"], ["place"]).collect()} == {"Q1", "Q3"}


def test_packs_of_decomposed_names_meet(spark, tmp_path):
    rows = [(i, "n", [unicodedata.normalize(form, "パリ")], ((30.0, 110.0),)) for i, form in (("a", "NFC"), ("b", "NFD"))]
    df = spark.createDataFrame(rows, "authorityId string, primaryName string, searchStrings array<string>, metadata struct<geo:struct<lat:double,lon:double>>")
    assert api.crosswalk_places(df.where("authorityId = 'a'"), df.where("authorityId = 'b'"))["matched"] == 1
    assert api.report(df, str(tmp_path / "r")) == {"entities": 2, "total_strings": 2, "unique_strings": 1, "ambiguous_strings": 1}


def test_config():
    assert api.validate_config() == []
    bad = [("a", "Q1", "x", 5, 1), ("a", "q2", "", 1, 2)]
    assert len(api.validate_config(bad, {"k": (["Q1"], [])}, {"k": (["Q2"], [])})) == 5


def test_classes_with_cycles(spark):
    rows = [("i", "P31", "Q3"), ("Q3", "P279", "Q2"), ("Q2", "P279", "Q1"), ("Q1", "P279", "Q3"), ("j", "P31", "Q9")]
    g = spark.createDataFrame(rows, "s string, p string, o string").withColumn("lang", F.lit(None).cast("string"))
    assert [r.s for r in triples.instances(g, ["Q1"]).collect()] == ["i"]
    assert triples.closure_document(g, {"k": ["Q1"]}).first().closure == ["Q1", "Q2", "Q3"]


def test_tables_keep_order_head_and_empty_cells(spark, tmp_path):
    df = spark.range(100, numPartitions=7).select("id", F.when(F.col("id") % 2 == 0, F.col("id")).alias("even"), F.lit("x").alias("z"))
    for write, sep in ((packs.write_tsv, "\t"), (packs.write_csv, ",")):
        write(df, str(tmp_path / "t"))
        got = [r.value for r in spark.read.text(str(tmp_path / "t")).collect()]
        assert got == [sep.join(("id", "even", "z")), *(sep.join((str(k), str(k) if k % 2 == 0 else "", "x")) for k in range(100))]


def test_selections():
    assert config.selection("dynasty-p27", ["song", "tang"]) == (["Q1107", "Q9683"], "song+tang")
    assert config.selection("dynasty-p27", priority=True) == ([d[1] for k in config.PRIORITY for d in config.DYNASTIES if d[0] == k], "priority")
    assert config.selection("country-p27", country="japan") == (["Q17"], "japan") and config.selection("pre-ming") == ([], "pre-ming")
    for bad in ({"dynasties": ["atlantis"]}, {}, {"membership": "country-p27", "country": "atlantis"}):
        with pytest.raises(ValueError):
            config.selection(bad.pop("membership", "dynasty-p27"), **bad)


def test_config_of_languages_identifiers_and_countries():
    found = api.validate_config(config.DYNASTIES + [("china", config.CHINA, "中國", 1, 2)], languages={"zh-hant": ([], "hant")}, identifiers=[("X1", "viaf", "trim")], countries=[("a", "17", "x"), ("a", "Q1", "")])
    assert found == ["dynasty china has the item of the region", "country a: 17 is no item", "country a is repeated", "country a has no label", "language zh-hant has no labels", "language zh-hans is missing", "identifier viaf: X1 is no property", "identifier cbdb is missing"]


def test_report_of_the_name_policy(spark, tmp_path):
    said = lambda **kv: {k: {"type": "literal", "value": v} for k, v in kv.items()}
    uri = "http://www.wikidata.org/entity/"
    rows = [said(item=uri + "Q1", itemLabel="李白", alias="太白"), said(item=uri + "Q1", itemLabel="李白", alias="青蓮居士", familyName="李"), said(item=uri + "Q1", itemLabel="李白", alias="太白"), said(item=uri + "Q20", itemLabel="杜甫"), said(item=uri + "Q3", itemLabel="Li", alias=" 李三 ")]
    page = spark.createDataFrame([(json.dumps({"results": {"bindings": rows}}),)], "value string")
    raw = C.sampled_persons(files.ordered_bindings(page), "ord")
    assert sorted(map(tuple, raw.collect())) == [("Q1", "李白", ["太白", "青蓮居士"], "李"), ("Q20", "杜甫", [], ""), ("Q3", "Li", ["李三"], "")]
    told = api.policy_report(raw, str(tmp_path / "r"), {"dynasty": "tang"})
    lines = [r.value for r in spark.read.text(str(tmp_path / "r")).collect()]
    assert lines == ["dynasty: tang", "entities: 3", "raw_strings: 6", "filtered_strings: 3", "dropped_pct: 50.0", "", "sample_dropped:", "- 太白", "- Li", "- 李三"] and told["entities"] == 3
    assert api.policy_report(raw.limit(0), str(tmp_path / "e"), {})["dropped_pct"] == "0.0"


def test_batch_compilers_and_tables(spark, tmp_path):
    raw = "qid string, primaryLabel string, aliases array<string>, familyName string, p27 array<string>, p2348 array<string>, p31 array<string>, birthYear int, deathYear int, inceptionYear int, publicationYear int, dissolvedYear int, crosswalk struct<viaf:string>"
    rows = [("Q1", "李白", ["青蓮居士"], "", ["Q9683"], [], ["Q5"], 701, 762, None, None, None, ("9",)), ("Q2", "朱元璋", [], "", ["Q9903"], [], ["Q5"], 1328, 1398, None, None, None, None), ("Q3", "王安石", [], "", ["Q1107"], [], ["Q5"], 1021, 1086, None, None, None, None)]
    df = spark.createDataFrame(rows, raw)
    made = api.compile_graph_all(df, "zh-hant", str(tmp_path), ["tang", "ming"])
    assert {k: m["entityCount"] for k, m in made.items()} == {"tang": 1, "ming": 1, "pre-ming": 2}
    assert spark.read.json(str(tmp_path / "person-zh-hant-tang")).first().metadata.startYear == 701
    by_kind = api.compile_graph_language({"person": df, "place": df}, "zh-hant", str(tmp_path))
    assert {k: (m["entityCount"], m["membership"]) for k, m in by_kind.items()} == {"person": (3, "label-only"), "place": (3, "label-only")}
    places = spark.createDataFrame([("7", "保德縣", ["保德縣", "保德"], ("縣", 1374, None, "county", (38.0, 112.0)))], "authorityId string, primaryName string, searchStrings array<string>, metadata struct<subtype:string,startYear:int,endYear:int,layer:string,geo:struct<lat:double,lon:double>>")
    api.places_tsv(places, str(tmp_path / "tsv"))
    assert [r.value for r in spark.read.text(str(tmp_path / "tsv")).collect()] == ["sys_id\tname_ft\ttype_ch\tbeg_yr\tend_yr\tlat\tlon\tlayer\tsearch_strings", "7\t保德縣\t縣\t1374\t\t38.0\t112.0\tcounty\t保德縣|保德"]
    others = spark.createDataFrame([(k, "保德", ["保德"], ((38.0, 112.0),)) for k in "ab"], "authorityId string, primaryName string, searchStrings array<string>, metadata struct<geo:struct<lat:double,lon:double>>")
    assert api.crosswalk_places(places, others, str(tmp_path / "x"))["ambiguous"] == 1
    assert [r.value for r in spark.read.text(str(tmp_path / "x/ambiguous")).collect()] == ["chgis_sys_id\tdila_pl_id\treason\tname", "7\ta\tmultiple_dila_candidates\t保德", "7\tb\tmultiple_dila_candidates\t保德"]
    people = spark.createDataFrame([("1", "夏目漱石", "ナツメ, ソウセキ", None, 1867, 1916)], "authorityId string, name string, yomi string, yomiAlt array<string>, birthYear int, deathYear int")
    api.export_ime(people, "authorityId", "name", str(tmp_path / "ime"))
    assert [r.value for r in spark.read.text(str(tmp_path / "ime")).collect()][:2] == ["authorityId,surface,kana,yomiHiragana,birthYear,deathYear", "1,夏目漱石,ナツメ ソウセキ,なつめ そうせき,1867,1916"]
