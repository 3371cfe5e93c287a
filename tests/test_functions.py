"""Functions, sources and compilers on small golden cases."""

import json
import random
import re
import sqlite3
import struct
import unicodedata

import pytest
from pyspark.sql import functions as F

from onoma.functions import clues, kana, names, text, years
from onoma.operators import compilers as C
from onoma.operators import config
from onoma.operators import relational as R
from onoma.sinks import packs
from onoma.sources import binary, files, tei
from onoma.streaming import resumable


def one(spark, c, **cols):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()]) if cols else spark.range(1)
    return row.select(c.alias("x")).first()[0]


def test_text(spark):
    got = one(spark, text.normalize_surface(F.col("s")), s="　é  ﻿ b　")
    assert got == "é b"
    assert one(spark, text.normalize_surface(F.lit(None).cast("string"))) == ""
    assert one(spark, text.split_alt_names(F.lit("甲; 乙；丙;;"))) == ["甲", "乙", "丙"]
    assert one(spark, text.search_strings(F.array(F.lit("ab"), F.lit("王 "), F.lit("王安"), F.lit("王安"), F.lit("abc")))) == ["王安", "abc"]
    assert one(spark, text.stem(F.lit("新興郡"), F.lit("郡"))) == "新興" and one(spark, text.stem(F.lit("保縣"), F.lit("縣"))) is None
    assert one(spark, text.first_clause(F.lit("甲" * 70 + "。乙"))) == "甲" * 57 + "…"


def test_typed_names(spark):
    alts = F.array(*[F.struct(F.lit(t).alias("type"), F.lit(v).alias("value")) for t, v in [(4, "介甫"), (5, "半山老人"), (6, "文"), (8, "王荊公"), (10, "獾郎")]])
    got = one(spark, names.typed_entries(F.lit("王安石"), F.lit("王"), F.lit("安石"), alts))
    assert [(e.text, e.type) for e in got] == [("王安石", "primary"), ("王介甫", "courtesy"), ("半山老人", "art"), ("王荊公", "variant")]
    assert one(spark, names.person_strings(F.lit("李白"), F.array(F.lit("太白"), F.lit("李太白"), F.lit("李十二"), F.lit("Li Bai")))) == ["李白", "李太白"]


def test_decomposed_names_are_composed(spark):
    nfd = lambda x: F.lit(unicodedata.normalize("NFD", x))
    assert one(spark, text.search_strings(F.array(nfd("ガギ"), F.lit("ガギ"), nfd("Nguyễn"), nfd("한국"), F.lit(None).cast("string")))) == ["ガギ", "Nguyễn", "한국"]
    assert one(spark, text.search_strings(F.array(nfd("ぱ"), nfd("éé")))) == []  # one and two characters when composed
    assert one(spark, text.split_alt_names(nfd("ガ;ギ；;"))) == ["ガ", "ギ"] and one(spark, text.names_from_pipe(nfd("ガ|é"))) == ["ガ", "é"]
    assert one(spark, names.person_strings(nfd("ガギ"), F.array(nfd("グゲ"), nfd("ガギグ"), F.lit("ガギグ")))) == ["ガギ", "ガギグ"]
    assert one(spark, names.kind_strings(nfd("ガギ"), F.array(F.lit("ガギ")))) == ["ガギ"]
    alts = F.array(*[F.struct(F.lit(t).alias("type"), v.alias("value")) for t, v in ((5, nfd("グゲ")), (5, nfd("ガギグ")), (8, F.lit("ガギグ")))])
    assert [(e.text, e.type) for e in one(spark, names.typed_entries(nfd("ガギ"), F.lit(None).cast("string"), F.lit(""), alts))] == [("ガギ", "primary"), ("ガギグ", "art")]
    places = spark.createDataFrame([(1, unicodedata.normalize("NFD", "ガギ"), unicodedata.normalize("NFD", "パリ;ガギ"), None, None, None)], "c_addr_id int, c_name_chn string, c_alt_names string, c_firstyear int, c_lastyear int, c_admin_type string")
    assert C.snapshot_places(places).first().searchStrings == ["ガギ", "パリ"]


def test_kana(spark):
    assert one(spark, kana.to_hiragana(F.lit("ヴァナヽ"))) == "ゔぁなゝ"
    assert one(spark, kana.readings(F.lit("ナツメ, ソウセキ, 1867-1916"), F.lit(None).cast("array<string>"))) == ["ナツメ ソウセキ", "ナツメソウセキ", "ナツメ", "ソウセキ"]
    assert one(spark, kana.is_kana_dominant(F.lit("なつめ漱"))) is False and one(spark, kana.is_kana_dominant(F.lit("なつめそう石"))) is True


def test_clues(spark):
    n = F.lit(None)
    none, s = n.cast("int"), n.cast("string")
    dates = clues.life_dates(F.lit(1021), F.lit(1086), none, none, none)
    assert one(spark, clues.person(F.lit("王安石"), F.lit("Wang Anshi"), dates, clues.dynasty(F.lit("宋"), F.lit("Song")), s)) == "王安石 (Wang Anshi, 1021–1086, 宋 Song)"
    assert one(spark, clues.person(F.lit("n"), s, clues.life_dates(none, none, none, none, F.lit(1050)), s, s)) == "n (fl. 1050)"
    assert one(spark, clues.listed_place(F.lit("n"), F.lit("寺"), F.lit("南京"))) == "n (寺 — 南京)"
    assert one(spark, clues.mapped_place(F.lit("n"), s, F.lit(1374), none, s, F.lit("p"))) == "n (from 1374)" and one(spark, clues.mapped_place(F.lit("n"), s, none, none, s, F.lit("p"))) == "n (p)"
    assert [one(spark, clues.office(F.lit("n"), a, b)) for a, b in ((F.lit("T"), F.lit("D")), (F.lit("T"), s), (s, F.lit("D")), (s, s))] == ["n (T, D)", "n (T, )", "n, D)", "n"]
    assert one(spark, clues.graph_person(F.lit("虬髯客"), F.lit("唐"), F.lit(True), F.lit("Q9999001"))) == "虬髯客 (唐, fictional, Wikidata Q9999001)"


def test_years(spark):
    assert one(spark, years.claim_year(F.lit("-0221-01-01T00:00:00Z"))) == -221 and one(spark, years.year_of_date(F.lit("約0383年"))) == 383
    assert one(spark, years.before(1367, F.lit(1300), F.lit(None).cast("int"))) is True and one(spark, years.before(1367, F.lit(1300), F.lit(1400))) is False


def _snak(kind, value):
    return {"mainsnak": {"snaktype": "value", "datavalue": {"type": kind, "value": value}}}


def _entity(q, label, aliases=(), p31="Q5", p27="Q9683", **claims):
    ids = lambda *qs: [_snak("wikibase-entityid", {"id": x}) for x in qs]
    return {
        "type": "item", "id": q, "labels": {"zh-hant": {"language": "zh-hant", "value": label}}, "aliases": {"zh-hant": [{"language": "zh-hant", "value": a} for a in aliases]},
        "claims": {"P31": ids(*p31.split()), "P27": ids(*p27.split()), **claims},
    }


def test_graph_dump(spark, tmp_path):
    rows = [
        _entity("Q1", "李白", ["李太白", "太白"], P569=[_snak("time", {"time": "+0701-00-00T00:00:00Z"})], P214=[_snak("string", "VIAF 123")], P497=[_snak("string", "0032540")]),
        _entity("Q2", "李某"), _entity("Q3", "虬髯客", p31="Q5 Q15632617"), _entity("Q4", "消歧義", p31="Q5 Q4167410"), _entity("Q5000", "大清人", p27="Q8733"), _entity("Q6", "長安", p31="Q515", p27=""),
    ]
    (tmp_path / "dump.json").write_text("[\n" + ",\n".join(json.dumps(r, ensure_ascii=False) for r in rows) + ",\n{broken,\n]\n")
    entities = files.dump(spark, str(tmp_path / "dump.json"))
    raw = C.raw_entities(entities, "zh-hant")
    assert raw.count() == 6
    persons = C.of_kind(raw, "person")
    tang = C.in_dynasty(persons, ["Q9683"])
    got = {r.authorityId: r for r in C.graph_persons(tang, F.lit("唐"), F.lit(618), F.lit(907)).collect()}
    assert set(got) == {"Q1", "Q3"} and got["Q1"].searchStrings == ["李白", "李太白"] and got["Q1"].metadata.startYear == 701 and got["Q3"].metadata.ana == "fictional"
    row = raw.where("qid = 'Q1'").first()
    assert row.crosswalk.viaf == "123" and row.crosswalk.cbdb == "32540"
    early = {r.qid: r.period.label for r in C.pre_ming(persons).collect()}
    assert early == {"Q1": "唐", "Q2": "唐", "Q3": "唐"}
    assert {(r.lang, r.kind, r.qid) for r in C.one_scan(entities, ["zh-hant", "ja"], ["person", "place"]).collect() if r.kind == "place"} == {("zh-hant", "place", "Q6")}
    assert C.graph_kind(C.of_kind(raw, "place"), "place", "zh-hant").first().metadata.description == "長安 (Wikidata Q6)"
    assert C.filter_stats(tang).first().dropped >= 2


def test_tei(spark, tmp_path):
    (tmp_path / "p.xml").write_text('<listPerson><person xml:id="A1" ana="monk"><persName xml:lang="zho-Hant">畺良耶舍</persName><persName xml:lang="eng">K</persName><birth>0383<note>x 999</note></birth><death>0442</death><note type="dynasty">劉宋</note><occupation>譯經</occupation><idno type="CBDB">00123</idno><idno type="Wikidata">Q9</idno></person><person xml:id="A2"><persName xml:lang="eng">no</persName></person></listPerson>')
    (tmp_path / "q.xml").write_text('<listPlace><place xml:id="P1"><placeName xml:lang="zho-Hant">棲霞寺</placeName><note type="category">寺</note><note>建於(265 ~ 316)。後</note><location><place key="D1">x</place><geo>32.1 118.9</geo></place><place xml:id="D1"><placeName xml:lang="zho">南京</placeName></place></listPlace>')
    labels = config.static_labels(spark)
    p = C.listed_persons(tei.persons(spark, str(tmp_path / "p.xml")), labels).collect()
    assert len(p) == 1 and p[0].metadata.description == "畺良耶舍 (383–442, 劉宋, 譯經)" and p[0].metadata.crosswalk.cbdb == "123" and p[0].metadata.crosswalk.wikidata == ["Q9"]
    places = tei.places(spark, str(tmp_path / "q.xml"))
    assert places.count() == 2
    xw = spark.createDataFrame([("P1", "c7")], "dila string, chgis string")
    q = {r.authorityId: r for r in C.listed_places(places, tei.districts(spark, str(tmp_path / "q.xml")), xw).collect()}
    assert (q["P1"].metadata.startYear, q["P1"].metadata.endYear, q["P1"].metadata.crosswalk.chgis) == (265, 316, "c7") and q["P1"].metadata.geo is None


def test_snapshot(spark, tmp_path):
    db = sqlite3.connect(tmp_path / "s.db")
    db.executescript("""
        CREATE TABLE BIOG_MAIN(c_personid INT, c_name_chn TEXT, c_name TEXT, c_surname_chn TEXT, c_mingzi_chn TEXT, c_birthyear INT, c_deathyear INT, c_index_year INT, c_fl_earliest_year INT, c_fl_latest_year INT, c_dy INT);
        CREATE TABLE DYNASTIES(c_dy INT, c_dynasty TEXT, c_dynasty_chn TEXT, c_start INT, c_end INT);
        CREATE TABLE ALTNAME_DATA(c_personid INT, c_alt_name_chn TEXT, c_alt_name_type_code INT);
        INSERT INTO BIOG_MAIN VALUES (1762, '王安石', 'Wang Anshi', '王', '安石', 1021, 1086, 1080, NULL, NULL, 15), (2, ' ', 'x', '', '', NULL, NULL, NULL, NULL, NULL, 15), (3, '趙三郎', NULL, '趙', '', NULL, NULL, NULL, NULL, NULL, 15);
        INSERT INTO DYNASTIES VALUES (15, 'Song', '宋', 960, 1279);
        INSERT INTO ALTNAME_DATA VALUES (1762, '介甫', 4), (1762, '半山老人', 5), (1762, '文', 6), (1762, '王荊公', 8), (1762, '獾郎', 10);
    """)  # fmt: skip
    db.commit()
    db.close()
    binary.register(spark)
    t = lambda n: spark.read.format("sqlite").option("path", str(tmp_path / "s.db")).option("dbtable", n).option("numPartitions", 2).load()
    got = {r.authorityId: r for r in C.snapshot_persons(t("BIOG_MAIN"), t("ALTNAME_DATA"), t("DYNASTIES")).collect()}
    assert set(got) == {"1762", "3"} and got["1762"].searchStrings == ["王安石", "王介甫", "半山老人", "王荊公"]
    assert got["1762"].metadata.description == "王安石 (Wang Anshi, 1021–1086, 宋 Song)" and got["3"].metadata.startYear == 960


def test_shapefile(spark, tmp_path):
    def rec(n, kind, x, y):
        body = struct.pack("<i2d", kind, x, y)
        return struct.pack(">ii", n, len(body) // 2) + body

    (tmp_path / "county.shp").write_bytes(b"\0" * 100 + rec(1, 1, 112.0, 38.0) + rec(2, 1, 113.0, 39.0))
    cols = [("NAME_FT", 20), ("TYPE_CH", 6), ("SYS_ID", 8), ("BEG_YR", 6), ("OBJ_TYPE", 8)]
    head = struct.pack("<4xIHH20x", 2, 32 + 32 * len(cols) + 1, 1 + sum(w for _, w in cols))
    desc = b"".join(n.encode().ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([w]) + b"\0" * 15 for n, w in cols)
    rows = b"".join(b" " + b"".join(v.encode().ljust(w) for v, (_, w) in zip(r, cols)) for r in [("保德縣", "縣", "7", "1374", "POINT"), ("x", "縣", "8", "", "POLYGON")])
    (tmp_path / "county.dbf").write_bytes(head + desc + b"\r" + rows)
    binary.register(spark)
    df = spark.read.format("shapefile").option("path", str(tmp_path)).load()
    empty = lambda s: spark.createDataFrame([], s)
    got = C.mapped_places(df, empty("chgis string, cbdb string"), empty("chgis string, dila string")).collect()
    assert len(got) == 1 and got[0].searchStrings == ["保德縣", "保德"] and got[0].metadata.geo.lat == 38.0 and got[0].metadata.description == "保德縣 (縣, from 1374)"


def test_catalogue_kinds(spark, tmp_path):
    rows = [("1", "夏目漱石", "夏目漱石 (1867-1916)", "ナツメ, ソウセキ", None, 1867, 1916), ("2", "Smith", None, None, None, None, None)]
    raw = spark.createDataFrame(rows, "authorityId string, name string, heading string, yomi string, yomiAlt array<string>, birthYear int, deathYear int")
    assert [r.searchStrings for r in C.catalogue(raw, "person").collect()] == [["夏目漱石"]]
    place = C.catalogue(raw, "place").where("authorityId = '1'").first()
    assert place.searchStrings[:3] == ["夏目漱石", "夏目漱石 (1867-1916)", "ナツメ ソウセキ"] and place.metadata.description == "夏目漱石 (NDL 1)"
    assert C.ime_rows(raw, "authorityId", "name").count() == 4
    (tmp_path / "w.tsv").write_text("1\t源氏物語\t源語; 紫文\t紫式部\n\nx\n2\t枕草子\n")
    works = files.works(spark, str(tmp_path / "w.tsv"))
    got = {r.authorityId: r for r in C.catalogue(works, "work").collect()}
    assert got["1"].metadata.description == "源氏物語 (紫式部, NDL 1)" and got["1"].searchStrings == ["源氏物語", "源語", "紫文"] and set(got) == {"1", "2"}


def test_crosswalk_and_closure(spark):
    a = spark.createDataFrame([(1, "c1", ["甲", "乙"], 30.0, 110.0), (2, "c2", ["丙"], 30.0, 110.0), (3, "c3", ["丁"], None, None), (4, "c4", ["戊"], 33.5, 110.0)], "row long, id string, names array<string>, lat double, lon double")
    b = spark.createDataFrame([("d1", ["乙", "甲"], 30.5, 110.0), ("d2", ["丙"], 30.0, 110.2), ("d3", ["丙"], None, None), ("d4", ["丁"], 1.0, 1.0), ("d5", ["戊"], 32.0, 110.0)], "id string, names array<string>, lat double, lon double")
    one_, many, stats = R.crosswalk_split(a, R.crosswalk(a, b))
    assert {(r.left_id, r.right_id, r.method, r.name) for r in one_.collect()} == {("c1", "d1", "name+geo", "乙"), ("c3", "d4", "name-only", "丁")}
    assert {(r.left_id, r.right_id) for r in many.collect()} == {("c2", "d2"), ("c2", "d3")} and tuple(stats.first()) == (2, 1, 1, 4)
    edges = spark.createDataFrame([("b", "a"), ("c", "b"), ("a", "c"), ("d", "x")], "child string, parent string")
    roots = spark.createDataFrame([("r", "a")], "root string, node string")
    assert {r.node for r in R.closure(edges, roots).collect()} == {"a", "b", "c"}


def test_sinks_and_streams(spark, tmp_path):
    df = spark.createDataFrame([("CBDB", "1", "person", "王安石", ["王安石", "王介甫"])], "source string, authorityId string, kind string, primaryName string, searchStrings array<string>")
    m = packs.write_pack(df, str(tmp_path / "pack"), "CBDB")
    assert (m["entityCount"], m["stringCount"]) == (1, 2)
    assert packs.bundle_index(spark, str(tmp_path / "pack"), {"b": "part-"}).count() == 1
    packs.write_tsv(spark.createDataFrame([("a\tb", 'c"d')], "x string, y string"), str(tmp_path / "t"))
    assert files.tsv(spark, str(tmp_path / "t")).collect()[0].x == "a b"
    src = tmp_path / "in"
    src.mkdir()
    (src / "1.txt").write_text("a\nb\n")
    run = lambda **s: resumable.extract(spark, str(src), lambda d: d, str(tmp_path / "out"), str(tmp_path / "cp"), s)["rows_in"]
    assert run(k=1) == 2 and run(k=1) == 0
    (src / "2.txt").write_text("c\n")
    assert run(k=1) == 1 and spark.read.parquet(str(tmp_path / "out")).count() == 3
    with pytest.raises(ValueError):
        run(k=2)


def test_harvest_keeps_keys_whole_and_goes_on_from_the_sink(spark, tmp_path):
    rows = [(None, 0), (1, 1), (2, 2), (2, 3), (2, 4), (3, 5), (3, 6), (4, 7)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(3)
    sink = str(tmp_path / "sink")
    run = lambda x: resumable.harvest(lambda after, n: R.keyset_page(x, "k", after, n), "k", sink, 2)
    held = lambda: sorted(r.v for r in spark.read.parquet(sink).collect())
    assert run(df) == 3 and held() == list(range(8))
    assert run(df) == 0 and held() == list(range(8))
    assert run(df.unionByName(spark.createDataFrame([(5, 8)], "k int, v int"))) == 1 and held() == list(range(9))


def test_clauses_years_and_headings(spark):
    assert one(spark, text.first_clause(F.lit(" 譯經僧。次句"))) == "譯經僧" and one(spark, text.first_clause(F.lit("a" * 50))) == "a" * 40
    assert one(spark, text.first_clause(F.lit("甲" * 70 + "。"))) == "甲" * 57 + "…" and one(spark, text.first_clause(F.lit(None).cast("string"))) is None
    span = years.year_range(F.col("s"))
    assert tuple(one(spark, span, s="某地\n（+265 ~ 316）郡")) == (265, 316) and tuple(one(spark, span, s="x (1—2)")) == (None, None) and tuple(one(spark, span, s="釋道安尼 (312-385)")) == (None, None)
    assert [one(spark, years.claim_year(F.lit(t))) for t in ("+1867-01-01T", "-0221-01-01T", "1867-01-01")] == [1867, -221, None]
    none = F.array().cast("array<string>")
    assert one(spark, names.heading_strings(F.lit("東大寺 (奈良市)"), F.lit("東大寺 (奈良市, 1234)"), none, none, names.is_usable_native_name)) == ["東大寺 (奈良市)", "東大寺 (奈良市, 1234)", "東大寺"]
    assert one(spark, names.heading_strings(F.lit("NHK"), F.lit("日本放送協会"), none, none, names.is_usable_native_name)) == []


def test_kana_of_an_entity(spark):
    value = lambda *vs: [{"mainsnak": {"snaktype": "value", "datavalue": {"type": "string", "value": v}}} for v in vs]
    time = [{"mainsnak": {"snaktype": "somevalue"}}, {"mainsnak": {"snaktype": "value", "datavalue": {"type": "time", "value": {"time": "+1867-02-09T00:00:00Z"}}}}]
    e = {"type": "item", "id": "Q1", "labels": {k: {"language": k, "value": v} for k, v in {"ja": "ナツメ", "ja-Hira": "なつめ　そうせき", "ja-Kana": "ナツメ ソウセキ"}.items()}, "aliases": {"ja": [{"language": "ja", "value": v} for v in ("ソーセキ", "漱石", "ｿｳｾｷ")]}, "claims": {"P1814": value("Natsume", "なつめ きんのすけ"), "P569": time}}
    got = C.raw_entities(files.dump_entities(spark.createDataFrame([(json.dumps(e),)], "value string")), "ja").first()
    assert got.nameInKana == ["なつめ きんのすけ", "なつめ そうせき", "そーせき", "なつめ"] and got.yomiHiragana == "なつめ きんのすけ" and got.birthYear is None
    assert one(spark, kana.is_kana_dominant(F.lit("な つ め 石"))) is False and one(spark, kana.is_kana_dominant(F.lit("な つ め そ 石"))) is True
    rows = C.graph_ime_rows(spark.createDataFrame([got], C.raw_entities(files.dump_entities(spark.createDataFrame([(json.dumps(e),)], "value string")), "ja").schema)).collect()
    assert [r.kana for r in rows] == got.nameInKana
    raw = spark.createDataFrame([("1", "x", "なつめ ナツメ ソウセキ", None, 1, 2)], "id string, name string, yomi string, yomiAlt array<string>, birthYear int, deathYear int")
    assert all(r.yomiHiragana == r.kana.translate({ord(a): b for a, b in zip(kana.KATAKANA, kana.HIRAGANA)}) for r in C.ime_rows(raw, "id", "name").collect())


def test_packs_of_one_scan(spark):
    snak = lambda q: {"mainsnak": {"snaktype": "value", "datavalue": {"type": "wikibase-entityid", "value": {"id": q}}}}
    rows = [("Q1", ["Q5"], ["Q9683"]), ("Q2", ["Q5", "Q4167410"], ["Q9683"]), ("Q3", ["Q515"], []), ("Q4", ["Q5"], ["Q17"]), ("Q5", ["Q5"], [])]
    lines = [(json.dumps({"type": "item", "id": i, "labels": {"ja": {"language": "ja", "value": f"名{i}"}}, "aliases": {}, "claims": {"P31": [snak(q) for q in p31], "P27": [snak(q) for q in p27]}}),) for i, p31, p27 in rows]
    entities = files.dump_entities(spark.createDataFrame(lines, "value string"))
    ids = lambda **kw: {(r.kind, r.qid) for r in C.raw_packs(entities, ["ja", "ko"], ["person", "place"], **kw).collect()}
    place = {("place", "Q3")}
    assert ids() == place | {("person", q) for q in ("Q1", "Q4", "Q5")} == {(r.kind, r.qid) for r in C.one_scan(entities, ["ja"], ["person", "place"]).collect()}
    assert ids(membership="country-p27", qids=["Q17"]) == place | {("person", "Q4")} and ids(membership="pre-ming") == place | {("person", "Q1")}
    with pytest.raises(ValueError):
        C.is_member("by-heart")
    made = C.graph_kind(C.raw_packs(entities, ["ja"], ["place"]), "place", "ja").first()
    assert made.metadata.crosswalk.wikidata == ["3"] and made.metadata.crosswalk.viaf is None
    assert C.raw_packs(entities, ["ja", "ko"], ["person", "place"])._jdf.queryExecution().executedPlan().toString().count("ExistingRDD") == 1


def test_dirty_cells():
    assert [binary.cell(v, "bigint") for v in (1, "x", "7", None, 2.5, "")] == [1, None, 7, None, 2, None]
    assert binary.cell(b"\xff", "string") == "�" and binary.cell(3, "string") == "3" and binary.cell("1e3", "double") == 1000.0


def test_composition_leaves_safe_ranges_alone():
    """No character of SAFE is changed by composition, has a combining class, or joins the one before it."""
    ranges = [tuple(int(x, 16) for x in re.findall(r"\\u([0-9A-F]{4})", part)) for part in re.findall(r"\\u[0-9A-F]{4}-\\u[0-9A-F]{4}", text.SAFE)]
    assert len(ranges) == 9 and ranges[0] == (0, 0x2FF)
    second = {int(d.split()[1], 16) for c in range(0x10000) if (d := unicodedata.decomposition(chr(c))) and not d.startswith("<") and " " in d} | set(range(0x1161, 0x1176)) | set(range(0x11A8, 0x11C3))
    for lo, hi in ranges:
        for c in range(lo, hi + 1):
            assert unicodedata.normalize("NFC", chr(c)) == chr(c) and not unicodedata.combining(chr(c)) and c not in second, hex(c)


def test_courtesy_names_and_validity(spark):
    rows = spark.createDataFrame([("子美", "美"), ("子", "子"), ("子不語集", "子不語集"), ("美子", "美子")], "a string, b string")
    assert rows.where(text.courtesy_body(F.col("a")) != F.col("b")).count() == 0
    words = spark.createDataFrame([(w,) for w in ("", "a", "ab", "abc", "李", "李白", "é1", "-'", None)], "w string")
    assert [r[0] for r in words.select(text.is_valid(F.col("w"))).collect()] == [False, False, False, True, False, True, False, False, None]
    assert [r[0] for r in words.select(text.is_valid(F.col("w"), "latn")).collect()] == [False, False, False, True, False, False, False, False, None]


def test_white_space(spark):
    """Against Python's regular expressions over the same class."""
    ws, rng = f"[{text.BLANKS}]", random.Random(4)
    assert len(set(text.BLANKS)) == 25 and all(re.fullmatch(ws, c) for c in text.BLANKS)
    texts = ["", " ", text.BLANKS, "a\u0085 \u0085", "\u0085", " \u0085 a"] + ["".join(rng.choice("ab" + text.BLANKS + "\u0085é李") for _ in range(rng.randint(0, 12))) for _ in range(500)]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    got = df.select("k", text.collapse(F.col("t")).alias("c"), text.strip(F.col("t")).alias("s")).orderBy("k").collect()
    assert [r.c for r in got] == [re.sub(f"{ws}+", " ", t).strip(" ") for t in texts]
    assert [r.s for r in got] == [t.strip(text.BLANKS) for t in texts]
