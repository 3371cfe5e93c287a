"""SQLite scans, sink and harvests; SPARQL endpoints; the splittable reader of TEI lists."""

import csv
import gzip
import http.server
import io
import json
import re
import sqlite3
import threading
import urllib.parse
from contextlib import closing

import pytest
from pyspark.sql import functions as F

from onoma.operators import compilers as C
from onoma.operators import patterns
from onoma.plans import api
from onoma.sources import binary, files, sparql, sqlite, tei
from onoma.streaming import resumable


def run(path, sql):
    with closing(sqlite3.connect(path)) as db:
        db.executescript(sql)
        db.commit()


def ask(path, sql):
    with closing(sqlite3.connect(path)) as db:
        return db.execute(sql).fetchall()


# --- SQLite: scans


@pytest.fixture
def dirty(spark, tmp_path):
    """Cells of other classes than their columns'."""
    path = str(tmp_path / "d.db")
    values = ["NULL", "'x'", "''", "'7'", "7", "7.5", "-3", "9007199254740993", "'é%_'", "x'ff41'", "1e300"]
    run(path, "CREATE TABLE t(k INTEGER, i INT, r REAL, s TEXT COLLATE NOCASE, n, \"odd \"\"name\" TEXT);" + "".join(f"INSERT INTO t VALUES ({k}, {a}, {values[(k * 7) % 11]}, {values[(k * 5 + 1) % 11]}, {values[(k * 3) % 11]}, 'a''b');" for k, a in enumerate(values * 5)))
    sqlite.register(spark)
    return path


TESTS = [
    "i = 7", "i <= 7", "i < 7", "i > 6", "i >= 8", "not i = 7", "i in (7, -3, 100)", "i not in (7)", "i is null", "i is not null", "r = 7.5", "r < 1e10", "r >= 7", "r is null", "s = 'x'", "s = 'X'",
    "s in ('x', '7')", "not s in ('x', '7')", "s > '5'", "s <= '7'", "s <> 'x'", "s like 'x%'", "s like '%x'", "s like '%.%'", "s = ''", "s is not null", "n = '7'", "n > '6'", "i <=> 7", "i = 7 and s is not null",
    "i = 7 or s = 'x'", "k > 20 and r < 100", "_ord < 9", "_ord in (3, 5)", "`odd \"name` = 'a''b'", "i > 9007199254740992", "r > double('nan')", "length(s) = 1",
]


def test_pushed_filters_change_no_result(spark, dirty):
    whole = sqlite.table(spark, dirty, "t").collect()
    kept = spark.createDataFrame(whole, sqlite.table(spark, dirty, "t").schema)
    for where in TESTS:
        got = sqlite.table(spark, dirty, "t").where(where).collect()
        assert sorted(got, key=repr) == sorted(kept.where(where).collect(), key=repr), where


def test_the_plan_shows_filters_and_columns(spark, dirty):
    df = sqlite.table(spark, dirty, "t", "k", "s").where("k > 3 and length(s) = 1 and s like 'x%'")
    assert df.columns == ["k", "s", "_ord"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.split("\n") if "BatchScan" in x)
    assert "k" in scan and "GreaterThan" in plan or "k > 3" in plan or "k#" in scan
    assert not re.search(r"Filter .*k#\d+L? > 3", plan), plan  # done by the source
    fields = [("k", "bigint"), ("s", "string")]
    assert sqlite.pushed(sqlite.ds.GreaterThan(("k",), 3), fields).sql.endswith('"k" > ? COLLATE BINARY))')
    assert sqlite.pushed(sqlite.ds.EqualTo(("k",), "3"), fields) is None and sqlite.pushed(sqlite.ds.EqualTo(("a", "b"), 3), fields) is None


def test_ranges_views_and_tables_without_rowids(spark, tmp_path):
    path = str(tmp_path / "r.db")
    run(path, "CREATE TABLE t(a INT); INSERT INTO t VALUES (3), (1), (2); CREATE VIEW v AS SELECT a FROM t WHERE a > 1; CREATE TABLE w(a TEXT PRIMARY KEY) WITHOUT ROWID; INSERT INTO w VALUES ('q'), ('p'); CREATE TABLE e(a INT)")
    run(path, "INSERT INTO t SELECT value + 10 FROM (WITH RECURSIVE c(value) AS (SELECT 1 UNION ALL SELECT value + 1 FROM c WHERE value < 500) SELECT value FROM c)")
    sqlite.register(spark)
    read = lambda n, **o: spark.read.format("sqlite").options(path=path, dbtable=n, **o).load()
    assert [r.a for r in sorted(read("t").limit(3).collect(), key=lambda r: r._ord)] == [3, 1, 2]
    assert read("t", numPartitions=4).rdd.getNumPartitions() == 4 and read("t", numPartitions=4).where("_ord > 490").count() == 13
    assert read("t", rows=100).rdd.getNumPartitions() == 6 and read("t", rows=100).count() == 503
    assert sorted((r.a, r._ord) for r in read("w").collect()) == [("p", 1), ("q", 2)] and read("w").where("_ord = 2").first().a == "q"
    assert read("v").count() == 502 and read("e").count() == 0
    with pytest.raises(Exception, match="no table"):
        read("missing")


# --- SQLite: sink


def test_sink_and_scan_round_trip(spark, tmp_path):
    path = f"file://{tmp_path}/w.db"
    df = spark.sql("SELECT id AS k, cast(id AS string) || 'é''\"' AS s, id / 4D AS r, id % 2 = 0 AS b, cast(NULL AS string) AS n, date'2020-01-02' AS d, 1.50BD AS m, cast('ab' AS binary) AS x FROM range(1000)").repartition(5)
    sqlite.register(spark)
    sqlite.write(df, path, "t", "k")
    back = sqlite.table(spark, path, "t").drop("_ord")
    assert sorted(map(tuple, back.collect())) == sorted((r.k, r.s, r.r, int(r.b), None, "2020-01-02", "1.50", "ab") for r in df.collect())
    sqlite.write(df.withColumn("s", F.lit("new")).union(df.limit(5).withColumn("k", F.col("k") + 5000)), path, "t", "k")  # rows of known keys stay
    assert ask(tmp_path / "w.db", "SELECT count(*), count(DISTINCT k), sum(s = 'new') FROM t") == [(1005, 1005, 0)]
    sqlite.write(df.limit(3), path, "t", mode="overwrite")
    assert sqlite.table(spark, path, "t").count() == 3 and [p.name for p in tmp_path.iterdir()] == ["w.db"]
    with pytest.raises(Exception, match="JSON"):
        sqlite.write(spark.sql("SELECT array(1) AS a"), path, "t")


def test_a_failed_task_leaves_no_rows(spark, tmp_path):
    sqlite.register(spark)
    path = str(tmp_path / "f.db")
    sqlite.write(spark.range(10), path, "t", "id")
    bad = spark.range(10, 100, 1, 4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        sqlite.write(bad, path, "t", "id")
    assert ask(path, "SELECT count(*) FROM t") == [(10,)] and [p.name for p in tmp_path.iterdir()] == ["f.db"]
    with pytest.raises(Exception, match="no column|has no"):  # within the commit
        sqlite.write(spark.range(10, 20).selectExpr("id", "id AS other"), path, "t", "id")
    assert ask(path, "SELECT count(*) FROM t") == [(10,)] and [p.name for p in tmp_path.iterdir()] == ["f.db"]


def test_sample_of_a_snapshot(spark, tmp_path):
    full, small = str(tmp_path / "full.db"), str(tmp_path / "small.db")
    run(full, "CREATE TABLE BIOG_MAIN(c_personid INT, c_name_chn TEXT); CREATE TABLE DYNASTIES(c_dy INT, c_dynasty TEXT); CREATE TABLE ALTNAME_DATA(c_personid INT, c_alt_name_chn TEXT);")
    run(full, "INSERT INTO DYNASTIES VALUES (1, 'a'), (2, 'b');" + "".join(f"INSERT INTO BIOG_MAIN VALUES ({k}, 'p{k}'); INSERT INTO ALTNAME_DATA VALUES ({k}, '{'甲' if k % 3 else '甲乙'}'), ({k}, '丙丁');" for k in range(1, 31)))
    assert api.snapshot_sample(spark, full, small, [3, 6], 5) == {"DYNASTIES": 2, "BIOG_MAIN": 7, "ALTNAME_DATA": 14}
    assert [r[0] for r in ask(small, "SELECT c_personid FROM BIOG_MAIN ORDER BY 1")] == [1, 2, 3, 4, 5, 6, 7]


def test_crosswalk_of_points_reaches_the_pack(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "s.db")
    run(path, "CREATE TABLE ADDR_CODES(c_addr_id INT, c_name_chn TEXT, CHGIS_PT_ID); INSERT INTO ADDR_CODES VALUES (5, 'x', ' 7 '), (6, 'y', 7), (8, 'z', ''), (9, 'w', NULL)")
    rows = spark.createDataFrame([("l", 1, 38.0, 112.0, {"NAME_FT": "保德縣", "TYPE_CH": "縣", "SYS_ID": "7", "OBJ_TYPE": "POINT"})], "layer string, shape int, lat double, lon double, attributes map<string,string>")
    monkeypatch.setattr(api, "point_rows", lambda *_: (rows, ["l", "none"]))
    made = api.compile_points(spark, "unused", str(tmp_path / "out"), snapshot=path)
    assert made["layerCounts"] == {"l": 1, "none": 0} and made["crosswalkCbdbCount"] == 1
    assert spark.read.json(str(tmp_path / "out/places")).first().metadata.crosswalk.cbdb == "6"


# --- harvests


def persons(n):
    """Authorities with up to nine bindings each."""
    out = []
    for k in range(n):
        uri = f"http://a.invalid/auth/{k:05d}"
        for j in range(1 + k * 7 % 9):
            out.append({"auth": uri, "name": f"名{chr(0x4E00 + k)}", "yomi": f"ヨミ{j}", **({"yomiAlt": f"ベツ{j % 2}"} if j else {}), **({"birth": f"{1500 + k}-01"} if k % 2 else {}), "heading": 'with "quotes", and\nlines'})
    return out


class Server:
    """A local endpoint over rows sorted by ?auth; it may fail at some requests, or give rows as CSV."""

    def __init__(self, rows, most=10**9, fail=(), log=None):
        self.rows, self.requests, outer = rows, [], self

        class Handler(http.server.BaseHTTPRequestHandler):
            def reply(self, sent):
                q = {k: v[0] for k, v in urllib.parse.parse_qs(sent).items()}
                outer.requests.append((self.command, q["query"]))
                text, n = q["query"], len(outer.requests)
                if n in fail:
                    body, kind = b'{"status": "error", "message": "busy"}', "application/json"
                else:
                    lo, hi = (re.search(rf"\?auth {op} <([^>]*)>", text) for op in (">", "<="))
                    ok = [r for r in outer.rows if (not lo or r["auth"] > lo[1]) and (not hi or r["auth"] <= hi[1])]
                    if "DISTINCT ?auth" in text:
                        ok = [{"auth": a} for a in dict.fromkeys(r["auth"] for r in ok)]
                    ok = ok[: min(most, int(re.search(r"LIMIT (\d+)", text)[1]))]
                    if q["format"] == "csv":
                        f = io.StringIO()
                        w = csv.DictWriter(f, ["auth", "name", "heading", "yomi", "yomiAlt", "birth"])
                        w.writeheader()
                        w.writerows(ok)
                        body, kind = f.getvalue().encode(), "text/csv"
                    else:
                        body, kind = sparql.result([{k: {"type": "uri" if k == "auth" else "literal", "value": v} for k, v in r.items()} for r in ok]).encode(), "application/json"
                self.send_response(200)
                self.send_header("Content-Type", kind)
                self.end_headers()
                self.wfile.write(body)

            def do_GET(self):
                self.reply(self.path.partition("?")[2])

            def do_POST(self):
                self.reply(self.rfile.read(int(self.headers["Content-Length"])).decode())

            def log_message(self, *_):
                pass

        self.server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.url = f"http://127.0.0.1:{self.server.server_port}/sparql"


QUERY = patterns.select(patterns.authorities("person"), *patterns.asked("person"), order="auth", limit="{limit}", bounds=True)


def values(rows):
    return sorted((tuple(sorted((k, x["value"]) for k, x in b.items())) for b in rows), key=repr)


@pytest.mark.parametrize("extra", [{}, {"method": "post"}, {"format": "csv"}, {"method": "post", "format": "csv"}])
def test_pages_keep_keys_whole_by_any_request(spark, extra):
    rows = persons(40)
    server = Server(rows, fail=(2, 5))
    binary.register(spark)
    df = spark.read.format("sparql").options(endpoint=server.url, query=QUERY, key="auth", limit=6, backoff=0, **extra).load()
    pages = [json.loads(r.value)["results"]["bindings"] for r in df.collect()]
    assert values(b for p in pages for b in p) == sorted((tuple(sorted(r.items())) for r in rows), key=repr)
    assert sum(len({b["auth"]["value"] for b in p}) for p in pages) == 40  # no key is on two pages
    assert {m for m, _ in server.requests} == {extra.get("method", "get").upper()}
    got = files.bindings(df).select(F.col("b")["auth"]["value"].alias("a"), F.col("b")["auth"]["type"].alias("t"))
    assert got.count() == len(rows) and got.select("t").distinct().first().t == "uri"


def test_an_endpoint_that_fails_or_cuts(spark):
    binary.register(spark)
    options = {"query": QUERY, "key": "auth", "backoff": 0}
    with pytest.raises(Exception, match="busy"):
        spark.read.format("sparql").options(endpoint=Server(persons(3), fail=range(1, 9)).url, **options).load().collect()
    rows = [{"auth": "http://a.invalid/1", "name": str(k)} for k in range(50)]
    assert len(json.loads(spark.read.format("sparql").options(endpoint=Server(rows).url, limit=4, **options).load().first().value)["results"]["bindings"]) == 50
    with pytest.raises(Exception, match="at most"):  # more bindings of one key than the endpoint ever gives
        spark.read.format("sparql").options(endpoint=Server(rows, most=4).url, limit=4, **options).load().collect()


def test_csv_results():
    assert sparql.csv_bindings('﻿a,b\r\nhttp://x/1,"q ""r"", s\nt"\r\n,\r\nv,\r\n') == [{"a": {"type": "uri", "value": "http://x/1"}, "b": {"type": "literal", "value": 'q "r", s\nt'}}, {}, {"a": {"type": "literal", "value": "v"}}]
    assert sparql.csv_bindings("") == []


@pytest.mark.parametrize("keys", [False, True])
def test_a_harvest_that_stops_goes_on(spark, tmp_path, keys):
    rows = persons(60)
    server = Server(rows, fail=(3,))
    binary.register(spark)
    more = {"keys": patterns.select(patterns.authorities("person"), "auth", order="auth", limit="{limit}", bounds=True, distinct=True)} if keys else {}
    go = lambda **o: api.harvest_catalogue(spark, "person", server.url, str(tmp_path / "raw"), str(tmp_path / "cp"), limit=7, ranges=2, delay=0, backoff=0, **more, **o)
    first = go(batches=2)
    assert first["batches"] == 2 and not first["resumed"]
    held = api.harvested(spark, str(tmp_path / "raw"))
    done = held.count()
    assert 0 < done < 60
    second = go()
    assert second["resumed"] and second["lastKey"] == rows[-1]["auth"]
    assert go()["batches"] == 0
    server.rows += [{"auth": "http://a.invalid/auth/99999", "name": "新人"}]
    assert go()["batches"] == 1
    got = {r.authorityId: r for r in api.harvested(spark, str(tmp_path / "raw")).collect()}
    assert len(got) == held.sparkSession.read.parquet(str(tmp_path / "raw")).count() == 61
    for k in range(60):
        own = [r for r in rows if r["auth"].endswith(f"{k:05d}")]
        r = got[f"{k:05d}"]
        assert (r.name, r.yomi, r.birthYear) == (f"名{chr(0x4E00 + k)}", "ヨミ0", 1500 + k if k % 2 else None)
        assert set(r.yomiAlt or []) == {x["yomi"] for x in own[1:]} | {x["yomiAlt"] for x in own if "yomiAlt" in x}
    runs = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "cp-runs")).collect()]
    assert len(runs) == 4 and all(r["finishedAt"] >= r["startedAt"] and r["settings"]["kind"] == "person" for r in runs)
    assert C.catalogue(api.harvested(spark, str(tmp_path / "raw")), "person").count() == 61


def test_a_batch_that_was_not_committed_runs_again(spark, tmp_path):
    path = str(tmp_path / "t.db")
    sqlite.register(spark)
    sqlite.write(spark.range(100).selectExpr("id % 25 AS k", "id AS v"), path, "t")
    calls = []

    def merge(batch):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("lost")
        return batch.groupBy("k").agg(F.sum("v").alias("v"), F.count("*").alias("n"))

    go = lambda: resumable.harvest_stream(spark, "sqlite", {"path": path, "dbtable": "t", "key": "k", "limit": "3", "ranges": "2"}, str(tmp_path / "out"), str(tmp_path / "cp"), merge)
    with pytest.raises(Exception, match="lost"):
        go()
    assert go()["lastKey"] == 24
    got = spark.read.parquet(str(tmp_path / "out")).drop("batch").collect()
    assert sorted((r.k, r.v, r.n) for r in got) == [(k, 4 * k + 150, 4) for k in range(25)]
    with pytest.raises(ValueError):
        resumable.harvest_stream(spark, "sqlite", {}, str(tmp_path / "out"), str(tmp_path / "cp"), settings={"other": 1})


def test_an_extraction_stops_after_its_batch_and_goes_on(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for k in range(12):
        (src / f"{k}.txt").write_text(f"{k}\n" * 3)
    stop = threading.Event()
    go = lambda **o: resumable.extract(spark, str(src), lambda d: d, str(tmp_path / "out"), str(tmp_path / "cp"), {}, files_per_batch=1, **o)
    threading.Timer(1.5, stop.set).start()
    first = go(stop=stop)
    rest = go()
    assert first["rows_in"] + rest["rows_in"] >= 36 and not rest["interrupted"]
    got = [r.value for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(got, key=int) == sorted((str(k) for k in range(12) for _ in range(3)), key=int)
    (src / "x.txt").write_text("99\n")
    assert resumable.extract(spark, str(src), lambda d: d, str(tmp_path / "out"), str(tmp_path / "cp"), {}, bytes_per_batch=10)["rows_in"] == 1


# --- TEI lists


def test_records_of_a_split_file_equal_those_of_a_whole_one(spark, tmp_path):
    recs = "\n".join(f'<person\n xml:id="A{k}"><persName>名{k} {"é" * (k % 17)}</persName><note>{"x" * (k * 37 % 301)}</note></person>' for k in range(800))
    body = f'﻿<TEI><listPerson>\n<person n="1">no id</person>{recs}'
    ends = {"a.xml": "</listPerson></TEI>", "b.xml": "", "c.xml": '\n<person xml:id="cut"><persName>z</persName>', "d.xml": "\n"}
    texts = {n: body + tail for n, tail in ends.items()} | {"long.xml": f'<person xml:id="L">{"y" * 300_000}</person><person xml:id="M"></person>', "none.xml": "<TEI/>", "empty.xml": ""}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    (tmp_path / "e.xml.gz").write_bytes(gzip.compress((body + ends["c.xml"]).encode()))
    want = {n: re.findall(r'<person\s+xml:id="[^"]+"[\s\S]*?</person>', t) for n, t in (texts | {"e.xml.gz": body + ends["c.xml"]}).items()}
    for size in ("128m", "30000b", "7001b"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1000b")
        try:
            whole = tei.records(spark, str(tmp_path), "person")
            assert size == "128m" or whole.rdd.getNumPartitions() > 8
            assert sorted(r.xml for r in whole.collect()) == sorted(x for w in want.values() for x in w)
            assert sorted(r.xml for r in tei.records(spark, str(tmp_path / "c.xml"), "person").collect()) == sorted(want["c.xml"])
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
