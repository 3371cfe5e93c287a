"""Commands, and resumable extraction."""

import json
import sqlite3
import threading
from contextlib import closing

import pytest

from onoma import __main__ as commands
from onoma.plans import api
from test_sources import Server, persons


def entity(k):
    labels = {"ja": {"language": "ja", "value": "人" + chr(0x5200 + k)}}
    kind = {"mainsnak": {"snaktype": "value", "datavalue": {"type": "wikibase-entityid", "value": {"id": "Q5" if k % 3 else "Q515"}}}}
    land = {"mainsnak": {"snaktype": "value", "datavalue": {"type": "wikibase-entityid", "value": {"id": "Q17" if k % 2 else "Q9683"}}}}
    return json.dumps({"type": "item", "id": f"Q{k}", "labels": labels, "aliases": {}, "claims": {"P31": [kind], "P27": [land]}}) + ","


def run(spark, capsys, *argv):
    code = commands.main(list(argv), spark)
    said = capsys.readouterr().out.strip().split("\n")[-1]
    return code, said


def test_extraction_that_stops_equals_one_that_does_not(spark, tmp_path, capsys):
    (tmp_path / "dump").mkdir()
    for n in range(8):
        (tmp_path / f"dump/{n}.json").write_text("[\n" + "\n".join(entity(k) for k in range(30 * n + 1, 30 * n + 31)) + "\n]\n")
    args = "--dump", str(tmp_path / "dump"), "--kinds", "person,place", "--languages", "ja"
    assert run(spark, capsys, "extract", *args, "--out", str(tmp_path / "whole"))[0] == 0
    stop = threading.Event()
    threading.Timer(2.0, stop.set).start()
    first = api.extract_resumable(spark, str(tmp_path / "dump"), "person,place", ["ja"], str(tmp_path / "part"), str(tmp_path / "cp"), files_per_batch=1, stop=stop)
    code, said = run(spark, capsys, "extract-new", *args, "--out", str(tmp_path / "part"), "--checkpoint", str(tmp_path / "cp"), "--files", "1")
    assert code == 0 and first["batches"] >= 1 and not json.loads(said)["interrupted"]
    for kind in ("person", "place"):
        one, two = (sorted(map(str, api.raw_of(spark, str(tmp_path / p), "ja", kind).collect())) for p in ("whole/label-only", "part"))
        assert one == two and len(one) == (160 if kind == "person" else 80)
    with pytest.raises(ValueError, match="other settings"):
        api.extract_resumable(spark, str(tmp_path / "dump"), "place", ["ja"], str(tmp_path / "part"), str(tmp_path / "cp"))
    code, said = run(spark, capsys, "compile-country", "--raw", str(tmp_path / "part"), "--out", str(tmp_path / "jp"), "--language", "ja", "--country", "japan")
    assert json.loads(said)["entityCount"] == 80
    assert json.loads(run(spark, capsys, "compile-persons", "--raw", str(tmp_path / "whole/label-only"), "--out", str(tmp_path / "p"), "--language", "ja", "--dynasties", "tang")[1])["tang"]["entityCount"] == 80
    assert json.loads(run(spark, capsys, "compile-language", "--raw", str(tmp_path / "part"), "--out", str(tmp_path / "l"), "--language", "ja", "--kinds", "place")[1])["place"]["entityCount"] == 80
    assert json.loads(run(spark, capsys, "report", "--pack", str(tmp_path / "jp"), "--out", str(tmp_path / "r"))[1])["entities"] == 80
    code, said = run(spark, capsys, "bundle", "--packs", str(tmp_path / "p"), "--out", str(tmp_path / "b"), "--regions", "x=person-ja-tang")
    assert json.loads(said)["packs-x"]["fileCount"] >= 2 and (tmp_path / "b/packs-x.tar.gz").exists()


def test_harvest_and_catalogue(spark, tmp_path, capsys):
    server = Server(persons(20))
    args = "harvest", "--kind", "person", "--endpoint", server.url, "--out", str(tmp_path / "raw"), "--checkpoint", str(tmp_path / "cp"), "--limit", "5", "--ranges", "1", "--delay", "0"
    assert json.loads(run(spark, capsys, *args, "--batches", "1")[1])["batches"] == 1
    assert json.loads(run(spark, capsys, *args)[1])["resumed"]
    assert json.loads(run(spark, capsys, "compile-catalogue", "--raw", str(tmp_path / "raw"), "--kind", "person", "--out", str(tmp_path / "pack"))[1])["entityCount"] == 20
    run(spark, capsys, "export-ime", "--raw", str(tmp_path / "raw"), "--out", str(tmp_path / "ime"))
    assert spark.read.text(str(tmp_path / "ime")).count() > 20


def test_other_commands(spark, tmp_path, capsys):
    assert run(spark, capsys, "validate") == (0, "valid")
    count = commands.COMMANDS["sparql"][2](spark, commands.parser().parse_args(["sparql", "--kind", "person", "--what", "count"]), threading.Event())
    assert "SELECT (COUNT(?entity) AS ?count) WHERE {" in count
    text = commands.COMMANDS["sparql"][2](spark, commands.parser().parse_args(["sparql", "--kind", "place", "--what", "sample", "--prefix", "東"]), threading.Event())
    assert 'regex(str(?name), "^東")' in text and text.endswith("ORDER BY ?name\nLIMIT 20")
    (tmp_path / "works").write_text("1\t心\t\t夏目\t\t\n\n2\t門\n")
    assert run(spark, capsys, "parse-works", "--input", str(tmp_path / "works"), "--out", str(tmp_path / "w"))[1] == "2"
    assert json.loads(run(spark, capsys, "compile-catalogue", "--raw", str(tmp_path / "w"), "--kind", "work", "--out", str(tmp_path / "wp"))[1])["entityCount"] == 2
    with closing(sqlite3.connect(tmp_path / "s.db")) as db:
        db.executescript("CREATE TABLE BIOG_MAIN(c_personid INT, c_name_chn TEXT); CREATE TABLE DYNASTIES(c_dy INT); CREATE TABLE ALTNAME_DATA(c_personid INT, c_alt_name_chn TEXT); INSERT INTO BIOG_MAIN VALUES (1, 'a'), (2, 'b')")
    assert json.loads(run(spark, capsys, "sample-snapshot", "--sqlite", str(tmp_path / "s.db"), "--out", str(tmp_path / "t.db"), "--persons", "2")[1])["BIOG_MAIN"] == 1
    with pytest.raises(SystemExit):
        commands.main(["no-such-command"], spark)
