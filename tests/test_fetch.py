"""Downloads and zip archives."""

import hashlib
import http.server
import threading
import zipfile

import pytest

from onoma.sources import fetch, files


@pytest.fixture
def server():
    """Paths answer by turns: /busy fails twice, /torn lies once, /gone is not there."""
    asked = {}

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            n = asked[self.path] = asked.get(self.path, 0) + 1
            body = f"text of {self.path} ".encode() * 1000
            if self.path == "/busy" and n < 3:
                self.send_response(503 if n == 1 else 429)
                self.send_header("Retry-After", "0")
                self.end_headers()
                return
            if self.path == "/gone":
                self.send_response(404)
                self.end_headers()
                return
            self.send_response(200)
            self.end_headers()
            self.wfile.write(b"other" if self.path == "/torn" and n == 1 else body)

        def log_message(self, *_):
            pass

    s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    return f"http://127.0.0.1:{s.server_port}", asked


def sha(name):
    return hashlib.sha256(f"text of {name} ".encode() * 1000).hexdigest()


def test_fetch(spark, tmp_path, server):
    url, asked = server
    wanted = spark.createDataFrame([(f"{url}/a", "x/a.bin", None), (f"{url}/busy", "busy", sha("/busy")), (f"{url}/torn", "torn", sha("/torn"))], "url string, name string, sha256 string")
    got = {r.name: r for r in fetch.fetch(wanted, f"file://{tmp_path}/up", wait=0.01)}
    assert {n: (r.requests, r.sha256) for n, r in got.items()} == {"x/a.bin": (1, sha("/a")), "busy": (3, sha("/busy")), "torn": (2, sha("/torn"))}
    assert fetch.digest_of(f"{tmp_path}/up/torn") == (got["torn"].bytes, sha("/torn")) and sorted(p.name for p in (tmp_path / "up").iterdir()) == ["busy", "torn", "x"]
    again = {r.name: r.requests for r in fetch.fetch(wanted, f"{tmp_path}/up", wait=0.01)}
    assert again == {"x/a.bin": 1, "busy": 0, "torn": 0} and asked["/busy"] == 3
    with pytest.raises(Exception, match="status 404"):
        fetch.fetch(spark.createDataFrame([(f"{url}/gone", "gone", None)], wanted.schema), f"{tmp_path}/up", wait=0.01)
    with pytest.raises(Exception, match="has the digest"):
        fetch.fetch(spark.createDataFrame([(f"{url}/a", "wrong", "0" * 64)], wanted.schema), f"{tmp_path}/up", attempts=2, wait=0.01)
    assert not (tmp_path / "up/wrong").exists() and asked["/gone"] == 1


def test_zip_lines(spark, tmp_path, monkeypatch):
    with zipfile.ZipFile(tmp_path / "works.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("dir/works.tsv", "1\t坊っちゃん\t\t夏目漱石\r\n2\t心\t\t\n" + "".join(f"{k}\tt{k}\n" for k in range(3, 25_000)))
        z.writestr("readme.txt", "no table")
    with zipfile.ZipFile(tmp_path / "more.ZIP", "w") as z:
        z.writestr("b.tsv", "x\ty")
        z.writestr("empty.tsv", "")
    rows = fetch.zip_lines(spark, str(tmp_path), r"\.tsv$")
    assert {(r.member, r["count"]) for r in rows.groupBy("member").count().collect()} == {("dir/works.tsv", 24_999), ("b.tsv", 1)}
    rows.where("member = 'dir/works.tsv'").select("value").write.text(str(tmp_path / "lines"))
    got = {r.id: r for r in files.works(spark, str(tmp_path / "lines")).where("id in ('1', '2')").collect()}
    assert got["1"].creators == ["夏目漱石"] and got["2"].title == "心"
    assert fetch.zip_lines(spark, str(tmp_path), "nothing").count() == 0
