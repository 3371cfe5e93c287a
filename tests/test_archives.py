"""Archives of packs, first usable files, limits in a dump's order, running totals and stored closures."""

import gzip
import hashlib
import io
import json
import random
import tarfile

import pytest
from pyspark.sql import functions as F

from onoma.operators import relational as R
from onoma.plans import api
from onoma.sinks import bundles, packs


@pytest.fixture
def packs_folder(tmp_path):
    root = tmp_path / "packs"
    for name, text in {"cbdb/persons/part-0": "a" * 5000, "cbdb/manifest.json": "{}", "cbdb/none": "", "wikidata/person-ja/part-0": "名" * 700, "ndl/" + "long" * 40 + "/part-0": "x", "cbdb/persons/_SUCCESS": "", "cbdb/persons/.part-0.crc": "y", "ndl/pointer": "version https://git-lfs.github.com/spec/v1\n", "empty": ""}.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(text)
    return root


def test_archives_are_the_same_bytes_at_every_run(spark, packs_folder, tmp_path):
    regions = {"chinese": ["cbdb/"], "japanese": ["ndl/", "wikidata/person-ja"], "both": ["cbdb/manifest", "wikidata/"]}
    made = [api.build_bundles(spark, str(packs_folder), str(tmp_path / f"out{k}"), regions, {"cbdb": "2026-06-27", "ndl": None}, {"licenses": {"cbdb": "CC"}}) for k in range(2)]
    assert made[0] == made[1] == json.loads((tmp_path / "out0/packs-index.json").read_text()) and made[0]["bundleVersion"] == "cbdb-20260627-ndl-local"
    for b in made[0]["bundles"]:
        first, second = ((tmp_path / f"out{k}" / b["fileName"]).read_bytes() for k in range(2))
        assert first == second and (len(first), hashlib.sha256(first).hexdigest()) == (b["bytes"], b["sha256"])
        with tarfile.open(fileobj=io.BytesIO(first)) as tar:
            held = {m.name: tar.extractfile(m).read() for m in tar.getmembers()}
        assert list(held) == [f"packs/{f['path']}" for f in b["files"]] and b["fileCount"] == len(held)
        for f in b["files"]:
            text = held[f"packs/{f['path']}"]
            assert text == (packs_folder / f["path"]).read_bytes() and (len(text), hashlib.sha256(text).hexdigest()) == (f["bytes"], f["sha256"])
    assert {b["id"].split("-")[1]: b["fileCount"] for b in made[0]["bundles"]} == {"both": 2, "chinese": 3, "japanese": 2}
    with pytest.raises(ValueError, match="no files"):
        api.build_bundles(spark, str(packs_folder), str(tmp_path / "none"), {"x": ["nothing/"]})


def test_an_archive_of_many_parts(spark, tmp_path):
    root = tmp_path / "many"
    root.mkdir()
    for k in range(60):
        (root / f"f{k:02d}").write_bytes(random.Random(k).randbytes(1 + k * 97 % 3000))
    one, many = (bundles.build(spark, str(root), str(tmp_path / f"o{n}"), part=n) for n in (1 << 30, 5000))
    assert one["bundles"][0]["files"] == many["bundles"][0]["files"]
    texts = [gzip.decompress((tmp_path / f"o{n}/all.tar.gz").read_bytes()) for n in (1 << 30, 5000)]
    assert texts[0] == texts[1] and len(tarfile.open(fileobj=io.BytesIO(texts[0])).getmembers()) == 60
    assert sorted(p.name for p in (tmp_path / "o5000").iterdir()) == ["all.tar.gz", "all.tar.gz.json", "packs-index.json"]


def test_first_usable_file(spark, packs_folder, tmp_path):
    pointer, missing, good, other = str(packs_folder / "ndl/pointer"), str(tmp_path / "missing"), str(packs_folder / "cbdb/manifest.json"), str(packs_folder / "empty")
    assert bundles.first_usable(spark, missing, pointer, good, other) == good and bundles.first_usable(spark, other, good) == other
    assert bundles.first_usable(spark, missing, pointer) is None and bundles.first_usable(spark, missing) is None


def test_an_extraction_ends_with_the_entity_that_reaches_the_limit(spark, tmp_path):
    def entity(k):
        labels = {la: {"language": la, "value": f"n{k}"} for la in ("en", "ja") if k % 3 or la == "en"}
        kind = {"mainsnak": {"snaktype": "value", "datavalue": {"type": "wikibase-entityid", "value": {"id": "Q5" if k % 5 else "Q9"}}}}
        return {"type": "item", "id": f"Q{k}", "labels": labels, "aliases": {}, "claims": {"P31": [kind]}}

    lines = ["[", *(json.dumps(entity(k)) + "," for k in range(1, 300)), "broken", "]"]
    (tmp_path / "dump.json").write_text("\n".join(lines))
    rows = [("en", f"Q{k}") for k in range(1, 300) if k % 5] + [("ja", f"Q{k}") for k in range(1, 300) if k % 5 and k % 3]
    for size, most in (("128m", 1), ("7000b", 1), ("7000b", 100), ("7000b", 101), ("7000b", len(rows)), ("7000b", 10**6)):
        want, total = set(), 0
        for k in range(1, 300):
            if total >= most:
                break
            own = {r for r in rows if r[1] == f"Q{k}"}
            want, total = want | own, total + len(own)
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1b")
        try:
            assert size == "128m" or spark.read.text(str(tmp_path / "dump.json")).rdd.getNumPartitions() >= 7
            counts = api.extract(spark, str(tmp_path / "dump.json"), "person", ["en", "ja"], str(tmp_path / "out"), most=most)
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert {(r.lang, r.qid) for r in spark.read.json(str(tmp_path / "out")).collect()} == want and sum(r["count"] for r in counts.collect()) == len(want)


def test_running_totals(spark):
    rng = random.Random(1)
    rows = [(f"b{k % 3}", f"{k:04d}", rng.randint(0, 50)) for k in range(500)]
    df = spark.createDataFrame(rows, "b string, n string, v long").repartition(7)
    got = {(r.b, r.n): r.total for r in R.running_total(df, ["b", "n"], F.col("v")).collect()}
    total = 0
    for b, n, v in sorted(rows):
        assert got[b, n] == total
        total += v
    assert R.running_total(df.limit(0), ["b", "n"], F.col("v")).columns == ["b", "n", "v", "total"]


def test_stored_closures_grow_and_shrink_as_if_reckoned_anew(spark, tmp_path):
    rng = random.Random(2)
    pairs = list({(f"c{rng.randint(0, 39)}", f"c{rng.randint(0, 39)}") for _ in range(70)})
    frame = lambda rows: spark.createDataFrame(rows, "child string, parent string")
    roots = spark.createDataFrame([("a", "c0"), ("a", "c1"), ("b", "c2"), ("c", "zz"), ("d", "c3")], "root string, node string")
    held = lambda df: sorted(map(tuple, df.select("root", "node", "depth").collect()))
    path, now = str(tmp_path / "closure"), pairs[:40]
    keep = lambda **k: held(api.stored_closure(spark, path, frame(now), roots, **k))
    assert keep() == held(R.depths(frame(now), roots)) and keep() == keep()
    now = pairs[:60]
    assert keep(added=frame(pairs[40:60])) == held(R.depths(frame(now), roots))
    now = pairs[10:60]
    assert keep(removed=frame(pairs[:10])) == held(R.depths(frame(now), roots))
    now = pairs[20:]
    assert keep(added=frame(pairs[60:]), removed=frame(pairs[10:20])) == held(R.depths(frame(now), roots)) == keep()
    plain = {("a", "c0"): 0, ("a", "c1"): 0}
    front = list(plain)
    while front:
        front = [(r, c) for r, n in front for c, p in now if p == n and (r, c) not in plain and not plain.update({(r, c): plain[r, n] + 1})]
    assert [x for x in keep() if x[0] == "a"] == sorted((*k, d) for k, d in plain.items())


def test_crosswalks_by_cells_and_by_name_agree(spark, monkeypatch):
    rng = random.Random(3)
    place = lambda k: (k, f"p{k}", [rng.choice("abc") for _ in range(rng.randint(0, 3))], *((rng.uniform(-3, 3), rng.uniform(-3, 3)) if rng.random() < 0.8 else (None, rng.choice([None, 1.0]))))
    left = spark.createDataFrame([place(k) for k in range(120)], "row int, id string, names array<string>, lat double, lon double").repartition(3)
    right = spark.createDataFrame([place(k) for k in range(150)], left.schema).drop("row")
    found = []
    for common in (1000, 0):
        monkeypatch.setattr(R, "COMMON", common)
        found.append(sorted(map(tuple, R.crosswalk(left, right, 0.5).collect()), key=repr))
    assert found[0] == found[1] and len(found[0]) > 500
    assert R.crosswalk(left, right.limit(0)).count() == 0


def test_long_tables_keep_their_order_in_one_file(spark, tmp_path):
    df = spark.range(20_000).repartition(7).orderBy("id").select(F.col("id").alias("k"), F.concat(F.lit("a\tb\n"), F.col("id")).alias("v"))
    for _ in range(2):  # the second time in place of the first
        packs.write_tsv(df, str(tmp_path / "t"))
    assert [p.name for p in (tmp_path / "t").iterdir() if not p.name.startswith(".")] == ["part-00000.txt"] and [p.name for p in tmp_path.iterdir()] == ["t"]
    assert (tmp_path / "t/part-00000.txt").read_text().split("\n") == ["k\tv", *(f"{k}\ta b {k}" for k in range(20_000)), ""]
