"""Queries whose work must not outgrow their input."""

import random
import sqlite3
from contextlib import closing

import pytest

from conftest import SF
from onoma.operators import crosswalks
from onoma.operators import relational as R
from onoma.plans import catalogue
from onoma.sources import sqlite


def _places(spark, n, start, seed, names=("a", "b", "c", None)):
    r = random.Random(seed)
    at = lambda: r.choice([None, float("nan"), float("inf"), 0.0]) if r.random() < 0.1 else r.randrange(24) / 4
    rows = [(start + k, f"{start + k}", [r.choice(names) for _ in range(r.choice([0, 1, 1, 1, 2, 3]))], at(), at()) for k in range(n)]
    return spark.createDataFrame(rows, "row long, id string, names array<string>, lat double, lon double")


@pytest.mark.parametrize("common", [1, 1000])
@pytest.mark.parametrize("kind", [0, 1, 2], ids=["matched", "ambiguous", "counts"])
def test_crosswalk_by_parts(spark, monkeypatch, kind, common):
    """the same rows as from all pairs, with several names, repeated rows and positions that are missing or no numbers."""
    monkeypatch.setattr(R, "COMMON", common)
    monkeypatch.setattr(crosswalks, "BLOCK", 3)
    left, right = _places(spark, 60, 0, 1), _places(spark, 30, 100, 2).drop("row")
    left = left.unionByName(left.limit(2))
    want, got = R.crosswalk_split(left, R.crosswalk(left, right))[kind], crosswalks.parts(left, right)[kind]
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_crosswalk_of_one_common_name(spark):
    """F2, F3: 1.6 thousand million pairs of one name are counted without being made."""
    side = lambda n: spark.range(n).select("id", R.F.array(R.F.lit("x")).alias("names"), (R.F.col("id") % 2).cast("double").alias("lat"), R.F.lit(0.0).alias("lon"))
    left = side(40_000).withColumn("row", R.F.col("id")).unionByName(spark.sql("SELECT -1L AS id, array('x') AS names, 9.5D AS lat, 0D AS lon, -1L AS row"))
    one, _, stats = crosswalks.parts(left, side(40_000).unionByName(spark.sql("SELECT -2L AS id, array('x') AS names, 9.0D AS lat, 0D AS lon")), 0.5)
    assert tuple(stats.first()) == (1, 40_000, 0, 40_001) and [(r.left_id, r.right_id) for r in one.collect()] == [(-1, -2)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_crosswalk_beside_dense_places(spark, seed):
    """of records beside those of the left only few are compared, and they tell as much as all."""
    r, band = random.Random(seed), 0.5
    at = lambda n, *steps: [(k, r.choice("xy"), *(r.choice([r.random(), r.randrange(steps[0]) / steps[0]]) * 2 - 1 for _ in "ab")) for k in range(n)]
    left, right = at(400, 8), at(600, 16)
    dense = [(1000 + k, "z", 0.3 + r.random() / 10, 0.3 + r.random() / 10) for k in range(5000)]
    df = spark.createDataFrame(right + dense, "right_id long, name string, b_lat double, b_lon double")
    few = [tuple(x) for x in crosswalks._telling(df, band).select(df.columns).collect()]
    assert len(few) == len(set(few)) and sum(x[1] == "z" for x in few) < 400
    met = lambda a, rows: [b[0] for b in rows if b[1] == a[1] and abs(a[2] - b[2]) <= band and abs(a[3] - b[3]) <= band]
    for a in left + [(k, "z", r.random(), r.random()) for k in range(400)] + [(0, "z", x - band, y + s * band) for _, _, x, y in dense[:200] for s in (-1, 1)]:
        want, got = met(a, right + dense), met(a, few)
        assert got == want or len(want) > 1 < len(got)


@pytest.mark.parametrize("name", ["compile_graph_works", "compile_graph_country", "compressed_dump", "name_policy_stats", "readings_and_identifiers"])
def test_lines_are_parsed_once(spark, name):
    """F5, F7, F8, F9, F12: no filter on an entity parses its line again."""
    plan = catalogue.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


@pytest.mark.parametrize("name", ["typed_names", "compile_catalogue_orgs", "compile_graph_works", "compile_graph_country", "readings_and_identifiers"])
def test_rows_of_small_files_are_dealt_over_tasks(spark, name):
    """a table of one small file is not one task."""
    assert catalogue.QUERIES[name](spark, SF).rdd.getNumPartitions() >= R.tasks(spark)


def test_costly_columns_are_worked_out_once(spark):
    """a filter on a column put by with_once is not pushed below it."""
    df = R.with_once(spark.range(3), "s", R.F.array(R.F.sha2(R.F.col("id").cast("string"), 256))).where(R.F.size("s") > 0)
    assert df.columns == ["id", "s"] and df.count() == 3 and df._jdf.queryExecution().optimizedPlan().toString().count("sha2(") == 1


def test_a_database_gets_an_index(spark, tmp_path):
    """what a stream reads by has an index, and parts, which SQLite joins itself, keep their order; a failed write leaves all as it was."""
    path = str(tmp_path / "t.db")
    sqlite.register(spark)
    rows = spark.range(1000, numPartitions=13).select((R.F.col("id") % 7).alias("k"), R.F.col("id").cast("string").alias("v"))
    sqlite.write(rows, path, "part", index="k")
    with sqlite.reading(path) as db:
        assert [r[0] for r in db.execute("SELECT v FROM part ORDER BY rowid")] == [str(k) for k in range(1000)]
        assert "USING COVERING INDEX" in str(db.execute("EXPLAIN QUERY PLAN SELECT DISTINCT k FROM part WHERE k > 1 ORDER BY 1 LIMIT 3").fetchall())
    got = sqlite.table(spark, path, "part").where("k = 3 and v like '1%'")
    assert sorted(map(tuple, got.collect())) == sorted((k % 7, str(k), k + 1) for k in range(1000) if k % 7 == 3 and str(k).startswith("1"))


def test_database_rows_are_read_in_batches(spark, tmp_path):
    """rows leave the reader as Arrow's batches, cells that don't fit as nulls."""
    path = str(tmp_path / "t.db")
    with closing(sqlite3.connect(path)) as db:
        db.execute("CREATE TABLE t (k INT, x REAL, s TEXT)")
        db.executemany("INSERT INTO t VALUES (?, ?, ?)", [(1, 1, "a"), ("x", "y", b"\xff"), (2**40, None, 7)])
        db.commit()
        got = list(sqlite.batches(db.execute("SELECT k, x, CAST(s AS BLOB) FROM t"), [("k", "bigint"), ("x", "double"), ("s", "string")]))
    assert [type(b).__name__ for b in got] == ["RecordBatch"] and got[0].to_pydict() == {"k": [1, None, 2**40], "x": [1.0, None, None], "s": ["a", "�", "7"]}
    sqlite.register(spark)
    assert sorted(map(tuple, sqlite.table(spark, path, "t").select("k", "x").collect()), key=str) == sorted([(1, 1.0), (None, None), (2**40, None)], key=str)


def test_edges_are_read_once_for_all_rounds(spark):
    """the rounds of a closure, and of its extension, don't reckon the edges again."""
    seen = spark.sparkContext.accumulator(0)
    counted = R.F.udf(lambda x: (seen.add(1), x > 0)[1], "boolean")
    edges = spark.range(1, 13, numPartitions=1).select((R.F.col("id") + 1).alias("child"), R.F.col("id").alias("parent")).where(counted("parent"))
    roots = spark.createDataFrame([(1, 1)], "root long, node long")
    known = R.depths(edges, roots)
    assert sorted((r.node, r.depth) for r in known.collect()) == [(k, k - 1) for k in range(1, 14)] and seen.value <= 24
    added = spark.createDataFrame([(20, 2), (3, 1)], "child long, parent long")
    got = R.extend_depths(known, edges.unionByName(added), added)
    assert {r.node: r.depth for r in got.collect()} == {1: 0, 2: 1, 20: 2, **{k: k - 2 for k in range(3, 14)}} and seen.value <= 48
