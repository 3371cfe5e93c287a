"""SQLite tables: scans with pushed filters, harvests by key, and a sink.

A database is one file, so its folder must be one that the driver and all executors see.
"""

from __future__ import annotations

import operator
import os
import shutil
import sqlite3
import uuid
from collections.abc import Callable, Iterator
from contextlib import closing
from dataclasses import dataclass
from datetime import date, datetime
from decimal import Decimal

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql.types import StructType

from onoma.sources.keyset import KeysetStream, Pages

#: Rowids of a partition, if neither numPartitions nor rows is given.
RANGE = 100_000
#: SQLite's storage classes that a Spark type's cells are expected to have.
CLASSES = {"bigint": "'integer'", "double": "'integer', 'real'", "string": "'text'"}


def local(path: str) -> str:
    """A path without its file: scheme."""
    return path if not path.startswith("file:") else "/" + path.removeprefix("file:").lstrip("/")


def reading(path: str):  # noqa: ANN201
    db = sqlite3.connect(f"file:{local(path)}?mode=ro", uri=True)
    db.text_factory = lambda b: b.decode("utf-8", "replace")
    return closing(db)


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def cell(v, kind: str):  # noqa: ANN001, ANN201
    """A cell as its column's type: SQLite keeps any value in any column, and what does not fit is null."""
    if v is None or kind == "string":
        return v if v is None or isinstance(v, str) else v.decode("utf-8", "replace") if isinstance(v, bytes) else str(v)
    try:
        got = (int if kind == "bigint" else float)(v)
    except (ValueError, TypeError, OverflowError):
        return None
    return got if kind != "bigint" or -(2**63) <= got < 2**63 else None


#: Arrow's types of the columns; rows are fetched, and handed to Spark, so many at a time.
_ARROW, FETCHED = {"bigint": pa.int64(), "double": pa.float64(), "string": pa.string()}, 10_000


def batches(rows: sqlite3.Cursor, fields: list[tuple[str, str]], keep: Callable | None = None) -> Iterator:
    """Rows as their columns' types, those that `keep` takes: as Arrow's batches, or as tuples where a column has a further type."""
    arrow = all(k in _ARROW for _, k in fields)
    while some := rows.fetchmany(FETCHED):
        columns = [[cell(v, k) for v in col] for col, (_, k) in zip(zip(*some, strict=True), fields, strict=True)]
        if keep or not arrow:
            kept = [r for r in zip(*columns, strict=True) if not keep or keep(r)]
            columns = list(zip(*kept, strict=True)) or [[] for _ in fields]
        if arrow:
            yield pa.RecordBatch.from_arrays([pa.array(c, _ARROW[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])
        else:
            yield from zip(*columns, strict=True)


# --- scans -----------------------------------------------------------------------------------------------------------


@dataclass
class Pushed:
    """A pushed filter: SQL that lets through at least what `holds` does, which has the last word on the converted cell."""

    column: int
    sql: str
    values: tuple
    holds: Callable


#: By filter: SQL of a column and a value, and the same of a converted cell that is not null.
_COMPARED = {
    ds.EqualTo: ("{} = ? COLLATE BINARY", "__eq__"), ds.LessThan: ("{} < ? COLLATE BINARY", "__lt__"), ds.LessThanOrEqual: ("{} <= ? COLLATE BINARY", "__le__"),
    ds.GreaterThan: ("{} > ? COLLATE BINARY", "__gt__"), ds.GreaterThanOrEqual: ("{} >= ? COLLATE BINARY", "__ge__"),
    ds.StringStartsWith: ("substr({0}, 1, length(?1)) = ?1", "startswith"), ds.StringEndsWith: ("substr({0}, -length(?1)) = ?1", "endswith"), ds.StringContains: ("instr({}, ?) > 0", "__contains__"),
}


def pushed(f: ds.Filter, fields: list[tuple[str, str]]) -> Pushed | None:
    """The filter as a test of one column; None if it can't be pushed."""
    inner = f.child if isinstance(f, ds.Not) else f
    if not hasattr(inner, "attribute") or len(inner.attribute) != 1:
        return None
    at = next((k for k, (n, _) in enumerate(fields) if n == inner.attribute[0]), None)
    if at is None:
        return None
    (name, kind), negated = fields[at], isinstance(f, ds.Not)
    col = quoted(name)
    odd = f"typeof({col}) NOT IN ({CLASSES[kind]}, 'null')"  # cells of another class are left to `holds`
    if isinstance(inner, (ds.IsNull, ds.IsNotNull)):
        absent = isinstance(inner, ds.IsNull) != negated
        return Pushed(at, f"({col} IS NULL OR {odd})" if absent else f"{col} IS NOT NULL", (), lambda v: (v is None) == absent)
    values = tuple(inner.value) if isinstance(inner, ds.In) else (inner.value,)
    fits = str if kind == "string" else (int, float)
    if not values or not all(isinstance(v, fits) and not isinstance(v, bool) and v == v and (isinstance(v, (str, float)) or -(2**63) <= v < 2**63) and v != "" for v in values):
        return None
    if isinstance(inner, ds.In):
        marks, known = ", ".join("?" * len(values)), frozenset(values)
        return Pushed(at, f"({odd} OR {col} COLLATE BINARY {'NOT ' * negated}IN ({marks}))", values, lambda v: v is not None and (v in known) != negated)
    if negated and not isinstance(inner, ds.EqualTo) or type(inner) not in _COMPARED:
        return None
    sql, method = _COMPARED[type(inner)]
    value = values[0]
    compare = getattr(operator, method) if hasattr(operator, method) else getattr(str, method)
    test = sql.format(col).replace("?1", "?")
    given = values * test.count("?")
    return Pushed(at, f"({odd} OR {'NOT ' * negated}({test}))", given, lambda v: v is not None and compare(v, value) != negated)


class SqliteSource(ds.DataSource):
    """format("sqlite"): options path, dbtable, columns (comma-separated, all by default).

    Scans: one partition for each 100,000 rowids, or for so many as option rows says, or numPartitions; column _ord is the rowid, which keeps the table's order.
    Filters on single columns reach SQLite. Tables without rowids and views are read by one task, _ord counts their rows.
    Streams: option key, a column; see KeysetStream. Rows without a key are not harvested.
    Writes: option key, comma-separated columns, of whose equals the first row stays; append keeps the rows that are there. Option index,
    comma-separated columns that get an index, as that by which a stream reads should have.
    """

    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> str:
        kinds = {"INT": "bigint", "BIG": "bigint", "SMA": "bigint", "TIN": "bigint", "REA": "double", "FLO": "double", "DOU": "double", "NUM": "double"}
        with reading(self.options["path"]) as db:
            cols = {c[1]: kinds.get((c[2] or "").upper()[:3], "string") for c in db.execute(f"PRAGMA table_info({quoted(self.options['dbtable'])})")}
        if not cols:
            raise ValueError(f"no table {self.options['dbtable']} in {self.options['path']}")
        wanted = [c.strip() for c in self.options["columns"].split(",")] if "columns" in self.options else list(cols)
        return ", ".join([*(f"`{c}` {cols[c]}" for c in wanted if c != "_ord"), "_ord bigint"])

    def reader(self, schema: StructType) -> ds.DataSourceReader:
        return SqliteReader(self.options, schema)

    def streamReader(self, schema: StructType) -> ds.DataSourceStreamReader:  # noqa: N802
        return KeysetStream(TablePages(self.options, schema), dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> ds.DataSourceWriter:  # noqa: FBT001
        return SqliteWriter(self.options, schema, overwrite)


def _fields(schema: StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


class SqliteReader(ds.DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.table, self.parts, self.step = options["path"], options["dbtable"], options.get("numPartitions"), int(options.get("rows", RANGE))
        self.fields, self.tests, self.rowids = _fields(schema), [], True

    def pushFilters(self, filters: list[ds.Filter]) -> Iterator[ds.Filter]:  # noqa: N802
        for f in filters:
            test = pushed(f, self.fields)
            if test is None:
                yield f
            else:
                self.tests.append(test)

    def partitions(self) -> list[ds.InputPartition]:
        with reading(self.path) as db:
            try:
                lo, hi = db.execute(f"SELECT min(rowid), max(rowid) FROM {quoted(self.table)}").fetchone()
            except sqlite3.OperationalError:  # no rowids
                lo, hi, self.rowids = None, None, False
            if lo is None and db.execute("SELECT count(*) FROM sqlite_master WHERE type = 'view' AND lower(name) = lower(?)", (self.table,)).fetchone()[0]:
                self.rowids = False
        if not self.rowids:
            return [ds.InputPartition(None)]
        if not isinstance(lo, int):
            return [ds.InputPartition((0, -1))]
        step = -(-(hi - lo + 1) // int(self.parts)) if self.parts else self.step
        return [ds.InputPartition((a, min(a + step - 1, hi))) for a in range(lo, hi + 1, step)]

    def read(self, partition: ds.InputPartition) -> Iterator:
        number = "rowid" if partition.value else "row_number() OVER ()"
        where = [*(['"_ord" BETWEEN ? AND ?'] if partition.value else []), *(t.sql for t in self.tests)]
        sql = f'SELECT {", ".join(quoted(n) for n, _ in self.fields)} FROM (SELECT {number} AS "_ord", * FROM {quoted(self.table)})'
        sql += f" WHERE {' AND '.join(where)}" * bool(where) + ' ORDER BY "_ord"'
        with reading(self.path) as db:
            rows = db.execute(sql, [*(partition.value or ()), *(v for t in self.tests for v in t.values)])
            yield from batches(rows, self.fields, (lambda r: all(t.holds(r[t.column]) for t in self.tests)) if self.tests else None)


class TablePages(Pages):
    """A table by one of its columns, which should have an index."""

    def __init__(self, options: dict, schema: StructType):
        self.path, self.table, self.key, self.fields = options["path"], quoted(options["dbtable"]), quoted(options.get("key", "")), _fields(schema)

    def _bounds(self, after, upto) -> tuple[str, list]:  # noqa: ANN001
        sql = [f"{self.key} IS NOT NULL", *([f"{self.key} > ?"] if after is not None else []), *([f"{self.key} <= ?"] if upto is not None else [])]
        return " AND ".join(sql), [v for v in (after, upto) if v is not None]

    def keys(self, after, most: int) -> list:  # noqa: ANN001
        where, values = self._bounds(after, None)
        with reading(self.path) as db:
            return [r[0] for r in db.execute(f"SELECT DISTINCT {self.key} FROM {self.table} WHERE {where} ORDER BY 1 LIMIT ?", [*values, most])]

    def rows(self, after, upto) -> Iterator:  # noqa: ANN001
        where, values = self._bounds(after, upto)
        cols = ", ".join("rowid" if n == "_ord" else quoted(n) for n, _ in self.fields)
        with reading(self.path) as db:
            yield from batches(db.execute(f"SELECT {cols} FROM {self.table} WHERE {where} ORDER BY {self.key}", values), self.fields)


# --- sink ------------------------------------------------------------------------------------------------------------


@dataclass
class Part(ds.WriterCommitMessage):
    at: int
    path: str


#: SQLite's names of Spark's types; all others are text.
STORED = {"tinyint": "INTEGER", "smallint": "INTEGER", "int": "INTEGER", "bigint": "INTEGER", "boolean": "INTEGER", "float": "REAL", "double": "REAL", "binary": "BLOB"}


def stored(v):  # noqa: ANN001, ANN201
    """A Spark value as SQLite keeps it."""
    if isinstance(v, (date, datetime)):
        return v.isoformat(*(" ",) if isinstance(v, datetime) else ())
    return str(v) if isinstance(v, Decimal) else bytes(v) if isinstance(v, bytearray) else int(v) if isinstance(v, bool) else v


class SqliteWriter(ds.DataSourceWriter):
    """Each task writes a file of its own beside the database; the driver's commit has SQLite join those of successful tasks and add
    them in one transaction, in the order of partitions. Whatever fails before, or within it, leaves the database as it was."""

    def __init__(self, options: dict, schema: StructType, overwrite: bool):  # noqa: FBT001
        self.path, self.table, self.overwrite = local(options["path"]), options["dbtable"], overwrite
        self.key, self.index = ([c.strip() for c in options[k].split(",")] if options.get(k) else [] for k in ("key", "index"))
        kinds = [(f.name, STORED.get(f.dataType.typeName() if f.dataType.typeName() == "boolean" else f.dataType.simpleString(), "TEXT")) for f in schema.fields]
        if any(f.dataType.typeName() in ("array", "map", "struct", "variant") for f in schema.fields):
            raise ValueError("SQLite keeps no arrays, maps or structs; write them as JSON")
        self.columns, self.names = ", ".join(f"{quoted(n)} {k}" for n, k in kinds), ", ".join(quoted(n) for n, _ in kinds)
        self.marks = ", ".join("?" * len(kinds))
        self.stage = f"{self.path}.staged-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[Row]) -> Part:
        task = TaskContext.get()
        os.makedirs(self.stage, exist_ok=True)
        path = f"{self.stage}/{task.partitionId()}-{task.taskAttemptId()}"
        with closing(sqlite3.connect(path)) as db:
            db.execute("PRAGMA synchronous = OFF")
            db.execute(f"CREATE TABLE part ({self.columns})")
            db.executemany(f"INSERT INTO part VALUES ({self.marks})", (tuple(map(stored, r)) for r in iterator))
            db.commit()
        return Part(task.partitionId(), path)

    def _joined(self, messages: list[Part | None]) -> str | None:
        """The file of the first part, into which SQLite has copied the others, in the order of partitions."""
        first, *others = sorted((m for m in messages if m), key=lambda m: m.at) or [None]
        if first is None:
            return None
        with closing(sqlite3.connect(first.path, isolation_level=None)) as db:
            for pragma in ("synchronous", "journal_mode"):
                db.execute(f"PRAGMA {pragma} = OFF")
            for part in others:
                db.execute("ATTACH ? AS other", (part.path,))
                db.execute("INSERT INTO main.part SELECT * FROM other.part ORDER BY rowid")
                db.execute("DETACH other")
                os.remove(part.path)
        return first.path

    def commit(self, messages: list[Part | None]) -> None:
        staged = self._joined(messages)
        with closing(sqlite3.connect(self.path, isolation_level=None)) as db:
            if staged:
                db.execute("ATTACH ? AS staged", (staged,))
            db.execute("BEGIN IMMEDIATE")
            try:
                if self.overwrite:
                    db.execute(f"DROP TABLE IF EXISTS main.{quoted(self.table)}")
                db.execute(f"CREATE TABLE IF NOT EXISTS main.{quoted(self.table)} ({self.columns})")
                if self.key:
                    db.execute(f"CREATE UNIQUE INDEX IF NOT EXISTS main.{quoted(self.table + ' by ' + ', '.join(self.key))} ON {quoted(self.table)} ({', '.join(map(quoted, self.key))})")
                if staged:
                    db.execute(f"INSERT OR IGNORE INTO main.{quoted(self.table)} ({self.names}) SELECT * FROM staged.part ORDER BY rowid")
                if self.index:
                    db.execute(f"CREATE INDEX IF NOT EXISTS main.{quoted(self.table + ' indexed by ' + ', '.join(self.index))} ON {quoted(self.table)} ({', '.join(map(quoted, self.index))})")
                db.execute("COMMIT")
            except BaseException:
                db.execute("ROLLBACK")
                raise
        shutil.rmtree(self.stage, ignore_errors=True)

    def abort(self, messages: list[Part | None]) -> None:  # noqa: ARG002
        shutil.rmtree(self.stage, ignore_errors=True)


# --- entry points ----------------------------------------------------------------------------------------------------


def register(spark: SparkSession) -> None:
    """The format, and the session's switch for filters that reach Python sources."""
    spark.dataSource.register(SqliteSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", True)  # noqa: FBT003


def table(spark: SparkSession, path: str, name: str, *columns: str) -> DataFrame:
    """Some columns of a table, or all, and _ord."""
    reader = spark.read.format("sqlite").option("path", path).option("dbtable", name)
    return (reader.option("columns", ",".join(columns)) if columns else reader).load()


def write(df: DataFrame, path: str, name: str, key: str = "", mode: str = "append", index: str = "") -> None:
    df.write.format("sqlite").option("path", path).option("dbtable", name).option("key", key).option("index", index).mode(mode).save()
