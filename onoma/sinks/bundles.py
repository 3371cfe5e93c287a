"""Archives of pack files: the same bytes at every run, written side by side, with an index of sizes and hashes.

Members stand in the order of their names. A prefix sum of their sizes places each in a part of about PART bytes, which one
task compresses; gzip streams may follow one another, so the parts, one behind the other, are the archive. The folder of the
archives must be one that the driver and all executors see.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import os
import shutil
import tarfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from onoma.operators.relational import running_total
from onoma.operators.storage import empty_files, exists, qualified
from onoma.sources.files import usable
from onoma.sources.sqlite import local

#: Bytes of members that one task compresses.
PART = 64 << 20


@dataclass
class Parts(ds.WriterCommitMessage):
    """(bundle, part, file) of what a task wrote."""

    files: list[tuple[str, int, str]]


def member(name: str, content: bytes) -> bytes:
    """A tar member that says nothing of its time or owner."""
    info = tarfile.TarInfo(name)
    info.size = len(content)
    return info.tobuf(tarfile.PAX_FORMAT, "utf-8", "surrogateescape") + content + b"\0" * (-len(content) % tarfile.BLOCKSIZE)


class ArchiveSink(ds.DataSource):
    """format("archive"): option path, a folder; rows (bundle, part, name, content), each part in one task and in order.

    Writes bundle.tar.gz for each bundle, and bundle.tar.gz.json with its bytes and SHA-256, when all tasks have succeeded.
    """

    @classmethod
    def name(cls) -> str:
        return "archive"

    def writer(self, schema: StructType, overwrite: bool) -> ds.DataSourceWriter:  # noqa: ARG002, FBT001
        return ArchiveWriter(local(self.options["path"]))


class ArchiveWriter(ds.DataSourceWriter):
    def __init__(self, path: str):
        self.path, self.stage = path, f"{path}/.staged-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[Row]) -> Parts:
        os.makedirs(self.stage, exist_ok=True)
        done: list[tuple[str, int, str]] = []
        out = None
        try:
            for r in iterator:
                if not done or done[-1][:2] != (r.bundle, r.part):
                    _close(out)
                    done.append((r.bundle, r.part, f"{self.stage}/{uuid.uuid4().hex}"))
                    out = gzip.GzipFile("", "wb", 6, open(done[-1][2], "wb"), mtime=0)  # noqa: SIM115  a name would differ from run to run
                out.write(member(r.name, bytes(r.content)))
        finally:
            _close(out)
        return Parts(done)

    def commit(self, messages: list[Parts | None]) -> None:
        parts = sorted(f for m in messages if m for f in m.files)
        for bundle in sorted({b for b, _, _ in parts}):
            path, digest = f"{self.stage}/{bundle}", hashlib.sha256()
            with open(path, "wb") as out:
                for piece in [*(_chunks(f) for b, _, f in parts if b == bundle), [gzip.compress(b"\0" * tarfile.RECORDSIZE, mtime=0)]]:
                    for chunk in piece:
                        digest.update(chunk)
                        out.write(chunk)
            about = {"fileName": f"{bundle}.tar.gz", "bytes": os.path.getsize(path), "sha256": digest.hexdigest()}
            os.replace(path, f"{self.path}/{bundle}.tar.gz")
            with open(f"{self.path}/{bundle}.tar.gz.json", "w") as f:
                json.dump(about, f)
        shutil.rmtree(self.stage, ignore_errors=True)

    def abort(self, messages: list[Parts | None]) -> None:  # noqa: ARG002
        shutil.rmtree(self.stage, ignore_errors=True)


def _close(out: gzip.GzipFile | None) -> None:
    if out is not None:
        file = out.fileobj
        out.close()
        file.close()


def _chunks(path: str) -> Iterator[bytes]:
    with open(path, "rb") as f:
        while chunk := f.read(1 << 20):
            yield chunk


def pack_files(spark: SparkSession, folder: str, content: bool = False) -> DataFrame:
    """(name, bytes, sha256) of a folder's usable files, and their content if asked for; names are relative to it."""
    files = usable(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)).select("path", "content")
    empty = spark.createDataFrame([(p, b"") for p in empty_files(spark, folder)], "path string, content binary")
    files = files.unionByName(empty).where(~F.regexp_extract("path", "([^/]+)$", 1).rlike(r"^[._]|\.crc$"))
    name = F.substr("path", F.lit(len(qualified(spark, folder)) + 2))
    return files.select(name.alias("name"), F.octet_length("content").cast("long").alias("bytes"), F.sha2("content", 256).alias("sha256"), *(["content"] if content else []))


def of_bundles(files: DataFrame, bundles: dict[str, list[str]]) -> DataFrame:
    """files with bundle, a row for each bundle one of whose prefixes starts the name."""
    groups = [F.when(F.coalesce(*[F.nullif(F.col("name").startswith(p), F.lit(False)) for p in prefixes]), F.lit(b)) for b, prefixes in bundles.items()]
    return files.withColumn("bundle", F.explode(F.array_compact(F.array(*groups))))


def build(spark: SparkSession, folder: str, out: str, bundles: dict[str, list[str]] | None = None, facts: dict | None = None, prefix: str = "packs", part: int = PART) -> dict:
    """Writes an archive for each bundle of a folder's files, and an index of them; returns the index.

    bundles: name -> prefixes of the files' names; all files are one bundle otherwise. A bundle without a file is an error. The
    index has `facts`, and for each bundle its archive's bytes and SHA-256 and its files with theirs; run anew it is the same.
    """
    bundles = bundles or {"all": [""]}
    spark.dataSource.register(ArchiveSink)
    placed = of_bundles(pack_files(spark, folder), bundles)
    placed = running_total(placed, ["bundle", "name"], F.col("bytes") + 2 * tarfile.BLOCKSIZE).withColumn("part", F.floor(F.col("total") / part).cast("int"))
    listed = {r.bundle: [f.asDict() for f in r.files] for r in placed.groupBy("bundle").agg(F.array_sort(F.collect_list(F.struct(F.col("name").alias("path"), "bytes", "sha256"))).alias("files")).collect()}
    if missing := sorted(set(bundles) - set(listed)):
        raise ValueError(f"no files for {missing}")
    os.makedirs(local(out), exist_ok=True)
    rows = pack_files(spark, folder, content=True).select("name", "content").join(placed.select("bundle", "part", "name"), "name")
    rows = rows.select("bundle", "part", F.concat(F.lit(f"{prefix}/"), "name").alias("name"), "content")
    rows.repartition("bundle", "part").sortWithinPartitions("bundle", "part", "name").write.format("archive").option("path", out).mode("append").save()
    made = []
    for bundle, files in sorted(listed.items()):
        with open(f"{local(out)}/{bundle}.tar.gz.json") as f:
            made.append({"id": bundle, **json.load(f), "pathPrefix": prefix, "fileCount": len(files), "files": files})
    index = {"schemaVersion": 1, **(facts or {}), "bundles": made}
    with open(f"{local(out)}/packs-index.json", "w") as f:
        json.dump(index, f, ensure_ascii=False, indent=2)
    return index


def first_usable(spark: SparkSession, *candidates: str) -> str | None:
    """The first path that holds a usable file; what is missing, or points to large-file storage only, is passed over."""
    there = [(k, c) for k, c in enumerate(candidates) if exists(spark, c)]
    of = lambda c: usable(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(c)).select(F.lit(1).alias("x")).limit(1)
    empty = spark.createDataFrame([(k,) for k, c in there if empty_files(spark, c)], "k int")
    return reduce(DataFrame.unionByName, [of(c).select(F.lit(k).alias("k")) for k, c in there], empty).agg(F.min_by(F.element_at(F.array(*map(F.lit, candidates)), F.col("k") + 1), "k")).first()[0]
