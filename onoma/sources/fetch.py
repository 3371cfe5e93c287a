"""Upstream files: downloads side by side into a shared folder, and the lines of zip archives.

The folder must be one that the driver and all executors see. A file appears under its name only when it is whole.
"""

from __future__ import annotations

import hashlib
import io
import os
import re
import time
import urllib.error
import urllib.request
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from onoma.sources.sqlite import local

#: Lines of a batch, and bytes of a read.
LINES, CHUNK = 10_000, 1 << 20


def digest_of(path: str) -> tuple[int, str]:
    """(bytes, SHA-256) of a file."""
    found, n = hashlib.sha256(), 0
    with open(path, "rb") as f:
        while chunk := f.read(CHUNK):
            found.update(chunk)
            n += len(chunk)
    return n, found.hexdigest()


def download(url: str, path: str, sha256: str | None, attempts: int, wait: float) -> tuple[int, str, int]:
    """(bytes, SHA-256, requests made); a file that is there with the right digest is not asked for again.

    After a network error, a status that may pass (429 or from 500 on) or a wrong digest it asks again, each time after twice the
    wait, or after what the server's Retry-After says; other statuses, and the last failure, are errors.
    """
    if sha256 and os.path.exists(path) and (known := digest_of(path))[1] == sha256:
        return *known, 0
    for attempt in range(1, attempts + 1):
        part, pause = f"{path}.part-{uuid.uuid4().hex}", wait * 2 ** (attempt - 1)
        try:
            with urllib.request.urlopen(url, timeout=120) as r, open(part, "wb") as out:
                while chunk := r.read(CHUNK):
                    out.write(chunk)
            n, digest = digest_of(part)
            if sha256 and digest != sha256:
                raise OSError(f"{url} has the digest {digest}, not {sha256}")
            os.replace(part, path)
            return n, digest, attempt
        except urllib.error.HTTPError as e:
            if e.code != 429 and e.code < 500 or attempt == attempts:
                raise RuntimeError(f"{url}: status {e.code} after {attempt} requests") from e
            said = e.headers.get("Retry-After", "")
            pause = float(said) if re.fullmatch(r"\d+", said) else pause
        except OSError as e:
            if attempt == attempts:
                raise RuntimeError(f"{url}: no file after {attempt} requests: {e}") from e
        finally:
            if os.path.exists(part):
                os.remove(part)
        time.sleep(pause)
    raise AssertionError


def fetch(wanted: DataFrame, folder: str, attempts: int = 5, wait: float = 1.0) -> list[Row]:
    """wanted: (url, name, sha256, null if unknown) -> (name, bytes, sha256, requests), when all files are in the folder."""
    at = local(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                path = os.path.join(at, r["name"])
                os.makedirs(os.path.dirname(path), exist_ok=True)
                n, digest, asked = download(r["url"], path, r["sha256"], attempts, wait)
                yield pa.RecordBatch.from_pylist([{"name": r["name"], "bytes": n, "sha256": digest, "requests": asked}])

    rows = wanted.select("url", "name", "sha256").repartition("url").mapInArrow(run, "name string, bytes long, sha256 string, requests long")
    return rows.collect()  # a row per file


def zip_lines(spark: SparkSession, path: str, member: str = "") -> DataFrame:
    """(file, member, value): the lines of the members of zip archives whose names the regular expression is found in.

    An archive is read by one task, which holds a batch of lines at a time and, in a store that is no mounted folder, the archive (2 GiB at most).
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).where(F.lower("path").endswith(".zip"))
    mounted = F.col("path").startswith("file:")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                with zipfile.ZipFile(local(r["path"]) if r["content"] is None else io.BytesIO(r["content"])) as z:
                    for info in z.infolist():
                        if info.is_dir() or not re.search(member, info.filename):
                            continue
                        with z.open(info) as f:
                            held: list[str] = []
                            for line in io.TextIOWrapper(f, "utf-8", "replace", newline="\n"):
                                held.append(line.rstrip("\n").removesuffix("\r"))
                                if len(held) == LINES:
                                    yield _lines(r["path"], info.filename, held)
                                    held = []
                            if held:
                                yield _lines(r["path"], info.filename, held)

    shapes = [files.where(mounted).select("path", F.lit(None).cast("binary").alias("content")), files.where(~mounted).select("path", "content")]
    return shapes[0].unionByName(shapes[1]).mapInArrow(run, "file string, member string, value string")


def _lines(path: str, member: str, held: list[str]) -> pa.RecordBatch:
    n = len(held)
    return pa.RecordBatch.from_arrays([pa.array([path] * n), pa.array([member] * n), pa.array(held)], ["file", "member", "value"])
