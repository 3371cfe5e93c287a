"""Point shapefiles, and the registration of all formats."""

from __future__ import annotations

import os
import struct

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from onoma.sources import sparql, sqlite
from onoma.sources.sqlite import cell  # noqa: F401


def discover(root: str) -> list[str]:
    """Shapefiles below a folder, sorted, each once; folders that cannot be read are passed over."""
    found = {os.path.join(d, f) for d, _, files in os.walk(root, onerror=lambda _: None) for f in files if f.lower().endswith(".shp")}
    return sorted(found)


def shapes(path: str) -> list[tuple[int, float | None, float | None]]:
    """(shape type, x, y) of each record; other shapes than points have no coordinates."""
    with open(path, "rb") as f:
        data = f.read()
    at, out = 100, []
    while at + 12 <= len(data):
        size = 2 * struct.unpack(">i", data[at + 4 : at + 8])[0]
        kind = struct.unpack("<i", data[at + 8 : at + 12])[0]
        point = struct.unpack("<2d", data[at + 12 : at + 28]) if kind in (1, 11, 21) else (None, None)
        out.append((kind, *point))
        at += 8 + size
    return out


def attributes(path: str) -> list[dict[str, str]]:
    """Rows of a dBASE table, trimmed, UTF-8."""
    with open(path, "rb") as f:
        data = f.read()
    n, head, size = struct.unpack("<IHH", data[4:12])
    fields, at = [], 32
    while data[at] != 0x0D:
        fields.append((data[at : at + 11].split(b"\0")[0].decode(), data[at + 16]))
        at += 32
    rows = []
    for k in range(n):
        rec, pos, row = data[head + k * size : head + (k + 1) * size], 1, {}
        for name, width in fields:
            row[name], pos = rec[pos : pos + width].decode("utf-8", "replace").strip(), pos + width
        rows.append(row)
    return rows


class ShapefileSource(DataSource):
    """format("shapefile"): option path, a folder; a row per record, one partition per file."""

    @classmethod
    def name(cls) -> str:
        return "shapefile"

    def schema(self) -> str:
        return "layer string, shape int, lat double, lon double, attributes map<string,string>"

    def reader(self, schema: StructType) -> DataSourceReader:
        return ShapefileReader(self.options["path"])


class ShapefileReader(DataSourceReader):
    def __init__(self, root: str):
        self.files = discover(root)

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(f) for f in self.files]

    def read(self, partition: InputPartition):  # noqa: ANN201
        base = os.path.splitext(partition.value)[0]
        dbf = next(p for p in (f"{base}.dbf", f"{base}.DBF") if os.path.exists(p))
        for (kind, x, y), row in zip(shapes(partition.value), attributes(dbf), strict=True):
            yield os.path.basename(base), kind, y, x, row


def register(spark: SparkSession) -> None:
    """Also the formats of the other modules."""
    spark.dataSource.register(ShapefileSource)
    sqlite.register(spark)
    sparql.register(spark)
