"""SPARQL endpoints: requests with retries, pages by key, in batch or as a stream; a row is a page of whole keys, as result JSON."""

from __future__ import annotations

import csv
import io
import json
import time
import urllib.parse
import urllib.request
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql.types import StructType

from onoma.sources.keyset import KeysetStream, Pages

#: Media types of the result formats.
ACCEPT = {"json": "application/sparql-results+json", "csv": "text/csv"}
Binding = dict[str, dict[str, str]]


def csv_bindings(text: str) -> list[Binding]:
    """Rows of a CSV result, quotes and line breaks in cells included; an empty cell is an unbound variable."""
    rows = csv.reader(io.StringIO(text, newline=""))
    names = [n.removeprefix("﻿") for n in next(rows, [])]
    kind = lambda v: "uri" if v.startswith(("http://", "https://", "urn:")) else "literal"
    return [{n: {"type": kind(v), "value": v} for n, v in zip(names, row, strict=False) if v != ""} for row in rows if row]


def json_bindings(text: str) -> list[Binding]:
    """Rows of a JSON result; a report of an error, which may come with status 200, is a ValueError."""
    found = json.loads(text)
    if not isinstance(found, dict) or "bindings" not in found.get("results", {}):
        raise ValueError(f"the endpoint reports an error: {text[:500]}")
    return found["results"]["bindings"]


def result(rows: list[Binding]) -> str:
    return json.dumps({"results": {"bindings": rows}}, ensure_ascii=False)


class Endpoint(Pages):
    """Options: endpoint; query, with {bounds} and {limit}; key, a variable; limit (bindings of a request, 1000).

    method: get or post; format: json or csv; retries (3) and backoff (2 seconds, times the attempt) after network errors and error
    reports; delay (seconds between a task's requests); keys: a query for different keys alone, with {bounds} and {limit}, by
    which a stream's batches are planned more cheaply.
    """

    def __init__(self, options: dict[str, str]):
        self.options = dict(options)
        self.limit, self.key = int(options.get("limit", 1000)), options.get("key")

    def ask(self, query: str) -> list[Binding]:
        o = self.options
        kind, tries = o.get("format", "json"), int(o.get("retries", 3))
        body = urllib.parse.urlencode({"query": query, "format": kind})
        post = o.get("method", "get").lower() == "post"
        request = urllib.request.Request(o["endpoint"] if post else f"{o['endpoint']}?{body}", data=body.encode() if post else None, headers={"Accept": ACCEPT[kind], "User-Agent": o.get("agent", "onoma")})
        for attempt in range(1, tries + 1):
            try:
                with urllib.request.urlopen(request, timeout=float(o.get("timeout", 120))) as r:
                    text = r.read().decode()
                if kind == "csv" and text.lstrip()[:1] in ("{", "<"):
                    raise ValueError(f"the endpoint reports an error: {text[:500]}")
                return csv_bindings(text) if kind == "csv" else json_bindings(text)
            except (OSError, ValueError) as e:
                if attempt == tries:
                    raise RuntimeError(f"no result after {tries} requests: {e}") from e
                time.sleep(float(o.get("backoff", 2)) * attempt)
        raise AssertionError

    def page(self, template: str, after: str | None, upto: str | None, limit: int) -> list[Binding]:
        bounds = [f"FILTER (?{self.key} {op} <{v}>)" for op, v in ((">", after), ("<=", upto)) if v]
        return self.ask(template.replace("{bounds}", " ".join(bounds)).replace("{limit}", str(limit)))

    def keys(self, after: str | None, most: int) -> list[str]:
        template, found = self.options.get("keys"), []
        while len(found) < most:
            rows = self.page(template or self.options["query"], after, None, most - len(found) if template else self.limit)
            new = list(dict.fromkeys(r[self.key]["value"] for r in rows))
            found += new[: most - len(found)]
            if template or len(rows) < self.limit or not new:
                break
            after = new[-1]
        return found

    def rows(self, after: str | None, upto: str | None) -> Iterator[tuple[str]]:
        """A page's last key may go on behind the page, so it comes with the next; one that alone fills a page is asked for with a higher limit."""
        if self.key is None:
            yield (result(self.page(self.options["query"], None, None, self.limit)),)
            return
        limit, alone = self.limit, 0
        while True:
            got = self.page(self.options["query"], after, upto, limit)
            if len(got) < limit:
                if alone and len(got) <= alone and len(self.page(self.options["query"], None, None, alone + 1)) <= alone:  # it never gives more
                    raise RuntimeError(f"the endpoint gives {len(got)} bindings at most, fewer than {got[-1][self.key]['value']} has")
                if got:
                    yield (result(got),)
                return
            last = got[-1][self.key]["value"]
            whole = [b for b in got if b[self.key]["value"] != last]
            if whole:
                yield (result(whole),)
                after, limit, alone = whole[-1][self.key]["value"], self.limit, 0
            else:
                limit, alone = 2 * limit, len(got)
            time.sleep(float(self.options.get("delay", 0)))


class SparqlSource(ds.DataSource):
    """format("sparql"): the options of Endpoint; streams also take those of KeysetStream. Without a key, one request's rows.

    A batch scan's pages follow one another, so one task reads them; a stream's ranges are read side by side.
    """

    @classmethod
    def name(cls) -> str:
        return "sparql"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema: StructType) -> ds.DataSourceReader:  # noqa: ARG002
        return SparqlReader(Endpoint(self.options), self.options.get("after"))

    def streamReader(self, schema: StructType) -> ds.DataSourceStreamReader:  # noqa: ARG002, N802
        return KeysetStream(Endpoint(self.options), dict(self.options))


class SparqlReader(ds.DataSourceReader):
    def __init__(self, endpoint: Endpoint, after: str | None):
        self.endpoint, self.after = endpoint, after

    def read(self, partition: ds.InputPartition) -> Iterator[tuple[str]]:  # noqa: ARG002
        return self.endpoint.rows(self.after, None)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SparqlSource)
