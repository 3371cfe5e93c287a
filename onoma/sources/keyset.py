"""Harvests as streams: the offset is the last key, and a batch holds whole keys.

A batch is planned by keys alone: from the last key on, so many keys are asked for, and cut into ranges (after, upto]. A
range is read by one task, and read again after a failure it gives the same rows. No key is cut, so rows that belong to
one key are merged within their batch, and no state outlives it.
"""

from __future__ import annotations

import json
from abc import ABC, abstractmethod
from collections.abc import Iterator

from pyspark.sql.datasource import DataSourceStreamReader, InputPartition


class Pages(ABC):
    """What a source must answer; keys are strings or integers, in the source's own order. It travels to the tasks."""

    @abstractmethod
    def keys(self, after: str | int | None, most: int) -> list[str | int]:
        """The next different keys, `most` at most, after a key or from the first."""

    @abstractmethod
    def rows(self, after: str | int | None, upto: str | int | None) -> Iterator[tuple]:
        """All rows of the keys after the one and up to the other; None: no bound."""


class KeysetStream(DataSourceStreamReader):
    """Options: limit (keys of a range, 1000), ranges (of a batch, 4), batches (after which nothing new is reported; 0: no bound),
    offset (where an earlier run of the checkpoint stands, as `resumable.logged_offset` has it)."""

    def __init__(self, pages: Pages, options: dict[str, str]):
        self.pages, self.limit, self.ranges = pages, int(options.get("limit", 1000)), int(options.get("ranges", 4))
        self.left = int(options.get("batches", 0)) or -1
        self.now = json.loads(options["offset"]) if options.get("offset") else self.initialOffset()

    def initialOffset(self) -> dict:
        return {"after": "null", "cuts": "[]"}

    def latestOffset(self) -> dict:
        """The next batch's end, with the cuts of its ranges, so that they are the same when it is read again."""
        found = self.pages.keys(json.loads(self.now["after"]), self.limit * self.ranges) if self.left else []
        if found:
            self.left -= 1
            self.now = {"after": json.dumps(found[-1]), "cuts": json.dumps([*found[self.limit - 1 : -1 : self.limit], found[-1]])}
        return self.now

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        cuts = [json.loads(start["after"]), *json.loads(end["cuts"])]
        return [] if start == end else [InputPartition(x) for x in zip(cuts[:-1], cuts[1:], strict=True)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield from self.pages.rows(*partition.value)
