"""Scans that go on where they stopped, by Structured Streaming's file offsets."""

from __future__ import annotations

import contextlib
import hashlib
import json
import signal
from collections.abc import Callable, Iterator
from datetime import datetime, timezone
from threading import Event, Thread, current_thread, main_thread

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from onoma.operators.storage import exists
from onoma.sources import binary


def fingerprint(settings: dict) -> str:
    return hashlib.sha256(json.dumps(settings, sort_keys=True).encode()).hexdigest()


def check_settings(spark: SparkSession, checkpoint: str, settings: dict) -> None:
    """A checkpoint only goes on with the settings that it began with."""
    path, now = f"{checkpoint}-settings", fingerprint(settings)
    if not exists(spark, path):
        spark.range(1).select(F.lit(now).alias("value")).coalesce(1).write.text(path)
    elif spark.read.text(path).first()[0] != now:
        raise ValueError("the checkpoint belongs to other settings")


@contextlib.contextmanager
def on_signals(*signals: signal.Signals) -> Iterator[Event]:
    """An event that SIGINT or SIGTERM sets, instead of ending the process; the old handlers come back. In the main thread only."""
    stop, old = Event(), {}
    if current_thread() is main_thread():
        old = {s: signal.signal(s, lambda *_: stop.set()) for s in signals or (signal.SIGINT, signal.SIGTERM)}
    try:
        yield stop
    finally:
        for s, handler in old.items():
            signal.signal(s, handler)


def run_out(query: StreamingQuery, stop: Event | None = None) -> bool:
    """Waits until a query has nothing left to read, or, once `stop` is set, until its running batch has ended, and stops it; whether it was stopped.

    A batch that begins meanwhile is broken off: either it was not committed, and runs again when the query goes on, or it was, and is
    only missing from the run's figures.
    """
    failed: list[Exception] = []

    def wait() -> None:
        try:
            query.processAllAvailable()
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    waiting = Thread(target=wait, daemon=True)
    waiting.start()
    while waiting.is_alive() and not (stop and stop.is_set()):
        waiting.join(0.2)
    stopped, done = waiting.is_alive(), lambda: len(query.recentProgress)
    before = done()
    while waiting.is_alive() and query.isActive and done() == before:
        waiting.join(0.2)
    query.stop()
    waiting.join()
    if failed and not stopped:
        raise failed[0]
    return stopped


def extract(
    spark: SparkSession, source: str, transform: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str, settings: dict, files_per_batch: int = 100,
    schema: str | None = None, fmt: str = "text", bytes_per_batch: int | None = None, stop: Event | None = None,
) -> dict:
    """Reads what is new in a folder, transforms it and appends it to a Parquet table; each file counts exactly once.

    A batch, after which the position is kept, has so many files, or so many bytes if that is given. stop: an event
    that ends the run after its batch, as on_signals gives it; another run goes on from there. Returns the run's figures, which are
    also kept beside the checkpoint, a line a run.
    """
    check_settings(spark, checkpoint, settings)
    began = datetime.now(timezone.utc)
    bound = ("maxBytesPerTrigger", bytes_per_batch) if bytes_per_batch else ("maxFilesPerTrigger", files_per_batch)
    reader = spark.readStream.format(fmt).option(*bound)
    rows = transform((reader.schema(schema) if schema else reader).load(source))
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(kept, max(1_000_000, int(spark.conf.get(kept))))  # all batches are counted below
    query = rows.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    stopped = run_out(query, stop)
    return log_run(spark, checkpoint, began, settings, {**figures(query), "interrupted": stopped})


def figures(query: StreamingQuery) -> dict:
    done = [p for p in query.recentProgress if p["numInputRows"]]
    return {"rows_in": sum(p["numInputRows"] for p in done), "batches": len(done)}


def log_run(spark: SparkSession, checkpoint: str, began: datetime, settings: dict, found: dict) -> dict:
    """Adds a line of JSON to the runs beside a checkpoint."""
    run = {"startedAt": began.isoformat(), "finishedAt": datetime.now(timezone.utc).isoformat(), "settings": settings, **found}
    spark.createDataFrame([(json.dumps(run, ensure_ascii=False, default=str),)], "value string").coalesce(1).write.mode("append").text(f"{checkpoint}-runs")
    return found


# --- harvests by key ---------------------------------------------------------------------------------------------------


def logged_offset(spark: SparkSession, checkpoint: str) -> str:
    """The newest offset in a checkpoint's log, as JSON; '' before the first batch."""
    path = f"{checkpoint}/offsets"
    if not exists(spark, path):
        return ""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").try_cast("long").alias("batch"))
    newest = lines.where(F.col("batch").isNotNull() & F.col("value").contains('"cuts"')).orderBy(F.desc("batch")).first()
    return newest.value if newest else ""


def harvest_stream(
    spark: SparkSession, fmt: str, options: dict[str, str], sink: str, checkpoint: str, merge: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    settings: dict | None = None, batches: int = 0, stop: Event | None = None,
) -> dict:
    """Harvests a source of whole keys (sparql, or a table of sqlite) behind the last key of the checkpoint, until it has no more.

    `merge` makes a batch's rows from what it read; since a batch has all rows of its keys, it may group by key. A batch is written
    under batch=n, anew if it has to run again, so every key counts once. batches: after which the run ends (0: none); stop: ends it
    after its batch. Returns and keeps the run's figures, as extract does, with the last key.
    """
    binary.register(spark)
    check_settings(spark, checkpoint, settings or {})
    began, before = datetime.now(timezone.utc), logged_offset(spark, checkpoint)
    rows = spark.readStream.format(fmt).options(**options).option("offset", before).option("batches", batches).load()
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(kept, max(1_000_000, int(spark.conf.get(kept))))
    put = lambda batch, n: merge(batch).write.mode("overwrite").parquet(f"{sink}/batch={n}")
    query = rows.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start()
    stopped = run_out(query, stop)
    after = logged_offset(spark, checkpoint)
    last = json.loads(json.loads(after)["after"]) if after else None
    return log_run(spark, checkpoint, began, settings or {}, {**figures(query), "lastKey": last, "resumed": bool(before), "interrupted": stopped})


def position(spark: SparkSession, sink: str, key: str):  # noqa: ANN201
    """The largest key of a sink; None if it holds nothing."""
    if not exists(spark, sink):
        return None
    try:
        return spark.read.parquet(sink).agg(F.max(key)).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":  # a folder without a file
            raise
        return None


def harvest(page: Callable[[object, int], DataFrame], key: str, sink: str, limit: int, after=None) -> int:  # noqa: ANN001
    """Appends pages after the key of the last, until one is short; returns the number of pages.

    It goes on from `after`, or from the largest key in the sink. A page must hold all rows of its last key, as those of
    keyset_page do: the next begins strictly after it.
    """
    pages = 0
    after = position(SparkSession.active(), sink, key) if after is None else after
    while True:
        got = page(after, limit).cache()
        n, last = got.agg(F.count("*"), F.max(key)).first()
        if n:
            got.write.mode("append").parquet(sink)
            pages, after = pages + 1, last
        got.unpersist()
        if n < limit or last is None:
            return pages
