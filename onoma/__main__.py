"""Commands: python -m onoma COMMAND --help. Each runs one entry point of plans.api and prints what it returns as JSON."""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Callable
from threading import Event

from pyspark.sql import DataFrame, SparkSession

from onoma.operators import config, patterns
from onoma.plans import api
from onoma.sinks import bundles
from onoma.sources import files, sqlite
from onoma.streaming import resumable

Run = Callable[[SparkSession, argparse.Namespace, Event], object]
COMMANDS: dict[str, tuple[str, list[str], Run]] = {}


def command(name: str, said: str, *flags: str):  # noqa: ANN201
    """Registers a command; flags are names, with ! if they must be given, * for lists, # for numbers, ? for switches."""

    def put(run: Run) -> Run:
        COMMANDS[name] = (said, list(flags), run)
        return run

    return put


def _crosswalk(spark: SparkSession, path: str | None, left: str, right: str) -> DataFrame | None:
    """(left, right) of a crosswalk's table."""
    return files.tsv(spark, path).selectExpr(f"{left[1]} AS {left[0]}", f"{right[1]} AS {right[0]}") if path else None


_SIDES = ("chgis", "chgis_sys_id"), ("dila", "dila_pl_id")


@command("compile-snapshot", "packs of a relational snapshot", "sqlite!", "out!")
def _(spark, a, stop):
    return api.compile_snapshot(spark, a.sqlite, a.out)


@command("sample-snapshot", "a small database of some persons of a snapshot", "sqlite!", "out!", "persons*")
def _(spark, a, stop):
    return api.snapshot_sample(spark, a.sqlite, a.out, [int(p) for p in a.persons])


@command("compile-lists", "packs of TEI lists", "persons!", "places!", "out!", "districts", "crosswalk", "snapshot")
def _(spark, a, stop):
    dynasties = None
    if a.snapshot:
        sqlite.register(spark)
        dynasties = sqlite.table(spark, a.snapshot, "DYNASTIES", *api.SNAPSHOT_COLUMNS["DYNASTIES"])
    return api.compile_lists(spark, a.persons, a.places, a.out, a.districts, _crosswalk(spark, a.crosswalk, *_SIDES), dynasties)


@command("compile-points", "a pack of point layers", "input!", "out!", "snapshot", "crosswalk")
def _(spark, a, stop):
    links = _crosswalk(spark, a.crosswalk, *_SIDES)
    return api.compile_points(spark, a.input, a.out, dila=links.dropDuplicates(["chgis"]) if links is not None else None, snapshot=a.snapshot)


@command("places-tsv", "places of a pack as a table for crosswalks", "pack!", "out!")
def _(spark, a, stop):
    api.places_tsv(spark.read.json(a.pack), a.out)


@command("crosswalk", "matches of two packs of places by name and position", "left!", "right!", "out!")
def _(spark, a, stop):
    return api.crosswalk_places(spark.read.json(a.left), spark.read.json(a.right), a.out)


@command("extract", "raw rows of a dump", "dump!", "out!", "kinds!", "languages*", "membership", "dynasties*", "priority?", "country", "max#")
def _(spark, a, stop):
    got = api.extract_selection(spark, a.dump, a.kinds, a.languages, a.out, a.membership or "label-only", a.dynasties, a.priority, a.country, most=a.max)
    return [r.asDict() for r in got.collect()]


@command("extract-new", "raw rows of what is new in a folder of dump files; stops after a batch when interrupted", "dump!", "out!", "checkpoint!", "kinds!", "languages*", "membership", "dynasties*", "priority?", "country", "files#", "bytes#")
def _(spark, a, stop):
    mode = a.membership or "label-only"
    qids, _ = config.selection(mode, a.dynasties, a.priority, a.country)
    return api.extract_resumable(spark, a.dump, a.kinds, a.languages, a.out, a.checkpoint, membership=mode, qids=qids or None, files_per_batch=a.files or 100, bytes_per_batch=a.bytes, stop=stop)


@command("compile-persons", "packs of persons by dynasty and before the Ming", "raw!", "out!", "language!", "dynasties*", "pre-ming?")
def _(spark, a, stop):
    return api.compile_graph_all(api.raw_of(spark, a.raw, a.language, "person"), a.language, a.out, a.dynasties or None, a.pre_ming)


@command("compile-country", "a pack of a country's persons", "raw!", "out!", "language!", "country!")
def _(spark, a, stop):
    _, qid, label = config.selected_country(a.country)
    return api.compile_graph_country(api.raw_of(spark, a.raw, a.language, "person"), qid, label, a.out)


@command("compile-language", "packs of a language by label alone", "raw!", "out!", "language!", "kinds!")
def _(spark, a, stop):
    return api.compile_graph_language({k: api.raw_of(spark, a.raw, a.language, k) for k in api.parse_kinds(a.kinds)}, a.language, a.out)


@command("report", "the strings that name most entities of a pack", "pack!", "out!", "limit#")
def _(spark, a, stop):
    return api.report(spark.read.json(a.pack), a.out, limit=a.limit or 100)


@command("policy-report", "what the name policy does to raw persons", "raw!", "out!", "language!")
def _(spark, a, stop):
    return api.policy_report(api.raw_of(spark, a.raw, a.language, "person"), a.out, {"language": a.language})


@command("export-ime", "readings of raw persons of a catalogue, or of the graph, for input methods", "raw!", "out!", "language")
def _(spark, a, stop):
    if a.language:
        api.export_graph_ime(api.raw_of(spark, a.raw, a.language, "person"), a.out)
    else:
        api.export_ime(api.harvested(spark, a.raw), "authorityId", "name", a.out)


@command("build-closure", "classes below the kinds' roots, from a table of triples", "triples!", "out!")
def _(spark, a, stop):
    found = api.kind_closure(spark.read.parquet(a.triples))
    rows = [(k, i, e) for k, (i, e) in found.items()]
    spark.createDataFrame(rows, "kind string, included array<string>, excluded array<string>").coalesce(1).write.mode("overwrite").json(a.out)
    return {k: {"included": len(i), "excluded": len(e)} for k, i, e in rows}


@command("validate", "checks of the dimensions")
def _(spark, a, stop):
    if found := api.validate_config():
        sys.exit("\n".join(found))
    return "valid"


@command("sparql", "the query of a count, page or sample of a catalogue's kind", "kind!", "what!", "prefix", "limit#")
def _(spark, a, stop):
    tree = patterns.authorities(a.kind, f"^{a.prefix}" if a.prefix else None)
    if a.what == "count":
        return patterns.count(tree, "entity" if a.kind == "person" else "auth")
    return patterns.select(tree, *patterns.asked(a.kind), order="name" if a.what == "sample" else "auth", limit=a.limit or 20)


@command("harvest", "a catalogue's raw rows from an endpoint; goes on from its checkpoint, stops after a batch when interrupted", "kind!", "endpoint!", "out!", "checkpoint!", "limit#", "ranges#", "batches#", "delay#")
def _(spark, a, stop):
    return api.harvest_catalogue(spark, a.kind, a.endpoint, a.out, a.checkpoint, a.limit or 1000, a.ranges or 4, 0.3 if a.delay is None else a.delay, a.batches or 0, stop)


@command("parse-works", "raw rows of a file of works", "input!", "out!", "limit#")
def _(spark, a, stop):
    return api.parse_works(spark, a.input, a.out, a.limit)


@command("compile-catalogue", "a pack of a catalogue's raw rows", "raw!", "out!", "kind!")
def _(spark, a, stop):
    raw = spark.read.json(a.raw) if a.kind == "work" else api.harvested(spark, a.raw)
    return api.compile_catalogue(raw, a.kind, a.out)


@command("bundle", "archives of a folder of packs, and their index; --regions name=prefix,prefix", "packs!", "out!", "regions*")
def _(spark, a, stop):
    regions = {k: v.split(",") for k, _, v in (r.partition("=") for r in a.regions)}
    index = api.build_bundles(spark, a.packs, a.out, regions or None)
    return {b["id"]: {k: b[k] for k in ("fileName", "bytes", "sha256", "fileCount")} for b in index["bundles"]}


@command("first-usable", "the first of some paths that holds a usable file", "paths*")
def _(spark, a, stop):
    return bundles.first_usable(spark, *a.paths)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser("onoma", description=__doc__)
    each = top.add_subparsers(dest="command", required=True)
    for name, (said, flags, _) in COMMANDS.items():
        p = each.add_parser(name, help=said, description=said)
        for flag in flags:
            bare, last = flag.rstrip("!*#?"), flag[-1]
            more: dict = {"!": {"required": True}, "*": {"nargs": "*", "default": []}, "#": {"type": float if bare == "delay" else int}, "?": {"action": "store_true"}}.get(last, {})
            p.add_argument(f"--{bare}", **more)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """130 after an interrupted run, whose batch was finished; else 0."""
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"onoma {a.command}").getOrCreate()
    with resumable.on_signals() as stop:
        got = COMMANDS[a.command][2](spark, a, stop)
    print(got if isinstance(got, str) else json.dumps(got, ensure_ascii=False, default=str))
    return 130 if isinstance(got, dict) and got.get("interrupted") else 0


if __name__ == "__main__":
    sys.exit(main())
