"""Graph patterns as trees: joined over a local table of triples (s, p, o, lang), or written out as SPARQL for an endpoint.

A group's patterns are inner joins on the variables they share, its optional groups left joins, its MINUS groups anti joins,
its VALUES a semi join with fixed terms. A group may nest; what it shares with the group above are its join keys.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onoma.operators.relational import closure

#: Prefixes of catalogues' vocabularies.
PREFIXES = {
    "foaf": "http://xmlns.com/foaf/0.1/", "xl": "http://www.w3.org/2008/05/skos-xl#", "ndl": "http://ndl.go.jp/dcndl/terms/", "rda": "http://RDVocab.info/ElementsGr2/",
    "wd": "http://www.wikidata.org/entity/", "wdt": "http://www.wikidata.org/prop/direct/", "skos": "http://www.w3.org/2004/02/skos/core#", "scheme": "http://id.ndl.go.jp/auth#", "rdfs": "http://www.w3.org/2000/01/rdf-schema#",
}


@dataclass(frozen=True)
class Triple:
    """Subject and object are variables (?x) or terms, the predicate is a term or a path a/b*; lang: of the object's literal."""

    s: str
    p: str
    o: str
    lang: str | None = None

    @property
    def variables(self) -> list[str]:
        return [x[1:] for x in dict.fromkeys((self.s, self.o)) if x.startswith("?")]


@dataclass(frozen=True)
class Group:
    """matches, lacks: (variable, regular expression) that its text must, or must not, contain; values: (variable, terms)."""

    patterns: tuple[Triple, ...]
    optional: tuple[Group, ...] = ()
    minus: tuple[Group, ...] = ()
    matches: tuple[tuple[str, str], ...] = ()
    lacks: tuple[tuple[str, str], ...] = ()
    values: tuple[tuple[str, tuple[str, ...]], ...] = ()

    @property
    def variables(self) -> list[str]:
        """Those it binds, in the order of their first mention."""
        return list(dict.fromkeys([v for p in self.patterns for v in p.variables] + [v for g in self.optional for v in g.variables]))


def predicates(group: Group) -> set[str]:
    return {x.rstrip("*") for p in group.patterns for x in p.p.split("/")}.union(*(predicates(g) for g in (*group.optional, *group.minus)))


def _scan(triples: DataFrame, pattern: Triple, values: dict[str, tuple[str, ...]]) -> DataFrame:
    """The pattern's variables as columns. A path a/b* ends in a fixed term, or in a variable that has fixed values."""
    step, _, path = pattern.p.partition("/")
    ok: Column = F.col("p") == step
    if path:
        ends = values.get(pattern.o[1:]) if pattern.o.startswith("?") else (pattern.o,)
        if not ends or not path.endswith("*"):
            raise ValueError(f"{pattern} has no fixed end, or is no path a/b*")
        edges = triples.where(F.col("p") == path[:-1]).select(F.col("s").alias("child"), F.col("o").alias("parent"))
        start = triples.sparkSession.createDataFrame([(e, e) for e in ends], "root string, node string")
        below = closure(edges, start).select(F.col("node").alias("o"), "root")
        triples = triples.where(ok).join(below, "o").select("s", "p", F.col("root").alias("o"), "lang")
    for column, term in (("s", pattern.s), ("o", pattern.o)):
        if not term.startswith("?"):
            ok &= F.col(column) == term
    if pattern.lang is not None:
        ok &= F.col("lang") == pattern.lang
    if pattern.s == pattern.o:
        ok &= F.col("s") == F.col("o")
    return triples.where(ok).select(*[F.col("s" if pattern.s == f"?{v}" else "o").alias(v) for v in pattern.variables])


def _connected(patterns: tuple[Triple, ...]) -> Iterator[Triple]:
    """The patterns in an order in which each shares a variable with those before; none does: an error."""
    rest, bound = list(patterns), set(patterns[0].variables)
    while rest:
        at = next((k for k, p in enumerate(rest) if bound & set(p.variables)), None)
        if at is None:
            raise ValueError(f"{rest[0]} shares no variable with the patterns before it")
        bound |= set(rest[at].variables)
        yield rest.pop(at)


def _keys(bound: list[str], have: list[str], part: Group) -> list[str]:
    """The variables by which a part joins the group above: those that both always bind."""
    own = list(dict.fromkeys(v for p in part.patterns for v in p.variables))
    keys = [v for v in own if v in bound]
    if not keys or any(v in have and v not in keys for v in part.variables):
        raise ValueError(f"the part of {part.patterns[0]} shares no variable with the group above, or one that is not always bound")
    return keys


def _solve(triples: DataFrame, group: Group) -> DataFrame:
    values = dict(group.values)
    first, *rest = _connected(group.patterns)
    rows = _scan(triples, first, values)
    for pattern in rest:
        rows = rows.join(_scan(triples, pattern, values), [v for v in pattern.variables if v in rows.columns])
    for name, terms in group.values:
        rows = rows.where(F.col(name).isin(list(terms)))
    for name, regex in group.matches:
        rows = rows.where(F.col(name).rlike(regex))
    for name, regex in group.lacks:
        rows = rows.where(~F.col(name).rlike(regex))
    bound = rows.columns
    for part in group.minus:
        keys = _keys(bound, bound, part)
        rows = rows.join(_solve(triples, part).select(*keys), keys, "left_anti")
    for part in group.optional:
        rows = rows.join(_solve(triples, part), _keys(bound, rows.columns, part), "left")
    return rows


def solve(triples: DataFrame, group: Group) -> DataFrame:
    """A row per solution, a column per variable, null where an optional group has none; solutions are a bag, as in SPARQL.

    triples: (s, p, o, lang), each once. Only those of the tree's predicates are read.
    """
    return _solve(triples.where(F.col("p").isin(sorted(predicates(group)))), group).select(*group.variables)


def page(triples: DataFrame, group: Group, key: str, after: str | None = None, limit: int | None = None) -> DataFrame:
    """Solutions of the first `limit` keys behind a key, each with all its rows, which are chosen before optional groups are joined."""
    required = replace(group, optional=())
    if limit is None:
        rows = solve(triples, group)
        return rows if after is None else rows.where(F.col(key) > after)
    some = solve(triples, required).select(key)
    some = (some if after is None else some.where(F.col(key) > after)).distinct().orderBy(key).limit(limit)
    return solve(triples, group).join(some, key, "left_semi")


# --- SPARQL text ----------------------------------------------------------------------------------------------------


def _literal(text: str) -> str:
    return '"' + text.replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n").replace("\r", "\\r") + '"'


def _lines(group: Group, depth: int) -> Iterator[str]:
    pad = "  " * depth
    for name, terms in group.values:
        yield f"{pad}VALUES ?{name} {{ {' '.join(terms)} }}"
    for p in group.patterns:
        yield f"{pad}{p.s} {p.p} {p.o} ."
        if p.lang is not None:
            yield f"{pad}FILTER (lang({p.o}) = {_literal(p.lang)})"
    for sign, tests in (("", group.matches), ("!", group.lacks)):
        for name, regex in tests:
            yield f"{pad}FILTER ({sign}regex(str(?{name}), {_literal(regex)}))"
    for word, parts in (("MINUS", group.minus), ("OPTIONAL", group.optional)):
        for part in parts:
            yield f"{pad}{word} {{"
            yield from _lines(part, depth + 1)
            yield f"{pad}}}"


def _whole(head: str, body: str, tail: str = "") -> str:
    used = [f"PREFIX {k}: <{v}>" for k, v in PREFIXES.items() if f"{k}:" in body]
    return "\n".join([*used, f"{head} WHERE {{", body, f"}}{tail}"])


def select(group: Group, *variables: str, order: str | None = None, limit: str | int | None = None, bounds: bool = False, distinct: bool = False) -> str:
    """A SELECT of the tree; bounds: with {bounds} for a source that asks page by page, whose limit is "{limit}"."""
    tail = (f"\nORDER BY ?{order}" if order else "") + (f"\nLIMIT {limit}" if limit is not None else "")
    body = "\n".join([*_lines(group, 1), *(["  {bounds}"] if bounds else [])])
    return _whole(f"SELECT {'DISTINCT ' * distinct}{' '.join(f'?{v}' for v in variables or group.variables)}", body, tail)


def count(group: Group, variable: str, distinct: bool = False) -> str:
    """How many solutions the tree has without its optional groups."""
    required = replace(group, optional=())
    return _whole(f"SELECT (COUNT({'DISTINCT ' * distinct}?{variable}) AS ?count)", "\n".join(_lines(required, 1)))


# --- trees of the catalogue's kinds ------------------------------------------------------------------------------------

_HEADING = Group((Triple("?auth", "xl:prefLabel", "?pl"), Triple("?pl", "xl:literalForm", "?heading")), (Group((Triple("?pl", "ndl:transcription", "?yomi", "ja-kana"),)),))
_OTHER = Group((Triple("?auth", "xl:altLabel", "?al"), Triple("?al", "ndl:transcription", "?yomiAlt", "ja-kana")))


def authorities(kind: str, name: str | None = None) -> Group:
    """What a catalogue knows of its persons, places or orgs; name: a regular expression for names. Subdivisions are left out."""
    matches = (("name", name),) if name else ()
    if kind == "person":
        born, died = (Group((Triple("?entity", f"rda:{p}", f"?{v}"),)) for p, v in (("dateOfBirth", "birth"), ("dateOfDeath", "death")))
        required = Triple("?auth", "foaf:primaryTopic", "?entity"), Triple("?entity", "a", "foaf:Person"), Triple("?entity", "foaf:name", "?name")
        return Group(required, (_HEADING, _OTHER, born, died), matches=matches)
    scheme = {"place": "scheme:geographicNames", "org": "scheme:corporateNames"}[kind]
    return Group((Triple("?auth", "skos:inScheme", scheme), Triple("?auth", "rdfs:label", "?name")), (_HEADING, _OTHER), matches=matches, lacks=(("name", "--"),))


def asked(kind: str) -> list[str]:
    """The variables of a catalogue's page."""
    return ["auth", "name", "heading", "yomi", "yomiAlt", *(["birth", "death"] if kind == "person" else [])]


# --- trees of the graph's slices ---------------------------------------------------------------------------------------


def without_classes(group: Group, item: str, excluded: list[str]) -> Group:
    """The group without items of some classes or of classes below them."""
    if not excluded:
        return group
    part = Group((Triple(f"?{item}", "wdt:P31/wdt:P279*", "?excluded"),), values=(("excluded", tuple(f"wd:{q}" for q in excluded)),))
    return replace(group, minus=(*group.minus, part))


def persons_of(country: str, lang: str, excluded: list[str] | None = None, details: bool = False) -> Group:
    """Humans of a dynasty or country that have a label in the language; details: their other names, parts of names and years."""
    required = Triple("?item", "wdt:P31", "wd:Q5"), Triple("?item", "wdt:P27", f"wd:{country}"), Triple("?item", "rdfs:label", "?itemLabel", lang)
    part = lambda p, v: Group((Triple("?item", p, f"?{v}Item"), Triple(f"?{v}Item", "rdfs:label", f"?{v}", lang)))
    more = Group((Triple("?item", "skos:altLabel", "?alias", lang),)), part("wdt:P734", "familyName"), part("wdt:P735", "givenName"), Group((Triple("?item", "wdt:P569", "?birth"),)), Group((Triple("?item", "wdt:P570", "?death"),))
    return without_classes(Group(required, more if details else ()), "item", excluded or [])


def items_of(classes: list[str], lang: str | None = None, excluded: list[str] | None = None) -> Group:
    """Items of some classes or of classes below them, with a label if a language is given."""
    required = (Triple("?item", "wdt:P31/wdt:P279*", "?class"), *([Triple("?item", "rdfs:label", "?itemLabel", lang)] if lang else []))
    return without_classes(Group(required, values=(("class", tuple(f"wd:{q}" for q in classes)),)), "item", excluded or [])
