"""Pattern trees against a plain solver, and their SPARQL."""

import random
import re
from collections import Counter

import pytest

from onoma.operators import patterns
from onoma.operators.patterns import Group, Triple


def plain(triples, group, given=None):
    """Solutions one by one: every pattern in turn, then what must not be there, then each optional group."""
    found = [dict(given or {})]
    at = lambda x, b: b.get(x[1:], x if not x.startswith("?") else None)
    for t in group.patterns:
        step, _, path = t.p.partition("/")
        rows = []
        for s, p, o, lang in triples:
            if p != step or t.lang is not None and lang != t.lang:
                continue
            ends = {o}
            if path:
                front = {o}
                while front:
                    front = {y for x in front for a, q, y, _ in triples if q == path[:-1] and a == x} - ends
                    ends |= front
            rows += [(s, e) for e in ends]
        out = []
        for b in found:
            for s, o in rows:
                if at(t.s, b) in (None, s) and at(t.o, b) in (None, o) and not (t.s == t.o and s != o):
                    out.append(b | {x[1:]: v for x, v in ((t.s, s), (t.o, o)) if x.startswith("?")})
        found = out
    found = [b for b in found if all(b[v] in terms for v, terms in group.values) and all(re.search(r, b[v]) for v, r in group.matches) and not any(re.search(r, b[v]) for v, r in group.lacks)]
    for part in group.minus:
        found = [b for b in found if not any(all(b.get(k, v) == v for k, v in x.items()) for x in plain(triples, part))]
    for part in group.optional:
        found = [y for b in found for y in (plain(triples, part, b) or [b])]
    return found


TREES = [
    Group((Triple("?a", "p", "?b"),)),
    Group((Triple("?a", "p", "?b"), Triple("?b", "q", "?c"), Triple("?a", "r", "x1"))),
    Group((Triple("?b", "q", "?c"), Triple("?a", "p", "?b")), (Group((Triple("?c", "r", "?d"),), (Group((Triple("?d", "p", "?e", "ja"),)),)), Group((Triple("?a", "q", "?f"),)))),
    Group((Triple("?a", "p", "?b", "en"),), minus=(Group((Triple("?a", "q", "x2"),)),), lacks=(("b", "[13579]$"),)),
    Group((Triple("?a", "p", "?b"),), values=(("b", ("x1", "x4", "x5")),), matches=(("a", "x[0-5]"),), optional=(Group((Triple("?b", "q", "?c", "ja"), Triple("?c", "p", "?d"))),)),
    Group((Triple("?a", "p/q*", "x3"),), (Group((Triple("?a", "r", "?b"),)),)),
    Group((Triple("?a", "r", "?b"),), minus=(Group((Triple("?a", "p/q*", "?k"),), values=(("k", ("x2", "x6")),)),)),
    Group((Triple("?a", "p", "?a"), Triple("?a", "q", "?b"))),
    Group((Triple("x1", "p", "?b"), Triple("?b", "p", "?c"))),
]


@pytest.mark.parametrize("k", range(len(TREES)))
def test_trees_equal_a_plain_solver(spark, k):
    rng, tree = random.Random(k), TREES[k]
    rows = list({(f"x{rng.randint(0, 9)}", rng.choice("pqr"), f"x{rng.randint(0, 9)}"): rng.choice(["en", "ja", None]) for _ in range(70)}.items())
    triples = [(s, p, o, lang) for (s, p, o), lang in rows]
    df = spark.createDataFrame(triples, "s string, p string, o string, lang string").repartition(3)
    count = lambda found: Counter(tuple(b.get(v) for v in tree.variables) for b in found)
    want = plain(triples, tree)
    assert count(r.asDict() for r in patterns.solve(df, tree).collect()) == count(want)
    key = tree.variables[0]
    some = sorted({b[key] for b in want if b[key] > "x2"})[:3]
    assert count(r.asDict() for r in patterns.page(df, tree, key, "x2", 3).collect()) == count([b for b in want if b[key] in some])
    assert count(r.asDict() for r in patterns.page(df, tree, key, "x2").collect()) == count([b for b in want if b[key] > "x2"])


def test_trees_that_do_not_hang_together(spark):
    df = spark.createDataFrame([], "s string, p string, o string, lang string")
    with pytest.raises(ValueError, match="shares no variable"):
        patterns.solve(df, Group((Triple("?a", "p", "?b"), Triple("?c", "p", "?d"))))
    with pytest.raises(ValueError, match="shares no variable"):
        patterns.solve(df, Group((Triple("?a", "p", "?b"),), (Group((Triple("?c", "p", "?d"),)),)))
    with pytest.raises(ValueError, match="always bound"):  # the second part would join by what the first may leave unbound
        patterns.solve(df, Group((Triple("?a", "p", "?b"),), (Group((Triple("?a", "q", "?c"),)), Group((Triple("?a", "r", "?d"), Triple("?d", "r", "?c"))))))
    with pytest.raises(ValueError, match="no fixed end"):
        patterns.solve(df, Group((Triple("?a", "p/q*", "?b"),)))


def test_authorities_of_a_graph(spark):
    triples = [
        ("http://a/1", "foaf:primaryTopic", "e1", None), ("e1", "a", "foaf:Person", None), ("e1", "foaf:name", "夏目, 漱石", None), ("e1", "rda:dateOfBirth", "1867", None),
        ("http://a/1", "xl:prefLabel", "l1", None), ("l1", "xl:literalForm", "夏目, 漱石, 1867-1916", None), ("l1", "ndl:transcription", "ナツメ, ソウセキ", "ja-kana"), ("l1", "ndl:transcription", "Natsume, Soseki", "ja-latn"),
        ("http://a/1", "xl:altLabel", "l2", None), ("l2", "ndl:transcription", "ナツメ, キンノスケ", "ja-kana"), ("http://a/1", "xl:altLabel", "l3", None),
        ("http://a/2", "foaf:primaryTopic", "e2", None), ("e2", "a", "foaf:Person", None), ("e2", "foaf:name", "無名", None), ("e3", "foaf:name", "猫", None),
        ("http://a/4", "skos:inScheme", "scheme:geographicNames", None), ("http://a/4", "rdfs:label", "東京", None), ("http://a/5", "skos:inScheme", "scheme:geographicNames", None), ("http://a/5", "rdfs:label", "東京--地図", None),
    ]
    df = spark.createDataFrame(triples, "s string, p string, o string, lang string")
    got = patterns.solve(df, patterns.authorities("person")).select(*patterns.asked("person")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([("http://a/1", "夏目, 漱石", "夏目, 漱石, 1867-1916", "ナツメ, ソウセキ", "ナツメ, キンノスケ", "1867", None), ("http://a/2", "無名", None, None, None, None, None)], key=repr)
    assert [r.auth for r in patterns.solve(df, patterns.authorities("place")).collect()] == ["http://a/4"]
    assert patterns.solve(df, patterns.authorities("person", "^夏")).count() == 1


def test_sparql_text():
    text = patterns.select(patterns.authorities("person"), *patterns.asked("person"), order="auth", limit=7, bounds=True)
    assert text.split("\n") == [
        "PREFIX foaf: <http://xmlns.com/foaf/0.1/>", "PREFIX xl: <http://www.w3.org/2008/05/skos-xl#>", "PREFIX ndl: <http://ndl.go.jp/dcndl/terms/>", "PREFIX rda: <http://RDVocab.info/ElementsGr2/>",
        "SELECT ?auth ?name ?heading ?yomi ?yomiAlt ?birth ?death WHERE {", "  ?auth foaf:primaryTopic ?entity .", "  ?entity a foaf:Person .", "  ?entity foaf:name ?name .",
        "  OPTIONAL {", "    ?auth xl:prefLabel ?pl .", "    ?pl xl:literalForm ?heading .", "    OPTIONAL {", "      ?pl ndl:transcription ?yomi .", '      FILTER (lang(?yomi) = "ja-kana")', "    }", "  }",
        "  OPTIONAL {", "    ?auth xl:altLabel ?al .", "    ?al ndl:transcription ?yomiAlt .", '    FILTER (lang(?yomiAlt) = "ja-kana")', "  }",
        "  OPTIONAL {", "    ?entity rda:dateOfBirth ?birth .", "  }", "  OPTIONAL {", "    ?entity rda:dateOfDeath ?death .", "  }", "  {bounds}", "}", "ORDER BY ?auth", "LIMIT 7",
    ]
    counted = patterns.count(patterns.authorities("org"), "auth").split("\n")
    assert counted[-5:] == ["SELECT (COUNT(?auth) AS ?count) WHERE {", "  ?auth skos:inScheme scheme:corporateNames .", "  ?auth rdfs:label ?name .", '  FILTER (!regex(str(?name), "--"))', "}"]
    tang = patterns.count(patterns.persons_of("Q9683", "zh-hant", ["Q4167410"]), "item", distinct=True)
    assert "COUNT(DISTINCT ?item)" in tang and "VALUES ?excluded { wd:Q4167410 }" in tang and "?item wdt:P31/wdt:P279* ?excluded ." in tang and tang.count("PREFIX") == 3
    assert 'regex(str(?name), "^a\\"\\\\\\\\b")' in patterns.select(patterns.authorities("place", '^a"\\\\b'))
