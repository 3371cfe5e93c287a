"""Pipeline stages on tables with any columns; language models of thousands of letters."""

import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import functions as F

import corpus_pipeline
from onoma.llm import langid
from onoma.llm.common import with_row_key

SF = "/root/testdata/sf0.001"


def brute_phrases(text, train):
    n = i = 0
    while i < len(text):
        k = 1
        while i + k < len(text) and text[i : i + k + 1] in train:
            k += 1
        n, i = n + 1, i + k
    return n


def test_languages_of_thousands_of_letters():
    rng = np.random.default_rng(1)
    shared, own = [chr(0x4E00 + k) for k in range(500)], {"a": [chr(0x5200 + k) for k in range(5000)], "b": [chr(0xAC00 + k) for k in range(5000)]}
    say = lambda k, n: "".join(rng.choice(shared if rng.random() < 0.3 else own[k]) if rng.random() > 0.1 else " " for _ in range(n))
    model = langid.Model(tuple((k, langid.normalise(say(k, 20_000))) for k in "ab"))
    p = langid.Parser(model)
    train = dict(model.texts)
    assert p.letters > 8000 and p.width == langid.LETTERS + 2
    texts = [langid.normalise(say(k, n)) for k in "ab" for n in (1, 30, 3000)] + [train["a"][500:5000], train["b"][:2000] + train["a"][:2000], "żółw " * 40, ""]
    total, _, _ = p.phrases(texts)
    for row, k in zip(total, "ab", strict=True):
        assert row.tolist() == [brute_phrases(t, train[k]) for t in texts]
    short = [(k, say(k, 40)) for k in "ab" * 100]
    assert np.mean([x == k for (k, _), x in zip(short, p.predict([t for _, t in short])[0], strict=True)]) > 0.6  # random letters; 0.53 if most count as one


def test_no_training_text_is_cut(monkeypatch):
    text = " ".join(chr(0x4E00 + k * 7 % 900) * 2 for k in range(3000))
    monkeypatch.setattr(langid, "CELLS", 50_000)  # columns for few letters
    p = langid.Parser(langid.Model((("x", text), ("y", "plain words"))))
    assert p.width < 12
    probe = [text[k : k + 400] for k in range(0, 8000, 900)] + ["plain words and more", "words" + text[:50]]
    assert p.phrases(probe)[0].tolist() == [[brute_phrases(t, x) for t in probe] for x in (text, "plain words")]


def test_the_sample_holds_whole_texts(spark):
    rows = [(k, f"short text number {'abcdefghij'[k % 10]} {'klmnopqrst'[k // 10]} " + "of some words " * (k % 7), "x") for k in range(90)] + [(100 + k, "w" * 50_000 + "xyz"[k], "x") for k in range(3)] + [(200 + k, f"long {'y' * (900 + k)}", "only long") for k in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = [(r.lang, r.text) for r in langid.sample(df, "doc_id", "text", "lang", 60, 500).collect()]
    whole = {t for _, t, _ in rows}
    assert all(t in whole for la, t in got if la == "x") and 500 <= sum(len(t) for la, t in got if la == "x") < 1000
    assert [t for la, t in got if la == "only long"] == [("long " + "y" * 900)[:500]]


@pytest.fixture
def strange(spark):
    """Documents with columns that stages use themselves, and of types that have no hash."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(120)
    more = {"row_a": F.col("doc_id"), "Row_B": F.lit("x"), "copies": F.lit(7), "n_copies": F.lit(None).cast("int"), "copy": F.lit("c"), "nth_copy": F.lit(1), "fp": F.lit(0), "component": F.lit(1), "node": F.lit("n"), "size": F.lit(2), "target": F.lit(0.5),
            "taken": F.lit(3), "kept": F.lit(False), "n_words": F.lit(0), "lang_pred": F.lit("zz"), "score": F.lit(9), "key": F.lit("k"), "h": F.lit(1), "rank": F.lit(1), "part": F.lit(0), "a b`c": F.lit(1), "count": F.lit(0),
            "m": F.create_map(F.lit("p"), F.col("source"), F.lit("q"), F.col("lang")), "deep": F.array(F.struct(F.create_map(F.lit(1), F.lit("v")).alias("x"))), "none": F.lit(None).cast("map<string,int>")}
    out = docs.withColumns(more)
    odd = spark.createDataFrame([(None, None, None, None, None), (3, "", None, "src1", 0), (3, "", None, "src1", 0), (None, "Short words here.", "en", None, 1), (5, None, "en", "src1", None)], docs.schema)
    return out.unionByName(odd.withColumns({k: v if k not in ("m",) else F.lit(None).cast("map<string,string>") for k, v in more.items()}))


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_any_columns(spark, strange, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    got = stage(spark, strange, SF)
    plain = stage(spark, strange.select("doc_id", "text", "lang", "source", "n_chars"), SF)
    if name == "packing":
        assert got.select("doc_id", "start", "length").count() == plain.count()
        return
    assert got.columns == strange.columns and got.schema == strange.schema
    keys = lambda df: sorted((r.doc_id, r.text) for r in df.where("doc_id is not null and text != ''").collect())
    assert keys(got) == keys(plain) and got.count() > 0
    assert stage(spark, strange.limit(0), SF).count() == 0


def test_row_keys_tell_rows_with_maps_apart(spark):
    df = spark.sql("SELECT 1 AS row_a, map('a', 1, 'b', 2) AS m UNION ALL SELECT 1, map('b', 2, 'a', 1) UNION ALL SELECT 1, map('a', 1, 'b', 3) UNION ALL SELECT 1, null UNION ALL SELECT 1, map()")
    keyed, key = with_row_key(df)
    assert key == ["row_a_", "row_b"] and keyed.select(key).distinct().count() == 4


def test_mixing_of_an_id_that_many_rows_share(spark, monkeypatch):
    from collections import Counter

    from onoma.llm import mixing

    rows = [(7 if k % 3 == 0 else k, "one two three" if k % 2 else "a b", "xy"[k % 5 == 0]) for k in range(3000)] + [(None, "a b", "x")] * 500
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    found = []
    for alike in (10_000, 20):
        monkeypatch.setattr(mixing, "ALIKE", alike)
        found.append(Counter(map(tuple, mixing.mix(df).select("doc_id", "source", "size", "taken").collect())))
    assert found[0] == found[1] and sum(found[0].values()) == len(rows)
    assert Counter((i, s, n) for (i, s, n, _), c in found[0].items() for _ in range(c)) == Counter((i, s, len(t.split())) for i, t, s in rows)
    goals = {r.source: r.target for r in mixing.mix(df).select("source", "target").distinct().collect()}
    for source, target in goals.items():
        taken = sum(t * c for (_, s, _, t), c in found[0].items() if s == source)
        assert target - 3 <= taken <= target + 1e-6
    assert all(t in (n * k for k in range(3)) for (_, _, n, t) in found[0])
