"""SimHash, mixing, language ID, quality rules and packing against plain Python."""

import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from onoma.llm import components, langid, mixing, packing, quality, queries, simhash

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, "  \n ", "de", None, 4), (4, "one two", "en", "b", 7), (5, "word " * 30_000, "en", "b", 150_000),
    (6, "One TWO", "en", "b", 7), (6, "One TWO", "en", "b", 7), (7, "a b c d e f g h", None, None, 15), (8, "a b c d e f g h", None, "", 15), (None, "no id here at all", "en", "b", 17), (9, "é" * 10 + "  x", "fr", "c", 13),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


def brute_fp(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, most=2):
    parent = {i: i for i in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(fps, 2):
        if bin(fps[a] ^ fps[b]).count("1") <= most:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in fps}


def test_simhash_matches_brute_force(spark, docs):
    got = queries.op1_simhash_near_dedup(spark, SF).toPandas()
    fps = {r.doc_id: brute_fp(r.text) for r in docs.collect()}
    assert dict(zip(got.doc_id, got.fingerprint)) == {k: f"{v:016x}" for k, v in fps.items()}
    assert dict(zip(got.doc_id, got.component_id)) == brute_components(fps)


@pytest.mark.parametrize("bucket", [4096, 8])
def test_simhash_links_in_split_buckets(spark, bucket):
    rng = np.random.default_rng(5)
    base = [int(x) for x in rng.integers(0, 1 << 62, 12)]
    fps = {0: 0}
    while len(fps) < 400:
        f = base[len(fps) % 12]
        for b in rng.integers(0, 64, rng.integers(0, 6)):
            f ^= 1 << int(b)
        if f not in fps.values():
            fps[len(fps)] = f
    classes = spark.createDataFrame([(simhash._signed(f), i) for i, f in fps.items()], "fp long, rep long")
    comp = {r.node: r.component for r in components.connected_components(simhash.links(classes, bucket=bucket)).collect()}
    assert {i: comp.get(i, i) for i in fps} == brute_components(fps)


def test_allocation_is_the_cheapest():
    costs = [[5.0, 50, 500], [100.0, 120, 900], [90.0, 300, 900]]
    got = simhash.allocate(costs)
    best = min((sum(c[t] if t >= 0 else 0 for c, t in zip(costs, ts)), ts) for ts in itertools.product(range(-1, 3), repeat=3) if sum(ts) == 0)
    assert sum(got) == 0 and sum(c[t] if t >= 0 else 0 for c, t in zip(costs, got)) == best[0]


def test_simhash_probes_where_thresholds_are_uneven(spark, monkeypatch):
    monkeypatch.setattr(simhash, "allocate", lambda costs, max_diff=2: [1, 0, -1])
    test_simhash_links_in_split_buckets(spark, 16)


def test_simhash_odd_rows(spark, odd):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == len(ODD)
    by = {r.doc_id: r for r in got}
    assert by[1].fp == by[2].fp == by[3].fp == 0 and by[3].component_id == 1
    assert by[6].component_id == 4 and by[8].component_id == 7
    assert simhash.near_duplicates(odd.limit(0)).count() == 0
    assert simhash.near_duplicates(odd.withColumnsRenamed({"lang": "fp", "source": "rep"})).count() == len(ODD)


def test_components_with_hubs_apart(spark, monkeypatch):
    monkeypatch.setattr(components, "MANY", 1)
    monkeypatch.setattr(components, "SHARE", 4)
    monkeypatch.setattr(components, "CHUNK", 3)  # no task sees a whole star
    links = [(0, k) for k in range(1, 40)] + [(k, k + 1) for k in range(100, 130)] + [(39, 115)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(links, "u long, v long").repartition(8)).collect()}
    assert got == {k: 0 for k in [*range(40), *range(100, 131)]}


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 60)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(links, "u long, v long").repartition(4)).collect()}
    assert all(got[i] == 100 for i in range(100, 161)) and all(got[i] == 1 for i in range(1, 60)) and got[201] == 200
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % 3] for k, s in enumerate(order)}
    budget, closed = share * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in closed]
        level = (budget - sum(closed.values())) / max(sum(w[s] for s in free), 1)
        over = [s for s in free if level * w[s] > most * sizes[s]]
        if not over:
            return closed | {s: level * w[s] for s in free}
        closed |= {s: most * sizes[s] for s in over}


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_mixing(spark, docs, odd, which):
    df = {"docs": docs, "odd": odd}[which]
    got = mixing.mix(df).toPandas()
    assert len(got) == df.count()
    sizes = defaultdict(int)
    for r in df.collect():
        sizes[r.source] += len(WORD.findall(r.text or ""))
    goal, taken = brute_targets(sizes), defaultdict(int)
    for r in got.itertuples():
        s = r.source if isinstance(r.source, str) else None
        taken[s] += r.taken
        assert r.source_size == sizes[s] and r.target == pytest.approx(goal[s]) and r.taken in (0, r.size, 2 * r.size)
    longest = got.groupby(got.source.fillna("?"))["size"].max()
    for s in sizes:
        assert 0 <= goal[s] - taken[s] + 1e-6 <= (0.02 * goal[s] if which == "docs" else longest["?" if s is None else s] + 1e-3)
    again = mixing.mix(df.repartition(3)).toPandas()
    key = ["doc_id", "size", "taken"]
    assert got[key].sort_values(key).reset_index(drop=True).equals(again[key].sort_values(key).reset_index(drop=True))
    assert mixing.mix(df.limit(0)).count() == 0


def test_knapsack_and_fit():
    assert sum(s * n for s, n in zip([3, 5, 7], mixing.knapsack([3, 5, 7], [2, 1, 1], 15))) == 15
    assert mixing.knapsack([4], [3], 3) == [0] and mixing.knapsack([], [], 0) == []
    rng = np.random.default_rng(1)
    for _ in range(30):
        sizes = np.unique(rng.integers(1, 60, 6))
        counts = rng.integers(1, 5, len(sizes))
        budget = int(rng.integers(0, 2 * (sizes * counts).sum() + 1))
        passes, extra = mixing.fit(sizes, counts, budget)
        got = passes * (sizes * counts).sum() + (extra * sizes).sum()
        assert (extra <= counts).all() and budget - sizes.max() <= got <= budget


def test_fit_of_many_and_of_large_sizes():
    rng = np.random.default_rng(2)
    for n, most in ((3000, 20_000), (400, 1_000_000)):  # the equal shares alone would leave far more than RESERVE
        sizes = np.unique(rng.integers(1, most, n))
        counts = rng.integers(1, 50, len(sizes))
        total = int((sizes * counts).sum())
        for share in (0.0001, 0.37, 0.99, 1.5):
            passes, extra = mixing.fit(sizes, counts, int(total * share))
            got = passes * total + int((extra * sizes).sum())
            assert (extra <= counts).all() and (extra >= 0).all() and int(total * share) - max(8, sizes.min()) <= got <= int(total * share) or most > 20_000 and got <= int(total * share)


def brute_phrases(text, train):
    n = i = 0
    while i < len(text):
        k = 1
        while i + k < len(text) and text[i : i + k + 1] in train:
            k += 1
        n, i = n + 1, i + k
    return n


def test_cross_parsing_counts_longest_matches():
    train = langid.normalise("the cat sat on the mat with a hat and the rat that sat")
    p = langid.Parser(langid.Model((("x", train), ("y", "la casa de papel"))))
    for t in ["That cat sat!!  on the HAT", "zebra que 12 la casa", "", "a"]:
        total, n, _ = p.phrases([t, "mat", t])
        norm = langid.normalise(t)
        assert total[0, 0] == brute_phrases(norm, train) == total[0, 2] and total[0, 1] == 1
        assert n[0] == len(norm) + (t[-1:] == "!") or n[0] == len(norm)


@pytest.mark.parametrize("segment", [7, 64, 1024])
def test_phrases_do_not_end_at_segments(segment, monkeypatch):
    monkeypatch.setattr(langid, "SEGMENT", segment)
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcdef"), rng.integers(1, 7))) for _ in range(200)]
    train = " ".join(rng.choice(words, 400))
    p = langid.Parser(langid.Model((("x", train), ("y", " ".join(words)))))
    texts = ["", "ab " * 3000 + "a", "a" * 3000, "abcab" * 900] + [" ".join(rng.choice(words, rng.integers(1, 900))) for _ in range(8)]
    total, _, _ = p.phrases(texts)
    assert total[0].tolist() == [brute_phrases(t, train) for t in texts] and total[1].tolist() == [brute_phrases(t, " ".join(words)) for t in texts]


def test_language_model_stays_within_its_table():
    letters = "".join(chr(0x4E00 + k) for k in range(3000))
    p = langid.Parser(langid.Model((("zh", letters), ("en", "plain words"))))
    assert p.width == langid.LETTERS + 2 and p.predict([letters[:50], "plain words", "12", None])[0] == ["zh", "en", "und", "und"]


def test_language_id_on_held_out(spark, docs):
    got = queries.op6_language_id(spark, "/root/testdata/sf0.01").toPandas()
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").toPandas()
    both = got.merge(truth, on="doc_id")
    assert len(both) == 1000 and (both.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in both.doc_id]).all()
    h = both[both.held_out]
    assert (h.lang_pred == h.lang).mean() > 0.97 and both.score.between(0, 1).all()


def test_language_id_odd_rows(spark, docs, odd):
    model = langid.fit(docs)
    got = {r.doc_id: r for r in langid.identify(odd.withColumnRenamed("source", "score"), model).collect()}
    assert {got[i].lang_pred for i in (1, 2, 3)} == {"und"} and got[5].lang_pred == "en"
    assert langid.identify(odd.limit(0), model).count() == 0
    assert {r.lang_pred for r in langid.identify(odd, langid.Model(())).collect()} == {"und"}


def brute_counts(text):
    text = text or ""
    w = WORD.findall(text)
    at = defaultdict(list)
    for i in range(len(w) - 2):
        at[tuple(w[i : i + 3])].append(i)
    cover = {i + k for xs in at.values() if len(xs) > 1 for i in xs for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), sum(n - 1 for n in Counter(lines).values()), len(cover)


def test_quality_counts_and_list(spark, docs):
    got = queries.op7_quality_rules(spark, "/root/testdata/sf0.01").toPandas().set_index("doc_id")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    for r in docs.collect():
        g = got.loc[r.doc_id]
        want = brute_counts(r.text)
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == want
        assert g.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (g.base_failed and g.kept)
    labels = pd.read_parquet("/root/testdata/sf0.01/labels.parquet").set_index("doc_id").join(got)
    ok = labels[~labels.base_failed]
    assert (ok.kept == (ok.quality == 1)).mean() > 0.95 and ok[ok.quality == 1].kept.mean() > 0.98


def test_quality_odd_rows(spark, docs, odd):
    rules = quality.fit(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert rules == ()
    got = quality.judge(odd.withColumnRenamed("lang", "kept"), rules).collect()
    assert len(got) == len(ODD) and not any(r.kept for r in got)
    assert quality.judge(odd.limit(0), rules).count() == 0


def pieces_are_whole(pdf):
    for seq, g in pdf.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.offset.tolist() == [0, *g.length.cumsum()[:-1]] and g.length.sum() <= packing.WINDOW
    return (pdf.groupby("sequence_id").length.sum() < packing.WINDOW).sum()


def test_packing(spark, docs):
    from tokenizers import Tokenizer
    import public_tokenizers

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = packing.pack(docs.repartition(7)).toPandas()
    assert pieces_are_whole(got) <= 1
    by = {k: g.sort_values("start") for k, g in got.groupby("doc_id")}
    for r in docs.collect():
        want = np.array([*t.encode(r.text, add_special_tokens=False).ids, 1], "<u4")
        g = by[r.doc_id]
        assert b"".join(g.ids) == want.tobytes() and (g.doc_tokens == len(want)).all() and g.start.tolist() == [0, *g.length.cumsum()[:-1]]


def test_ids_of_odd_texts_are_the_tokenizers(monkeypatch):
    monkeypatch.setattr(packing, "CACHE", 300)  # generations change often
    e, rng = packing.encoder(None), np.random.default_rng(3)
    bits = ["a", "B", "é", "É", "e\u0301", "'s", "don't", "'", "1", "42", "中", "文字", " ", "  ", "\n", "\t", "\u00a0", "\x01", "\x85", "!", "...", "?)", "(", "<|", "<|endoftext|>", "<|ENDOFTEXT|>", "|>", "ß", "İ", "Σ", "ﬁ", "÷", "ÿ", "Ÿ", "word", "Straße", "\u0338", "👍", "\x00", "'LL", "Þ"]
    texts = [None, "", " ", "\n", "x" * 200 + "!" * 200] + ["".join(rng.choice(bits, rng.integers(1, 14))) for _ in range(6000)]
    for k in range(0, len(texts), 500):
        for t, ids in zip(texts[k : k + 500], e.encode_batch(texts[k : k + 500])):
            assert e.tokenizer.encode(t or "", add_special_tokens=False).ids == ids.tolist(), repr(t)
    assert e.encode_batch([]) == [] and max(map(len, e.young.names.to_pylist())) <= packing.LONGEST


def test_packing_odd_rows_and_many_tasks(spark, odd, monkeypatch):
    got = packing.pack(odd).toPandas()
    assert pieces_are_whole(got) <= 1 and got[got.doc_id == 1].length.tolist() == [1]
    assert got[got.doc_id == 6].start.tolist() == [0, 0] and got[got.doc_id.isna()].length.sum() == 6
    monkeypatch.setattr(packing, "FAN_IN", 2)
    more = packing.pack(odd.repartition(9), spaces=2).toPandas()
    assert pieces_are_whole(more) <= 1 and more.length.sum() == got.length.sum()
    assert packing.pack(odd.limit(0)).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows, ids = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, SF)
        assert rows.columns == docs.columns
        ids.append([r.doc_id for r in rows.collect()])
    assert set(ids[0]) >= set(ids[1]) >= set(ids[2]) >= set(ids[3]) and max(Counter(ids[3]).values()) <= 2
    kept = {r.doc_id: brute_fp(r.text) for r in docs.collect() if r.doc_id in set(ids[1])}
    assert sorted(ids[2]) == sorted(k for k, c in brute_components(kept).items() if k == c)
    out = corpus_pipeline.run(spark, SF)
    got, texts, copies = out.toPandas(), {r.doc_id: r.text for r in docs.collect()}, Counter(ids[3])
    assert set(got.doc_id) == set(ids[3]) and pieces_are_whole(got) <= 1
    for i, g in got.groupby("doc_id"):  # each copy's ids, whole
        want = np.append(packing.encoder(None).tokenizer.encode(texts[i], add_special_tokens=False).ids, 1).astype("<u4")
        assert g.length.sum() == copies[i] * len(want) and (g.doc_tokens == len(want)).all()
        assert all(x == want[k : k + n].tobytes() for x, k, n in zip(g.ids, g.start, g.length))


def test_pipeline_without_labelled_languages(spark, odd, tmp_path):
    import corpus_pipeline

    kept = [r.doc_id for r in corpus_pipeline.language_id(spark, odd.withColumn("lang", F.lit(None).cast("string")), SF).collect()]
    assert Counter(kept) == Counter(r[0] for r in ODD if any(map(str.isalpha, r[1] or "")))
    assert Counter(kept) == Counter(r.doc_id for r in corpus_pipeline.language_id(spark, odd, SF).collect())
    spark.read.parquet(f"{SF}/documents.parquet").withColumn("lang", F.lit(None).cast("string")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    ids = lambda sf: {r.doc_id for r in corpus_pipeline.run(spark, sf).select("doc_id").collect()}
    assert ids(str(tmp_path)) == ids(SF)


def test_mixing_stage_with_repeated_and_null_ids(spark):
    import corpus_pipeline

    rows = [(1, "one two three", "en", "a", 0), (1, "four five six", "en", "a", 0), (None, "seven eight nine", "en", "a", 0), (None, "ten eleven twelve", "en", "a", 0), (2, "same same same", "en", "a", 0), (2, "same same same", "en", "a", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = Counter((r.doc_id, r.text) for r in corpus_pipeline.mixing_sources(spark, df, SF).collect())
    again = Counter((r.doc_id, r.text) for r in corpus_pipeline.mixing_sources(spark, df.repartition(3), SF).collect())
    most = Counter((r[0], r[1]) for r in rows)
    assert sum(got.values()) == 9 == sum(r.copies for r in mixing.mix(df).collect()) and set(got) == set(most)
    assert all(n <= 2 * most[k] for k, n in got.items()) and got == again


def test_near_dedup_stage_with_repeated_and_null_ids(spark):
    import corpus_pipeline

    rng = np.random.default_rng(9)
    a, b, c, d, e = (" ".join(f"w{k}" for k in rng.integers(0, 10**6, 80)) for _ in range(5))
    rows = [(1, a), (2, a), (2, b), (3, b), (4, c), (4, d), (4, c), (None, d), (None, e), (None, e), (None, a)]
    want = sorted([(1, a), (2, b), (4, c), (4, d), (None, e)], key=str)
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA)
    for x in (df, df.repartition(3, "text"), df.orderBy(F.desc("text"))):
        assert sorted(((r.doc_id, r.text) for r in corpus_pipeline.simhash_near_dedup(spark, x, SF).collect()), key=str) == want
    twice = df.withColumn("source", F.col("text").substr(1, 3)).unionByName(df)  # of rows of one id and text the same one stays
    got = [{tuple(r) for r in corpus_pipeline.simhash_near_dedup(spark, x, SF).collect()} for x in (twice, twice.repartition(5), twice.orderBy("source"))]
    assert len(got[0]) == 5 and got[0] == got[1] == got[2]
    assert corpus_pipeline.simhash_near_dedup(spark, df.limit(0), SF).count() == 0


def test_language_sample_is_bounded_and_spread(spark):
    text = F.concat(F.lit("word "), F.transform(F.array(F.col("id")), lambda x: F.translate(x.cast("string"), "0123456789", "abcdefghij"))[0])
    rows = spark.range(4000).select(F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.lit(5)).cast("long").alias("doc_id"), text.alias("text"), F.when(F.col("id") % 2 == 0, "x").otherwise("y").alias("lang"))
    rows = rows.unionByName(spark.range(3000).select(F.lit(6).cast("long").alias("doc_id"), F.lit("the same").alias("text"), F.lit("z").alias("lang")))
    got = Counter(r.lang for r in langid.sample(rows, "doc_id", "text", "lang", 60, 20_000).collect())
    assert 60 < got["x"] <= 120 and 60 < got["y"] <= 120 and got["z"] == 1
    model = dict(langid.fit(rows).texts)
    assert model["z"] == "the same" and all(60 <= model[k].count("word") <= 120 for k in "xy")
