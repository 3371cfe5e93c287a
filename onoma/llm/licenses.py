"""License scans with built-in functions only.

Texts and notices become lower-cased words and shingles of five words. Texts are cut into overlapping windows of WINDOW
shingles, at every second one; notices have a window at each shingle, long ones two in a row of every eight. A window's MinHash values, one a band, retrieve the
notices that have a window with an equal value in that band; two windows meet with probability 1 - (1 - J)^BANDS, J being
their Jaccard similarity. Of a notice of six shingles or more a text that keeps CONTAINMENT keeps a run of five, and of a long one a run of
thirteen, as a word that is changed or put in takes four shingles at least: so one of its windows is the notice's, J is 1,
and they meet for certain. Shorter notices have windows of one shingle, which meet for certain too.

What is retrieved is verified: the share of the notice's shingles that the text has there. A place is looked for from where the
notice would begin if its words before the window were as they are, and from as many words earlier as may have been put in;
so it is found unless both searches begin with a shingle of the notice that stands there by chance.

Notices of under five words have no shingle of five; their words must stand in the text one after the other.
"""

from __future__ import annotations

import functools
import hashlib
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from onoma.llm.common import stash
from onoma.llm.license_texts import LINES, TEXTS

SHINGLE, WINDOW, STEP, BANDS, CONTAINMENT = 5, 4, 2, 3, 0.8
#: Notices of fewer shingles have windows of one; from DENSE on they have STEP windows of every STRIDE.
SINGLES, DENSE, STRIDE = 6, 60, 8
#: Band values that one pass looks for; longer lists of notices are scanned in several passes.
MOST_KEYS = 20_000
NOTICES = LINES | TEXTS
KEYS = "band int, key bigint, license string, own int, take int, early int"


def masks(bands: int = BANDS) -> list[int]:
    """XOR masks: under each, another shingle of a set tends to be the least."""
    out = []
    for k in range(bands):
        x = int.from_bytes(hashlib.blake2b(b"%d" % k, digest_size=8).digest(), "big")
        out.append(x - (1 << 64) if x >> 63 else x)
    return out


def clean(text: Column) -> Column:
    """Lower-cased runs of letters and digits, a blank between them."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))


def clean_words(text: str) -> list[str]:
    """As clean, of a notice; for its length alone."""
    return re.sub(r"[\W_]+", " ", text.lower()).split()


def shingle_hashes(w: Column) -> Column:
    n = F.size(w) - SHINGLE
    return F.when(n < 0, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(0))), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)])))


def shingle_texts(w: Column) -> Column:
    n = F.size(w) - SHINGLE
    return F.when(n < 0, F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(0))), lambda i: F.concat_ws(" ", *[F.get(w, i + k) for k in range(SHINGLE)])))  # a slice would copy the whole array each time


def least_of_pair(values: Column, i: Column, mask: int = 0) -> Column:
    """The lesser of two neighbours, the first of which is there, under a mask."""
    x = F.get(values, i)
    return F.least(x.bitwiseXOR(F.lit(mask)), F.coalesce(F.get(values, i + 1), x).bitwiseXOR(F.lit(mask))) if mask else F.least(x, F.coalesce(F.get(values, i + 1), x))


def upto(n: Column, step: int = 1) -> Column:
    """0, step, 2 step, ... below n; n is over 0."""
    return F.sequence(F.lit(0), n - 1, F.lit(step))


def listed(spark: SparkSession, notices: dict[str, str]) -> DataFrame:
    return spark.range(1).select(F.explode(F.create_map(*[F.lit(x) for kv in notices.items() for x in kv])).alias("license", "text"))


def notice_tables(spark: SparkSession, notices: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(license, n_words, take, shingles), and KEYS: a row per band value of each window; take is a place's longest run of shingles."""
    rows = listed(spark, notices)
    # n by the words, not by h: a filter on n moves below h, and would work it out word by word.
    rows = rows.withColumn("w", F.split(clean(F.col("text")), " ")).withColumn("n", F.size("w") - SHINGLE + 1).withColumn("h", shingle_hashes(F.col("w")))
    rows = rows.withColumn("early", 2 + F.ceil(F.size("w") / 5).cast("int")).withColumn("take", F.col("n") + F.col("early"))
    facts = rows.select("license", F.size("w").alias("n_words"), "take", F.array_distinct(shingle_texts(F.col("w"))).alias("shingles"))
    single = rows.where(F.col("n") < SINGLES).select(F.lit(0).alias("band"), "license", "take", "early", F.posexplode("h").alias("own", "key"))
    wide = rows.where(F.col("n") >= SINGLES).select("license", "take", "early", "h", "n", F.explode(upto(F.greatest(F.col("n") - WINDOW + 1, F.lit(1)))).alias("own")).where((F.col("n") < DENSE) | (F.col("own") % STRIDE < STEP))
    least = lambda m: F.least(*[F.get("h", F.col("own") + k).bitwiseXOR(F.lit(m)) for k in range(WINDOW)])
    values = F.array(*[F.struct(F.lit(b + 1).alias("band"), least(m).alias("key")) for b, m in enumerate(masks())])
    wide = wide.select("license", "take", "early", "own", F.explode(values).alias("v")).select("v.band", "v.key", "license", "own", "take", "early")
    return facts, single.select("band", "key", "license", "own", "take", "early").unionByName(wide)


def in_passes(notices: dict[str, str], most: int = MOST_KEYS) -> list[dict[str, str]]:
    """The notices in parts with about `most` band values at most; a longer one is a part by itself."""
    out, held = [], most + 1
    for name, text in notices.items():
        n = BANDS * len(clean_words(text))
        if n:
            if held + n > most:
                out.append({})
                held = 0
            out[-1][name] = text
            held += n
    return out


def scan(docs: DataFrame, notices: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, license, word_at, containment): notices that texts hold, a row for each place.

    word_at counts the text's words from 0. Null, empty and short texts hold none; notices without a word are not looked
    for; repeated rows are scanned each; an empty table gives an empty result; other columns are ignored. Texts stay
    whole: windows run to their last word. Notices may be as many and as long as they like.
    """
    parts = in_passes(NOTICES if notices is None else notices)
    if not parts:
        return docs.select(F.col(id_col).alias("doc_id"), F.lit("").alias("license"), F.lit(0).alias("word_at"), F.lit(0.0).alias("containment")).limit(0)
    return functools.reduce(DataFrame.unionByName, [_scan(docs, p, id_col, text_col) for p in parts])


def _scan(docs: DataFrame, notices: dict[str, str], id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    long = {k: v for k, v in notices.items() if len(clean_words(v)) >= SHINGLE}
    short = {k: v for k, v in notices.items() if k not in long}
    facts, keys = notice_tables(spark, long or {"": ""})
    wanted: list[list[int]] = [[] for _ in range(BANDS + 1)]
    for band, key in keys.select("band", "key").distinct().collect():  # of the notices, not of the corpus
        wanted[band].append(key)

    rows = docs.select(F.col(id_col).alias("doc_id"), clean(F.col(text_col)).alias("clean"))
    named = listed(spark, short or {"": ""}).select("license", clean(F.col("text")).alias("phrase"))
    phrases = {r.license: r.phrase for r in named.collect() if r.phrase}  # of the notices
    inside = lambda p: F.contains(F.concat(F.lit(" "), "clean", F.lit(" ")), F.lit(f" {p} "))
    shorts = F.array_compact(F.array(F.lit(None).cast("string"), *[F.when(inside(p), F.lit(k)) for k, p in phrases.items()]))
    rows = rows.select("doc_id", F.split("clean", " ").alias("w"), shorts.alias("shorts"))
    rows = rows.select("doc_id", "w", "shorts", shingle_hashes(F.col("w")).alias("h"))
    some = F.size("h") > 0
    # In each band the least of every second pair of shingles; a window is two pairs.
    pair = lambda m: lambda i: least_of_pair(F.col("h"), i, m)
    pairs = [F.when(some, F.transform(upto(F.size("h"), STEP), pair(m))).alias(f"p{b}") for b, m in enumerate(masks(), 1)]
    rows = rows.select("doc_id", "w", "shorts", "h", *pairs)
    value = lambda b, j: least_of_pair(F.col(f"p{b}"), j)

    def meets(j: Column) -> Column:
        return functools.reduce(lambda x, y: x | y, [value(b, j).isin(wanted[b]) for b in range(1, BANDS + 1) if wanted[b]], F.lit(False))

    none = F.array().cast("array<int>")
    ones = F.when(some, F.filter(upto(F.size("h")), lambda i: F.get("h", i).isin(wanted[0]))).otherwise(none) if wanted[0] else none
    wide = F.when(some, F.filter(upto(F.size("p1")), meets)).otherwise(none) if any(wanted[1:]) else none
    # The row number also keeps the filter on hits from being pushed below, where hits would be worked out again.
    rows = rows.select("*", F.monotonically_increasing_id().alias("row"), ones.alias("ones"), wide.alias("wide")).where((F.size("ones") > 0) | (F.size("wide") > 0) | (F.size("shorts") > 0))
    hit = lambda band, key, at: F.struct(F.lit(band).alias("band"), key.alias("key"), at.cast("int").alias("at"))
    hits = lambda b: lambda j: hit(b, value(b, j), j * STEP)
    found = [F.transform("ones", lambda i: hit(0, F.get("h", i), i)), *[F.transform("wide", hits(b)) for b in range(1, BANDS + 1)]]
    held = stash(rows.select("row", "doc_id", "w", "shorts", F.concat(*found).alias("found")), "license-hits")

    # Where the notices would begin; then each text once, for the words of those places.
    meet = held.select("row", F.explode("found").alias("f")).select("row", "f.band", "f.key", "f.at").join(F.broadcast(keys), ["band", "key"])  # MOST_KEYS rows, or one notice's
    begin = F.explode(F.array(F.col("at") - F.col("own"), F.col("at") - F.col("own") - F.col("early"))).alias("begin")
    meet = meet.select("row", "license", "take", begin)
    starts = meet.groupBy("row").agg(F.collect_set(F.struct("license", F.greatest("begin", F.lit(0)).alias("start"), "take")).alias("starts"))
    near = F.transform("starts", lambda x: F.struct(x["license"].alias("license"), x["start"].alias("start"), F.slice("w", x["start"] + 1, 2 * x["take"] + SHINGLE).alias("near")))
    placed = held.select("row", "doc_id", "w").join(starts, "row").select("row", "doc_id", near.alias("places")).select("row", "doc_id", F.explode("places").alias("p"))
    placed = placed.select("row", "doc_id", "p.license", "p.start", shingle_texts(F.col("p.near")).alias("here")).join(F.broadcast(facts), "license")
    first = F.array_position("here", F.get(F.array_intersect(F.slice("here", F.lit(1), F.col("take")), "shingles"), F.lit(0)))
    placed = placed.withColumn("first", first).where("first > 0")
    share = F.size(F.array_intersect("shingles", F.slice("here", F.col("first").cast("int"), F.col("take")))) / F.size("shingles")
    placed = placed.select("row", "doc_id", "license", "n_words", F.size("shingles").alias("n"), (F.col("start") + F.col("first") - 1).cast("int").alias("word_at"), share.alias("containment")).where(F.col("containment") >= CONTAINMENT)
    own = placed.groupBy("row", "license").agg(F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_set(F.struct("word_at", "containment"))).alias("found"), F.max("n_words").alias("n_words"), F.max("n").alias("n"))
    slack, least = 2 + F.ceil(F.col("n_words") / 5).cast("int"), F.ceil(F.col("n") * CONTAINMENT).cast("int") + SHINGLE - 1
    out = own.select("doc_id", "license", F.explode(places(F.col("found"), slack, least)).alias("p")).select("doc_id", "license", "p.word_at", "p.containment")

    said = held.where(F.size("shorts") > 0).select("doc_id", "w", F.explode("shorts").alias("license")).join(F.broadcast(named.select("license", F.split("phrase", " ").alias("p"))), "license")  # of the notices
    stands = lambda i: functools.reduce(lambda x, y: x & y, [(F.size("p") <= k) | F.coalesce(F.get("w", i + k) == F.get("p", F.lit(k)), F.lit(False)) for k in range(SHINGLE - 1)])
    at = F.filter(upto(F.size("w")), stands)
    said = said.select("doc_id", "license", F.explode(at).alias("word_at"), F.lit(1.0).alias("containment"))
    return out.unionByName(said)


def places(found: Column, slack: Column, least: Column) -> Column:
    """One of each run of overlapping finds (word_at, containment) in order: the best that begins within slack of the first.

    The next run begins `least` words on, the fewest that a verified place spans.
    """
    kind = "array<struct<word_at:int,containment:double,first:int>>"
    new = lambda x, first: F.array(F.struct(x["word_at"].alias("word_at"), x["containment"].alias("containment"), first.alias("first"))).cast(kind)

    def step(acc: Column, x: Column) -> Column:
        last = F.get(acc, F.size(acc) - 1)
        better = (x["word_at"] <= last["first"] + slack) & (x["containment"] > last["containment"])
        begins = (F.size(acc) == 0) | (x["word_at"] >= last["first"] + least)
        return F.when(begins, F.concat(acc, new(x, x["word_at"]))).when(better, F.concat(F.slice(acc, 1, F.size(acc) - 1), new(x, last["first"]))).otherwise(acc)

    return F.aggregate(found, F.array().cast(kind), step)
