"""Quality rules: a decision list learned from labelled documents by sequential covering.

A rule is a conjunction of thresholds on text statistics. It is grown on two thirds of the sample by information gain,
pruned on the rest, and kept while it is precise there; the documents that it covers then leave the sample. The list
becomes one ordered Spark conditional expression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from onoma.llm.common import map_arrow

#: Bound of the labelled sample.
SAMPLE = 20_000
MIN_WORDS, MOST_REPEAT = 50, 50
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_digits", "n_marks", "n_lines")
_SYMBOLS, _BLANKS, _MARKS = b"#*$%&|<>", b" \t\n\r\x0b\x0c", b"!?"
_UPPER, _DIGITS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"
#: Statistics that rules test, from COUNTS.
RATIOS = {
    "n_words": ("n_words", None),
    "symbols_per_word": ("n_symbols", "n_words"),
    "chars_per_word": ("word_chars", "n_words"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "marks_per_word": ("n_marks", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
}


def repeated_words(ws: list[bytes], n: int = 3) -> int:
    """Words that lie in an n-word window found twice or more, first finds included."""
    if len(ws) <= n:
        return 0
    index: dict[bytes, int] = {}
    a = np.array([index.setdefault(w, len(index)) for w in ws], np.int64)
    key = a[: len(a) - n + 1]
    for k in range(1, n):
        if k > 1:
            key = np.unique(key, return_inverse=True)[1]
        key = key * len(index) + a[k : len(a) - n + 1 + k]
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    hit = count[inverse] > 1
    cover = np.zeros(len(ws), bool)
    for k in range(n):
        cover[k : k + len(hit)] |= hit
    return int(cover.sum())


def counts(text: str | None) -> tuple[int, ...]:
    """COUNTS of a text; null: all 0."""
    if not text:
        return (0,) * len(COUNTS)
    raw = text.encode("utf-8", "replace")
    ws = raw.split()
    has = lambda of: len(raw) - len(raw.translate(None, of))
    seen: set[bytes] = set()
    dup = lines = 0
    for x in raw.split(b"\n"):
        if x and not x.isspace():
            lines += 1
            dup += x in seen
            seen.add(x)
    return len(ws), len(text) - has(_BLANKS), has(_SYMBOLS), dup, repeated_words(ws), has(_UPPER), has(_DIGITS), has(_MARKS), lines


def with_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with the columns COUNTS (long); own columns of these names are replaced."""
    docs = docs.drop(*COUNTS)
    at = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, *[T.StructField(c, T.LongType()) for c in COUNTS]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = np.array([counts(x.as_py()) for x in b.column(at)], np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(got[:, k].copy()) for k in range(len(COUNTS))]], schema.names)

    return map_arrow(docs, run, schema)


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    at: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.name] > self.at if self.above else x[self.name] <= self.at


Rule = tuple[Condition, ...]


def ratios(c: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {k: c[a].astype(float) / np.maximum(c[b], 1) if b else c[a].astype(float) for k, (a, b) in RATIOS.items()}


def _covers(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for c in rule:
        out &= c.holds(x)
    return out


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, longest: int = 4) -> Rule:
    rule: list[Condition] = []
    inside = np.ones(len(bad), bool)
    while len(rule) < longest:
        p0, n0 = bad[inside].sum(), inside.sum()
        if p0 == n0:
            break
        best = (1e-9, None)
        for name, v in x.items():
            own, b = v[inside], bad[inside]
            for at in np.unique(np.quantile(own, np.linspace(0, 1, 65), method="lower")):
                for above in (True, False):
                    m = own > at if above else own <= at
                    p, n = b[m].sum(), m.sum()
                    if p:
                        gain = p * (np.log2(p / n) - np.log2(p0 / n0))
                        if gain > best[0]:
                            best = (gain, Condition(name, above, float(at)))
        if best[1] is None:
            break
        rule.append(best[1])
        inside &= best[1].holds(x)
    return tuple(rule)


def learn(c: dict[str, np.ndarray], bad: np.ndarray, precision: float = 0.9, most: int = 12) -> tuple[Rule, ...]:
    """Rules that cover bad documents, in order; c has COUNTS. Every third document prunes.

    Of conditions of equal gain the first counts, by RATIOS' order, lower thresholds, and `above` before `at most`; of pruned rules of
    equal worth the longest. Without a bad document, or with bad ones alone, there is no rule.
    """
    x, rules = ratios(c), []
    prunes = np.arange(len(bad)) % 3 == 2
    left = np.ones(len(bad), bool)
    part = lambda m: {k: v[m] for k, v in x.items()}
    while len(rules) < most and (bad & left & ~prunes).sum() >= 3:
        rule = _grow(part(left & ~prunes), bad[left & ~prunes])
        if not rule:
            break
        m = left & prunes

        def worth(r: Rule, m: np.ndarray = m) -> float:
            cover = _covers(r, part(m), int(m.sum()))
            p = bad[m][cover].sum()
            return (2 * p - cover.sum()) / max(cover.sum(), 1)

        rule = max((rule[:k] for k in range(len(rule), 0, -1)), key=worth)
        if (worth(rule) + 1) / 2 < precision:
            break
        rules.append(rule)
        left &= ~_covers(rule, x, len(bad))
    return tuple(rules)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> tuple[Rule, ...]:
    """Rules from at most `sample` labelled documents, chosen by a hash of the id; labels: (doc_id, quality), 0 is bad.

    Labels that are null are left out; of several for one id the lowest counts. Rows of one id, or of equal hash, follow by id;
    rows without an id are not labelled, and null texts have no words. Without labelled rows, or documents: no rules.
    """
    chosen = labels.select(F.col("doc_id").alias("label_id"), F.col("quality").cast("int").alias("label")).where("label_id is not null and label is not null")
    chosen = chosen.orderBy(F.xxhash64("label_id"), "label_id").limit(sample).groupBy("label_id").agg(F.min("label").alias("label"))
    texts = docs.select(F.col(id_col).alias("label_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "label_id")  # at most `sample` rows
    rows = with_counts(texts).drop("text").orderBy(F.xxhash64("label_id"), "label_id").limit(sample).collect()
    got = {k: np.array([r[k] for r in rows], np.int64) for k in COUNTS}
    judged = ~base_failed_of(got)
    return learn({k: v[judged] for k, v in got.items()}, np.array([r["label"] == 0 for r in rows], bool)[judged])


def base_failed_of(c: dict[str, np.ndarray]) -> np.ndarray:
    return (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MOST_REPEAT * c["n_words"])


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEAT * F.col("n_words"))


def verdict(rules: tuple[Rule, ...]) -> Column:
    """The list as one conditional: the first rule that holds rejects; else the document stays."""
    value = {k: F.col(a).cast("double") / F.greatest(F.col(b), F.lit(1)) if b else F.col(a).cast("double") for k, (a, b) in RATIOS.items()}
    out = F.when(base_failed(), False)
    for rule in rules:
        test = F.lit(True)
        for c in rule:
            test = test & (value[c.name] > c.at if c.above else value[c.name] <= c.at)
        out = out.when(test, False)
    return out.otherwise(True)


def judge(docs: DataFrame, rules: tuple[Rule, ...], text_col: str = "text") -> DataFrame:
    """docs with COUNTS, base_failed and kept.

    Null, empty and wordless texts fail the base rule; repeated rows get the same verdict; empty tables stay empty;
    own columns of the names that are added are replaced.
    """
    return with_counts(docs.drop("base_failed", "kept"), text_col).withColumn("base_failed", base_failed()).withColumn("kept", verdict(rules))
