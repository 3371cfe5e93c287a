"""Language identification by cross-parsing entropy.

Each language has a suffix automaton of labelled text. A text is parsed against it into longest matches; the language
that needs the fewest phrases per symbol, times the bits that name a place in its training text, wins; of equals the
first in order. So that a long text is many short parses, segments of SEGMENT symbols of all texts of a block and of all
languages advance together, one symbol a step. Each segment is then parsed again from where the one before it left off,
until both parses agree, so the phrases are those of whole texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from onoma.llm.common import map_arrow

UNDETERMINED = "und"
#: Bounds of the training sample: texts and symbols of a language, texts and symbols of all together.
TEXTS, SYMBOLS, ALL_TEXTS, ALL_SYMBOLS = 60, 20_000, 60_000, 20_000_000
#: Labels up to which one expression tells where each label's sample ends.
FEW = 200
#: Letters that have a column of the automata's table, at most, and its cells; the edges of all other letters are looked up.
LETTERS, CELLS = 500, 25_000_000
SEGMENT, BLOCK = 1024, 1_000_000


@dataclass(frozen=True)
class Model:
    """Training text of each language, normalised; automata are built from it once per Python worker."""

    texts: tuple[tuple[str, str], ...]


def normalise(text: str) -> str:
    """Lower-cased letters; everything else is one blank between them."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def suffix_automaton(symbols: list[int]) -> tuple[int, np.ndarray]:
    """(states, edges as rows of state, symbol, next state) of the automaton of all substrings; state 0 is the empty one."""
    go, link, length, last = [{}], [-1], [0], 0
    for c in symbols:
        cur = len(go)
        go.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = cur
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                copy = len(go)
                go.append(dict(go[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = copy
                    p = link[p]
                link[q] = link[cur] = copy
        last = cur
    return len(go), np.array([(s, c, t) for s, edges in enumerate(go) for c, t in edges.items()], np.int64).reshape(-1, 3)


class Parser:
    """All languages' automata: next places, as 2 * next state + (1 where a phrase starts).

    Letters are numbered from the most frequent on. A table has a column for the blank, for the first letters, and one for
    all others: rarer letters' edges are a sorted list, and letters of no training text have none.
    """

    def __init__(self, model: Model):
        seen = Counter(c for _, t in model.texts for c in t if c != " ")
        index = {" ": 0} | {c: k + 1 for k, c in enumerate(sorted(seen, key=lambda c: (-seen[c], c)))}
        self.names, made = [name for name, _ in model.texts], [suffix_automaton([index[c] for c in t]) for _, t in model.texts]
        self.bits = [np.log2(len(t) + 1) for _, t in model.texts]
        states = sum(n for n, _ in made)
        self.letters = len(index)  # the number of any letter of no training text, too
        self.width = min(len(index), LETTERS + 1, max(1, CELLS // max(1, states) - 1)) + 1
        every = np.frombuffer("".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000)))).encode("utf-32-le"), np.uint32)
        self.symbol = np.zeros(0x110000, np.int32)
        self.symbol[[int(c) for c in every if chr(c).isalpha()]] = self.letters
        for c, k in index.items():
            self.symbol[ord(c)] = k
        self.roots, tables, rare, at = [], [], [], 0
        for n, (s, c, t) in ((n, edges.T) for n, edges in made):
            first = np.zeros(self.letters + 1, np.int64)  # from the root, itself where a letter is unknown
            first[c[s == 0]] = t[s == 0]
            table = np.broadcast_to((first[: self.width] + at) * 2 + 1, (n, self.width)).copy()  # a phrase starts
            table[:, -1] = at * 2 + 1
            common = (c < self.width - 1) & (s > 0)
            table[s[common], c[common]] = (t[common] + at) * 2
            tables.append(table.astype(np.int32))
            odd = c >= self.width - 1
            rare.append(np.stack([(s[odd] + at) * (self.letters + 1) + c[odd], (t[odd] + at) * 2 + (s[odd] == 0)]))
            self.roots.append(at)
            at += n
        self.table = np.concatenate([*tables, np.zeros((0, self.width), np.int32)]).ravel()
        self.keys, self.values = np.concatenate([*rare, np.zeros((2, 0), np.int64)], axis=1)
        order = np.argsort(self.keys)
        self.keys, self.values = np.append(self.keys[order], -1), np.append(self.values[order], 0).astype(np.int32)

    def step(self, state: np.ndarray, sym: np.ndarray, root: np.ndarray) -> np.ndarray:
        """Where states (in cells of the table) go by symbols; root: the states' own roots."""
        if self.letters < self.width:  # no letter is rare
            return self.table[state + sym]
        got = self.table[state + np.minimum(sym, self.width - 1)]
        rare = (sym >= self.width - 1) & (sym < self.letters)
        if rare.any():
            at = np.nonzero(np.broadcast_to(rare, got.shape))
            own, c, base = state[at] // self.width, np.broadcast_to(sym, got.shape)[at].astype(np.int64), np.broadcast_to(root, got.shape)[at] // self.width
            found, place = self.look(own, c)
            fresh, start = self.look(base, c)
            got[at] = np.where(found, place, np.where(fresh, start, base * 2 + 1))
        return got

    def look(self, state: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = state * np.int64(self.letters + 1) + c
        at = np.minimum(np.searchsorted(self.keys[:-1], key), len(self.keys) - 1)
        return self.keys[at] == key, self.values[at]

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: phrases of each language (languages x texts), symbols, letters."""
        low = [t.lower() for t in texts]
        lens = np.array([len(t) for t in low], np.int64)
        sym = self.symbol[np.frombuffer("".join(low).encode("utf-32-le", "replace"), np.uint32)]
        owner = np.repeat(np.arange(len(low), dtype=np.int32), lens)
        blank = sym == 0
        keep = np.ones(len(sym), bool)
        if len(sym):
            keep[1:] = ~blank[1:] | ~blank[:-1] & (owner[1:] == owner[:-1])
            keep[0] = not blank[0]
        sym, owner = sym[keep].astype(np.int32), owner[keep]
        n = np.bincount(owner, minlength=len(low)).astype(np.int64)
        letters = np.bincount(owner[sym != 0], minlength=len(low))
        pieces = -(-n // SEGMENT)
        doc = np.repeat(np.arange(len(low)), pieces)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = np.repeat(np.cumsum(n) - n, pieces) + nth * SEGMENT
        size = np.minimum(SEGMENT, n[doc] - nth * SEGMENT)
        order = np.argsort(-size, kind="stable")
        start, size, doc = start[order], size[order], doc[order]
        roots = np.array(self.roots, np.int32)[:, None]
        state = np.repeat(roots, len(doc), axis=1) * self.width
        count, final = np.zeros_like(state), np.empty_like(state)
        active = np.searchsorted(-size, -np.arange(int(size.max(initial=0))), "left")
        for t, k in enumerate(active.tolist()):
            if k < state.shape[1]:
                final[:, k : state.shape[1]] = state[:, k:]
                state = state[:, :k].copy()
            got = self.step(state, sym[start[:k] + t], roots * self.width)
            count[:, :k] += got & 1
            state = (got >> 1) * self.width
        final[:, : state.shape[1]] = state
        back = np.argsort(order)
        start, size, doc, count, final = start[back], size[back], doc[back], count[:, back], final[:, back]
        count += self.carried(sym, start, size, nth, final)
        total = np.array([np.bincount(doc, weights=c, minlength=len(low)) for c in count]).reshape(len(self.names), len(low))
        return total, n, letters

    def carried(self, sym: np.ndarray, start: np.ndarray, size: np.ndarray, nth: np.ndarray, final: np.ndarray) -> np.ndarray:
        """How the counts of segments change if each but a text's first goes on from the state that the one before ends in.

        Both parses of a segment run until their states agree, after which they are one. Where they never do, the
        segment's final state is another, and the next one is done again.
        """
        more, alone = np.zeros_like(final), final.copy()
        lang, lane = (x.ravel() for x in np.meshgrid(np.arange(len(final)), np.flatnonzero(nth > 0), indexing="ij"))
        roots = np.array(self.roots, np.int32) * self.width
        while len(lane):
            whole, own, delta, left = final[lang, lane - 1], roots[lang], np.zeros(len(lane), np.int32), np.arange(len(lane))
            ends, t = alone[lang, lane], 0
            while len(left := left[keep := (whole != own) & (size[lane[left]] > t)]):
                whole, own = whole[keep], own[keep]
                at = sym[start[lane[left]] + t]
                home = roots[lang[left]]
                a, b = self.step(whole, at, home), self.step(own, at, home)
                delta[left] += (a & 1) - (b & 1)
                whole, own, t = (a >> 1) * self.width, (b >> 1) * self.width, t + 1
                over = (whole != own) & (size[lane[left]] == t)
                ends[left[over]] = whole[over]
            more[lang, lane] = delta
            changed = np.flatnonzero(ends != final[lang, lane])
            final[lang, lane] = ends
            lang, lane = lang[changed], lane[changed] + 1
            more_of_text = (lane < len(nth)) & (nth[np.minimum(lane, len(nth) - 1)] > 0)
            lang, lane = lang[more_of_text], lane[more_of_text]
        return more

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The language of each text and how far it leads: 1 - its bits over those of the next."""
        if not self.names:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        total, n, letters = self.phrases([t or "" for t in texts])
        rate = total * np.array(self.bits)[:, None] / np.maximum(n, 1)
        first = rate.argmin(axis=0)
        ordered = np.sort(rate, axis=0)
        lead = 1 - ordered[0] / np.maximum(ordered[1], 1e-12) if len(rate) > 1 else np.ones(len(texts))
        known = letters > 0
        return [self.names[k] if ok else UNDETERMINED for k, ok in zip(first, known, strict=True)], np.where(known, np.clip(lead, 0, 1), 0.0)


_parsers: dict[Model, Parser] = {}


def parser(model: Model) -> Parser:
    if model not in _parsers:
        _parsers.clear()
        _parsers[model] = Parser(model)
    return _parsers[model]


def sample(rows: DataFrame, id_col: str, text_col: str, lang_col: str, texts: int, symbols: int) -> DataFrame:
    """(lang, pos, text): different rows of each label by a hash of id and text, whole, until they have `symbols` characters;
    about twice `texts` of them, never more. Longer texts than that are no rows of the sample, but for the shortest text of a
    label that has none other, which is cut."""
    size = F.char_length(text_col)
    placed = rows.select(F.col(lang_col).alias("lang"), F.pmod(F.xxhash64(F.col(id_col), F.col(text_col), F.lit(7)), F.lit(1 << 40)).alias("pos"), F.col(text_col).alias("text"), size.alias("size"))
    counts = placed.groupBy("lang").agg(F.approx_count_distinct(F.when(F.col("size") <= symbols, F.col("pos"))).alias("n"), F.min("size").alias("least"))
    labels = max(1, counts.count())
    texts, symbols = max(1, min(texts, ALL_TEXTS // labels)), max(1, min(symbols, ALL_SYMBOLS // labels))
    most = (F.lit(1 << 40) * F.least(F.lit(1.0), 2.0 * texts / F.greatest("n", F.lit(1)))).cast("long")
    longest = F.greatest(F.lit(symbols), F.col("least"))
    told = counts.select(F.col("lang").alias("label"), most.alias("most"), longest.alias("longest")).limit(FEW + 1).collect()
    if len(told) <= FEW:
        by = lambda c: F.coalesce(*[F.when(F.col("lang") == r.label, F.lit(r[c])) for r in told], F.lit(-1))
        drawn = placed.where((F.col("pos") <= by("most")) & (F.col("size") <= by("longest")))
    else:  # the same, by a join
        drawn = placed.join(counts.select("lang", most.alias("most"), longest.alias("longest")), "lang").where("pos <= most and size <= longest").drop("most", "longest")
    drawn = drawn.groupBy("lang", "pos").agg(F.min(F.left("text", F.lit(symbols))).alias("text"))
    own = Window.partitionBy("lang").orderBy("pos")
    drawn = drawn.withColumn("nth", F.row_number().over(own)).withColumn("before", F.sum(F.char_length("text")).over(own) - F.char_length("text"))
    return drawn.where((F.col("nth") <= 2 * texts) & (F.col("before") < symbols)).select("lang", "pos", "text")


def fit(docs: DataFrame, usable: Column | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", texts: int = TEXTS, symbols: int = SYMBOLS) -> Model:
    """A model of every label in usable rows, from a bounded sample of whole texts (see `sample`): at most twice `texts` texts
    of a label, until they have `symbols` characters. Equal texts count once, and ids may be null or repeated. With more labels
    than ALL_TEXTS / texts, or ALL_SYMBOLS / symbols, each has fewer.
    """
    rows = docs.where((usable if usable is not None else F.lit(True)) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    drawn = sample(rows, id_col, text_col, lang_col, texts, symbols).collect()  # twice ALL_SYMBOLS characters at most
    own: dict[str, list[str]] = {}
    for lang, _, text in sorted(drawn, key=lambda r: (r[0], r[1], r[2])):
        t, have = normalise(text), own.setdefault(lang, [])
        if t and t not in have:
            have.append(t)
    return Model(tuple((lang, " ".join(ts)) for lang, ts in sorted(own.items()) if ts))


def lettered(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows whose text has a letter: those that `identify` names by any model that knows a language."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([any(map(str.isalpha, t.as_py() or "")) for t in batch.column(at)], pa.bool_()))

    return map_arrow(docs, run, docs.schema)


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with lang_pred and score; own columns of these names are replaced.

    Null texts and texts without a letter are `und` with score 0, as is every text if the model knows no language;
    empty tables stay empty; repeated rows are judged alike.
    """
    docs = docs.drop("lang_pred", "score")
    at = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = parser(model)
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.utf8_length(batch.column(at)), 0).to_numpy(zero_copy_only=False))
            lo, langs, scores = 0, [], []
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + BLOCK, "right")))
                lang, score = p.predict(batch.column(at).slice(lo, hi - lo).to_pylist())
                langs += lang
                scores.append(score)
                lo = hi
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(np.concatenate([*scores, np.zeros(0)]))], schema.names)

    return map_arrow(docs, run, schema)
