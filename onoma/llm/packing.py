"""Bounded-space online packing of tokenised documents into windows of fixed length.

A task keeps at most `spaces` open windows. A piece goes to the open window that it fills best; when none has room,
the fullest window takes as much of the piece as fits, is closed, and the rest is placed again. Windows still open at
the end are merged over ever fewer tasks in the same way.
"""

from __future__ import annotations

import bisect
import importlib.util
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onoma.llm.common import map_arrow, stash

WINDOW, SPACES, END_ID = 2048, 64, 1
VOCABULARY = "word_bpe_49k.json"
#: Atoms of a generation that a worker remembers (two generations at most), their longest, characters of a block, and words that are encoded as one text.
CACHE, LONGEST, BLOCK, GLUED = 250_000, 64, 4_000_000, 200
#: Open tasks that one task merges.
FAN_IN = 32
PIECE = "doc_id long, start long, length long, doc_tokens long, ids binary, sequence_id long, offset long, open boolean"
#: Stands between words that are encoded in one go; words that hold it are encoded alone.
_MARK = "\x01"
#: Plain words: Latin letters, which the rules only make lower case and never split.
_LATIN = "^[a-zÀ-ÖØ-öø-ÿ]+$"
#: Punctuation that the rules cut off behind a letter or digit; apostrophes may begin a contraction.
_TAIL = "!\"#$%&()*+,-./:;=?@[\\]^_`{|}~"
_CUT_BEFORE_TAIL = "(?:[a-z0-9]|^[a-zß-öø-ÿ]+)$"


@dataclass(frozen=True)
class Atoms:
    """Different strings, how many ids each has, and all ids one after the other."""

    names: pa.Array
    lengths: np.ndarray
    ids: np.ndarray

    def at(self, places: np.ndarray) -> Atoms:
        n = self.lengths[places]
        begin = (np.cumsum(self.lengths) - self.lengths)[places]
        return Atoms(self.names.take(pa.array(places)), n, self.ids[np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())])

    def find(self, names: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of names: which are here, their places, and which are not."""
        got = pc.index_in(names, self.names)
        here = got.is_valid().to_numpy(zero_copy_only=False)
        return np.flatnonzero(here), got.drop_null().to_numpy(), np.flatnonzero(~here)

    def short(self) -> Atoms:
        """Those of at most LONGEST bytes: the cache is bounded by bytes, too."""
        fits = pc.binary_length(self.names).to_numpy() <= LONGEST
        return self if fits.all() else self.at(np.flatnonzero(fits))


def join(parts: list[Atoms]) -> Atoms:
    return Atoms(pa.concat_arrays([x.names for x in parts]), np.concatenate([x.lengths for x in parts]), np.concatenate([x.ids for x in parts]))


NO_ATOMS = Atoms(pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, "<u4"))


class Encoder:
    """ids of texts, uint32: the tokenizer's own, found word by word.

    The vocabulary's rules never join across ASCII white space and know no case, so each run between blanks has its own
    ids, and a run is an atom and the punctuation behind it. Arrow splits a block of texts and finds its different
    atoms; only those that neither generation of the cache knows are encoded, many at a time: plain words, each of which
    ends in an end-of-word token, without the steps that would not change them. Vocabularies of other rules than those of
    VOCABULARY's have their texts encoded one by one.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer, self.young, self.old = Tokenizer.from_file(path), NO_ATOMS, NO_ATOMS
        self.by_words = rules_of(path) == rules_of(default_vocabulary())
        if not self.by_words:
            return
        mark = self.tokenizer.encode(_MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[k for w, k in vocab.items() if w.endswith("</w>")]] = True

    def learn(self, new: pa.Array) -> tuple[np.ndarray, Atoms]:
        """ids of runs of no blanks, in another order, which comes first."""
        latin = pc.match_substring_regex(new, _LATIN).to_numpy(zero_copy_only=False)
        marked = pc.match_substring(new, _MARK).to_numpy(zero_copy_only=False) | (self.mark is None)
        plain, glue, alone = (np.flatnonzero(x) for x in (latin, ~latin & ~marked, ~latin & marked))
        words = pc.utf8_lower(new.take(pa.array(plain))).to_numpy(zero_copy_only=False).tolist()
        ids = self.run(self.plain, [" ".join(words[k : k + GLUED]) for k in range(0, len(words), GLUED)])
        parts, lengths = [ids], [np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)]
        if words := new.take(pa.array(glue)).to_pylist():
            ids = self.run(self.tokenizer, [f" {_MARK} ".join([*words[k : k + GLUED], ""]) for k in range(0, len(words), GLUED)])
            parts.append(ids[ids != self.mark])
            lengths.append(np.diff(np.flatnonzero(ids == self.mark), prepend=-1) - 1)
        for x in new.take(pa.array(alone)).to_pylist():
            parts.append(self.run(self.tokenizer, [x]))
            lengths.append(np.array([len(parts[-1])]))
        order = np.concatenate([plain, glue, alone])
        return order, Atoms(new.take(pa.array(order)), np.concatenate(lengths), np.concatenate(parts))

    def run(self, tokenizer, texts: list[str]) -> np.ndarray:  # noqa: ANN001
        out = [np.zeros(0, "<u4")]
        for k in range(0, len(texts), 50):
            out += [np.array(e.ids, "<u4") for e in tokenizer.encode_batch_fast(texts[k : k + 50], add_special_tokens=False)]
        return np.concatenate(out)

    def ids_of(self, names: pa.Array) -> tuple[np.ndarray, Atoms]:
        """Atoms and each name's place in them: from the younger generation, the older, or anew; when the younger is full the older goes."""
        if len(self.young.names) > CACHE:
            self.old, self.young = self.young, NO_ATOMS
        first, at, rest = self.young.find(names)
        second, more, other = self.old.find(names.take(pa.array(rest)))
        order, new = self.learn(names.take(pa.array(rest[other])))
        found = [self.young.at(at), self.old.at(more), new]
        self.young = join([self.young, *[x.short() for x in found[1:]]])
        place = np.empty(len(names), np.int64)
        place[np.concatenate([first, rest[second], rest[other][order]])] = np.arange(len(names))
        return place, join(found)

    def encode_batch(self, texts: pa.Array | list[str | None]) -> list[np.ndarray]:
        col = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        if not self.by_words:
            return [np.array(e.ids, "<u4") for k in range(0, len(col), 50) for e in self.tokenizer.encode_batch_fast(col.slice(k, 50).to_pylist(), add_special_tokens=False)]
        control = pc.match_substring(col, "<|")  # control tokens are told by their case: such texts are encoded whole
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.if_else(control, "", col)))
        runs = lists.flatten().dictionary_encode()
        atoms, tails = (x.dictionary_encode() for x in cut_tails(runs.dictionary))
        place, known = self.ids_of(pa.concat_arrays([atoms.dictionary, tails.dictionary]))
        bounds = np.concatenate([[0], np.cumsum(known.lengths)]).astype(np.int32)
        parts = pa.ListArray.from_arrays(bounds, pa.array(known.ids))
        both = np.stack([place[atoms.indices.to_numpy()], place[len(atoms.dictionary) + tails.indices.to_numpy()]], axis=1)
        of_run = parts.take(pa.array(both.ravel()))  # an atom and its tail after the other
        of_run = pa.ListArray.from_arrays(pa.array(of_run.offsets.to_numpy()[::2]), of_run.values)
        whole = of_run.take(runs.indices)
        ids, at = whole.values.to_numpy(), whole.offsets.to_numpy()[lists.offsets.to_numpy()].tolist()
        out = [ids[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        for k in np.flatnonzero(control.to_numpy(zero_copy_only=False)).tolist():
            out[k] = np.array(self.tokenizer.encode(col[k].as_py(), add_special_tokens=False).ids, "<u4")
        return out


def cut_tails(runs: pa.StringArray) -> tuple[pa.Array, pa.Array]:
    """(atoms, tails) of runs; a tail is empty where the rules might not cut before it."""
    body = pc.ascii_rtrim(runs, characters=_TAIL)
    cut = pc.match_substring_regex(body, _CUT_BEFORE_TAIL)
    n = np.where(cut.to_numpy(zero_copy_only=False), pc.binary_length(runs).to_numpy() - pc.binary_length(body).to_numpy(), 0)
    ends, total = np.frombuffer(runs.buffers()[1], np.int32)[runs.offset + 1 : runs.offset + len(runs) + 1], np.cumsum(n)
    at = np.repeat(ends - total, n) + np.arange(n.sum())
    data = np.frombuffer(runs.buffers()[2] or b"", np.uint8)[at]
    tails = pa.StringArray.from_buffers(len(runs), pa.py_buffer(np.concatenate([[0], total]).astype(np.int32)), pa.py_buffer(data))
    return pc.if_else(cut, body, runs), tails


def rules_of(path: str | None) -> dict | None:
    """What a vocabulary's file says of how texts become words and words tokens, without the tokens themselves."""
    if path is None:
        return None
    with open(path, encoding="utf-8") as f:
        said = json.load(f)
    model = {k: v for k, v in said.get("model", {}).items() if k not in ("vocab", "merges")}
    return {"model": model, "tokens": [{k: v for k, v in t.items() if k != "id"} for t in said.get("added_tokens", [])], **{k: said.get(k) for k in ("normalizer", "pre_tokenizer")}}


def default_vocabulary() -> str | None:
    """The public vocabulary's path, where it is installed."""
    if importlib.util.find_spec("public_tokenizers") is None:
        return None
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


_encoders: dict[str, Encoder] = {}


def encoder(path: str | None) -> Encoder:
    """One per Python worker; without a path the public vocabulary of VOCABULARY."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    path = path or default_vocabulary()
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Packer:
    """Open windows sorted by their room; closed ones go to rows."""

    def __init__(self, first_id: int, window: int, spaces: int, least_cut: int = 1):
        self.next_id, self.window, self.spaces, self.least_cut = first_id, window, spaces, least_cut
        self.open: list[tuple[int, int]] = []  # (room, sequence id)
        self.held: dict[int, list[tuple]] = {}
        self.rows: list[tuple] = []

    def close(self, seq: int) -> None:
        self.rows += [(*p, seq, False) for p in self.held.pop(seq)]

    def put(self, piece: tuple, room: int, seq: int) -> None:
        """piece: (doc_id, start, ids, doc_tokens), no longer than the room."""
        n = len(piece[2])
        self.held.setdefault(seq, []).append((*piece, self.window - room))
        if room == n:
            self.close(seq)
        else:
            bisect.insort(self.open, (room - n, seq))

    def add(self, doc_id: int | None, start: int, ids: np.ndarray, doc_tokens: int) -> None:
        while len(ids):
            n = len(ids)
            if n >= self.window:
                self.rows.append((doc_id, start, ids[: self.window], doc_tokens, 0, self.next_id, False))
                self.next_id += 1
                start, ids = start + self.window, ids[self.window :]
                continue
            k = bisect.bisect_left(self.open, (n, -1))
            if k < len(self.open):  # best fit: the least room that is enough
                room, seq = self.open.pop(k)
                self.put((doc_id, start, ids, doc_tokens), room, seq)
                return
            if len(self.open) < self.spaces:
                seq, self.next_id = self.next_id, self.next_id + 1
                self.put((doc_id, start, ids, doc_tokens), self.window, seq)
                return
            room, seq = self.open.pop(0)  # the fullest
            if room < self.least_cut:
                self.close(seq)
                continue
            self.put((doc_id, start, ids[:room], doc_tokens), room, seq)
            start, ids = start + room, ids[room:]

    def leave(self) -> None:
        """What is open stays open, for a later round."""
        for _, seq in self.open:
            self.rows += [(*p, seq, True) for p in self.held.pop(seq)]
        self.open = []

    def take(self) -> pa.RecordBatch | None:
        rows, self.rows = self.rows, []
        if not rows:
            return None
        doc, start, ids, total, offset, seq, is_open = zip(*rows, strict=True)
        cols = [pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array([len(x) for x in ids], pa.int64()), pa.array(total, pa.int64()), pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()), pa.array(seq, pa.int64()), pa.array(offset, pa.int64()), pa.array(is_open)]
        return pa.RecordBatch.from_arrays(cols, ["doc_id", "start", "length", "doc_tokens", "ids", "sequence_id", "offset", "open"])


def _blocks(batch: pa.RecordBatch, chars: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """The batch in blocks of about so many characters."""
    sizes = np.cumsum(pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        done = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, done + chars, "right")))
        yield batch.slice(at, to - at)
        at = to


def _pack(path: str | None, window: int, spaces: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(TaskContext.get().partitionId() << 36, window, spaces)
        end = np.array([end_id], np.uint32)
        for batch in batches:
            for b in _blocks(batch):
                for doc_id, ids in zip(b.column(0).to_pylist(), encoder(path).encode_batch(b.column(1)), strict=True):
                    ids = np.concatenate([ids, end])
                    packer.add(doc_id, 0, ids, len(ids))
                if out := packer.take():
                    yield out
        packer.leave()
        if out := packer.take():
            yield out

    return run


def _merge(level: int, window: int, spaces: int, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(level << 58 | TaskContext.get().partitionId() << 36, window, spaces)
        for b in batches:
            for r in b.to_pylist():
                packer.add(r["doc_id"], r["start"], np.frombuffer(r["ids"], np.uint32), r["doc_tokens"])
            if out := packer.take():
                yield out
        if last:
            rest = [p[:4] for _, seq in packer.open for p in packer.held[seq]]
            packer.open, packer.held, packer.spaces = [], {}, 1
            for p in rest:  # into one window after the other: a single one stays short
                packer.add(*p)
            for _, seq in packer.open:
                packer.close(seq)
        else:
            packer.leave()
        if out := packer.take():
            yield out

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, window: int = WINDOW, spaces: int = SPACES, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, length, doc_tokens, ids, sequence_id, offset): each id of each document in exactly one piece.

    ids: little-endian uint32, the document's token ids followed by end_id. Null and empty texts are the end id alone;
    documents longer than a window fill windows of their own, their rest is packed; repeated rows and null ids are
    packed like any other; an empty table gives an empty result; other columns are ignored. Only one sequence is short.
    Of windows that a piece fills equally well the one opened first takes it, as of equally full ones the first is closed.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    done = stash(map_arrow(rows, _pack(vocabulary, window, spaces, end_id), PIECE), "pieces")
    out, level = done.where("not open").drop("open"), 1
    left = done.where("open").withColumn("task", F.shiftright("sequence_id", 36))
    tasks = (left.agg(F.max("task")).first()[0] or 0) + 1
    while True:
        tasks = -(-tasks // FAN_IN)
        key = (F.col("task") / FAN_IN).cast("long") if tasks > 1 else F.lit(0)
        dealt = left.withColumn("to", F.pmod(key, F.lit(tasks)).cast("int")).repartition(tasks, "to").sortWithinPartitions("task", "sequence_id", "offset").drop("task", "to")
        done = stash(map_arrow(dealt, _merge(level, window, spaces, tasks == 1), PIECE), "merged")
        out = out.unionByName(done.where("not open").drop("open"))
        if tasks == 1:
            return out
        left, level = done.where("open").withColumn("task", F.shiftright(F.col("sequence_id").bitwiseAND(F.lit((1 << 58) - 1)), 36)), level + 1
