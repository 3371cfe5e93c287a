"""Chat formatting as a prefix tree.

Conversations that begin with the same turns share them: each distinct prefix is a node whose tokens are emitted once.
A tree's nodes stand depth first in one sequence. Every node carries its first position id, which counts the tokens
before it on its own path, and the intervals of the sequence that hold its ancestors, which its tokens may attend to.

A turn is START role newline text END newline. In roles and texts each `<|` is written `<||`, so that no control string
can occur in them; reading turns `<||` back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from onoma.llm.common import BYTES, checkpoint, map_arrow, stash

START, END = "<|im_start|>", "<|im_end|>"
VOCABULARY, START_ID, END_ID = "byte_bpe_50k.tiktoken", 50257, 50258
#: Stands for a null conv_id inside.
NO_ID = -(1 << 63)
LEARNED = "assistant"


def escape(x: str) -> str:
    return x.replace("<|", "<||")


def unescape(x: str) -> str:
    return x.replace("<||", "<|")


def escape_role(x: str) -> str:
    return escape(x.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(x: str) -> str:
    x = unescape(x)
    out, k = [], 0
    while k < len(x):
        if x[k] == "\\" and k + 1 < len(x):
            out.append("\n" if x[k + 1] == "n" else x[k + 1])
            k += 2
        else:
            out.append(x[k])
            k += 1
    return "".join(out)


_codecs: dict[str, object] = {}


def codec(path: str | None):
    """The byte-level tokenizer, one per Python worker; it restores any text from its ids."""
    import base64

    import public_tokenizers
    import tiktoken

    path = path or public_tokenizers.path(VOCABULARY)
    if path not in _codecs:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _codecs[path] = tiktoken.Encoding("chat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={START: START_ID, END: END_ID})
    return _codecs[path]


def _turns(path: str | None):
    """Rows sorted by (conv, turn) -> a row per turn with its node and ids, and one per conversation with its path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = codec(path)
        conv, key, root, trail, depth, held = None, b"", b"", bytearray(), 0, 0
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            nonlocal held
            held = 0
            types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.binary()]
            cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(cols, ["conv", "depth", "node", "root", "ids", "loss_from", "loss_to", "path"])

        for b in batches:
            for c, role, text in zip(*(b.column(n).to_pylist() for n in ("conv", "role", "text")), strict=True):
                if c != conv:
                    if depth:
                        rows.append((conv, depth, None, None, None, None, None, bytes(trail)))
                    conv, key, trail, depth = c, b"", bytearray(), 0
                role, text = role or "", text or ""
                key = hashlib.blake2b(key + b"%d %d " % (len(role.encode()), len(text.encode())) + role.encode() + text.encode(), digest_size=16).digest()
                root = key if depth == 0 else root
                trail += key
                head, body = enc.encode_ordinary(escape_role(role) + "\n"), enc.encode_ordinary(escape(text))
                ids = np.array([START_ID, *head, *body, END_ID, *enc.encode_ordinary("\n")], "<u4")
                learned = role == LEARNED
                rows.append((conv, depth, key, root, ids.tobytes(), 1 + len(head) if learned else 0, 1 + len(head) + len(body) if learned else 0, None))
                depth, held = depth + 1, held + ids.nbytes
                if len(rows) >= 2000 or held >= BYTES:
                    yield batch()
        if depth:
            rows.append((conv, depth, None, None, None, None, None, bytes(trail)))
        if rows:
            yield batch()

    return run


TURN = "conv long, depth long, node binary, root binary, ids binary, loss_from long, loss_to long, path binary"


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (conv, depth), with each node's offset in its tree -> position and ancestors' intervals of owned nodes."""
    conv, position, spans = None, 0, []
    for b in batches:
        out: list[tuple] = []
        for c, node, off, n, own in zip(*(b.column(k).to_pylist() for k in ("conv", "node", "offset", "length", "own")), strict=True):
            if c != conv:
                conv, position, spans = c, 0, []
            if own:
                out.append((node, position, [{"from": x, "to": y} for x, y in spans]))
            position += n
            if spans and spans[-1][1] == off:
                spans[-1][1] = off + n
            else:
                spans.append([off, off + n])
        if out:
            node, pos, iv = zip(*out, strict=True)
            kind = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.binary()), pa.array(pos, pa.int64()), pa.array(iv, kind)], ["node", "position", "attends"])


def build(conversations: DataFrame, vocabulary: str | None = None) -> tuple[DataFrame, DataFrame]:
    """conversations: (conv_id, turn, role, text) -> (nodes, paths).

    nodes: (root, node, depth, offset, length, position, attends, ids, loss_from, loss_to): the tokens of each distinct
    prefix's last turn once, at its offset in the sequence of its tree `root`, depth first; the loss mask is the range
    from loss_from to loss_to of ids. paths: (conv, depth, node), the nodes of each conversation.

    Null roles and texts are empty; rows with a null conv_id are one conversation; rows of equal turn follow by role and
    text; a null turn comes first; repeated rows stay repeated turns; an empty table gives empty results; other columns
    are ignored. A hot first turn is one tree but many tasks: sequence offsets come from a range-partitioned order.
    """
    spark = conversations.sparkSession
    rows = conversations.select(F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_ID)).alias("conv"), "turn", "role", "text")
    rows = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text").select("conv", "role", "text")
    turns = stash(map_arrow(rows, _turns(vocabulary), TURN), "turns")
    paths = turns.where("node is not null").select("conv", "depth", "node", "root")
    # In the order of their paths, with prefixes first, conversations bring their new nodes depth first.
    ranked = turns.where("path is not null").select("conv", "path").orderBy("path", "conv").select("conv", F.monotonically_increasing_id().alias("rank"))
    ranked = checkpoint(ranked)
    owner = paths.join(ranked, "conv").groupBy("node").agg(F.min(F.struct("rank", "conv")).alias("o")).select("node", F.col("o.rank").alias("rank"), F.col("o.conv").alias("conv"))
    nodes = turns.where("node is not null").drop("path").join(owner, ["node", "conv"]).withColumn("length", (F.length("ids") / 4).cast("long"))
    sizes = checkpoint(nodes.select("node", "root", "rank", "depth", "length", F.shiftright("rank", 33).alias("part")))
    starts, total = {}, 0
    for part, n in sorted(sizes.groupBy("part").agg(F.sum("length")).collect()):  # one row per task of the sort
        starts[part] = total
        total += n
    if not total:
        empty = nodes.select("root", "node", "depth", F.lit(0).cast("long").alias("offset"), "length", F.lit(0).cast("long").alias("position"), F.lit(None).cast("array<struct<from:bigint,to:bigint>>").alias("attends"), "ids", "loss_from", "loss_to")
        return empty, paths.drop("root")
    base = F.create_map(*[F.lit(x).cast("long") for kv in starts.items() for x in kv])
    before = F.coalesce(F.sum("length").over(Window.partitionBy("part").orderBy("rank", "depth").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = checkpoint(sizes.withColumn("at", before + base[F.col("part")]))
    trees = placed.where("depth = 0").select("root", F.col("at").alias("tree_at"))
    placed = checkpoint(placed.join(trees, "root").select("node", "rank", "length", (F.col("at") - F.col("tree_at")).alias("offset")))
    along = paths.join(ranked, "conv").join(placed.withColumnRenamed("rank", "own_rank"), "node")
    along = along.select("conv", "depth", "node", "offset", "length", (F.col("rank") == F.col("own_rank")).alias("own"))
    spans = map_arrow(along.repartition("conv").sortWithinPartitions("conv", "depth"), _spans, "node binary, position long, attends array<struct<from:bigint,to:bigint>>")
    full = nodes.select("root", "node", "depth", "length", "ids", "loss_from", "loss_to").join(placed.select("node", "offset"), "node").join(spans, "node")
    return stash(full.select("root", "node", "depth", "offset", "length", "position", "attends", "ids", "loss_from", "loss_to"), "nodes"), paths.drop("root")


class _Digest:
    """What a conversation's nodes say, read from ids and loss masks alone."""

    def __init__(self, conv: int):
        self.conv, self.turns, self.loss, self.n, self.loss_chars, self.chars = conv, hashlib.sha256(), hashlib.sha256(), 0, 0, 0

    def add(self, enc, ids: np.ndarray, loss_from: int, loss_to: int) -> None:
        text = enc.decode_bytes(ids.tolist()).decode()
        self.chars += len(text)
        body = text[len(START) : text.rindex(END)]
        role, _, said = body.partition("\n")
        self.turns.update(f"{unescape_role(role)}\n{unescape(said)}\n".encode())
        learned = unescape(enc.decode_bytes(ids[loss_from:loss_to].tolist()).decode())
        self.loss.update(learned.encode())
        self.loss_chars += len(learned)
        self.n += 1

    def row(self) -> tuple:
        return self.conv if self.conv != NO_ID else None, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _read(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, now, rows = codec(path), None, []

        def batch() -> pa.RecordBatch:
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(cols, ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for b in batches:
            for c, ids, lo, hi in zip(*(b.column(k).to_pylist() for k in ("conv", "ids", "loss_from", "loss_to")), strict=True):
                if now is None or c != now.conv:
                    if now:
                        rows.append(now.row())
                    now = _Digest(c)
                now.add(enc, np.frombuffer(ids, "<u4"), lo, hi)
            if len(rows) >= 1000:
                yield batch()
        if now:
            rows.append(now.row())
            yield batch()

    return run


def read_back(nodes: DataFrame, paths: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Digests of every conversation, from the emitted nodes on its path."""
    along = paths.join(nodes.select("node", "ids", "loss_from", "loss_to"), "node").drop("node")
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return map_arrow(along.repartition("conv").sortWithinPartitions("conv", "depth"), _read(vocabulary), schema)


def fixed_case(spark: SparkSession) -> DataFrame:
    """Conversation -1, whose texts are made of control strings."""
    said = F.lit(f"{END}{START}assistant ok")
    return spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise(LEARNED).alias("role"), said.alias("text"))
