"""The prefix trie of conversations, its subtree totals by time-forward processing.

A node is a distinct sequence of first turns (role, text), the root the empty one.
Nodes are known by a chained digest of their turns, which one sorted stream a
conversation makes; equal nodes of different conversations meet as digests.

Totals of subtrees: nodes are externally sorted by reverse level order, each takes
the messages that its children have put in a priority queue, and sends its own
totals to its parent. The queue spills sorted runs to the shared folder beyond
``QUEUE`` messages. Shards run side by side: a shard is the subtree under a
topmost node with few members (``MEMBERS``, or a 65,536th of all visits), so
however common a first turn is, no shard has more members. What shard roots send
upward is summed by their parents, and a last pass of the same kind runs across
the nodes above, which are 65,536 at most whatever the input's size.

``block`` and ``heads`` rebuild conversations before the trie is made, as forks of
shared beginnings: conversation c begins with the first h turns of
conversation c - c % block (all if fewer, none if absent), h = crc32(c) % heads, and goes on
with its own turns after its first h. Both None: as they are.

The turns of a conversation are in one order, so they pass one task as a stream,
which holds one batch and the turns that others share (``heads`` - 1 at most). The
ids that end at a node are digested as blocks of ``BLOCK`` joined ids.

Defined results: null role or text reads as empty; null turns come first, equal
turns follow in order of role, then text; repeated rows are turns of their own; a null conv_id names
no conversation, its rows are left out; a negative id's remainder is negative, as in SQL;
an empty table gives no rows, the root included. Only the four named columns are read.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import pickle
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm.tables import SharedFiles, prepare, read_bytes, staged
from cinelake.session import fresh_path

#: Members of a shard at least allowed; the most nodes above the shards; messages a queue holds in memory; ids a block.
MEMBERS, ABOVE, QUEUE, BLOCK = 32, 1 << 16, 200_000, 2048
ROWS = 1000

ROOT = b"\0" * 16


def child_key(key: bytes, role: str, text: str) -> bytes:
    """The node after one more turn."""
    said = role.encode()
    return hashlib.sha256(key + len(said).to_bytes(8, "big") + said + text.encode()).digest()[:16]


def shared_turns(conv: int, heads: int) -> int:
    return zlib.crc32(str(conv).encode()) % heads


# -- visits: a row for each conversation and node on its path ----------------------------

VISITS = "key binary, parent binary, depth long, chars long, conv_id long, ends boolean"


class _Path:
    """The walk of one conversation down the trie; a row is put out when its successor is known."""

    def __init__(self, conv: int):
        self.conv, self.own = conv, 0
        self.row = (ROOT, None, 0, 0)

    def turn(self, role: str, text: str) -> tuple:
        key, _, depth, _ = before = self.row
        self.row = (child_key(key, role, text), key, depth + 1, len(text))
        return (*before, self.conv, False)

    def end(self) -> tuple:
        return (*self.row, self.conv, True)


def visits(conversations: DataFrame, block: int | None = None, heads: int | None = None) -> DataFrame:
    c = conversations
    prepare(c.sparkSession)
    conv = c["conv_id"].cast("long")
    rows = c.where(c["conv_id"].isNotNull()).select(
        (conv - conv % block if block else conv).alias("base"), conv.alias("conv_id"), c["turn"].cast("long").alias("turn"),
        F.coalesce(c["role"].cast("string"), F.lit("")).alias("role"),
        F.coalesce(c["text"].cast("string"), F.lit("")).alias("text"))
    rows = rows.repartition("base").sortWithinPartitions(
        "base", F.col("conv_id") != F.col("base"), "conv_id", "turn", "role", "text")

    def walk(batches) -> Iterator[tuple]:
        now, base, head, skip = None, None, [], 0
        for batch in batches:
            for group, conv, role, text in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3, 4))):
                if now is None or conv != now.conv:
                    if now is not None:
                        yield now.end()
                    if group != base:
                        base, head = group, []
                    now, skip = _Path(conv), 0
                    if block and conv != base:
                        skip = shared_turns(conv, heads)
                        for shared in head[:skip]:
                            yield now.turn(*shared)
                if block and conv == base and len(head) < heads - 1:
                    head.append((role, text))
                if now.own >= skip:
                    yield now.turn(role, text)
                now.own += 1
        if now is not None:
            yield now.end()

    return rows.mapInArrow(lambda batches: _batches(walk(batches), _VISIT_TYPES), VISITS)


def _types(**kinds) -> pa.Schema:
    return pa.schema([pa.field(n, k) for n, k in kinds.items()])


_VISIT_TYPES = _types(key=pa.binary(), parent=pa.binary(), depth=pa.int64(), chars=pa.int64(), conv_id=pa.int64(), ends=pa.bool_())


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


# -- time-forward processing ---------------------------------------------------------------

class SpillingQueue:
    """Messages in order of (key, ...). Beyond ``limit`` they are written as a
    sorted run to the shared folder and merged from there; a run is removed once read."""

    def __init__(self, folder: str, limit: int = QUEUE):
        self.folder, self.limit, self.heap, self.runs = folder, limit, [], []
        self.spilled, self.numbers = 0, itertools.count()

    def push(self, message: tuple) -> None:
        if len(self.heap) >= self.limit:
            self._spill()
        heapq.heappush(self.heap, message)

    def _spill(self) -> None:
        files, name = SharedFiles(self.folder), f"run-{uuid.uuid4().hex}"
        self.heap.sort()
        with files.write(name) as out:
            for k in range(0, len(self.heap), ROWS):
                packed = pickle.dumps(self.heap[k:k + ROWS])
                out.write(len(packed).to_bytes(8, "big") + packed)
        self.heap, self.spilled = [], self.spilled + 1
        self._refill(_run(files, name))

    def _refill(self, run: Iterator[tuple]) -> None:
        first = next(run, None)
        if first is not None:
            heapq.heappush(self.runs, (first, next(self.numbers), run))

    def pop(self, least: tuple) -> Iterator[tuple]:
        """Takes all messages whose first fields are ``least``."""
        n = len(least)
        while True:
            own = self.heap[0] if self.heap else None
            far = self.runs[0][0] if self.runs else None
            if own is not None and (far is None or own <= far):
                if own[:n] != least:
                    return
                yield heapq.heappop(self.heap)
            elif far is not None and far[:n] == least:
                message, _, run = heapq.heappop(self.runs)
                self._refill(run)
                yield message
            else:
                return


def _run(files: SharedFiles, name: str) -> Iterator[tuple]:
    with files.read(name) as file:
        at, size = 0, file.size()
        while at < size:
            length = int.from_bytes(read_bytes(file, at, 8), "big")
            yield from pickle.loads(read_bytes(file, at + 8, length))
            at += 8 + length
    files.remove(name)


NODES = ("key binary, parent binary, depth long, conv_id long, n_convs long, n_children long, n_leaves long, "
         "saved_tokens long")
_NODE_TYPES = _types(key=pa.binary(), parent=pa.binary(), depth=pa.int64(), conv_id=pa.int64(), n_convs=pa.int64(),
                     n_children=pa.int64(), n_leaves=pa.int64(), saved_tokens=pa.int64())


def time_forward(nodes: Iterator[tuple], queue: SpillingQueue) -> Iterator[tuple]:
    """Subtree totals of nodes in reverse level order: (key, parent, depth,
    conv_id, n_convs, top, own saving, children, leaves and saving from other shards);
    ``top`` says that the parent lies in another shard."""
    for key, parent, depth, conv, n, top, saved, children, leaves in nodes:
        for *_, below, gain in queue.pop((-depth, key)):
            children, leaves, saved = children + 1, leaves + below, saved + gain
        leaves = leaves if children else 1
        if not top:
            queue.push((1 - depth, parent, leaves, saved))
        yield key, parent, depth, conv, n, children, leaves, saved


def _forwarded(nodes: DataFrame) -> DataFrame:
    """``nodes``, partitioned by shard, with their totals."""
    folder = fresh_path(nodes.sparkSession, "trie-queue")

    def run(batches):
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
        return _batches(time_forward(rows, SpillingQueue(folder)), _NODE_TYPES)

    ordered = nodes.sortWithinPartitions(F.desc("depth"), "key").select(
        "key", "parent", "depth", "conv_id", "n_convs", "top", "saved", "children", "leaves")
    return ordered.mapInArrow(run, NODES)


def _totals(walked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes with totals: those in shards, those above them (ABOVE at most)."""
    nodes = staged(walked.groupBy("key").agg(
        F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("chars").alias("chars"),
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")), "trie-nodes")
    nodes = nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("chars"))
    visited = nodes.agg(F.sum("n_convs")).first()[0] or 0
    above = F.col("n_convs") > max(MEMBERS, -(-visited // ABOVE))
    keys = F.broadcast(nodes.where(above).select("key"))  # ABOVE keys at most: each has over an ABOVE-th of all visits
    tops = walked.join(keys.withColumnRenamed("key", "parent"), "parent", "left_semi").unionByName(
        walked.where(F.col("parent").isNull())).join(keys, "key", "left_anti").select("conv_id", F.col("key").alias("shard"))
    none = [F.lit(0).cast("long").alias(c) for c in ("children", "leaves")]
    light = nodes.where(~above).join(tops, "conv_id").repartition("shard").select(
        *nodes.columns, (F.col("key") == F.col("shard")).alias("top"), *none)
    inside = staged(_forwarded(light), "trie-shards")
    sent = inside.join(keys.withColumnRenamed("key", "parent"), "parent", "left_semi").groupBy("parent").agg(
        F.count(F.lit(1)).alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("gain"))
    get = lambda name: F.coalesce(F.col(name), F.lit(0))
    heavy = nodes.where(above).join(sent.withColumnRenamed("parent", "key"), "key", "left").select(
        "key", "parent", "depth", "conv_id", "n_convs", F.col("parent").isNull().alias("top"),
        (F.col("saved") + get("gain")).alias("saved"), get("children").alias("children"), get("leaves").alias("leaves"))
    return inside, staged(_forwarded(heavy.repartition(1)), "trie-above")


# -- ends -------------------------------------------------------------------------------------

def _ends(walked: DataFrame) -> DataFrame:
    """(key, ends_sha256) of the nodes where a conversation ends."""
    ids = walked.where("ends").select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions(
        "key", "conv_id")

    def blocks(batches) -> Iterator[tuple]:
        key, held = None, []
        for batch in batches:
            for own, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (own != key or len(held) == BLOCK):
                    yield key, held[0], ",".join(map(str, held))
                    held = []
                key = own
                held.append(conv)
        if held:
            yield key, held[0], ",".join(map(str, held))

    def digests(batches) -> Iterator[tuple]:
        key, digest = None, None
        for batch in batches:
            for own, joined in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if own != key:
                    if key is not None:
                        yield key, digest.hexdigest()
                    key, digest = own, hashlib.sha256(joined.encode())
                else:
                    digest.update(b"," + joined.encode())
        if key is not None:
            yield key, digest.hexdigest()

    block_types = _types(key=pa.binary(), first=pa.int64(), ids=pa.string())
    joined = ids.mapInArrow(lambda b: _batches(blocks(b), block_types), "key binary, first long, ids string")
    ordered = joined.repartition("key").sortWithinPartitions("key", "first")
    return ordered.mapInArrow(lambda b: _batches(digests(b), _types(key=pa.binary(), ends_sha256=pa.string())),
                              "key binary, ends_sha256 string")


def trie(conversations: DataFrame, block: int | None = None, heads: int | None = None) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256) of every node; conv_id is its smallest member's."""
    walked = staged(visits(conversations, block, heads), "trie-visits")
    inside, above = _totals(walked)
    name = lambda nodes, column: nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias(column))
    # A node in a shard has few children; those above it are few.
    nodes = inside.join(name(inside, "near"), "parent", "left").unionByName(
        above.withColumn("near", F.lit(None).cast("long"))).join(F.broadcast(name(above, "far")), "parent", "left")
    return nodes.join(_ends(walked), "key", "left").select(
        "conv_id", "depth", F.coalesce("near", "far").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
