"""Prefix trie of conversations from padded matrices of turn ids.

A node is a distinct sequence of first turns. A turn's id is a 128-bit digest of role and text; the
path of a conversation, its turns' digests in a row, is a binary value whose order is that of the
trie. Conversations are range-partitioned by path and conv_id into shards of about ``SHARD_TURNS``
turns, so a path that very many conversations share is split like any other.

Within a shard the digests become small integers and the paths a matrix, a row per conversation,
padded where it is shorter. The matrix is taken in windows of ``WINDOW`` columns, and rows that end
before a window are left out of it, so one very long conversation does not widen the others. Rows
are sorted with numpy lexsort, ids of the conversations last; a node starts at depth d where a row
differs from the one before in column d or any earlier one: masks of changes, OR-accumulated from
column to column. reduceat over the starts gives the measures of every depth, and from the deepest
upwards those of subtrees.

Only nodes on the path of a shard's first or last row can have members in another shard. These
boundary nodes are given out in part, keyed by a digest chained along their path, and recombine by
key. Their own share of the subtree measures depends on all their members and is added afterwards:
each node is counted on one of the paths it lies on, the shares of a path are summed from its end
upwards, and the sums meet by key. All other nodes are complete in their shard. There are at most
two paths of boundary nodes a shard.

The conversations that end in a node are hashed in ascending order. Shards hold a node's in that
order, so those of a boundary node are pieces of text that are sorted by their first id and folded
into one running digest.

Defined results: null roles and texts are empty; rows without conv_id belong to no conversation.
Turns are ordered by ``turn``, null first, then role, then digest; repeated rows are turns of their
own. Without conversations there is no node, not even a root. Other columns are ignored. A path is a
value of 16 bytes a turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adpulse.llm.store import drop, stored

SHARD_TURNS = 1 << 19
WINDOW = 64
DIGEST = 16
#: First turns that a rebuilt conversation may take from another.
MOST_SHARED = 3

_WORD = r"[^\x20\x09-\x0D]+"


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, digest, words`` of every row that has a conv_id."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # The length before the role keeps role and text apart.
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.substring(F.sha2(whole, 256), 1, 2 * DIGEST).alias("digest"),
        F.regexp_count(text, F.lit(_WORD)).alias("words"),
    )


def sequences(turned: DataFrame) -> DataFrame:
    """``conv_id, own``: the turns of a conversation in order, as structs of digest and words."""
    listed = F.sort_array(F.collect_list(F.struct("turn", "role", "digest", "words")))
    own = F.transform(listed, lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words")))
    return turned.groupBy("conv_id").agg(own.alias("own"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """``conv_id, own``: the first h turns of conversation ``conv_id - conv_id % 20``, then its own
    after its first h, h being the CRC of the id modulo 4."""
    rows = sequences(turns(conversations))
    first = rows.where("conv_id % 20 = 0").select(
        F.col("conv_id").alias("base"), F.slice("own", 1, MOST_SHARED).alias("shared")
    )
    h = (F.crc32(F.col("conv_id").cast("string")) % (MOST_SHARED + 1)).cast("int")
    rows = rows.withColumn("base", F.col("conv_id") - F.col("conv_id") % 20).withColumn("h", h)
    none = F.slice("own", 1, 0)
    rest = F.slice("own", F.col("h") + 1, F.greatest(F.size("own"), F.lit(1)))
    both = F.concat(F.slice(F.coalesce("shared", none), F.lit(1), F.col("h")), rest)
    # At most twenty conversations (forty around zero) share a base.
    return rows.join(first, "base", "left").select("conv_id", both.alias("own"))


def paths(rows: DataFrame) -> DataFrame:
    """``conv_id, path, words`` from ``conv_id, own``."""
    digests = F.transform("own", lambda t: t["digest"])
    return rows.select(
        "conv_id",
        F.unhex(F.array_join(digests, "")).alias("path"),
        F.transform("own", lambda t: t["words"]).alias("words"),
    )


class Shard(NamedTuple):
    """Conversations of one shard: ids, turn ids and words in a row, and the bounds of each."""

    conv: np.ndarray
    ids: np.ndarray
    words: np.ndarray
    bounds: np.ndarray
    digests: np.ndarray

    @property
    def size(self) -> np.ndarray:
        return np.diff(self.bounds)


def shard_of(batches: list[pa.RecordBatch]) -> Shard:
    whole = pa.Table.from_batches(batches).combine_chunks()
    lists = whole["words"].chunk(0)
    size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    raw = b"".join(value.as_buffer() for value in whole["path"])
    given = np.frombuffer(raw, f"S{DIGEST}")
    digests, ids = np.unique(given, return_inverse=True)
    return Shard(
        whole["conv_id"].to_numpy(),
        ids.astype(np.int64),
        lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
        np.append(0, np.cumsum(size)),
        digests,
    )


def in_order(shard: Shard, window: int = WINDOW) -> np.ndarray:
    """Rows by path, a prefix before what it begins, then by conv_id."""
    size, start = shard.size, shard.bounds[:-1]
    order = np.argsort(shard.conv, kind="stable")
    deepest = int(size.max(initial=0))
    # The last columns first; each pass keeps the order of rows that are equal in its window.
    for low in range((max(deepest, 1) - 1) // window * window, -1, -window):
        longer = size[order] > low
        rows = order[longer]
        at = start[rows][:, None] + np.arange(low, min(low + window, deepest))
        padded = np.where(
            at < (start + size)[rows][:, None], shard.ids[np.minimum(at, len(shard.ids) - 1)], -1
        ) if len(rows) else np.zeros((0, 1), np.int64)
        order = np.concatenate([order[~longer], rows[np.lexsort(padded.T[::-1])]])
    return order


class Depth(NamedTuple):
    """The nodes of one depth, in order: the first and one past the last of their rows (among those
    at least as deep), their parent among the nodes above, and their measures."""

    rows: np.ndarray
    starts: np.ndarray
    parent: np.ndarray
    convs: np.ndarray
    least: np.ndarray
    ending: np.ndarray
    words: np.ndarray


def depths(shard: Shard, order: np.ndarray) -> list[Depth]:
    size, start = shard.size[order], shard.bounds[:-1][order]
    conv = shard.conv[order]
    rows = np.arange(len(order))
    node = np.zeros(len(order), np.int64)
    words = np.zeros(1, np.int64)
    starts, parent = np.zeros(1, np.int64), np.zeros(1, np.int64)
    found = []
    depth = 0
    while len(rows):
        ends = np.append(starts[1:], len(rows))
        ending = np.add.reduceat((size[rows] == depth).astype(np.int64), starts)
        least = np.minimum.reduceat(conv[rows], starts)
        found.append(Depth(rows, starts, parent, ends - starts, least, ending, words))
        deeper = size[rows] > depth
        rows, above = rows[deeper], node[deeper]
        if not len(rows):
            break
        column = shard.ids[start[rows] + depth]
        # A change in any earlier column shows as another node above.
        change = np.append(True, (above[1:] != above[:-1]) | (column[1:] != column[:-1]))
        starts = np.flatnonzero(change)
        node = np.cumsum(change) - 1
        parent = above[starts]
        words = shard.words[(start[rows] + depth)[starts]]
        depth += 1
    return found


NODE = (
    "conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends string, ends_sha256 string, parent_key binary, key binary, "
    "lines array<long>, words long"
)
NAMES = [part.split()[0] for part in NODE.split(", ")]
TYPES = [
    pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.string(), pa.string(), pa.binary(), pa.binary(),
    pa.list_(pa.int64()), pa.int64(),
]
#: Key of the root.
ROOT = bytes(32)


def chain(digests: np.ndarray) -> list[bytes]:
    """The keys of all nodes on a path of turns."""
    keys = [ROOT]
    for digest in digests:
        keys.append(hashlib.sha256(keys[-1] + digest.tobytes()).digest())
    return keys


def shard_nodes(shard: Shard, number: int) -> Iterator[pa.RecordBatch]:
    """The nodes of a shard, a batch per depth.

    Boundary nodes have a ``key`` and the numbers of the paths they lie on, ``lines``; their measures
    are those of the interior nodes below them, and their ``ends`` are text and not hashed. Children
    of boundary nodes have a ``parent_key`` in place of the parent's conv_id.
    """
    order = in_order(shard)
    levels = depths(shard, order)
    conv = shard.conv[order]
    size = len(order)
    # Whether a node holds the first or last row; in order they are the first and last node.
    boundary = []
    for level in levels:
        found = np.zeros(len(level.starts), bool)
        found[0] = level.rows[0] == 0
        found[-1] |= level.rows[-1] == size - 1
        boundary.append(found)
    leaves, saved, children = ([None] * len(levels) for _ in range(3))
    for depth in range(len(levels) - 1, -1, -1):
        level = levels[depth]
        n = len(level.starts)
        below_leaves, below_saved, below = (np.zeros(n, np.int64) for _ in range(3))
        if depth + 1 < len(levels):
            under = levels[depth + 1].parent
            cuts = np.flatnonzero(np.append(True, under[1:] != under[:-1]))
            which = under[cuts]
            below_leaves[which] = np.add.reduceat(leaves[depth + 1], cuts)
            below_saved[which] = np.add.reduceat(saved[depth + 1], cuts)
            below[which] = np.add.reduceat((~boundary[depth + 1]).astype(np.int64), cuts)
        own = ~boundary[depth]
        childless = below_leaves == 0
        leaves[depth] = below_leaves + (own & childless)
        saved[depth] = below_saved + np.where(own, (level.convs - 1) * level.words, 0)
        children[depth] = below
    first, last = (
        chain(shard.digests[shard.ids[shard.bounds[row] : shard.bounds[row + 1]]])
        for row in (order[0], order[-1])
    )
    for depth, level in enumerate(levels):
        n = len(level.starts)
        mine = boundary[depth]
        ends, digests = [None] * n, [None] * n
        nothing = hashlib.sha256(b"").hexdigest()
        for k, (at, many) in enumerate(zip(level.starts.tolist(), level.ending.tolist())):
            # Rows that end in a node come before those that go on.
            ids = ",".join(map(str, conv[level.rows[at : at + many]].tolist()))
            if mine[k]:
                ends[k] = ids or None
            else:
                digests[k] = hashlib.sha256(ids.encode()).hexdigest() if many else nothing
        keys, lines = [None] * n, [None] * n
        if level.rows[-1] == size - 1:
            keys[-1], lines[-1] = last[depth], [2 * number + 1]
        if level.rows[0] == 0:
            keys[0], lines[0] = first[depth], [2 * number, *(lines[0] or [])]
        above = [None] * n
        parent, hidden = np.zeros(n, np.int64), np.ones(n, bool)
        if depth:
            over = levels[depth - 1]
            parent, hidden = over.least[level.parent], boundary[depth - 1][level.parent]
            for k in np.flatnonzero(hidden).tolist():
                in_first = level.parent[k] == 0 and over.rows[0] == 0
                above[k] = (first if in_first else last)[depth - 1]
        values = [
            level.least, np.full(n, depth), pa.array(parent, pa.int64(), mask=hidden), level.convs,
            children[depth], leaves[depth], saved[depth], ends, digests, above, keys, lines,
            level.words,
        ]
        arrays = [
            v if isinstance(v, pa.Array) else pa.array(v, kind)
            for v, kind in zip(values, TYPES, strict=True)
        ]
        yield pa.RecordBatch.from_arrays(arrays, NAMES)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [batch for batch in batches if batch.num_rows]
    if held:
        yield from shard_nodes(shard_of(held), TaskContext.get().partitionId())


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of text in order of key and place to a digest per key. Holds one running digest."""
    key, digest = None, None

    def row() -> pa.RecordBatch:
        arrays = [pa.array([key], pa.binary()), pa.array([digest.hexdigest()], pa.string())]
        return pa.RecordBatch.from_arrays(arrays, ["key", "ends_sha256"])

    for batch in batches:
        for found, piece in zip(batch.column("key"), batch.column("ends"), strict=True):
            if found.as_py() != key:
                if key is not None:
                    yield row()
                key, digest = found.as_py(), hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(piece.as_buffer())
    if key is not None:
        yield row()


def _measures(boundary: DataFrame) -> DataFrame:
    """Boundary nodes recombined: a row per key, without the digest of their ends."""
    parts = boundary.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"),
        F.first("depth").alias("depth"),
        F.first("parent_key", ignorenulls=True).alias("parent_key"),
        F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("inner_children"),
        F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_tokens"),
        F.min(F.element_at("lines", 1)).alias("line"),
        F.first("words").alias("words"),
    )
    parts = stored(parts, "boundary")
    children = parts.where("parent_key is not null").groupBy(F.col("parent_key").alias("key"))
    parts = parts.join(children.agg(F.count("*").alias("more")), "key", "left")
    whole = F.col("inner_children") + F.coalesce("more", F.lit(0))
    return parts.withColumn("n_children", whole).drop("more", "inner_children")


def _own_shares(boundary: DataFrame, parts: DataFrame) -> DataFrame:
    """What boundary nodes themselves add to the subtrees of all nodes on their paths."""
    own = parts.select(
        F.col("key").alias("own_key"),
        F.col("line").alias("own_line"),
        (F.col("n_children") == 0).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saving"),
    )
    places = boundary.select("key", "depth", F.explode("lines").alias("line"))
    same = [places["key"] == own["own_key"], places["line"] == own["own_line"]]
    # A path is as long as its conversation.
    upwards = Window.partitionBy("line").orderBy(F.desc("depth"))
    sums = places.join(own, same, "left").select(
        "key",
        F.sum(F.coalesce("leaf", F.lit(0))).over(upwards).alias("leaf"),
        F.sum(F.coalesce("saving", F.lit(0))).over(upwards).alias("saving"),
    )
    return sums.groupBy("key").agg(F.sum("leaf").alias("leaf"), F.sum("saving").alias("saving"))


def trie(rows: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the conversations ``conv_id, path, words``: ``conv_id`` (smallest
    member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``."""
    rows = stored(rows, "paths")
    total = rows.agg(F.sum(F.size("words") + 1)).first()[0] or 0
    sharded = rows.repartitionByRange(1 + total // shard_turns, "path", "conv_id")
    nodes = stored(sharded.mapInArrow(_shards, NODE), "nodes")
    drop(rows)
    boundary = nodes.where("key is not null")
    parts = stored(_measures(boundary), "measures")
    pieces = boundary.where("ends is not null").withColumn(
        "first_end", F.substring_index("ends", ",", 1).cast("long")
    )
    pieces = pieces.select("key", "first_end", "ends").repartition("key")
    pieces = pieces.sortWithinPartitions("key", "first_end").select("key", "ends")
    digests = pieces.mapInArrow(_fold, "key binary, ends_sha256 string")
    whole = parts.join(_own_shares(boundary, parts), "key").join(digests, "key", "left").select(
        "key",
        "conv_id",
        "depth",
        "parent_key",
        "n_convs",
        "n_children",
        (F.col("n_leaves") + F.col("leaf")).alias("n_leaves"),
        (F.col("saved_tokens") + F.col("saving")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
    whole = stored(whole, "joined")
    parents = whole.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("found"))
    columns = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    inner = nodes.where("key is null and parent_key is null").select(*columns, "parent_conv_id")
    # Many children of one boundary node, the root above all, are split by adaptive execution.
    below = nodes.where("key is null and parent_key is not null").select(*columns, "parent_key")
    joined = below.unionByName(whole.select(*columns, "parent_key")).join(
        parents, "parent_key", "left"
    )
    joined = joined.select(*columns, F.col("found").alias("parent_conv_id"))
    return inner.unionByName(joined).select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        "parent_conv_id",
        *columns[2:],
    )


def conversation_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The trie of the rebuilt ``conversations`` (conv_id, turn, role, text)."""
    return trie(paths(rebuilt(conversations)), shard_turns)
