"""Conversation prefix trie: balanced parentheses per shard, shared spines merged.

A node is a sequence of first turns; conversations that begin with it are its members. The steps:

1. A running exclusive or of hashes of (place, turn) names every prefix (128 bits; different prefixes get one name
   with a chance of their number squared over 2**129). Grouped by name, prefixes become nodes.
2. A node is known from then on by its smallest member and its depth. The nodes of one smallest member are a
   chain, a stretch of one path. A conversation passes through few chains, so a path is a short list of
   (last depth, member) per conversation. From these follow each chain's parent and its place in preorder:
   after a chain come the chains that leave it, from the deepest place on.
3. Nodes with one member have one leaf and save nothing. The others, and the first node of each stretch with
   one member, are dealt out by ranges of the preorder. Each shard writes its nodes, below the path that leads to
   its first one (its spine), as balanced parentheses. ``find_close`` over blocks of least and greatest
   excess delimits subtrees, the rank of leaf pairs counts leaves, cumulative sums give savings.
4. Nodes whose subtree goes on in other shards are in those shards' spines; the parts are added up per node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.text import small_batches
from orderlens.operators.lookup import lookup_join
from orderlens.operators.running import running
from orderlens.operators.storage import store

#: Nodes in one shard, about 40 bytes each in its task.
SHARD = 250_000
#: Nodes with more than one in so many of all rows are joined by a broadcast; there are fewer than that.
HOT = 4096
#: Characters of member ids that are put together in one row.
CHUNK = 1 << 16
NAME = ["depth", "name_a", "name_b"]


class Parentheses:
    """A sequence of parentheses (1 opens) with the least and greatest excess of each block, and of pairs of blocks."""

    BLOCK = 64

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.excess = np.cumsum(2 * bits.astype(np.int64) - 1)
        blocks = -(-len(bits) // self.BLOCK)
        padded = np.full(blocks * self.BLOCK, self.excess[-1] if len(bits) else 0, dtype=np.int64)
        padded[: len(bits)] = self.excess
        self.low, self.high = [padded.reshape(blocks, -1).min(1)], [padded.reshape(blocks, -1).max(1)]
        while len(self.low[-1]) > 1:
            odd = len(self.low[-1]) % 2
            low, high = np.append(self.low[-1], [np.iinfo(np.int64).max] * odd), np.append(self.high[-1], [-1] * odd)
            self.low.append(low.reshape(-1, 2).min(1))
            self.high.append(high.reshape(-1, 2).max(1))

    def _holds(self, level: int, node: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Whether the target excess occurs in a block or run of blocks: excess changes by one a step."""
        inside = node < len(self.low[level])
        at = np.minimum(node, len(self.low[level]) - 1)
        return inside & (self.low[level][at] <= target) & (target <= self.high[level][at])

    def _scan(self, start: np.ndarray, target: np.ndarray, out: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """First place of the target from ``start`` to the end of its block; the rows without one."""
        at, ends = start.copy(), np.minimum((start // self.BLOCK + 1) * self.BLOCK, len(self.bits))
        while len(rows):
            live = at < ends
            hit = live.copy()
            hit[live] = self.excess[at[live]] == target[live]
            out[rows[hit]] = at[hit]
            if not live.any():
                break
            stay = ~hit
            left = stay & ~live
            if left.any() and not (stay & live).any():
                return rows[stay]
            at, ends, target, rows = at[stay] + live[stay], ends[stay], target[stay], rows[stay]
        return rows

    def find_close(self, opens: np.ndarray) -> np.ndarray:
        """The place of the closing parenthesis of each opening one; the sequence is balanced."""
        out = np.full(len(opens), -1, dtype=np.int64)
        target = self.excess[opens] - 1
        # In a block of its own first: a place right behind its block's end starts no scan.
        same = (opens + 1) // self.BLOCK == opens // self.BLOCK
        rows = np.flatnonzero(same)
        self._scan(opens[rows] + 1, target[rows], out, rows)
        rows = np.flatnonzero(out < 0)
        if not len(rows):
            return out
        # Up: until a run of blocks to the right holds the target.
        node, level = opens[rows] // self.BLOCK, np.zeros(len(rows), dtype=np.int64)
        found = np.full(len(rows), -1, dtype=np.int64)
        for k in range(len(self.low)):
            open_ = np.flatnonzero(found < 0)
            right = node[open_] + 1
            ok = (node[open_] % 2 == 0) & self._holds(k, right, target[rows[open_]])
            found[open_[ok]], level[open_[ok]] = right[ok], k
            node = node // 2
        # Down: into the left half if it holds the target.
        for k in range(len(self.low) - 1, 0, -1):
            here = np.flatnonzero(level == k)
            left = found[here] * 2
            found[here] = np.where(self._holds(k - 1, left, target[rows[here]]), left, left + 1)
            level[here] = k - 1
        self._scan(found * self.BLOCK, target[rows], out, rows)
        return out


def subtree_sums(depths: np.ndarray, weights: np.ndarray, last_is_leaf: bool) -> tuple[np.ndarray, np.ndarray]:
    """Leaves and summed weights below every node of a stretch of the preorder, its spine first.

    ``depths`` rise by one at most. The spine, nodes of depths 0 to ``depths[0]`` - 1, has no weights here. A last
    node that is no leaf has its children in the next shard and isn't counted as one.
    """
    spine = int(depths[0])
    every = np.concatenate([np.arange(spine), depths])
    closing = np.append(every[:-1] - every[1:] + 1, every[-1] + 1)  # parentheses that close after each node
    opens = np.arange(len(every)) + np.concatenate([[0], np.cumsum(closing[:-1])])
    bits = np.zeros(2 * len(every), dtype=np.int8)
    bits[opens] = 1
    tree = Parentheses(bits)
    closes = tree.find_close(opens)
    nodes = np.concatenate([[0], np.cumsum(bits)])  # opening ones before a place
    saved = np.concatenate([[0], np.cumsum(np.concatenate([np.zeros(spine, dtype=np.int64), weights]))])
    pair = (bits == 1) & (np.append(bits[1:], 0) == 0)
    pair[opens[-1]] &= last_is_leaf
    leaves = np.concatenate([[0], np.cumsum(pair)])
    return leaves[closes] - leaves[opens], saved[nodes[closes]] - saved[nodes[opens]]


def spine_members(key: list[dict], depth: int, root: int) -> np.ndarray:
    """Smallest members of the nodes above a node of ``depth`` in the chain with the given key."""
    out, member, at = np.zeros(depth, dtype=np.int64), root, 0
    for step in key:
        end = -step["back"] + 1
        out[at:end] = member
        member, at = step["member"], end
    out[at:] = member
    return out


def _prefixes(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """``conv_id``, the name of each of its prefixes, and the bytes of the last text; the empty prefix included."""
    marked = turns.select(
        "conv_id",
        F.col("place").alias("depth"),
        "size",
        F.xxhash64("place", "first", "second").alias("mark_a"),
        F.xxhash64(F.lit(1), "place", "first", "second").alias("mark_b"),
    )
    named = running(marked, ["conv_id"], ["depth"], xors={"name_a": "mark_a", "name_b": "mark_b"})
    zero = F.lit(0).cast("long")
    empty = conversations.select("conv_id", *(zero.alias(c) for c in [*NAME, "size"]))
    return named.select("conv_id", *NAME, "size").unionByName(empty)


def _paths(rows: DataFrame, nodes: DataFrame, root: int, total: int) -> DataFrame:
    """``conv_id`` and ``path``: (deepest, member, shared) of each chain it passes through, from the root on.

    ``shared`` is the last depth in that chain of a node with several members.
    """
    several = nodes.where("n_convs > 1 AND depth > 0").select(*NAME, "member", "n_convs")
    hot = F.broadcast(several.where(F.col("n_convs") * HOT > total).drop("n_convs"))
    cold = several.where(F.col("n_convs") * HOT <= total).drop("n_convs")
    met = rows.join(hot, NAME).unionByName(rows.join(hot, NAME, "left_anti").join(cold, NAME))
    depth, zero = F.col("depth"), F.lit(0).cast("long")
    start = rows.where("depth = 0").select("conv_id", F.lit(root).cast("long").alias("member"), zero.alias("deepest"), zero.alias("shared"))
    ends = rows.select("conv_id", F.col("conv_id").alias("member"), depth.alias("deepest"), F.lit(None).cast("long").alias("shared"))
    steps = met.select("conv_id", "member", depth.alias("deepest"), depth.alias("shared")).unionByName(start).unionByName(ends)
    chains = steps.groupBy("conv_id", "member").agg(F.max("deepest").alias("deepest"), F.max("shared").alias("shared"))
    listed = chains.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("deepest", "member", "shared"))).alias("path"))
    # A conversation that ends in another one's chain has no chain of its own.
    last, before = F.get("path", F.size("path") - 1), F.get("path", F.size("path") - 2)
    none = (F.size("path") > 1) & (last["deepest"] == before["deepest"])
    return listed.select("conv_id", F.when(none, F.slice("path", 1, F.size("path") - 1)).otherwise(F.col("path")).alias("path"))


def _chains(paths: DataFrame) -> DataFrame:
    """``member``, its first and last trie depth, its parent chain, and its place in preorder."""
    last, before = F.get("path", F.size("path") - 1), F.get("path", F.size("path") - 2)
    top = F.coalesce(before["deepest"] + 1, F.lit(0).cast("long"))
    steps = F.transform(
        F.sequence(F.lit(1), F.size("path") - 1),
        lambda k: F.struct((-F.get("path", k - 1)["deepest"]).alias("back"), F.get("path", k)["member"].alias("member")),
    )
    key = F.when(F.size("path") > 1, steps).otherwise(F.array().cast("array<struct<back:bigint,member:bigint>>"))
    return paths.where(last["member"] == F.col("conv_id")).select(
        F.col("conv_id").alias("member"),
        top.alias("top"),
        before["member"].alias("parent"),
        (F.coalesce(last["shared"], top - 1) + 1).alias("trie_end"),
        key.alias("key"),
    )


def _subtrees(trie: DataFrame, root: int, shards: int) -> DataFrame:
    """``member``, ``depth``, ``n_leaves`` and ``saved`` of the nodes in ``trie``: steps 3 and 4."""

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, key = [], None
        for batch in batches:
            if batch.num_rows:
                key = batch.column("key")[0].as_py() if key is None else key
                parts.append([batch.column(c).to_numpy(zero_copy_only=False) for c in ("member", "depth", "weight", "leaf")])
        if not parts:
            return
        member, depth, weight, leaf = (np.concatenate(x) for x in zip(*parts))
        leaves, saved = subtree_sums(depth, weight, bool(leaf[-1]))
        spine = int(depth[0])
        columns = [
            np.concatenate([spine_members(key, spine, root), member]),
            np.concatenate([np.arange(spine), depth]),
            leaves,
            saved,
        ]
        yield from pa.table(dict(zip(["member", "depth", "n_leaves", "saved"], map(pa.array, columns)))).to_batches(1 << 16)

    ordered = trie.repartitionByRange(shards, "key", "depth").sortWithinPartitions("key", "depth")
    parts = ordered.mapInArrow(shard, "member long, depth long, n_leaves long, saved long")
    return parts.groupBy("member", "depth").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))


def member_digests(ends: DataFrame) -> DataFrame:
    """``digest`` per (``member``, ``depth``): SHA-256 of the ascending, comma-joined ids of ``ends``.

    Such a digest has to be taken in order. Ids are joined to pieces by ranges first, and a node's pieces are
    passed through the digest one after another, so no list of ids is held.
    """
    spark = ends.sparkSession
    small_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in batch.schema.names))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema({"member": pa.int64(), "depth": pa.int64(), "least": pa.int64(), "ids": pa.string()})
        out, size, node, least, ids = [], 0, None, 0, []
        for member, depth, conv in rows_of(batches):
            if ids and (node != (member, depth) or len(ids) * 20 > CHUNK):
                out.append((*node, least, ",".join(ids)))
                size += len(out[-1][3]) + 24
                ids = []
                if size > 4 * CHUNK:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                    out, size = [], 0
            if not ids:
                node, least = (member, depth), conv
            ids.append(str(conv))
        if ids:
            out.append((*node, least, ",".join(ids)))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema({"member": pa.int64(), "depth": pa.int64(), "digest": pa.string()})
        out, node, state = [], None, None
        for member, depth, _, ids in rows_of(batches):
            if node == (member, depth):
                state.update(f",{ids}".encode())
                continue
            if node:
                out.append((*node, state.hexdigest()))
            node, state = (member, depth), hashlib.sha256(ids.encode())
            if len(out) >= 1024:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                out = []
        if node:
            out.append((*node, state.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    order = ["member", "depth", "conv_id"]
    joined = ends.select(*order).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    pieces = joined.mapInArrow(join, "member long, depth long, least long, ids string")
    dealt = pieces.repartition(parts, "member", "depth").sortWithinPartitions("member", "depth", "least")
    return dealt.mapInArrow(digest, "member long, depth long, digest string")


def trie(turns: DataFrame, conversations: DataFrame, shard_nodes: int = SHARD) -> DataFrame:
    """One row per node of the trie of ``conversations`` (``conv_id``, each once) and their ``turns``.

    ``turns`` have ``conv_id``, ``place`` from 1 without gaps, and the content columns of ``numbered_turns``. A node is
    ``conv_id``, its smallest member, and ``depth``; ``parent_conv_id`` is the parent's (null for the root), ``n_convs`` the
    members, ``n_children`` the children, ``n_leaves`` the childless nodes in its subtree, ``saved`` the sum over its
    subtree of (members - 1) times the bytes of the last text, ``ends_sha256`` the digest of the ids of members
    that end there. No conversations give no rows. ``shard_nodes`` bounds the nodes that a shard takes.
    """
    spark = turns.sparkSession
    small_batches(spark)
    rows = store(_prefixes(turns, conversations), "prefixes")
    total, root = rows.agg(F.count("*"), F.min("conv_id")).first()
    nodes = rows.groupBy(*NAME).agg(F.min("conv_id").alias("member"), F.count("*").alias("n_convs"), F.max("size").alias("size"))
    nodes = store(nodes, "nodes")
    paths = store(_paths(rows, nodes, root, total), "paths")
    own = lookup_join(nodes.drop("name_a", "name_b"), _chains(paths), "member", ["depth"], "inner")
    parent = F.when(F.col("depth") > F.col("top"), F.col("member")).otherwise(F.col("parent"))
    own = store(own.withColumn("parent", parent), "nodes")
    children = (
        own.where("parent IS NOT NULL")
        .groupBy(F.col("parent").alias("member"), (F.col("depth") - 1).alias("depth"))
        .agg(F.count("*").alias("n_children"))
    )
    known = own.drop("top").join(children, ["member", "depth"], "left").fillna(0, ["n_children"])
    known = store(known, "nodes")
    upper = known.where(F.col("depth") <= F.col("trie_end")).select(
        "member",
        "depth",
        "key",
        ((F.col("n_convs") - 1) * F.col("size")).alias("weight"),
        ((F.col("n_convs") == 1) | (F.col("n_children") == 0)).alias("leaf"),
    )
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-upper.count() // shard_nodes))
    end = F.get("path", F.size("path") - 1)
    ends = paths.select(end["member"].alias("member"), end["deepest"].alias("depth"), "conv_id")
    return (
        known.join(_subtrees(upper, root, shards), ["member", "depth"], "left")
        .join(member_digests(ends), ["member", "depth"], "left")
        .select(
            F.col("member").alias("conv_id"),
            "depth",
            F.col("parent").alias("parent_conv_id"),
            "n_convs",
            "n_children",
            F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"),
            F.coalesce("saved", F.lit(0)).cast("long").alias("saved"),
            F.coalesce("digest", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )
