"""Random forest in two phases: upper levels by histograms, the rest of each tree inside one group.

Features are cut into bins. While a node has more rows than a group may hold, its split is found from counts per
(tree, node, feature, bin, class), added up over all rows in one pass per level. A node that fits is handed over:
its rows, keyed by (tree, node), come together once, and the subtree is completed there, down to pure leaves. So
thousands of small nodes take one shuffle and not a pass per level.

What a row counts in a tree (its bootstrap weight) is a hash of the row and the tree, and all counts are integers,
so a forest does not depend on partitions. Subtrees stay in a table; only the upper levels are on the driver.

Rows are packed into a few words, and the loops over (row, tree) are compiled (``compiled.py``). ``bootstrap``, ``_dealt``,
``grow`` and ``leaf_probability`` say the same in numpy; tests compare the two.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.models import compiled
from orderlens.models.newton import matrix
from orderlens.operators.storage import store

BINS = 64
#: Rows whose values place the edges of bins.
SAMPLE_ROWS = 20_000
#: Bootstrap rows of a node that are grown in one group, at most, and bytes of its packed rows.
HANDED = 4_000_000
GROUP_BYTES = 1 << 26
#: Rows that look up one subtree in one group, at most.
ASKED = 500_000
#: Tasks that complete or look up subtrees, at most; a node's rows are in one of them.
GROUP_TASKS = 20_000
#: Rows of a packed part, at most; a task deals its parts out to all trees.
PART_ROWS = 16_384
#: Nodes whose histograms one pass takes (1 kB per node and feature).
OPEN_NODES = 2_000
#: Rows whose nodes are searched for splits at a time.
CACHED_ROWS = 65_536
#: Above the weight of a group.
PAIR = 1 << 26
#: Probabilities are added up in units of this, so sums do not depend on order.
UNIT = 1 << 40
_CDF = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])


def _largest(share: float) -> int:
    """The largest unsigned 64-bit number that is at most ``share`` of 2 ** 64, as ``bootstrap`` divides."""
    low, high = 0, 2**64
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if middle / 2.0**64 <= share else (low, middle)
    return low


_LARGEST = np.array([_largest(share) for share in _CDF.tolist()], dtype="<u8")


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers, one to one."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def bootstrap(keys: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is drawn for a tree: Poisson of mean one, from a hash."""
    start = mixed(np.array([(seed << 32) + tree + 1], dtype=np.uint64))
    share = mixed(keys.view(np.uint64) ^ start) / 2.0**64
    return np.searchsorted(_CDF, share).astype(np.int64)


def shuffled_features(tree: int, nodes: np.ndarray, features: int, seed: int) -> np.ndarray:
    """For each node, all features in the order of a hash; the first ones are tried."""
    start = mixed(np.array([(seed << 32) + tree + 1], dtype=np.uint64))
    draws = mixed(mixed(nodes.astype(np.uint64) + start)[:, None] + np.arange(1, features + 1, dtype=np.uint64))
    return draws.argsort(1, kind="stable")


def feature_order(tree: int, nodes: np.ndarray, features: int, seed: int) -> np.ndarray:
    """For each node, a rank of every feature; the first ones are tried."""
    return shuffled_features(tree, nodes, features, seed).argsort(1, kind="stable")


@dataclass
class Settings:
    features: int
    weights: tuple[float, float]  # of the classes
    max_depth: int
    seed: int
    handed: int = HANDED

    @property
    def tried(self) -> int:
        return max(1, math.isqrt(self.features))


def best_splits(counts: np.ndarray, weights: tuple[float, float]) -> tuple[np.ndarray, np.ndarray]:
    """Gain and last bin on the left of the best split of each row of (bins, classes) counts; gain -1 if there is none.

    The gain is the drop of the weighted Gini impurity times the weight; equal gains take the lowest bin.
    """
    left = np.cumsum(counts, axis=1)[:, :-1]
    right = counts.sum(1)[:, None] - left
    sides = []
    for side in (left, right, counts.sum(1)[:, None]):
        a, b = side[..., 0] * weights[0], side[..., 1] * weights[1]
        sides.append(2 * a * b / np.maximum(a + b, 1e-300))
    gain = sides[2] - sides[0] - sides[1]
    gain = np.where((left.sum(2) > 0) & (right.sum(2) > 0), np.maximum(gain, 0.0), -1.0)
    at = gain.argmax(1)
    return gain[np.arange(len(gain)), at], at


def split_gain(left: np.ndarray, both: np.ndarray, weights: tuple[float, float]) -> np.ndarray:
    """Gain of the cuts with ``left`` counts per class of ``both``; -1 where a side is empty. As in ``best_splits``."""
    right = both - left
    sides = []
    for side in (left, right, both):
        a, b = side[0] * weights[0], side[1] * weights[1]
        sides.append(2 * a * b / np.maximum(a + b, 1e-300))
    gain = sides[2] - sides[0] - sides[1]
    return np.where((left.sum(0) > 0) & (right.sum(0) > 0), np.maximum(gain, 0.0), -1.0)


@dataclass
class Rows:
    """Rows of nodes, those of a node next to each other: ``sizes`` rows each, with ``both`` counts per class."""

    bins: np.ndarray
    label: np.ndarray
    times: np.ndarray
    sizes: np.ndarray
    both: np.ndarray

    def of(self, nodes: np.ndarray) -> Rows:
        """Those of the nodes marked true."""
        if nodes.all():
            return self
        kept = np.flatnonzero(np.repeat(nodes, self.sizes))
        return Rows(self.bins.take(kept, 0), self.label.take(kept), self.times.take(kept), self.sizes[nodes], self.both[:, nodes])


def splits_of(rows: Rows, tried: np.ndarray, widths: np.ndarray, weights: tuple[float, float]) -> list[np.ndarray]:
    """Gain, feature and last bin on the left of the best split of each node, from its ``tried`` features in ascending
    order (nodes, number); gain and feature -1 if there is none.

    Some nodes at a time, so that their rows stay in the processor's cache for all features.
    """
    ends = np.cumsum(rows.sizes)
    parts, node, row = [], 0, 0
    while node < len(ends):
        last = max(node + 1, int(np.searchsorted(ends, row + CACHED_ROWS, "right")))
        end = int(ends[last - 1])
        part = Rows(rows.bins[row:end], rows.label[row:end], rows.times[row:end], rows.sizes[node:last], rows.both[:, node:last])
        parts.append(_splits_of(part, tried[node:last], widths, weights))
        node, row = last, end
    return [np.concatenate(columns) for columns in zip(*parts)]


def _splits_of(rows: Rows, tried: np.ndarray, widths: np.ndarray, weights: tuple[float, float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A feature takes as many counts as it has bins (``widths``), so one of two values costs two and not ``BINS``."""
    n, k = len(rows.sizes), rows.bins.shape[1]
    gain, feature, cut = np.full(n, -1.0), np.full(n, -1), np.zeros(n, dtype=np.int64)
    flat, base = rows.bins.ravel(), np.arange(len(rows.label)) * k
    # Both sums in one number: a group has fewer than 2 ** 26 rows' weight, and doubles are exact up to 2 ** 53.
    pair = rows.times * (1 + rows.label * PAIR)
    for f in tried.T:
        width = widths[f]
        start = np.cumsum(width) - width
        cell = flat[base + np.repeat(f, rows.sizes)] + np.repeat(start, rows.sizes)
        cells = int(width.sum())
        counts = np.bincount(cell, pair, cells)
        one = np.floor(counts / PAIR)
        left = np.cumsum(np.stack([counts - one * (PAIR + 1), one]), axis=1)
        before = np.zeros((2, n))
        before[:, 1:] = left[:, start[1:] - 1]
        left -= np.repeat(before, width, axis=1)
        found = split_gain(left, np.repeat(rows.both, width, axis=1), weights)
        best = np.maximum.reduceat(found, start)
        better = np.flatnonzero(best > gain)
        if len(better):
            # The lowest bin of those with the best gain.
            hits = np.flatnonzero(found == np.repeat(best, width))
            first = hits[np.searchsorted(hits, start[better])]
            gain[better], feature[better], cut[better] = best[better], f[better], first - start[better]
    return gain, feature, cut


def grow(bins: np.ndarray, label: np.ndarray, times: np.ndarray, tree: int, node: int, settings: Settings) -> dict[str, np.ndarray]:
    """The subtree below ``node`` for its rows, level by level: feature (-1: leaf), last bin on the left, left child
    (the right one follows it), probability of class 1 per node, and the gain per feature."""
    k, tried = settings.features, settings.tried
    importance = np.zeros(k)
    widths = bins.max(0, initial=0).astype(np.int64) + 1
    done: dict[str, list] = {"feature": [], "bin": [], "left": [], "probability": []}
    ids = np.array([node], dtype=np.int64)
    both = np.array([[times[label == c].sum()] for c in (0, 1)], dtype=np.float64)
    rows = Rows(bins, label, times.astype(np.float64), np.array([len(label)]), both)
    depth, made = node.bit_length() - 1, 1
    while len(ids):
        n = len(ids)
        weighted = rows.both * np.array(settings.weights)[:, None]
        open_ = (rows.both.min(0) > 0) & (depth < settings.max_depth)
        gain, feature, cut = np.full(n, -1.0), np.full(n, -1), np.zeros(n, dtype=np.int64)
        probability = weighted[1] / weighted.sum(0)
        rows, at = rows.of(open_), np.flatnonzero(open_)
        if len(at):
            order = shuffled_features(tree, ids[at], k, settings.seed)
            gain[at], feature[at], cut[at] = splits_of(rows, np.sort(order[:, :tried], axis=1), widths, settings.weights)
            # The other features only where the first ones cannot part the rows.
            bare = feature[at] < 0
            if bare.any() and tried < k:
                gain[at[bare]], feature[at[bare]], cut[at[bare]] = splits_of(rows.of(bare), np.sort(order[bare, tried:], axis=1), widths, settings.weights)
        parted = feature >= 0
        np.add.at(importance, feature[parted], gain[parted])
        done["feature"].append(feature)
        done["bin"].append(cut)
        done["left"].append(np.where(parted, made + 2 * (np.cumsum(parted) - 1), -1))
        done["probability"].append(probability)
        rows = halved(rows.of(parted[at]), feature[parted], cut[parted])
        ids = (2 * ids[parted][:, None] + np.array([0, 1])).ravel()
        made += len(ids)
        depth += 1
    return {name: np.concatenate(parts) for name, parts in done.items()} | {"importance": importance}


def halved(rows: Rows, feature: np.ndarray, cut: np.ndarray) -> Rows:
    """The rows by child: those of a node up to its ``cut`` first, then the others."""
    sizes, n = rows.sizes, len(rows.label)
    if not n:
        return Rows(rows.bins, rows.label, rows.times, np.zeros(0, dtype=np.int64), np.zeros((2, 0)))
    value = rows.bins.ravel()[np.arange(n) * rows.bins.shape[1] + np.repeat(feature, sizes)]
    child = 2 * np.repeat(np.arange(len(sizes)), sizes) + (value > np.repeat(cut, sizes))
    two = np.bincount(child, minlength=2 * len(sizes))
    right = np.cumsum(child & 1)  # up to here, over all nodes
    first = np.cumsum(sizes) - sizes
    before = np.where(first > 0, right[first - 1], 0)
    number = right - np.repeat(before, sizes)  # right ones of the node up to here
    place = np.where(child & 1, np.repeat(first + two[::2], sizes) + number - 1, np.arange(n) - number)
    both = np.bincount(2 * child + rows.label, rows.times, 4 * len(sizes)).reshape(-1, 2).T
    by = np.empty(n, dtype=np.int64)
    by[place] = np.arange(n)
    return Rows(rows.bins.take(by, 0), rows.label.take(by), rows.times.take(by), two, both)


def leaf_probability(subtree: dict[str, np.ndarray], bins: np.ndarray) -> np.ndarray:
    at = np.zeros(len(bins), dtype=np.int64)
    live = np.flatnonzero(subtree["feature"][at] >= 0)
    while len(live):
        node = at[live]
        side = bins[live, subtree["feature"][node]] > subtree["bin"][node]
        at[live] = subtree["left"][node] + side
        live = live[subtree["feature"][at[live]] >= 0]
    return subtree["probability"][at]


@dataclass
class Upper:
    """The upper levels of one tree: splits by node number (children 2i and 2i + 1), and what stands at their ends."""

    splits: dict[int, tuple[int, int]] = field(default_factory=dict)
    leaves: dict[int, float] = field(default_factory=dict)
    handed: set[int] = field(default_factory=set)

    def table(self) -> tuple[np.ndarray, ...]:
        """Node numbers, features, bins and places of both children (-1: no split) of the splits."""
        numbers = sorted(self.splits)
        place = {node: i for i, node in enumerate(numbers)}
        children = [[place.get(2 * node, -1), place.get(2 * node + 1, -1)] for node in numbers]
        cuts = np.array([self.splits[node] for node in numbers]).reshape(-1, 2)
        return np.array(numbers), cuts[:, 0], cuts[:, 1], np.array(children)

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The node without a split that each row comes to."""
        end = np.ones(len(bins), dtype=np.int64)
        if not self.splits:
            return end
        numbers, feature, cut, children = self.table()
        live, at = np.arange(len(bins)), np.zeros(len(bins), dtype=np.int64)
        while len(live):
            side = (bins[live, feature[at]] > cut[at]).astype(np.int64)
            end[live] = 2 * numbers[at] + side
            at = children[at, side]
            live, at = live[at >= 0], at[at >= 0]
        return end


@dataclass
class Layout:
    """Where a packed row keeps its features. A row is some 64-bit words: the weight in a tree (7 bits) and the label,
    a byte for each feature with more than two bins, and from a word of its own on a bit for each other feature."""

    place: np.ndarray  # a feature's first bit
    width: np.ndarray  # its bins
    words: int
    bits: int  # the first word of bits

    def packed(self, bins: np.ndarray, label: np.ndarray) -> np.ndarray:
        """The rows as words, of weight 0."""
        out = np.zeros((len(bins), self.words * 8), dtype=np.uint8)
        out[:, 0] = label << 7
        for f, place in enumerate(self.place.tolist()):
            if self.width[f] > 2:
                out[:, place >> 3] = bins[:, f]
            else:
                out[:, place >> 3] |= bins[:, f] << (place & 7)
        return out

    def spec(self, settings: Settings) -> bytes:
        """What the compiled functions have to know."""
        head = struct.pack("<6iq3d", self.words, self.bits, settings.features, settings.tried, settings.max_depth, len(_LARGEST), settings.seed, *settings.weights, float(UNIT))
        return head + _LARGEST.tobytes() + self.place.astype("<i4").tobytes() + self.width.astype("<i4").tobytes()


def layout(edges: list[np.ndarray]) -> Layout:
    width = np.array([len(e) + 1 for e in edges])
    wide = width > 2
    bits = -(-(1 + int(wide.sum())) // 8)
    place = np.where(wide, 8 * np.cumsum(wide), 64 * bits + np.cumsum(~wide) - 1)
    return Layout(place, width, bits - (-int((~wide).sum()) // 64), bits)


@dataclass
class Forest:
    settings: Settings
    trees: int
    edges: list[np.ndarray]
    upper: list[Upper]
    subtrees: DataFrame  # tree, node, and a subtree as ``unpacked`` reads it
    importances: np.ndarray  # adding up to 1


def bin_edges(rows: DataFrame, total: int) -> list[np.ndarray]:
    """Upper edges of the bins of each feature, from the rows of the least hashes: the same whatever the partitions."""
    share = min(1.0, SAMPLE_ROWS / max(total, 1))
    picked = rows.where(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int(share * (1 << 30))).select("features").toArrow()
    x = np.vstack([matrix(b) for b in picked.to_batches() if b.num_rows])
    edges = []
    for column in x.T:
        values = np.unique(column)
        if len(values) > BINS:
            values = np.unique(np.sort(column)[np.linspace(0, len(column) - 1, BINS).astype(int)])
        edges.append((values[:-1] + values[1:]) / 2)
    return edges


def binned(rows: DataFrame, edges: list[np.ndarray], columns: list[str]) -> DataFrame:
    """Long ``columns`` and ``bins``, a byte per feature."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch)
                table = np.stack([np.searchsorted(e, x[:, k]) for k, e in enumerate(edges)], axis=1).astype(np.uint8)
                kept = [batch.column(c).cast(pa.int64()) for c in columns]
                yield pa.RecordBatch.from_arrays([*kept, pa.array([r.tobytes() for r in table], pa.binary())], names=[*columns, "bins"])

    schema = ", ".join(f"{c} long" for c in columns) + ", bins binary"
    return rows.select(*columns, "features").mapInArrow(cut, schema)


def parts(rows: DataFrame, edges: list[np.ndarray], size: int, labelled: bool) -> DataFrame:
    """The rows packed, up to ``size`` in a part: ``rows`` and their ``keys``."""
    plan = layout(edges)
    columns = ["key", *(["label"] if labelled else [])]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, keys, n = [], [], 0

        def part(stop: int) -> pa.RecordBatch:
            every, names = np.concatenate(waiting), np.concatenate(keys)
            waiting[:], keys[:] = [every[stop:]], [names[stop:]]
            return pa.RecordBatch.from_pydict({"rows": [every[:stop].tobytes()], "keys": [names[:stop].tobytes()]})

        for batch in batches:
            if batch.num_rows:
                x = matrix(batch)
                bins = np.stack([np.searchsorted(e, x[:, k]) for k, e in enumerate(edges)], axis=1).astype(np.uint8)
                label = batch.column("label").cast(pa.uint8()).to_numpy() if labelled else np.zeros(len(bins), dtype=np.uint8)
                waiting.append(plan.packed(bins, label))
                keys.append(batch.column("key").cast(pa.int64()).to_numpy())
                n += len(bins)
            while n >= size:
                yield part(size)
                n -= size
        if n:
            yield part(n)

    return rows.select(*columns, "features").mapInArrow(pack, "rows binary, keys binary")


def _stored_parts(rows: DataFrame, edges: list[np.ndarray], total: int, labelled: bool) -> DataFrame:
    """In parts for all cores: each row is dealt out to every tree, so a small table is much work."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    size = max(1, min(PART_ROWS, -(-total // (4 * cores))))
    packed = parts(rows, edges, size, labelled).repartition(max(cores, -(-total // size)))
    return store(packed.withColumn("part", F.monotonically_increasing_id()), "parts")


def walks(upper: list[Upper], state: Callable[[int, int], int]) -> bytes:
    """The upper levels of all trees for the compiled functions: places of the trees, then the splits and ends of each,
    an end with its ``state`` by (tree, node). A split that only leads to ends of state 0 is such an end itself."""
    places, out, at = [], [], 4 * len(upper)
    for tree, top in enumerate(upper):
        states, ends, packed = {}, [], []
        for node in sorted(top.splits, reverse=True):  # children before their parents
            for child in (2 * node, 2 * node + 1):
                if child not in states:
                    states[child] = state(tree, child)
            states[node] = states[2 * node] or states[2 * node + 1]
        numbers = [node for node in sorted(top.splits) if states[node]]
        place = {node: i for i, node in enumerate(numbers)}

        def child(node: int, ends: list = ends, place: dict = place) -> int:
            if node in place:
                return place[node]
            ends.append(node)
            return -len(ends)

        if not numbers:
            ends.append(1)
            states.setdefault(1, 0 if top.splits else state(tree, 1))
        for node in numbers:
            packed.append(struct.pack("<4i", *top.splits[node], child(2 * node), child(2 * node + 1)))
        packed += [struct.pack("<qi", node, states[node]) for node in ends]
        piece = struct.pack("<2i", len(numbers), len(ends)) + b"".join(packed)
        places.append(at)
        out.append(piece)
        at += len(piece)
    return struct.pack(f"<{len(places)}i", *places) + b"".join(out)


def _table(batch: pa.RecordBatch, k: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("bins").to_pylist()), dtype=np.uint8).reshape(-1, k)


def _upper_levels(data: DataFrame, plan: Layout, trees: int, total: int, settings: Settings) -> tuple[list[Upper], np.ndarray]:
    """Phase one, and the gains of its splits per (tree, feature)."""
    upper = [Upper() for _ in range(trees)]
    gains = np.zeros((trees, settings.features))
    open_ = [(t, 1) for t in range(trees)]
    # A bootstrap of few rows fits at once; its size varies by the square root.
    if total + 6 * math.isqrt(total) <= settings.handed:
        for u in upper:
            u.handed.add(1)
        return upper, gains
    while open_:
        following = []
        for start in range(0, len(open_), OPEN_NODES):
            block = open_[start : start + OPEN_NODES]
            for rest in (False, True):
                bare = []
                found = _level(data, plan, upper, block, settings, rest)
                for tree, node in {*block} - {row[:2] for row in found}:
                    upper[tree].handed.add(node)  # no row was drawn
                for tree, node, feature, cut, gain, sizes in found:
                    u = upper[tree]
                    if sizes.sum() <= settings.handed:
                        u.handed.add(node)
                    elif feature >= 0:
                        u.splits[node] = (feature, cut)
                        gains[tree, feature] += gain
                        following += [(tree, 2 * node), (tree, 2 * node + 1)]
                    elif not rest and settings.tried < settings.features and sizes.min() > 0 and node.bit_length() - 1 < settings.max_depth:
                        bare.append((tree, node))
                    else:
                        weighted = sizes * settings.weights
                        u.leaves[node] = float(weighted[1] / weighted.sum()) if sizes.sum() else 0.5
                # The other features only where the first ones cannot part the rows.
                block = bare
                if not bare:
                    break
        open_ = following
    return upper, gains


def _level(data: DataFrame, plan: Layout, upper: list[Upper], block: list[tuple[int, int]], settings: Settings, rest: bool) -> list[tuple]:
    """(tree, node, feature, bin, gain, class sizes) of open nodes: one pass, counts added up per node.

    Only the features are counted that a node tries first, or, if ``rest``, all others. A node that is small enough
    comes back with its sizes. Feature -1: none of these features parts the rows, or the depth is reached.
    """
    k, tried, width = settings.features, settings.tried, plan.width
    some = slice(tried, None) if rest else slice(tried)
    asked = {*block}

    def choose(table: pa.Table) -> pa.Table:
        tree, node = table.column("tree")[0].as_py(), table.column("node")[0].as_py()
        features = np.sort(shuffled_features(tree, np.array([node]), k, settings.seed)[0, some])
        added = sum(np.frombuffer(c, dtype="<i8") for c in table.column("counts").to_pylist()).reshape(-1, 2)
        counts = np.zeros((len(features), BINS, 2), dtype=np.int64)
        for row, part in zip(counts, np.split(added, np.cumsum(width[features])[:-1])):
            row[: len(part)] = part
        sizes = counts[0].sum(0)
        feature, cut, gain = -1, 0, -1.0
        if sizes.min() > 0 and node.bit_length() - 1 < settings.max_depth:
            found, where = best_splits(counts, settings.weights)
            best = int(found.argmax())  # the lowest feature of those with the best gain
            if found[best] >= 0:
                feature, cut, gain = int(features[best]), int(where[best]), float(found[best])
        row = {"tree": tree, "node": node, "feature": feature, "bin": cut, "gain": gain, "n0": int(sizes[0]), "n1": int(sizes[1])}
        return pa.Table.from_pylist([row], schema=choices)

    choices = pa.schema([("tree", pa.int32()), ("node", pa.int64()), ("feature", pa.int32()), ("bin", pa.int32()), ("gain", pa.float64()), ("n0", pa.int64()), ("n1", pa.int64())])
    sent = compiled.over(data, "Count", plan.spec(settings), walks(upper, lambda tree, node: int((tree, node) in asked)), rest)
    found = sent.groupBy("tree", "node").applyInArrow(choose, "tree int, node long, feature int, bin int, gain double, n0 long, n1 long")
    rows = sorted(found.collect(), key=lambda r: (r["tree"], r["node"]))  # one row an open node
    return [(r["tree"], r["node"], r["feature"], r["bin"], r["gain"], np.array([r["n0"], r["n1"]])) for r in rows]


def _dealt(data: DataFrame, upper: list[Upper], columns: list[str], k: int, drawn: Callable | None) -> DataFrame:
    """Rows of handed-over nodes by (``tree``, ``node``), packed: one row per batch, tree and node.

    ``columns`` are packed as 64-bit numbers; ``drawn`` gives the weight of each row in a tree, and rows of weight 0
    stay behind.
    """
    shared = data.sparkSession.sparkContext.broadcast(upper)
    names = ["tree", "node", "bins", *columns, *(["times"] if drawn else [])]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = _table(batch, k)
            values = [batch.column(c).to_numpy() for c in columns]
            for tree, top in enumerate(shared.value):
                at = top.nodes(bins)
                times = drawn(batch.column("key").to_numpy(), tree) if drawn else None
                kept = np.flatnonzero(times > 0) if drawn else np.arange(len(at))
                by = kept[np.argsort(at[kept], kind="stable")]
                nodes, first = np.unique(at[by], return_index=True)
                rows = []
                for node, part in zip(nodes.tolist(), np.split(by, first[1:])):
                    if node in top.handed:
                        packed = [bins[part].tobytes(), *(v[part].tobytes() for v in values)]
                        rows.append((tree, node, *packed, *([times[part].astype(np.uint8).tobytes()] if drawn else [])))
                if rows:
                    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * (len(names) - 2)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    schema = "tree int, node long" + "".join(f", {n} binary" for n in names[2:])
    return data.mapInArrow(deal, schema)


def _tasks(groups: int) -> int:
    return max(1, min(groups, GROUP_TASKS))


def unpacked(subtree: bytes) -> dict[str, np.ndarray]:
    """A subtree's arrays: feature (-1: leaf), last bin on the left, left child (the right one follows it), and the
    probability of class 1 of the leaves."""
    n = int.from_bytes(subtree[:4], "little")
    split, left = np.frombuffer(subtree, "<i4", 2 * n, 4).reshape(-1, 2).T
    leaf = np.frombuffer(subtree, "<f8", -1, 4 + 8 * n)
    feature = np.where(split < 0, -1, split >> 8)
    probability = np.where(split < 0, leaf[np.where(split < 0, left, 0)], np.nan)
    return {"feature": feature, "bin": split & 255, "left": np.where(split < 0, -1, left), "probability": probability}


def _leaf(probability: float) -> bytes:
    """A subtree of one leaf."""
    return struct.pack("<3id", 1, -1, 0, probability)


def fit(rows: DataFrame, features: int, trees: int, weights: tuple[float, float], max_depth: int, seed: int, handed: int = HANDED) -> Forest:
    """``rows``: ``key`` (a hash of the row's id), ``label`` (0 or 1), ``features`` (array of doubles), stored.

    ``weights`` are those of the two classes, ``handed`` the bootstrap rows that a group may hold.
    """
    total = rows.count()
    edges = bin_edges(rows, total)
    plan = layout(edges)
    settings = Settings(features, weights, max_depth, seed, min(handed, GROUP_BYTES // (8 * plan.words)))
    data = _stored_parts(rows, edges, total, True)
    upper, gains = _upper_levels(data, plan, trees, total, settings)
    spec = plan.spec(settings)
    dealt = compiled.over(data, "Deal", spec, walks(upper, lambda tree, node: int(node in upper[tree].handed)))
    # A number of tasks of its own: few bytes are much work here.
    dealt = dealt.repartition(_tasks(sum(len(u.handed) for u in upper)), "tree", "node").sortWithinPartitions("tree", "node")
    subtrees = store(compiled.over(dealt, "Grow", spec), "subtrees")
    parts = subtrees.select("tree", F.posexplode("importance").alias("feature", "gain"))
    for r in parts.groupBy("tree", "feature").agg(F.sum("gain").alias("gain")).collect():  # trees * features
        gains[r["tree"], r["feature"]] += r["gain"]
    shares = gains / np.maximum(gains.sum(1, keepdims=True), 1e-300)
    return Forest(settings, trees, edges, upper, subtrees, shares.sum(0) / max(shares.sum(), 1e-300))


def score(forest: Forest, rows: DataFrame) -> DataFrame:
    """``key`` and ``probability`` of class 1, the mean over the trees; ``key`` tells the rows of ``rows`` apart.

    Rows meet the subtrees in groups by (tree, node, block), each with some ``ASKED`` rows at most, and the answers of
    all trees come together by part. Both go through their tasks as sorted streams.
    """
    trees, upper, settings = forest.trees, forest.upper, forest.settings
    spark = rows.sparkSession
    total = rows.count()
    spec = layout(forest.edges).spec(settings)
    data = _stored_parts(rows, forest.edges, total, False)
    blocks: dict[tuple[int, int], int] = {}
    if total > ASKED:
        ends = compiled.over(data, "Ends", spec, walks(upper, lambda tree, node: 1))
        for r in ends.groupBy("tree", "node").agg(F.sum("n").alias("n")).collect():  # a row an end of the upper levels
            blocks[r["tree"], r["node"]] = -(-r["n"] // ASKED)
    asked = compiled.over(data, "Ask", spec, walks(upper, lambda tree, node: blocks.get((tree, node), 1)))
    # What leaves of the upper levels say is a subtree as well.
    leaves = [(tree, node, bytearray(_leaf(p))) for tree, top in enumerate(upper) for node, p in top.leaves.items()]
    known = forest.subtrees.select("tree", "node", F.col("subtree").alias("bytes"))
    if leaves:
        known = known.unionByName(spark.createDataFrame(leaves, "tree int, node long, bytes binary"))
    last = F.lit(0)
    several = [(tree, node, n - 1) for (tree, node), n in blocks.items() if n > 1]
    if several:
        known = known.join(F.broadcast(spark.createDataFrame(several, "tree int, node long, last int")), ["tree", "node"], "left")
        last = F.coalesce("last", F.lit(0))
    known = known.select("tree", "node", "bytes", F.explode(F.sequence(F.lit(0), last)).alias("block"), F.lit(0).alias("kind"))
    tasks = _tasks(max(sum(len(top.handed) for top in upper), sum(blocks.values())))
    both = asked.unionByName(known).repartition(tasks, "tree", "node", "block")
    said = compiled.over(both.sortWithinPartitions("tree", "node", "block", "kind"), "Answer", spec)
    keys = data.select("part", F.lit(0).alias("kind"), F.col("keys").alias("bytes"))
    told = said.unionByName(keys).repartition(_tasks(-(-total // PART_ROWS)), "part")
    sums = compiled.over(told.sortWithinPartitions("part", "kind"), "Total", spec)
    return sums.select("key", (F.col("units") / F.lit(float(UNIT) * trees)).alias("probability"))
