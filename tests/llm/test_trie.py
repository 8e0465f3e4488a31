"""The conversation trie against brute force: parentheses, shards, queries' rows, edge cases."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.llm import conversations, prefix_trie
from orderlens.llm.prefix_trie import Parentheses, subtree_sums


def random_depths(rng, n):
    out = [0]
    while len(out) < n:
        out.append(rng.randint(max(1, out[-1] - rng.choice([0, 0, 1, 9])), out[-1] + 1))
    return np.array(out)


@pytest.mark.parametrize("n", [1, 2, 31, 32, 33, 500, 5000])
def test_find_close(n):
    rng = random.Random(n)
    for shape in (random_depths(rng, n), np.arange(n), np.minimum(np.arange(n), 1)):
        closing = np.append(shape[:-1] - shape[1:] + 1, shape[-1] + 1)
        bits = np.array([b for c in closing for b in [1] + [0] * c], dtype=np.int8)
        stack, want = [], {}
        for k, b in enumerate(bits):
            if b:
                stack.append(k)
            else:
                want[stack.pop()] = k
        opens = np.flatnonzero(bits)
        assert Parentheses(bits).find_close(opens).tolist() == [want[k] for k in opens.tolist()]


@pytest.mark.parametrize("pieces", [1, 3, 40])
def test_shards_add_up(pieces):
    rng = random.Random(pieces)
    depths = random_depths(rng, 400)
    weights = np.array([rng.randrange(100) for _ in depths])
    path, want, got = [], defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    ancestors = []
    for k, d in enumerate(depths.tolist()):
        path = [*path[:d], k]
        ancestors.append(path)
        leaf = k + 1 == len(depths) or depths[k + 1] <= d
        for a in path:
            want[a][0] += leaf
            want[a][1] += int(weights[k])
    cuts = sorted({0, len(depths), *rng.sample(range(1, len(depths)), pieces - 1)})
    for a, b in zip(cuts, cuts[1:]):
        leaf = b == len(depths) or depths[b] <= depths[b - 1]
        leaves, saved = subtree_sums(depths[a:b], weights[a:b], leaf)
        for node, x, y in zip([*ancestors[a][:-1], *range(a, b)], leaves.tolist(), saved.tolist()):
            got[node][0] += x
            got[node][1] += y
    assert got == want


def brute_trie(convs: dict[int, list[tuple[str, str]]]):
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
        ends[tuple(convs[c])].append(c)
    children = defaultdict(set)
    for p in members:
        if p:
            children[p[:-1]].add(p)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    return {
        (m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(children[p]), leaves[p], saved[p],
         sha256(",".join(map(str, ends[p])).encode()).hexdigest())
        for p, m in members.items()
    }


def rows_of(df):
    return [(r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved, r.ends_sha256) for r in df.collect()]


@pytest.mark.parametrize("shard", [5, 250_000])
def test_trie(spark, shard):
    rng = random.Random(shard)
    convs = {}
    for c in range(-3, 160):
        base = convs.get(rng.randrange(-3, 160), [])
        convs[c] = [*base[: rng.randrange(12)], *((rng.choice(["user", "assistant"]), rng.choice(["a", "é", "bb", ""])) for _ in range(rng.randrange(9)))]
    long = [("user", str(k)) for k in range(300)]
    convs |= {500: long, 501: long, 502: long[:200], 503: long[:250] + [("x", "y")]}
    rows = [(c, 2 * k - 7, *t) for c, turns in convs.items() for k, t in enumerate(turns)]
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    ids = spark.createDataFrame([(c,) for c in convs], "conv_id long")
    got = rows_of(prefix_trie.trie(conversations.numbered_turns(table), ids, shard))
    assert len(got) == len(set(got)) and set(got) == brute_trie(convs)


def test_large_group_of_copies(spark):
    """Ids of many copies, over the size of one piece, go through the digest in order."""
    rows = [(c, k, "user", "same") for c in range(9000) for k in range(2)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    turns = conversations.numbered_turns(table)
    got = rows_of(prefix_trie.trie(turns, table.select("conv_id").distinct()))
    assert set(got) == brute_trie({c: [("user", "same")] * 2 for c in range(9000)})


def test_borrowed_and_edges(spark):
    rows = [
        (None, 0, "user", "no conversation"),
        (0, None, None, None),
        (0, 1, "user", "x"),
        (0, 1, "user", "x"),
        (0, 2, "user", "y" * 200_000),
        (3, 5, "assistant", "only"),
        (-1, 0, "user", "negative"),
        (12, 0, "a", "base is absent"),
        (12, 1, "a", "second"),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("place", F.lit("clash"))
    table = table.withColumn("member", F.lit(1)).withColumn("depth", F.lit(1))
    own = defaultdict(list)
    for c, turn, role, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0)):
        if c is not None:
            own[c].append((role or "", text or ""))
    want = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        want[c] = [*own.get(c - c % 5, [])[:h], *own[c][h:]]
    turns = conversations.numbered_turns(table)
    conv = F.col("conv_id")
    rebuilt, ids = conversations.with_borrowed_beginnings(turns, conv - F.pmod(conv, F.lit(5)), F.crc32(conv.cast("string").cast("binary")) % 9, 8)
    assert set(rows_of(prefix_trie.trie(rebuilt, ids))) == brute_trie(want)
    empty = conversations.numbered_turns(table.limit(0))
    assert rows_of(prefix_trie.trie(empty, empty.select("conv_id"))) == []
