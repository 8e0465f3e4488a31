"""The language model's trie: sequences in Elias-Fano code, and levels against counts."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from orderlens.llm.lm import bundle, unbundle
from orderlens.llm.trie import EliasFano, Trie, _place, sorted_order


@pytest.mark.parametrize("n, universe", [(0, 5), (1, 1), (1, 100), (5, 10), (1000, 300), (5000, 10**9), (300, 10**15)])
def test_access_and_find_in_ranges(n, universe):
    random = np.random.default_rng(n)
    numbers = np.sort(random.integers(0, universe, n))
    assert (EliasFano.build(numbers, universe).access(np.arange(n)) == numbers).all()
    different = np.unique(numbers)
    level = EliasFano.build(different, universe)
    asked = np.concatenate([different, random.integers(0, universe + 5, 200)])
    begin = random.integers(0, len(different) + 1, len(asked))
    end = np.minimum(begin + random.integers(0, 50, len(asked)), len(different))
    where = {int(x): i for i, x in enumerate(different)}
    want = [where.get(int(x), -1) for x in asked]
    assert level.find(asked).tolist() == want
    got = level.find(asked, begin, end)
    assert got.tolist() == [i if a <= i < b else -1 for i, a, b in zip(want, begin, end)]


@pytest.mark.parametrize("step", [1, 2, 70])
def test_ends_of_buckets_are_the_next_starts(step):
    """Also where a bucket's ones fill several words."""
    numbers = np.concatenate([np.arange(0, 400, step), np.full(700, 401), np.full(64, 500)])
    sequence = EliasFano.build(numbers, 600)
    h = np.arange(sequence.highest)
    assert (sequence.bucket_ends(h, sequence.bucket_starts(h)) == sequence.bucket_starts(h + 1)).all()


def test_ones_before_every_zero_of_a_word():
    words = np.append(np.random.default_rng(3).integers(0, 1 << 64, 50, dtype=np.uint64), np.array([0, 1, 1 << 63], dtype=np.uint64))
    for word in words:
        zeros = [i for i in range(64) if not int(word) >> i & 1]
        k = np.arange(1, len(zeros) + 1)
        want = [int(word & np.uint64((1 << i) - 1)).bit_count() for i in zeros]
        assert EliasFano._ones_before(np.full(len(k), word), k).tolist() == want


@pytest.mark.parametrize("top", [50, 1 << 40])
def test_order_and_places_by_one_key_or_several(top):
    """Whether or not the keys fit into one number, and the dictionary into a table."""
    random = np.random.default_rng(9)
    keys = [random.integers(0, top, 3000) // (top // 50) * (top // 50) for _ in range(3)]
    order = sorted_order(*keys)
    assert [k[order].tolist() for k in keys] == [k[np.lexsort(keys[::-1])].tolist() for k in keys]
    known, asked = np.unique(keys[0])[::2], np.append(keys[0], [-1, top + 5])
    where = {x: i for i, x in enumerate(known.tolist())}
    assert _place(known, asked).tolist() == [where.get(x, -1) for x in asked.tolist()]


def test_trie_against_counts(tmp_path):
    random, weight, alone = np.random.default_rng(7), 4.0, 5
    v, u, w = random.zipf(1.5, (3, 8000)).clip(0, 40).astype(np.uint64)
    (v, u, w), count = np.unique(np.stack([v, u, w]), axis=1, return_counts=True)
    one, two, pairs, three = Counter(), Counter(), Counter(), {}
    for a, b, c, n in zip(u, v, w, count):
        one[b] += n
        two[b, c] += n
        pairs[a, b] += n
        three[a, b, c] = n
    trie = Trie.build(tmp_path, u, v, w, count, lambda x: np.array([one[i] for i in x]), weight, np.array([alone], np.uint64))
    qv, qu, qw = np.unique(random.integers(0, 50, (3, 4000)).astype(np.uint64), axis=1)
    got = zip(qu, qv, qw, *trie.log10(qu, qv, qw, at_once=700), trie.left(qv))
    for a, b, c, after_two, rest, after_one, left in got:
        assert np.isnan(after_one) == (not two[b, c])
        assert np.isnan(after_two) == ((a, b, c) not in three or b == alone)
        if two[b, c]:
            assert after_one == pytest.approx(np.log10(two[b, c] / (one[b] + weight)), abs=0.02)
        if not np.isnan(after_two):
            assert after_two == pytest.approx(np.log10(three[a, b, c] / (pairs[a, b] + weight)), abs=0.02)
        seen = 0 if b == alone else pairs[a, b]
        assert rest == pytest.approx(np.log10(weight / (seen + weight)), abs=0.02)
        assert left == pytest.approx(np.log10(weight / (one[b] + weight)), abs=0.02)


def test_empty_trie(tmp_path):
    none, asked = np.zeros(0, dtype=np.uint64), np.arange(3, dtype=np.uint64)
    trie = Trie.build(tmp_path, none, none, none, np.zeros(0, dtype=np.int64), lambda x: np.zeros(len(x)), 4.0, none)
    three, rest, two = trie.log10(asked, asked, asked)
    assert np.isnan(three).all() and np.isnan(two).all() and not rest.any() and not trie.left(asked).any()


def test_bundles():
    arrays = [np.array([0, 255]), np.array([70_000]), np.array([], dtype=np.int64), np.array([1 << 63], np.uint64), np.array([-0.5])]
    assert [x.tolist() for x in unbundle(bundle(*arrays))] == [x.tolist() for x in arrays]
