"""An n-gram trie of order three in Elias-Fano code, memory-mapped, for one shard of a language model."""

from __future__ import annotations

from pathlib import Path

import numpy as np

_SAMPLE = 64  # bits per entry of the directory
_PAIRS, _FOURS, _EIGHTS, _BYTES, _TOPS = (np.uint64(x * 0x0101010101010101) for x in (0x55, 0x33, 0x0F, 0x01, 0x80))
#: Place of the k-th one (from 1) in a byte.
_PLACES = np.array([[0, *(bits := [i for i in range(8) if byte >> i & 1]), *[0] * (8 - len(bits))] for byte in range(256)], dtype=np.uint64)


class EliasFano:
    """A monotone sequence of n numbers below ``universe``: low bits packed, high bits in unary.

    A number x stands as a one at place (x >> low) + i of the upper bits; zeros separate the buckets of equal
    high bits. The directory has the ones before every word.
    """

    def __init__(self, n: int, low: int, lower: np.ndarray, upper: np.ndarray, ones: np.ndarray):
        self.n, self.low, self.lower, self.upper, self.ones = n, low, lower, upper, ones
        self.zeros = np.arange(len(ones), dtype=np.int64) * _SAMPLE - ones
        self.highest = int(self.zeros[-1]) - 1  # buckets that a zero ends

    @classmethod
    def build(cls, numbers: np.ndarray, universe: int) -> EliasFano:
        n = len(numbers)
        low = max(0, int(universe // max(n, 1)).bit_length() - 1)
        numbers = numbers.astype(np.uint64)
        high = (numbers >> np.uint64(low)).astype(np.int64)
        bits = int(universe >> low) + n + 1
        words = -(-bits // _SAMPLE) * (_SAMPLE // 64)
        flags = np.zeros(words * 64, dtype=np.uint8)
        flags[high + np.arange(n)] = 1
        upper = np.packbits(flags, bitorder="little").view(np.uint64)
        per = np.bitwise_count(upper).reshape(-1, _SAMPLE // 64).sum(axis=1, dtype=np.int64)
        ones = np.concatenate([[0], np.cumsum(per)])
        # Low parts side by side, ``low`` bits each, with a spare word at the end.
        lower = np.zeros(n * low // 64 + 2, dtype=np.uint64)
        if low and n:
            value = numbers & np.uint64((1 << low) - 1)
            at = np.arange(n, dtype=np.int64) * low
            word, shift = at >> 6, (at & 63).astype(np.uint64)
            # Several numbers fall into a word; words ascend, so each run is one reduction.
            first = np.flatnonzero(np.diff(word, prepend=-1))
            lower[word[first]] |= np.bitwise_or.reduceat(value << shift, first)
            over = np.flatnonzero((at & 63) + low > 64)
            lower[word[over] + 1] |= value[over] >> (np.uint64(64) - shift[over])
        return cls(n, low, lower, upper, ones)

    def bucket_starts(self, h: np.ndarray) -> np.ndarray:
        """How many numbers have high bits below ``h``: the place of the h-th zero, less the zeros before it."""
        block = np.searchsorted(self.zeros, h, side="left") - 1  # the h-th zero (from 1) lies in this block
        block = np.maximum(block, 0)
        want = h - self.zeros[block]
        ones = self.ones[block].copy()
        open_ = h > 0
        # Walk over the words of the block, then the bytes of the word, then its bits.
        word = block * (_SAMPLE // 64)
        for k in range(_SAMPLE // 64):
            w = self.upper[np.minimum(word + k, len(self.upper) - 1)]
            zeros = 64 - np.bitwise_count(w).astype(np.int64)
            last = open_ & (want <= zeros)
            if last.any():
                ones[last] += self._ones_before(w[last], want[last])
            skip = open_ & ~last
            ones[skip] += 64 - zeros[skip]
            want = np.where(skip, want - zeros, want)
            open_ = skip
        ones[h == 0] = 0
        return ones

    def bucket_ends(self, h: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """``bucket_starts`` of ``h + 1`` from those of ``h``: the ones that follow on the h-th zero belong to h."""
        at = starts + h
        word, shift = at >> 6, at & 63
        left = self.upper[word] >> shift.astype(np.uint64)
        run = np.bitwise_count(left & ~(left + np.uint64(1))).astype(np.int64)
        ends = starts + run
        over = np.flatnonzero(shift + run == 64)
        while len(over):  # the ones go on in the next word
            word[over] += 1
            left = self.upper[word[over]]
            run = np.bitwise_count(left & ~(left + np.uint64(1))).astype(np.int64)
            ends[over] += run
            over = over[run == 64]
        return ends

    @staticmethod
    def _ones_before(words: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Ones before the k-th zero (from 1) of each word: its byte by sums over the bytes, its bit by a table."""
        zeros = ~words
        sums = zeros - (zeros >> np.uint64(1) & _PAIRS)
        sums = (sums & _FOURS) + (sums >> np.uint64(2) & _FOURS)
        sums = (sums + (sums >> np.uint64(4)) & _EIGHTS) * _BYTES  # a byte has the zeros up to its end
        before_k, k = k, k.astype(np.uint64)
        reached = np.bitwise_count((sums | _TOPS) - k * _BYTES & _TOPS).astype(np.uint64)
        at = np.uint64(64) - reached * np.uint64(8)
        k -= sums << np.uint64(8) >> at & np.uint64(255)
        at += _PLACES[(zeros >> at & np.uint64(255)).astype(np.int64), k.astype(np.int64)]
        return at.astype(np.int64) - (before_k - 1)

    def low_bits(self, i: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(i), dtype=np.uint64)
        at = i.astype(np.int64) * self.low
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        value = self.lower[word] >> shift
        more = (at & 63) + self.low > 64
        value[more] |= self.lower[word[more] + 1] << (np.uint64(64) - shift[more])
        return value & np.uint64((1 << self.low) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        """The i-th numbers (from 0)."""
        i = i.astype(np.int64)
        block = np.searchsorted(self.ones, i, side="right") - 1  # the i-th one lies in this block
        left = i - self.ones[block]
        high = np.zeros(len(i), dtype=np.int64)
        open_ = np.ones(len(i), dtype=bool)
        for k in range(_SAMPLE // 64):
            word = block * (_SAMPLE // 64) + k
            w = self.upper[np.minimum(word, len(self.upper) - 1)]
            ones = np.bitwise_count(w).astype(np.int64)
            last = open_ & (left < ones)
            if last.any():
                # The place of the one with ``left`` ones before it is that of a zero of the inverted word.
                want = left[last] + 1
                before = self._ones_before(~w[last], want)
                high[last] = word[last] * 64 + before + want - 1 - i[last]
            left = np.where(open_ & ~last, left - ones, left)
            open_ &= ~last
        return (high << self.low) + self.low_bits(i).astype(np.int64)

    def find(self, numbers: np.ndarray, begin: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """Place of each number, or -1, among the places from ``begin`` to before ``end`` (by default all).

        The number's bucket is cut to this range, then searched by halving."""
        if not self.n:
            return np.full(len(numbers), -1, dtype=np.int64)
        high = (numbers.astype(np.uint64) >> np.uint64(self.low)).astype(np.int64)
        known = high <= self.highest
        high = np.minimum(high, self.highest)
        target = numbers.astype(np.uint64) & np.uint64((1 << self.low) - 1)
        a = self.bucket_starts(high)
        end_ = self.bucket_ends(high, a)
        if begin is not None:
            a, end_ = np.maximum(a, begin), np.minimum(end_, end)
        b = np.where(known, end_, a)
        while True:  # least place in the bucket whose low bits reach the target
            open_ = np.flatnonzero(a < b)
            if not len(open_):
                break
            middle = (a[open_] + b[open_]) >> 1
            less = self.low_bits(middle) < target[open_]
            a[open_[less]] = middle[less] + 1
            b[open_[~less]] = middle[~less]
        inside = known & (a < end_)
        found = np.where(inside, a, 0)
        inside &= self.low_bits(found) == target
        return np.where(inside, found, -1)

    def arrays(self) -> dict[str, np.ndarray]:
        return {"lower": self.lower, "upper": self.upper, "ones": self.ones}


class Level:
    """Ids in ranges, ascending within each, as one monotone sequence: each range goes on from the last number
    of the one before it. Pointers, in the same code, say where ranges begin."""

    def __init__(self, pointers: EliasFano, ids: EliasFano):
        self.pointers, self.ids = pointers, ids

    @staticmethod
    def build(ranges: np.ndarray, ids: np.ndarray, n_ranges: int) -> Level:
        """``ranges``: the range's number per id, ascending; ``ids`` ascend within a range."""
        starts = np.searchsorted(ranges, np.arange(n_ranges + 1))
        last = np.zeros(n_ranges + 1, dtype=np.int64)
        filled = np.flatnonzero(np.diff(starts))
        last[filled + 1] = ids[starts[filled + 1] - 1]
        numbers = ids + np.cumsum(last)[ranges]
        universe = int(numbers[-1]) + 1 if len(numbers) else 1
        return Level(EliasFano.build(starts, len(ids) + 1), EliasFano.build(numbers, universe))

    def range_of(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin and end of ranges, and what stands before their ids; a negative number is an empty range."""
        none, number = number < 0, np.maximum(number, 0)
        begin, end = self.pointers.access(number), self.pointers.access(number + 1)
        if not self.ids.n:
            return begin, begin, begin
        before = np.where(begin > 0, self.ids.access(np.maximum(begin, 1) - 1), 0)
        return begin, np.where(none, begin, end), before

    def find(self, ids: np.ndarray, begin: np.ndarray, end: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Places of the ids in their ranges; -1 for a negative id or one that the range lacks."""
        place = np.full(len(ids), -1, dtype=np.int64)
        some = np.flatnonzero((ids >= 0) & (begin < end))
        place[some] = self.ids.find(ids[some] + before[some], begin[some], end[some])
        return place


class Trie:
    """Words after one and two words, with quantised probabilities and back-off weights.

    A context v has a range of successors w and a range of the words u before it; each pair (u, v) has a range
    of successors. Ids are places in the shard's dictionary, except in the last level: there an id is the
    word's place among the successors of v, so it stays small. All levels are monotone sequences in Elias-Fano
    code with monotone pointers, and a search stays between two pointers. Probabilities and weights are bytes,
    places in tables of log10 values. All arrays are files of ``folder``, mapped and not read.
    """

    def __init__(self, folder: Path, shapes: dict[str, tuple[int, int]]):
        def load(name: str) -> np.ndarray:
            return np.load(folder / f"{name}.npy", mmap_mode="r").view(np.ndarray)

        def sequence(name: str) -> EliasFano:
            return EliasFano(*shapes[name], *(load(f"{name}-{part}") for part in ("lower", "upper", "ones")))

        self.words, self.heads = load("words"), load("heads")
        self.after, self.before, self.after_two = (Level(sequence(f"{x}-at"), sequence(x)) for x in LEVELS)
        self.codes = {x: (load(f"{x}-codes"), load(f"{x}-table")) for x in ("two", "two-rest", "three", "three-rest")}

    @staticmethod
    def build(
        folder: Path, u: np.ndarray, v: np.ndarray, w: np.ndarray, count: np.ndarray, totals, weight: float, alone: np.ndarray
    ) -> Trie:
        """From different triples, sorted by (v, u, w), with counts.

        ``totals``: function from words to their counts as contexts. The probability of a successor is count /
        (total + weight), and the rest is left for words not seen there. No pair is stored for the contexts
        v of ``alone``.
        """
        words = distinct(u, w)
        changes = _changes(v)
        heads, head = v[changes], np.cumsum(changes) - 1
        u, w = _place(words, u), _place(words, w)
        # Pairs (v, w): the successors of one word.
        both = head << 32 | w
        order = both.argsort()
        new = _changes(both[order])
        first = np.flatnonzero(new)
        pair_head, pair_word = head[order][first], w[order][first]
        pair_count = np.add.reduceat(count[order], first) if len(first) else count
        start = np.searchsorted(pair_head, np.arange(len(heads)))
        relative = np.empty(len(order), dtype=np.int64)
        relative[order] = np.cumsum(new) - 1 - start[head[order]]
        total = totals(heads)
        # Pairs (u, v) with their successors, as places among those of v.
        long = ~np.isin(v, alone)
        u, count, relative, owner = u[long], count[long], relative[long], head[long]
        new = _changes(owner, u)
        first = np.flatnonzero(new)
        number = np.cumsum(new) - 1
        two_total = np.add.reduceat(count, first) if len(first) else count
        levels = {
            "after": Level.build(pair_head, pair_word, len(heads)),
            "before": Level.build(owner[first], u[first], len(heads)),
            "after-two": Level.build(number, relative, len(first)),
        }
        logs = {
            "two": np.log10(pair_count / (total[pair_head] + weight)),
            "two-rest": np.log10(weight / (total + weight)),
            "three": np.log10(count / (two_total[number] + weight)),
            "three-rest": np.log10(weight / (two_total + weight)),
        }
        files, shapes = {"words": words, "heads": heads}, {}
        for name, level in levels.items():
            for key, sequence in ((name, level.ids), (f"{name}-at", level.pointers)):
                files |= {f"{key}-{part}": array for part, array in sequence.arrays().items()}
                shapes[key] = (sequence.n, sequence.low)
        for name, values in logs.items():
            files[f"{name}-codes"], files[f"{name}-table"] = quantise(values)
        for name, array in files.items():
            np.save(folder / f"{name}.npy", array)
        return Trie(folder, shapes)

    def log10(
        self, u: np.ndarray, v: np.ndarray, w: np.ndarray, order: int = 3, at_once: int = 65_536
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For triples sorted by (v, u): log10 probability after (u, v), NaN if not seen; log10 weight of what is left
        there; and log10 probability of w after v, NaN if not seen."""
        cuts = range(0, max(len(w), 1), at_once)
        parts = [[x.astype(np.float32) for x in self._log10(*(x[k : k + at_once] for x in (u, v, w)), order)] for k in cuts]
        return tuple(np.concatenate(x) for x in zip(*parts))

    def _log10(self, u: np.ndarray, v: np.ndarray, w: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        # Contexts and pairs once, however many words follow them.
        first = np.flatnonzero(_changes(v))
        times = np.diff(np.append(first, len(v)))
        head = _place(self.heads, v[first])
        successors = [np.repeat(x, times) for x in self.after.range_of(head)]
        place = self.after.find(_place(self.words, w), *successors)
        two = self._value("two", place)
        if order == 2:
            return np.full(len(w), np.nan), np.zeros(len(w)), two
        pair = np.flatnonzero(_changes(v, u))
        per = np.diff(np.append(pair, len(v)))
        of = np.searchsorted(first, pair, side="right") - 1
        ranges = [x[of] for x in self.before.range_of(head)]
        context = self.before.find(_place(self.words, u[pair]), *ranges)
        seen = [np.repeat(x, per) for x in self.after_two.range_of(context)]
        relative = np.where(place >= 0, place - successors[0], -1)
        three = self._value("three", self.after_two.find(relative, *seen))
        rest = np.nan_to_num(self._value("three-rest", context))
        return three, np.repeat(rest, per), two

    def left(self, v: np.ndarray) -> np.ndarray:
        """log10 of what a context leaves for words not seen after it; 0 for one that was not seen."""
        return np.nan_to_num(self._value("two-rest", _place(self.heads, v)))

    def _value(self, name: str, place: np.ndarray) -> np.ndarray:
        codes, table = self.codes[name]
        out = np.full(len(place), np.nan)
        seen = place >= 0
        out[seen] = table[codes[place[seen]]]
        return out


LEVELS = ("after", "before", "after-two")


def _changes(*keys: np.ndarray) -> np.ndarray:
    """Where a sorted row differs from the one before it."""
    new = np.ones(len(keys[0]), dtype=bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


def distinct(*parts: np.ndarray) -> np.ndarray:
    """The different numbers, ascending. ``np.unique`` takes a hash table for this, several times slower than a sort."""
    numbers = np.sort(np.concatenate(parts))
    return numbers[_changes(numbers)]


def sorted_order(*keys: np.ndarray) -> np.ndarray:
    """An order by the keys, the first one foremost; equal rows come in any order.

    Numbers from 0. One sort where all keys fit into 63 bits side by side."""
    bits = [int(k.max()).bit_length() if len(k) else 0 for k in keys]
    if sum(bits) > 63:
        return np.lexsort(keys[::-1])
    packed = np.zeros(len(keys[0]), dtype=np.int64)
    for k, b in zip(keys, bits):
        packed = packed << b | k
    return packed.argsort()


def _place(keys: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Place of each asked key among the sorted ``keys``, or -1."""
    if not len(keys):
        return np.full(len(asked), -1, dtype=np.int64)
    if 0 <= keys[0] and keys[-1] <= 4 * (len(keys) + len(asked)):
        # Places in a small dictionary: a table of all.
        table = np.full(int(keys[-1]) + 2, -1, dtype=np.int64)
        table[keys] = np.arange(len(keys))
        return table[np.where((asked < 0) | (asked > keys[-1]), len(table) - 1, asked)]
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, at, -1)


def quantise(logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One byte per value: places in a table of means of 256 equally wide bins."""
    if not len(logs):
        return np.zeros(0, dtype=np.uint8), np.zeros(1)
    width = max((logs.max() - logs.min()) / 256, 1e-12)
    codes = np.minimum((logs - logs.min()) / width, 255).astype(np.uint8)
    times = np.bincount(codes, minlength=256)
    return codes, np.bincount(codes, logs, 256) / np.maximum(times, 1)
