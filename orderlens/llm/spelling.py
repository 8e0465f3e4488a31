"""Spelling variants: words at edit distance one, found by an index of variable-length grams.

1. Words and their counts are taken from whole texts; each task adds up its own words before the shuffle.
2. The gram dictionary holds the frequent grams (more than a limit of places over all different words), level by
   level: a gram can only be frequent if its beginning is. So rare branches are pruned as they come up.
3. A word, with marks before and behind it, is decomposed at every place into the shortest gram that is not in the
   dictionary (``LONGEST`` characters at most). Whether a gram is taken depends on its own characters alone, so an
   edit affects only the grams that cover its place; all others are found in the edited word too.
4. For each place of a word (a letter replaced or deleted there) and each gap (a letter put in there) the grams
   that such an edit cannot affect are merged into one key. Two words at distance one have the same key for the
   place of their edit, so a join of keys finds them, and every candidate is verified.

The bound of affected grams is used per place, not as one number per word: lists of single grams are too
long where many words share a few endings.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.text import hand_back, mix, release, small_batches
from orderlens.operators.storage import store

# The letters of words, after lower-casing A-Z.
RUN = re.compile("[a-zÀ-ÿ]+")
SHORTEST = 7
#: Characters of a gram: from 2 on.
LONGEST = 5
#: Places a gram may have without being frequent, at least; and frequent grams of one length at most.
RARE, DICTIONARY = 32, 1 << 19
#: Different words that a task adds up before it passes them on.
HELD = 200_000
_BITS = np.uint64(7)
_END, _BEFORE = 91, 92


def misspelt(doc_id: int | None, run: str, one_in: int) -> str:
    """``run`` without one letter if a checksum of the document's id (empty if null) and the run says so."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    return run if h % one_in else run[: h % len(run)] + run[h % len(run) + 1 :]


def counted_words(docs: DataFrame, least_n: int = 2, one_in: int | None = 31) -> DataFrame:
    """``word`` and ``n`` of the runs of letters in all texts of ``docs`` (``doc_id``, ``text``).

    A-Z are lower-cased. ``one_in``: how many of the different runs of a document lose a letter (see ``misspelt``); None
    leaves them as they are. Words of fewer than ``SHORTEST`` characters or ``least_n`` places are left out. Null
    texts have no words; repeated rows count each for itself.
    """
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        held: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                runs = RUN.findall((text or "").encode().lower().decode())
                own = Counter([r for r in runs if len(r) >= SHORTEST])
                if one_in:
                    begin = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                    for run in [r for r in own if zlib.crc32(r.encode(), begin) % one_in == 0]:
                        n, word = own.pop(run), misspelt(doc_id, run, one_in)
                        held[word] += n
                held.update(own)
            if len(held) > HELD:
                yield rows(held)
                held = Counter()
        yield rows(held)
        hand_back()

    def rows(held: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"word": pa.array(list(held), pa.string()), "n": pa.array(list(held.values()), pa.int64())})

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(count, "word string, n long")
    words = found.groupBy("word").agg(F.sum("n").alias("n"))
    return words.where((F.char_length("word") >= SHORTEST) & (F.col("n") >= least_n))


class Letters:
    """The words of a batch as numbers, one after another: marks before each word, its letters, its end."""

    def __init__(self, words: list[str]):
        before = "\x01" * (LONGEST - 1)
        points = np.frombuffer("".join(f"{before}{w}\x00" for w in words).encode("utf-32-le"), dtype="<u4")
        points = points.astype(np.int64)
        latin = np.where(points >= 0xC0, points - (0xC0 - 27), points - 96)
        self.codes = np.select([points == 0, points == 1], [_END, _BEFORE], latin).astype(np.uint64)
        ends = np.flatnonzero(points == 0)
        self.whole = np.diff(ends, prepend=-1)  # characters of each word, with its marks
        self.size = self.whole - LONGEST  # letters
        end = np.repeat(ends, self.whole)
        self.word = np.repeat(np.arange(len(words)), self.whole)  # of each character
        self.place = np.arange(len(points)) - (end - np.repeat(self.whole, self.whole) + 1)
        self.room = end - np.arange(len(points)) + 1  # characters up to the end, which counts

    def grams(self, length: int) -> np.ndarray:
        """The gram that begins at each character, as one number; cut off at the word's end."""
        out = np.zeros(len(self.codes), dtype=np.uint64)
        for k in range(length):
            out = np.where(self.room > k, out << _BITS | np.roll(self.codes, -k), out)
        return out

    def variable(self, frequent: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Gram and its length at each character; ``frequent`` has sorted grams of length 2, 3, ..."""
        length, gram = np.minimum(2, self.room), self.grams(2)
        growing = np.ones(len(self.codes), dtype=bool)
        for k, known in enumerate(frequent, 2):
            growing &= is_in(gram, known) & (self.room > k)
            gram = np.where(growing, self.grams(k + 1), gram)
            length = length + growing
        return gram, length

    def keys(self, frequent: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Per character, the merged grams that an edit cannot affect: of it, and of the gap before it.

        Grams to the left count with their place, those to the right with their distance from the end.
        """
        gram, length = self.variable(frequent)
        left = mix(mix(gram) + self.place.astype(np.uint64))
        right = mix(mix(gram) - self.room.astype(np.uint64))
        right[self.room == 1] = 0  # the end begins no gram
        until = np.zeros(len(gram) + 1, dtype=np.uint64)
        np.add.at(until, np.arange(len(gram)) + length, np.where(self.room > 1, left, np.uint64(0)))
        until = np.cumsum(until, dtype=np.uint64)[:-1]  # grams that end before a character, of all words so far
        behind = np.cumsum(right[::-1], dtype=np.uint64)[::-1]  # grams from a character on, of all words to come
        first = np.flatnonzero(self.place == 0)
        # A gram that reaches a word's end closes at the next word's first character.
        until = until - until[first[self.word]]
        after = np.append(behind[first[1:]], np.uint64(0))[self.word]
        spot = self.place.astype(np.uint64) << np.uint64(32)
        size = self.whole[self.word].astype(np.uint64)
        following = np.append(behind[1:], np.uint64(0))
        here = mix(mix(mix(until + spot) + (following - after)) + size)
        gap = mix(mix(mix(until + spot) + (behind - after)) + size + np.uint64(1))
        return here, gap


def is_in(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), dtype=bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def gram_dictionary(words: DataFrame, rare: int = RARE) -> list[np.ndarray]:
    """Sorted frequent grams of 2, 3, ... ``LONGEST`` - 1 characters of the stored ``words``.

    Of one length at most ``DICTIONARY`` are frequent, as the limit of places rises with their number.
    """
    context = words.sparkSession.sparkContext
    places = words.agg(F.sum(F.char_length("word") + LONGEST)).first()[0] or 0
    limit = max(rare, places // DICTIONARY)
    frequent: list[np.ndarray] = []
    for length in range(2, LONGEST):
        shared = context.broadcast(list(frequent))

        def count(batches: Iterator[pa.RecordBatch], length: int = length, shared: Broadcast = shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                letters = Letters(batch.column("word").to_pylist())
                grams = letters.grams(length)[letters.room > length]  # one that reaches the end grows no more
                if length > 2:
                    grams = grams[is_in(grams >> _BITS, shared.value[-1])]
                found, n = np.unique(grams, return_counts=True)
                yield pa.RecordBatch.from_pydict({"gram": pa.array(found.astype(np.int64)), "n": pa.array(n, pa.int64())})

        counts = words.select("word").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
        found = counts.where(F.col("n") > limit).select("gram").toArrow()
        frequent.append(np.sort(found.column("gram").to_numpy().astype(np.uint64)))
    return frequent


def edit_keys(words: DataFrame, frequent: list[np.ndarray], gaps: bool) -> DataFrame:
    """``key`` and ``id`` of every place of a word (``id``, ``word``), or of every gap between its letters (step 4)."""
    shared = words.sparkSession.sparkContext.broadcast(frequent)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = Letters(batch.column("word").to_pylist())
            keys = letters.keys(shared.value)[gaps]
            wanted = np.flatnonzero((letters.place >= LONGEST - 1) & (letters.room > (0 if gaps else 1)))
            ids = batch.column("id").to_numpy()[letters.word[wanted]]
            yield pa.RecordBatch.from_arrays([pa.array(keys[wanted].astype(np.int64)), pa.array(ids)], names=["key", "id"])

    return words.select("id", "word").mapInArrow(cut, "key long, id long")


def near_pairs(words: DataFrame, rare: int = RARE) -> DataFrame:
    """``a``, ``na``, ``b``, ``nb``: every pair a < b of the stored ``words`` (``word``, ``n``) at edit distance one, once.

    Words consist of the letters of ``RUN``. ``rare``: places up to which a gram is not frequent. Hashes stand for
    words until candidates are verified, so a word's length counts once.
    """
    small_batches(words.sparkSession)
    frequent = gram_dictionary(words, rare)
    named = words.select(F.xxhash64("word").alias("id"), "word", "n")

    def side(keys: DataFrame, name: str) -> DataFrame:
        return keys.select(F.col("key").alias(f"key_{name}"), F.col("id").alias(name))

    def whole(name: str) -> DataFrame:
        return named.select(F.col("id").alias(name), F.col("word").alias(f"word_{name}"), F.col("n").alias(f"n_{name}"))

    x = side(edit_keys(named, frequent, gaps=False), "x")
    replaced = x.join(side(edit_keys(named, frequent, gaps=False), "y"), F.expr("key_x = key_y AND x < y")).select("x", "y")
    put_in = x.join(side(edit_keys(named, frequent, gaps=True), "y"), F.expr("key_x = key_y")).select("x", "y")
    candidates = replaced.unionByName(put_in).distinct()
    verified = candidates.join(whole("x"), "x").join(whole("y"), "y").where("levenshtein(word_x, word_y, 1) = 1")
    first = F.col("word_x") < F.col("word_y")

    def ordered(low: str, high: str, name: str) -> Column:
        return F.when(first, F.col(low)).otherwise(F.col(high)).alias(name)

    return verified.select(
        ordered("word_x", "word_y", "a"), ordered("n_x", "n_y", "na"), ordered("word_y", "word_x", "b"), ordered("n_y", "n_x", "nb")
    )


def variants(words: DataFrame, factor: int = 10) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of every row of the stored ``words``.

    A word's form is its near word of largest count (ties: the smallest), if that is ``factor`` times the word's own
    or more. ``root`` is where the forms lead to, the word itself without a form. No words give no rows.
    """
    pairs = store(near_pairs(words), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("nb").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("na").alias("near_n"))
    )
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("down"), "near")).alias("best")
    )
    has_form = -F.col("best")["down"] >= factor * F.col("n")
    known = words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has_form, F.col("best")["near"]).alias("form"),
        F.when(has_form, -F.col("best")["down"]).alias("form_n"),
    )
    known = store(known, "forms")
    return known.join(roots(known.where("form IS NOT NULL").select("word", "form")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``: counts rise ``factor``-fold from word to form, so few rounds reach the last one."""
    step = forms.select(F.col("word").alias("root"), F.col("form").alias("further"))
    found = forms.select("word", F.col("form").alias("root"))
    while True:
        moved = store(found.join(step, "root", "left"), "roots")
        found = moved.select("word", F.coalesce("further", "root").alias("root"))
        if moved.where("further IS NOT NULL").limit(1).count() == 0:
            return found
