"""Language-model scores from a trigram trie in shards; the shards never meet in one place.

A token is an event (u, v, w): the two tokens before it and itself. Events are dealt out by v, so a shard has
all successors of its contexts v and of all pairs (u, v): it builds its part of the trie from the training events
and looks up all of its events in it. What isn't found after v backs off to the unigram count of w, by a join.
Sums per document are all that leaves a shard, for the documents that occur in it. A context v so frequent that
its events would fill a shard is split by u, and the counts of its pairs (v, w), added up over the shards, are
joined as well. The first token of a text has one context only, the beginning, which is split by w.

Smoothing, with a parameter m: P(w | u, v) = c(u, v, w) / (c(u, v) + m) if the triple was seen in training, else
m / (c(u, v) + m) * P(w | v); P(w | v) = c(v, w) / (c(v) + m) if the pair was seen, else m / (c(v) + m) * P(w);
P(w) = (c(w) + 1) / (N + V + 1). The sum over all words is at most 1. The order is three, or two on request.
"""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterator
from itertools import batched
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.text import hand_back, mix, small_batches, word_hashes
from orderlens.llm.trie import Trie, _changes, _place, distinct, sorted_order
from orderlens.operators.storage import store

#: Events of one shard, and events that a task gathers before it sends them.
SHARD_EVENTS, STRETCH_EVENTS = 2_000_000, 1_000_000
#: Triples that a shard's task builds a trie of at once: it goes through its contexts range by range.
AT_ONCE = 250_000
#: The commonest words, which stand as two bytes wherever a dictionary is sent (8 bytes each in every task).
CODED = 1 << 16
#: Ids of the end of a text, and of what stands before its first word.
END, BEGIN = np.uint64(1), np.uint64(2)
BEGIN_ONLY = np.array([BEGIN])


def tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, and the number of words per text. The ids 1 and 2 are not words."""
    words, counts = word_hashes(texts)
    return np.maximum(words, np.uint64(16)), counts


def word_counts(docs: DataFrame, train: Column) -> DataFrame:
    """``word`` (id) and ``n`` over the words of the rows where ``train`` holds."""

    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(tokens(batch.column("text").to_pylist())[0])
            size += len(held[-1])
            if size > STRETCH_EVENTS:
                yield counted(held)
                held, size = [], 0
        if held:
            yield counted(held)

    def counted(held: list[np.ndarray]) -> pa.RecordBatch:
        words, n = np.unique(np.concatenate(held), return_counts=True)
        arrays = [pa.array(words.view(np.int64), pa.int64()), pa.array(n, pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, names=["word", "n"])

    found = docs.filter(train).select("text").mapInArrow(count, "word long, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def bundle(*arrays: np.ndarray) -> bytes:
    """Arrays in one blob; unsigned numbers in as few bytes as the largest needs."""
    parts = []
    for x in arrays:
        if x.dtype.kind != "f" and x.dtype != np.uint64:
            top = int(x.max()) if len(x) else 0
            x = x.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(t).max))
        parts += [x.dtype.char.encode(), len(x).to_bytes(8, "little"), x.tobytes()]
    return b"".join(parts)


def unbundle(data: bytes | memoryview) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        kind, n = np.dtype(chr(data[at])), int.from_bytes(data[at + 1 : at + 9], "little")
        out.append(np.frombuffer(data, kind, n, at + 9))
        at += 9 + n * kind.itemsize
    return out


def _lengths(new: np.ndarray) -> np.ndarray:
    """Lengths of the runs that begin where ``new`` holds."""
    return np.diff(np.append(np.flatnonzero(new), len(new)))


def _decoded(codes: np.ndarray, rare: np.ndarray, coded: np.ndarray) -> np.ndarray:
    return np.concatenate([coded[codes], rare])


def _events(docs: DataFrame, frequent: np.ndarray, coded: np.ndarray, shards: int) -> DataFrame:
    """Blobs of events by shard: different triples once, and for each the texts of the stretch that have it.

    A stretch is what a task gathers before it sends. Words stand as places in the blob's own dictionary, which
    has the places of common words among ``coded`` and the ids of the others. One more blob per stretch, under a negative shard, says which rows its texts are and how many tokens they have.
    """
    small_batches(docs.sparkSession)

    def pack(held: list[tuple], stretch: int) -> pa.RecordBatch:
        ids, train, word, sizes = (np.concatenate(x) for x in zip(*held))
        # Each text's words and its end follow on what stands before them.
        owner = np.repeat(np.arange(len(sizes)), sizes + 1)
        last = np.cumsum(sizes + 1) - 1
        token = np.empty(len(owner), dtype=np.uint64)
        inner = np.ones(len(owner), dtype=bool)
        inner[last] = False
        token[inner], token[last] = word, END
        words, own = np.unique(np.append(token, BEGIN), return_inverse=True)
        begin, w = own[-1], own[:-1]
        start = np.concatenate([[0], last[:-1] + 1])
        v, u = np.empty_like(w), np.empty_like(w)
        v[1:] = w[:-1]
        v[start] = begin
        u[1:] = v[:-1]
        u[start] = begin
        spread = mix(words)
        code = np.searchsorted(coded, words)
        if len(coded):
            code[coded[np.minimum(code, len(coded) - 1)] != words] = len(coded)
        key = spread[v]
        split = np.isin(words, frequent)[v]
        key[split] = mix(words[v[split]] + spread[u[split]])
        key[start] = mix(BEGIN + spread[w[start]])
        shard = (key % np.uint64(shards)).astype(np.int64)
        # By shard, v, u, w, then text: triples get numbers first, so that all fit into one key.
        by = sorted_order(v, u, w)
        triple = np.empty(len(by), dtype=np.int64)
        triple[by] = np.cumsum(_changes(v[by], u[by], w[by])) - 1
        order = sorted_order(shard, triple, owner)
        high, low, owner = (shard << 32 | v)[order], (u << 32 | w)[order], owner[order]
        new = _changes(high, low, owner)
        times, high, low, owner = _lengths(new), high[new], low[new], owner[new]
        mark = owner << 1 | train[owner]
        edge = np.flatnonzero(_changes(high >> 32))
        rows = [(-1 - stretch % shards, bundle(ids.view(np.uint64), sizes + 1))]
        for a, b in zip(edge, [*edge[1:], len(high)]):
            h, l = high[a:b], low[a:b]
            triple, pair, head = _changes(h, l), _changes(h, l >> 32), _changes(h)
            v, u, w = h[head] & 0xFFFFFFFF, l[pair] >> 32, l[triple] & 0xFFFFFFFF
            used, places = np.unique(np.concatenate([v, u, w]), return_inverse=True)
            # Common words first in the blob's dictionary.
            is_coded = code[used] < len(coded)
            place = np.where(is_coded, np.cumsum(is_coded), is_coded.sum() + np.cumsum(~is_coded)) - 1
            dictionary = code[used[is_coded]], words[used[~is_coded]]
            v, u, w = np.split(place[places], [len(v), len(v) + len(u)])
            spreads = _lengths(head[pair]), _lengths(pair[triple]), _lengths(triple)
            rows.append((int(h[0] >> 32), bundle(*dictionary, v, u, w, *spreads, mark[a:b], times[a:b])))
        shard_column, data = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(shard_column, pa.int64()), pa.array([stretch] * len(rows), pa.int64()), pa.array(data, pa.binary())],
            names=["shard", "stretch", "data"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        held, size = [], 0
        for batch in batches:
            words, counts = tokens(batch.column("text").to_pylist())
            train = batch.column("train").to_numpy(zero_copy_only=False).astype(bool)
            held.append((batch.column("row").to_numpy(), train, words, counts))
            size += len(words) + len(counts)
            if size > STRETCH_EVENTS:
                yield pack(held, (part << 32) + number)
                held, size, number = [], 0, number + 1
        if size:
            yield pack(held, (part << 32) + number)
        del held
        hand_back()

    return docs.mapInArrow(run, "shard long, stretch long, data binary")


#: ``rows``: ids and sizes of a stretch's texts; ``sums``: texts, words known, unigram and model logarithms; ``back``:
#: text, context and word of what backs off, and how often; ``pairs``: counts of
#: split contexts, by bucket of the word, with a negative stretch.
ANSWER = "stretch long, rows binary, sums binary, back binary, pairs binary"


def _answers(
    events: DataFrame, frequent: dict[int, int], coded: np.ndarray, shards: int, training_texts: int, weight: float, order: int
) -> DataFrame:
    """Per shard and stretch, sums over the texts of the stretch that occur in the shard, and what backs off.

    What is left to a frequent context's pairs is marked with the context, as its counts are spread over shards;
    all else that backs off has context 0. Rows and sizes of the stretches are handed on."""
    return events.groupBy("shard").applyInArrow(scorer(frequent, coded, shards, training_texts, weight, order), ANSWER)


def scorer(
    frequent: dict[int, int], coded: np.ndarray, shards: int, training_texts: int, weight: float, order: int, at_once: int = AT_ONCE
) -> Callable[[pa.Table], pa.Table]:
    """Function from a shard's events to its answers.

    Contexts do not share anything, so each range of them that has up to ``at_once`` triples (or is one context)
    has a trie of its own, one after the other: beside the events, memory is that of a range and not of the shard."""
    common = np.array(list(frequent), dtype=np.int64).view(np.uint64)
    by_id = np.argsort(common)
    common, common_counts = common[by_id], np.array(list(frequent.values()), dtype=np.int64)[by_id]

    def score(table: pa.Table) -> pa.Table:
        out = answers(table)
        hand_back()  # all arrays but the answers are gone
        return out

    def answers(table: pa.Table) -> pa.Table:
        shard, stretch = (table.column(c).to_pylist() for c in ("shard", "stretch"))
        if shard[0] < 0:
            return answer([(s, d, b"", b"", b"") for s, d in zip(stretch, table.column("data").to_pylist())])
        # Views of the table's own memory.
        blobs = [unbundle(memoryview(x.as_buffer())) for x in table.column("data")]
        # The shard's own dictionary; words are places in it, BEGIN among them.
        words = BEGIN_ONLY
        for some in batched(blobs, 8):
            words = distinct(words, *(_decoded(*b[:2], coded) for b in some))
        here = np.isin(words, common)  # contexts that are split over shards
        spread_counts = _count_of(words, common, common_counts)
        own = [np.searchsorted(words, _decoded(*b[:2], coded)).astype(np.int32) for b in blobs]
        size = np.zeros(len(words), dtype=np.int64)
        for places, (_, _, v, _, _, per_head, per_pair, *_) in zip(own, blobs):
            size[places[v]] += np.add.reduceat(per_pair, _starts(per_head)[:-1], dtype=np.int64)
        ranges = _ranges(size, at_once)
        # A blob's contexts ascend, so a range of them is a stretch of each of its arrays.
        cuts = []
        for places, (_, _, v, _, _, per_head, per_pair, entries, *_) in zip(own, blobs):
            heads = np.searchsorted(places[v], ranges)
            pairs = _starts(per_head)[heads]
            triples = _starts(per_pair)[pairs]
            cuts.append((heads, pairs, triples, _starts(entries)[triples]))
        texts = [distinct(b[-2] >> 1) for b in blobs]
        sums = [np.zeros((3, len(t))) for t in texts]  # known, base, model
        off = [[NO_BACK] for _ in blobs]
        rows = []
        for k in range(len(ranges) - 1):
            parts = []
            for places, cut, (_, _, v, u, w, per_head, per_pair, entries, mark, times) in zip(own, cuts, blobs):
                head, pair, triple, entry = (slice(c[k], c[k + 1]) for c in cut)
                per_v = np.repeat(places[v[head]], per_head[head])
                parts.append(
                    (
                        np.repeat(places[u[pair]], per_pair[pair]),
                        np.repeat(per_v, per_pair[pair]),
                        places[w[triple]],
                        entries[triple],
                        mark[entry],
                        times[entry],
                    )
                )
            back, pairs = part(words, here, spread_counts, parts, texts, sums)
            for o, b in zip(off, back):
                o.append(b)
            rows += pairs
        for s, t, (known, base, model), o in zip(stretch, texts, sums, off):
            # The model's sums are rounded to a byte per probability anyway.
            totalled = bundle(t, known.astype(np.int64), base, model.astype(np.float32))
            rows.append((s, b"", totalled, bundle(*(np.concatenate(x) for x in zip(*o))), b""))
        return answer(rows)

    def part(
        words: np.ndarray, here: np.ndarray, spread_counts: np.ndarray, parts: list[tuple], texts: list[np.ndarray], sums: list[np.ndarray]
    ) -> tuple[list[tuple], list[tuple]]:
        """What backs off in each stretch, and rows of the pairs of split contexts, for a range of contexts. Adds to ``sums``."""
        bounds = np.cumsum([0, *(len(p[2]) for p in parts)])
        u, v, w, entries = (np.concatenate(x) for x in zip(*(p[:4] for p in parts)))
        if not len(w):
            return [NO_BACK] * len(parts), []
        trained = np.concatenate([(p[4] & 1).astype(np.int32) * p[5] for p in parts])
        count = np.add.reduceat(trained, _starts(entries)[:-1], dtype=np.int64)
        # Triples of all stretches once; ``at`` leads from a stretch's triple to it.
        by = sorted_order(v, u, w)
        new = _changes(v[by], u[by], w[by])
        at = np.empty(len(by), dtype=np.int32)
        at[by] = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        u, v, w, count = u[by][first], v[by][first], w[by][first], np.add.reduceat(count[by], first)
        used = count > 0
        tu, tv, tw, tn = u[used], v[used], w[used], count[used]
        # Training counts of the range's contexts: as words, they are counted where they are contexts.
        head = np.flatnonzero(_changes(tv))
        seen, counts = tv[head], np.add.reduceat(tn, head) if len(head) else tn
        begin = np.searchsorted(words, BEGIN)

        def totals(c: np.ndarray) -> np.ndarray:
            own = np.maximum(_count_of(c, seen, counts), spread_counts[c])
            return np.where(c == begin, training_texts, own)

        c = totals(v)
        split = here[v]
        folder = Path(tempfile.mkdtemp(prefix="trie-"))  # read by this task alone, removed at its end
        try:
            trie = Trie.build(folder, tu, tv, tw, tn, totals, weight, np.array([begin]))
            three, rest, two = trie.log10(u, v, w, order)
            rest_two = trie.left(v)
            del trie
        finally:
            shutil.rmtree(folder, ignore_errors=True)
        # A split context's pairs are counted elsewhere: its share of the probability is here, theirs joined.
        shorter = np.where(split, -np.log10(c + weight), np.where(np.isnan(two), rest_two, two))
        model = np.where(np.isnan(three), rest + shorter, three)
        back = np.isnan(three) & (split | np.isnan(two))
        real = v != begin  # each word is a context once, so its unigram count is at hand
        base = np.where(real, np.log10(c + 1), 0.0)
        known = (real & (c > 0)).astype(np.float64)
        off = []
        for k, ((*_, entries, mark, times), own, total) in enumerate(zip(parts, texts, sums)):
            text = mark >> 1
            which = np.repeat(at[bounds[k] : bounds[k + 1]], entries)
            place = _place(own, text)
            for t, x in zip(total, (known, base, model)):
                t += np.bincount(place, x[which] * times, len(own))
            far = back[which]
            left = which[far]
            context = np.where(split[left], words[v[left]], np.uint64(0))
            off.append((text[far], context, words[w[left]], times[far]))
        rows = []
        mine = here[tv]
        if mine.any():
            pv, pw, pn = words[tv[mine]], words[tw[mine]], tn[mine]
            bucket = (mix(pw) % np.uint64(max(1, shards // 8))).astype(np.int64)
            by = np.lexsort((pv, pw, bucket))
            bucket, pv, pw, pn = bucket[by], pv[by], pw[by], pn[by]
            first = np.flatnonzero(_changes(pv, pw))
            bucket, pv, pw, pn = bucket[first], pv[first], pw[first], np.add.reduceat(pn, first)
            edge = np.flatnonzero(_changes(bucket))
            for i, j in zip(edge, [*edge[1:], len(bucket)]):
                rows.append((-1 - int(bucket[i]), b"", b"", b"", bundle(pv[i:j], pw[i:j], pn[i:j])))
        return off, rows

    def answer(rows: list[tuple]) -> pa.Table:
        stretch, *blobs = zip(*rows)
        names = [f.split()[0] for f in ANSWER.split(", ")]
        return pa.table(dict(zip(names, [pa.array(stretch, pa.int64()), *(pa.array(b, pa.binary()) for b in blobs)])))

    return score


def _starts(lengths: np.ndarray) -> np.ndarray:
    """Where runs of these lengths begin, and where the last one ends."""
    return np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])


def _ranges(size: np.ndarray, most: int) -> list[int]:
    """Bounds of ranges whose sizes add up to ``most`` at most, but for single ones that are larger."""
    total, bounds = np.cumsum(size), [0]
    while bounds[-1] < len(size):
        before = int(total[bounds[-1] - 1]) if bounds[-1] else 0
        bounds.append(max(bounds[-1] + 1, int(np.searchsorted(total, before + most, side="right"))))
    return bounds


def _count_of(asked: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Counts of the asked keys; 0 for those that are not among the sorted ``keys``."""
    if not len(keys):
        return np.zeros(len(asked), dtype=np.int64)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, counts[at], 0)


def _sums(answers: DataFrame) -> DataFrame:
    """Per text: ``row``, ``n_tokens``, ``known``, ``base`` and ``model``, summed over the shards."""

    def add(table: pa.Table) -> pa.Table:
        ids, sizes = unbundle(next(r for r in table.column("rows").to_pylist() if r))
        known, base, model = np.zeros(len(ids), dtype=np.int64), np.zeros(len(ids)), np.zeros(len(ids))
        for blob in table.column("sums").to_pylist():
            if blob:
                texts, *sums = unbundle(blob)
                for total, x in zip((known, base, model), sums):
                    total[texts] += x.astype(total.dtype)
        columns = {"row": ids.view(np.int64), "n_tokens": sizes.astype(np.int64), "known": known, "base": base, "model": model}
        return pa.table(columns)

    return (
        answers.filter("stretch >= 0")
        .select("stretch", "rows", "sums")
        .groupBy("stretch")
        .applyInArrow(add, "row long, n_tokens long, known long, base double, model double")
    )


def _backed_off(answers: DataFrame) -> DataFrame:
    """``row``, ``context``, ``word`` and ``times`` of the tokens that the trie does not know after their contexts."""

    def name(table: pa.Table) -> pa.Table:
        ids = unbundle(next(r for r in table.column("rows").to_pylist() if r))[0].view(np.int64)
        text, context, word, times = (
            np.concatenate(x) for x in zip(*(unbundle(b) for b in table.column("back").to_pylist() if b), NO_BACK)
        )
        columns = {"row": ids[text.astype(np.int64)], "context": context.view(np.int64)}
        return pa.table(columns | {"word": word.view(np.int64), "times": times.astype(np.int64)})

    return (
        answers.filter("stretch >= 0")
        .select("stretch", "rows", "back")
        .groupBy("stretch")
        .applyInArrow(name, "row long, context long, word long, times long")
    )


NO_BACK = [np.zeros(0, dtype=t) for t in (np.uint8, np.uint64, np.uint64, np.uint8)]


def _after_frequent(answers: DataFrame) -> DataFrame:
    """``follower`` and ``after``: how often the word follows each frequent context in training, by context."""

    def merge(table: pa.Table) -> pa.Table:
        context, word, n = (np.concatenate(x) for x in zip(*map(unbundle, table.column("pairs").to_pylist())))
        by = np.lexsort((context, word))
        context, word, n = context[by], word[by], n[by].astype(np.int64)
        first = np.flatnonzero(_changes(word, context))
        context, word, n = context[first], word[first], np.add.reduceat(n, first)
        head = np.flatnonzero(_changes(word))
        # A word has at most one entry per frequent context.
        after = pa.MapArray.from_arrays(
            pa.array(np.append(head, len(word)), pa.int32()), pa.array(context.view(np.int64)), pa.array(n)
        )
        return pa.table({"follower": pa.array(word[head].view(np.int64)), "after": after})

    return (
        answers.filter("stretch < 0")
        .select("stretch", "pairs")
        .groupBy("stretch")
        .applyInArrow(merge, "follower long, after map<long, long>")
    )


def score(docs: DataFrame, train: Column, weight: float = 4.0, order: int = 3, shard_events: int = SHARD_EVENTS) -> DataFrame:
    """Scores of every row of ``docs`` (``doc_id``, ``text``), learnt from the rows where ``train`` holds.

    Columns: ``doc_id``, ``train``, ``n_tokens`` (words and the end), ``n_known`` (seen in training),
    ``train_tokens``, ``base_score`` (add-one unigrams) and ``score`` (the trie's log10 probability).

    Null and empty texts are the end alone. Rows with one id and one text are one row of the result;
    repeated rows each count in training. A null id is an id. Without training rows all counts are 0.
    ``order`` is 2 or 3. ``shard_events`` decides how the work is cut, not what comes out, but for the
    bytes that probabilities are rounded to.
    """
    if order not in (2, 3):
        raise ValueError("order must be 2 or 3")
    key = F.xxhash64(F.col("doc_id").cast("string"), F.coalesce("text", F.lit("")))
    rows = docs.select("doc_id", "text", F.coalesce(train, F.lit(False)).alias("train"), key.alias("row"))
    counts = store(word_counts(rows, F.col("train")), "words")
    words, different = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    every, texts = rows.agg(F.count("*"), F.coalesce(F.sum(F.col("train").cast("long")), F.lit(0))).first()
    train_tokens, vocabulary = words + texts, different + (texts > 0)
    # All rows have about as many tokens as the training rows; with none of these, any number will do.
    shards = max(8, -(-train_tokens * every // (max(texts, 1) * shard_events)))
    # Words that would fill a quarter of a shard by themselves: fewer than four per shard.
    frequent = {r["word"]: r["n"] for r in counts.filter(F.col("n") * 4 * shards > words).collect()}
    split = np.array(list(frequent), dtype=np.int64).view(np.uint64)
    commonest = counts.orderBy(F.desc("n"), "word").select("word").limit(CODED).collect()
    coded = np.sort(np.array([r["word"] for r in commonest], dtype=np.int64).view(np.uint64))
    events = _events(rows.drop("doc_id"), split, coded, shards)
    answers = store(_answers(events, frequent, coded, shards, texts, weight, order), "answers")
    size = float(np.log10(train_tokens + vocabulary + 1))
    n = F.when(F.col("word") == int(END), F.lit(int(texts))).otherwise(F.coalesce("n", F.lit(0)))
    one = F.log10(n + 1.0) - size
    # After a frequent context its share has been taken; left are the pair's count, or the weight and the unigram.
    pair = F.col("after")[F.col("context")]
    worth = F.when(F.col("context") == 0, one).otherwise(F.coalesce(F.log10(pair.cast("double")), one + float(np.log10(weight))))
    backed = (
        _backed_off(answers)
        .join(counts, "word", "left")
        .join(_after_frequent(answers), F.col("word") == F.col("follower"), "left")
        .groupBy("row")
        .agg(F.sum(worth * F.col("times")).alias("back"))
    )
    # Repeated rows have sent their events each, and are one row of the result.
    summed = _sums(answers).groupBy("row").agg(
        F.first("n_tokens").alias("n_tokens"),
        F.avg("known").alias("known"),
        F.avg("base").alias("base"),
        F.sum("model").alias("model"),
        F.count("*").alias("copies"),
    )
    own = rows.groupBy("row").agg(F.min("doc_id").alias("doc_id"), F.first("train").alias("train"))
    model = (F.col("model") + F.coalesce("back", F.lit(0.0))) / F.col("copies")
    return (
        own.join(summed, "row")
        .join(backed, "row", "left")
        .select(
            "doc_id",
            "train",
            "n_tokens",
            (F.round("known") + int(texts > 0)).cast("long").alias("n_known"),
            F.lit(int(train_tokens)).alias("train_tokens"),
            (F.col("base") + float(np.log10(texts + 1)) - F.col("n_tokens") * size).alias("base_score"),
            model.alias("score"),
        )
    )
