"""Document fingerprints by SpotSigs.

A spot is a common word (anchor) and the chain of the next content words after it, content words being all
that are not in the list of anchors. A text's fingerprint is the multiset of its spots, held as the set of 32-bit
hashes of (spot, occurrence), as text: eight hexadecimal digits each, ascending. Two spots of a pair of texts are
taken for one with a chance of 2**-32.

Fingerprints are compared by Jaccard similarity. For a threshold t, sets are partitioned by length, so that sets
that can reach t are in one partition or in neighbouring ones; within these, pairs are found by their rarest
spots, and the exact comparison stops as soon as the spots that are left cannot reach t any more.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from orderlens.llm.text import PUNCTUATION, hand_back, map_text, mix, release, row_hash, small_batches, word_hashes
from orderlens.operators.storage import store

# Common words of four languages, which begin spots.
ANCHORS = """
the of and to a in is that it for was on with as be by are this at
der die und den von zu das sich mit des auf für ist im nicht dem ein eine
le la les et du une est pour par dans avec qui pas sur
el los las que en y se del un por con no su para es al de
""".split()
#: Content words in a chain.
CHAIN = 3
#: One in so many other words begins a spot as well.
EXTRA = 8
#: In texts of at most so many words every word does.
SHORT = 24
#: Bytes of text that a task of the sorted pass should get.
TASK_BYTES = 48 << 20
_STEP = np.uint64(0x2545F4914F6CDD1D)


def spots(texts: list[str | None], anchors: np.ndarray, chain: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different keys (text's number << 32 | hash) of all spots, and the number of spots per text.

    Words are runs of ASCII letters and digits and of characters beyond ASCII, A-Z lowered. Besides the
    anchors, one in ``EXTRA`` of all other words begins spots, chosen by hash, for texts in other languages; it stays
    a content word. In a text of at most ``SHORT`` words every word begins one. A chain at the end of the text may be
    shorter, down to one word, or to none where every word begins a spot, so each text with words has
    spots.
    """
    words, counts = word_hashes(texts, PUNCTUATION)
    owner = np.repeat(np.arange(len(counts)), counts)
    common = np.isin(words, anchors)
    content = np.flatnonzero(~common)
    # Per word, the number of content words up to it: the next one's place among them.
    after = np.cumsum(~common)
    at = np.flatnonzero(common | (words % np.uint64(EXTRA) == 0))
    keys = _chains(words, owner, at, content, after[at], chain)
    spotted = np.bincount((keys >> np.uint64(32)).astype(np.int64), minlength=len(counts)) > 0
    rest = np.flatnonzero(((counts <= SHORT) | ~spotted)[owner])
    if len(rest):
        every = np.arange(len(words))
        keys = np.concatenate([keys, _chains(words, owner, rest, every, rest + 1, chain, alone=True)])
    # The second, third ... occurrence of a spot is a spot of its own.
    keys = np.sort(keys)
    run = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
    times = (np.arange(len(keys)) - np.repeat(run, np.diff(np.append(run, len(keys))))).astype(np.uint64)
    again = times > 0
    keys[again] = (keys[again] >> np.uint64(32) << np.uint64(32)) | (mix((keys[again] & np.uint64(0xFFFFFFFF)) * _STEP + times[again]) >> np.uint64(32))
    keys = np.unique(keys)
    sizes = np.bincount((keys >> np.uint64(32)).astype(np.int64), minlength=len(counts))
    return keys, sizes


def _chains(words, owner, at, followers, first, chain, alone=False) -> np.ndarray:
    """Keys of the spots that begin at the words ``at``; ``first`` is their first follower's place."""
    total = words[at] * _STEP
    found = np.full(len(at), alone)
    for k in range(chain):
        place = first + k
        inside = place < len(followers)
        word = followers[np.minimum(place, max(len(followers) - 1, 0))] if len(followers) else place
        inside &= (owner[np.where(inside, word, 0)] == owner[at]) if len(words) else inside
        found |= inside
        total = mix(total + np.where(inside, words[np.where(inside, word, 0)], np.uint64(k))) * _STEP
    total = mix(total)[found] >> np.uint64(32)
    return (owner[at][found].astype(np.uint64) << np.uint64(32)) | total


def as_text(keys: np.ndarray, sizes: np.ndarray) -> list[str]:
    digits = keys.astype(np.uint32).astype(">u4").tobytes().hex()
    ends = (8 * np.cumsum(sizes)).tolist()
    return [digits[a:b] for a, b in zip([0, *ends], ends)]


def likeness(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Jaccard similarity of the sets of each row, given as keys with the row's number; two empty sets are alike."""
    both = np.intersect1d(a, b, assume_unique=True) >> np.uint64(32)
    common = np.bincount(both.astype(np.int64), minlength=len(na))
    whole = na + nb - common
    return np.where(whole, common / np.maximum(whole, 1), 1.0)


def anchor_hashes(anchors: list[str]) -> np.ndarray:
    return word_hashes([" ".join(anchors)], PUNCTUATION)[0]


def fingerprint(docs: DataFrame, anchors: list[str] = ANCHORS, chain: int = CHAIN) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_spots`` and ``fingerprint`` of every row of ``docs`` (``doc_id``, ``text``).

    Null and empty texts have no spots and the empty fingerprint. Repeated rows are rows each for itself;
    equal texts have equal fingerprints. Other columns are not read; no rows give no rows.
    """
    marks = anchor_hashes(anchors)

    def measure(batch: pa.RecordBatch) -> pa.Table:
        keys, sizes = spots(batch.column("text").to_pylist(), marks, chain)
        return pa.table(
            {
                "doc_id": batch.column("doc_id"),
                "text_hash": batch.column("text_hash"),
                "n_spots": pa.array(sizes, pa.int64()),
                "fingerprint": pa.array(as_text(keys, sizes), pa.string()),
            }
        )

    rows = docs.select("doc_id", row_hash(F.col("text")).alias("text_hash"), "text")
    kind = dict(rows.dtypes)["doc_id"]
    return map_text(rows, measure, f"doc_id {kind}, text_hash long, n_spots long, fingerprint string")


def edited(text: str, follower: str) -> str:
    """``text`` with the last third replaced by the first as many characters of ``follower``."""
    n = len(text) // 3
    return text[: len(text) - n] + follower[:n]


COMPARED = {
    "doc_id": pa.int64(),
    "n_chars": pa.int64(),
    "edited_sha256": pa.string(),
    "n_spots": pa.int64(),
    "n_edited_spots": pa.int64(),
    "fingerprint": pa.string(),
    "edited_fingerprint": pa.string(),
    "near_edited": pa.float64(),
    "near_next": pa.float64(),
}


def compare_with_followers(
    docs: DataFrame, anchors: list[str] = ANCHORS, chain: int = CHAIN, with_text: bool = False, task_bytes: int = TASK_BYTES
) -> DataFrame:
    """Every text against its follower and against itself with the end taken from the follower.

    The follower is the next row by descending ``doc_id`` (null last; rows of one id by a hash of their texts),
    after the last the first. Null texts are empty. Columns: see ``COMPARED``; ``with_text`` adds ``edited_text``. No rows
    give no rows.

    Ranges of this order are found from the ids and hashes alone, so the texts are shuffled once. Each task reads
    its range in order with one row's look ahead; the first row of the next range (one a task) is sent along.
    """
    spark = docs.sparkSession
    small_batches(spark)
    marks = anchor_hashes(anchors)
    columns = COMPARED | ({"edited_text": pa.string()} if with_text else {})
    schema = pa.schema(list(columns.items()))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_hash(F.col("text")).alias("tie"), "text")
    firsts = _first_rows(rows, task_bytes)
    if not firsts:
        return spark.createDataFrame([], from_arrow_schema(schema))
    keys = [_key(i, t) for i, t in firsts]

    def compared(rows: list[tuple[int | None, str]], follower: str) -> pa.RecordBatch:
        texts = [t for _, t in rows]
        changed = [edited(t, f) for t, f in zip(texts, [*texts[1:], follower])]
        own, n_own = spots([*texts, follower], marks, chain)
        other, n_other = spots(changed, marks, chain)
        last = len(own) - int(n_own[-1])
        # The next row's spots under this row's number.
        behind = own[int(n_own[0]) :] - np.uint64(1 << 32)
        values = {
            "doc_id": [i for i, _ in rows],
            "n_chars": list(map(len, texts)),
            "edited_sha256": [sha256(t.encode()).hexdigest() for t in changed],
            "n_spots": n_own[:-1],
            "n_edited_spots": n_other,
            "fingerprint": as_text(own[:last], n_own[:-1]),
            "edited_fingerprint": as_text(other, n_other),
            "near_edited": likeness(own[:last], other, n_own[:-1], n_other),
            "near_next": likeness(own[:last], behind, n_own[:-1], n_own[1:]),
            "edited_text": changed,
        }
        return pa.RecordBatch.from_arrays([pa.array(values[n], k) for n, k in columns.items()], schema=schema)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        held: list[tuple[int | None, str]] = []
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            rows = [*held, *zip(batch.column("doc_id").to_pylist(), texts)]
            if len(rows) > 1:
                yield compared(rows[:-1], rows[-1][1])
            held = rows[-1:]  # in the end the row that was sent along
        hand_back()

    @F.pandas_udf("int")
    def range_of(doc_id: pd.Series, tie: pd.Series) -> pd.Series:
        missing = doc_id.isna()
        return pd.Series([bisect_right(keys, _key(None if m else i, t)) - 1 for i, t, m in zip(doc_id, tie, missing)])

    # Ids go through Python as text: a nullable column of numbers would come as floats.
    part = range_of(F.col("doc_id").cast("string"), "tie")
    follows = [(i, t, k) for k, (i, t) in enumerate([*firsts[1:], firsts[0]])]
    wanted = F.broadcast(spark.createDataFrame(follows, "follower_id long, follower_tie long, part int"))
    same = F.col("doc_id").eqNullSafe(F.col("follower_id")) & (F.col("tie") == F.col("follower_tie"))
    sent = rows.join(wanted, same).dropDuplicates(["part"]).withColumn("last", F.lit(True))
    dealt = rows.withColumn("part", part).withColumn("last", F.lit(False)).unionByName(sent.select("doc_id", "tie", "text", "part", "last"))
    ordered = dealt.repartitionById(len(firsts), F.col("part")).sortWithinPartitions("last", F.desc_nulls_last("doc_id"), "tie")
    return ordered.select("doc_id", "text").mapInArrow(walk, from_arrow_schema(schema))


def _key(doc_id: int | str | None, tie: int) -> tuple[bool, int, int]:
    return doc_id is None, -int(doc_id or 0), tie


def _first_rows(rows: DataFrame, task_bytes: int) -> list[tuple[int | None, int]]:
    """Id and hash of the first row of each range, in order; ranges hold about ``task_bytes`` of text."""
    spark = rows.sparkSession
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // task_bytes))
    place = F.struct(F.col("doc_id").isNull().alias("none"), (-F.col("doc_id")).alias("down"), F.col("tie").alias("tie"))
    ranged = rows.select("doc_id", "tie", place.alias("place")).repartitionByRange(parts, "place")
    least = ranged.groupBy(F.spark_partition_id().alias("part")).agg(F.min("place").alias("place"))
    found = sorted((p["none"], p["down"] or 0, p["tie"]) for p in (r["place"] for r in least.collect()))  # one a range
    return [(None if none else -down, tie) for none, down, tie in found]


def length_part(n: Column, percent: int) -> Column:
    """Partition of a set length: sets of similarity ``percent`` in a hundred are in one or in neighbouring ones."""
    # A ratio a little above 100 / percent, so that rounding never puts two such sets further apart.
    return F.floor(F.log(n) / F.lit(math.log(100 / percent) * (1 + 1e-9))).cast("int")


def similar_pairs(prints: DataFrame, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Pairs of different fingerprints with a similarity of ``percent`` in a hundred or more, and the members.

    ``prints``: ``doc_id``, ``fingerprint``, ``n_spots``. Returns (a, b, similarity) of class numbers, a < b, each
    pair once, and (``doc_id``, ``class``): rows with equal fingerprints are a class, so copies aren't expanded.
    Rows without spots are in no class.
    """
    members = store(
        prints.where("n_spots > 0").select("doc_id", F.xxhash64("fingerprint").alias("class"), "fingerprint", "n_spots"), "prints"
    )
    sets = members.dropDuplicates(["class"]).select("class", F.col("n_spots").alias("n"), "fingerprint")
    sets = store(sets.withColumn("part", length_part(F.col("n"), percent)), "sets")
    spot = F.explode(F.expr("transform(sequence(0, cast(n as int) - 1), k -> substring(fingerprint, 8 * k + 1, 8))")).alias("spot")
    held = sets.select("class", "n", "part", spot)
    counts = held.groupBy("spot").agg(F.count("*").alias("df"))
    ranked = held.join(counts, "spot").groupBy("class", "n", "part").agg(
        F.array_sort(F.collect_list(F.struct("df", "spot"))).alias("ordered")
    )
    # Of the rarest n - need + 1 spots a similar set has at least one; spots of one set alone find nothing.
    need = F.ceil(F.col("n") * percent / F.lit(100)).cast("int")
    prefix = F.expr(f"slice(ordered, 1, cast(n - ceil(n * {percent} / 100) + 1 as int))")
    posted = ranked.select("class", "n", "part", need.alias("need"), F.posexplode(prefix).alias("place", "s"))
    posted = posted.where("s.df > 1").select("class", "n", "part", "place", F.col("s.spot").alias("spot"))
    posted = store(posted, "postings")
    x = posted.select("spot", F.col("class").alias("a"), F.col("n").alias("na"), F.col("place").alias("pa"), F.explode(F.array(F.col("part") - 1, "part", F.col("part") + 1)).alias("part"))
    y = posted.select("spot", F.col("class").alias("b"), F.col("n").alias("nb"), F.col("place").alias("pb"), "part")
    # The first common spot has all the others behind it on both sides.
    behind = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    fits = (F.col("a") < F.col("b")) & ((100 + percent) * behind >= percent * (F.col("na") + F.col("nb")))
    pairs = x.join(y, ["spot", "part"]).where(fits).select("a", "b").distinct()
    texts = sets.select("class", "fingerprint")
    both = pairs.join(texts.select(F.col("class").alias("a"), F.col("fingerprint").alias("fa")), "a").join(
        texts.select(F.col("class").alias("b"), F.col("fingerprint").alias("fb")), "b"
    )

    def verify(batch: pa.RecordBatch) -> pa.Table:
        a, b, out = batch.column("a").to_pylist(), batch.column("b").to_pylist(), []
        for x, y in zip(batch.column("fa").to_pylist(), batch.column("fb").to_pylist()):
            out.append(pruned_similarity(x, y, percent))
        kept = [k for k, s in enumerate(out) if s is not None]
        return pa.table({"a": pa.array([a[k] for k in kept], pa.int64()), "b": pa.array([b[k] for k in kept], pa.int64()), "similarity": pa.array([out[k] for k in kept], pa.float64())})

    return map_text(both, verify, "a long, b long, similarity double"), members.select("doc_id", "class")


def pruned_similarity(a: str, b: str, percent: int, step: int = 256) -> float | None:
    """Jaccard similarity of two fingerprints, or None if it is below ``percent`` in a hundred.

    The sets are compared stretch by stretch of their order; the comparison ends as soon as the spots without
    a partner are too many.
    """
    x, y = (np.frombuffer(bytes.fromhex(s), dtype=">u4") for s in (a, b))
    most = (100 - percent) * (len(x) + len(y)) // (100 + percent)  # spots that may be without a partner
    common = done_x = done_y = 0
    while done_x < len(x) and done_y < len(y):
        edge = min(x[min(done_x + step, len(x)) - 1], y[min(done_y + step, len(y)) - 1])
        to_x, to_y = (int(np.searchsorted(s, edge, side="right")) for s in (x, y))
        common += len(np.intersect1d(x[done_x:to_x], y[done_y:to_y], assume_unique=True))
        done_x, done_y = to_x, to_y
        if done_x + done_y - 2 * common > most:
            return None
    whole = len(x) + len(y) - common
    return common / whole if 100 * common >= percent * whole else None
