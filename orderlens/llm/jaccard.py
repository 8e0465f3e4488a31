"""N-gram Jaccard join by vertical partitioning.

Texts are sets of word n-grams, held as 64-bit hashes (two different n-grams of a pair are taken for one with
a chance of their number squared over 2**65). Texts with equal sets form a class, whose members need no
comparison; the join runs over classes. The steps, all exact:

1. Two sets with Jaccard similarity of at least t share ``common(n)`` of the first ``prefix(n)`` n-grams in the
   order of their hashes, n being either size. These prefixes are cut into fragments of the order. Each
   fragment counts, for every class, the n-grams that another class has too; the counts are summed. Classes
   with fewer than ``common(n)`` can have no partner.
2. For the rest, n-grams are counted and each set ordered by rarity; partners share one of the first
   n - need(n) + 1. Which pairs share one is looked up in rounds. A round pairs the classes of an n-gram with
   one of them, verifies, and joins what is linked into components. The last round pairs all classes of an
   n-gram that are still in different components. So no link between components is lost, and a large group
   of near copies isn't expanded into all its pairs.
3. Pairs are verified by vertical partitioning: the order is cut into fragments, each counts the common
   n-grams of the pairs, and the counts are summed per pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.graph import components
from orderlens.llm.text import hand_back, map_text, mix, release, row_hash, small_batches, without, word_hashes
from orderlens.operators.storage import store

#: N-grams that one fragment, and one block of pairs, should hold.
FRAGMENT = 500_000
#: Ids up to this number are broadcast (8 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 4_000_000
#: Fragments of the order that the verification of pairs is cut into: by the two highest bits.
VERTICAL = 4


def ngram_sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    """Sorted different hashes of each text's word n-grams; with fewer words, of the whole sequence."""
    words, counts = word_hashes(texts)
    total = np.zeros(len(words), dtype=np.uint64)
    for k in range(n):
        shifted = np.zeros(len(words), dtype=np.uint64)
        shifted[: max(len(words) - k, 0)] = words[k:]
        total = mix(total * np.uint64(0x2545F4914F6CDD1D) + shifted)
    out, at = [], 0
    for c in counts.tolist():
        if c >= n:
            out.append(np.unique(total[at : at + c - n + 1]))
        elif c:
            whole = blake2b(words[at : at + c].tobytes(), digest_size=8).digest()
            out.append(np.frombuffer(whole, dtype=np.uint64))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
        at += c
    return out


def class_id(ngrams: np.ndarray) -> int:
    return int.from_bytes(blake2b(ngrams.tobytes(), digest_size=8).digest(), "little", signed=True)


class Bounds:
    """What similarity of at least ``percent`` in a hundred asks of a set of n."""

    def __init__(self, percent: int):
        self.percent = percent

    def need(self, n: int) -> int:
        """Least number of common n-grams with any partner."""
        return -(-self.percent * n // 100)

    def common(self, n: int) -> int:
        """Common n-grams asked for within the prefixes. Grows no faster than ``need``, so that of two
        partners the longer one's demand is met in the shorter one's prefix as well."""
        return max(1, self.need(n) // 4)

    def prefix(self, n: int) -> int:
        return n - self.need(n) + self.common(n)

    def need_column(self, n: Column) -> Column:
        return F.ceil(n * self.percent / F.lit(100)).cast("long")

    def linked(self, inter: Column, a: Column, b: Column) -> Column:
        return 100 * inter >= self.percent * (a + b - inter)

    def lengths(self, a: Column, b: Column) -> Column:
        return 100 * F.least(a, b) >= self.percent * F.greatest(a, b)


def classes(docs: DataFrame, n: int) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_shingles`` and class (null for the empty set) of every row, without texts."""

    def measure(batch: pa.RecordBatch) -> pa.Table:
        sets = ngram_sets(batch.column("text").to_pylist(), n)
        return pa.table(
            {
                "doc_id": batch.column("doc_id"),
                "text_hash": batch.column("text_hash"),
                "n_shingles": pa.array(map(len, sets), pa.int64()),
                "class": pa.array([class_id(s) if len(s) else None for s in sets], pa.int64()),
            }
        )

    rows = docs.select("doc_id", row_hash(F.col("text")).alias("text_hash"), "text")
    kind = dict(rows.dtypes)["doc_id"]
    return map_text(rows, measure, f"doc_id {kind}, text_hash long, n_shingles long, class long")


def addressed(owners: np.ndarray, ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """The owners that occur in a message: their numbers in the stretch, their classes, and who of them owns each n-gram.

    ``owners`` at or above the number of ``ids`` are nobody.
    """
    names, places = np.unique(owners, return_inverse=True)
    names = names[names < len(ids)]
    kind = np.uint16 if len(names) < 1 << 16 else np.uint32
    return names.astype(np.uint32).tobytes(), ids[names].tobytes(), places.astype(kind).tobytes()


def placed_owners(blob: bytes, n: int, owners: int) -> np.ndarray:
    """Place of the owner of each of ``n`` n-grams among a message's classes; -1 for nobody."""
    places = np.frombuffer(blob, dtype=f"<u{len(blob) // n}").astype(np.int64)
    return np.where(places >= owners, -1, places)


def possible_classes(docs: DataFrame, n: int, bounds: Bounds, ngrams: int) -> DataFrame:
    """``class`` of the sets that share enough of their prefix with other classes (step 1).

    Within a stretch of a partition each n-gram is sent once: if several classes there have it, it is known
    to be shared and counted at once. So a frequent n-gram comes to its fragment once per stretch. A message names the
    classes that own its n-grams and no others, and the answer those with shared n-grams, so the bytes of an n-gram
    do not depend on the number of fragments.
    """
    fragments = max(16, -(-ngrams // FRAGMENT))
    step = -(-(1 << 64) // fragments)
    edges = np.array([i * step for i in range(1, fragments)], dtype=np.uint64)
    small_batches(docs.sparkSession)

    def send(ids: list[int], prefixes: list[np.ndarray], stretch: int) -> pa.RecordBatch:
        grams = np.concatenate(prefixes)
        owners = np.repeat(np.arange(len(ids), dtype=np.uint32), [len(p) for p in prefixes])
        order = np.argsort(grams)
        grams, owners = grams[order], owners[order]
        first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
        times = np.diff(np.append(first, len(grams)))
        here = np.bincount(owners[np.repeat(times > 1, times)], minlength=len(ids))
        # Of n-grams known to be shared the owners need no answer.
        grams, owners = grams[first], np.where(times > 1, len(ids), owners[first])
        cut = [0, *np.searchsorted(grams, edges).tolist(), len(grams)]
        every = np.array(ids, dtype=np.int64)
        rows = [(-1 - stretch % fragments, every.tobytes(), here.astype(np.uint32).tobytes(), b"", b"")]
        for k, (x, y) in enumerate(zip(cut, cut[1:])):
            if y > x:
                names, classes_, places = addressed(owners[x:y], every)
                rows.append((k, classes_, names, grams[x:y].tobytes(), places))
        slot, *blobs = zip(*rows)
        arrays = [pa.array(slot, pa.int32()), pa.array([stretch] * len(rows), pa.int64())]
        return pa.RecordBatch.from_arrays(
            arrays + [pa.array(blob, pa.binary()) for blob in blobs],
            names=["slot", "stretch", "classes", "names", "grams", "owners"],
        )

    def cut_prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        part, number = TaskContext.get().partitionId(), 0
        ids, prefixes, held, size = [], [], set(), 0
        for batch in batches:
            for s in ngram_sets(batch.column("text").to_pylist(), n):
                c = class_id(s)
                if len(s) and c not in held:
                    held.add(c)
                    ids.append(c)
                    prefixes.append(s[: bounds.prefix(len(s))])
                    size += len(prefixes[-1])
            if size > FRAGMENT:
                yield send(ids, prefixes, (part << 32) + number)
                number += 1
                ids, prefixes, held, size = [], [], set(), 0
        if ids:
            yield send(ids, prefixes, (part << 32) + number)
        hand_back()

    def count(table: pa.Table) -> pa.Table:
        """Per stretch, for its classes the n-grams of this fragment that others have too, if there are any."""
        rows = table.select(["slot", "stretch", "classes", "names", "grams", "owners"]).to_pylist()
        if rows[0]["slot"] < 0:  # counted by the senders
            answers = [(r["stretch"], r["classes"], b"", r["names"]) for r in rows]
        else:
            ids = [np.frombuffer(r["classes"], dtype=np.int64) for r in rows]
            classes_, starts = np.concatenate(ids), np.cumsum([0, *map(len, ids)])
            sent = [np.frombuffer(r["grams"], dtype=np.uint64) for r in rows]
            own = [placed_owners(r["owners"], len(g), len(i)) for r, g, i in zip(rows, sent, ids)]
            grams, owners = np.concatenate(sent), np.concatenate([np.where(o < 0, -1, o + a) for o, a in zip(own, starts)])
            order = np.argsort(grams)
            grams, owners = grams[order], owners[order]
            first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
            times = np.diff(np.append(first, len(grams)))
            # Held by two classes, or by several in one stretch (then without an owner).
            of = np.append(classes_, 0)[owners]
            shared = np.minimum.reduceat(owners, first) < 0
            shared |= np.minimum.reduceat(of, first) != np.maximum.reduceat(of, first)
            asking = owners[np.repeat(shared, times) & (owners >= 0)]
            n = np.bincount(asking, minlength=len(classes_)).astype(np.uint32)
            answers = []
            for r, a, b in zip(rows, starts, starts[1:]):
                some = np.flatnonzero(n[a:b])
                if len(some):
                    names = np.frombuffer(r["names"], dtype=np.uint32)[some]
                    answers.append((r["stretch"], None, names.tobytes(), n[a:b][some].tobytes()))
        columns = dict(zip(["stretch", "classes", "names", "counts"], zip(*answers))) if answers else {}
        schema = pa.schema({"stretch": pa.int64(), "classes": pa.binary(), "names": pa.binary(), "counts": pa.binary()})
        return pa.table({f.name: columns.get(f.name, []) for f in schema}, schema=schema)

    def add(table: pa.Table) -> pa.Table:
        """Sums over the fragments; a row per class of the stretch."""
        rows = table.select(["classes", "names", "counts"]).to_pylist()
        (own,) = [r for r in rows if r["classes"] is not None]
        total = np.frombuffer(own["counts"], dtype=np.uint32).astype(np.int64)
        for r in rows:
            if r["classes"] is None:
                total[np.frombuffer(r["names"], dtype=np.uint32)] += np.frombuffer(r["counts"], dtype=np.uint32)
        return pa.table({"class": pa.array(np.frombuffer(own["classes"], dtype=np.int64)), "shared": pa.array(total)})

    schema = "slot int, stretch long, classes binary, names binary, grams binary, owners binary"
    return (
        docs.select("text")
        .mapInArrow(cut_prefixes, schema)
        .groupBy("slot")
        .applyInArrow(count, "stretch long, classes binary, names binary, counts binary")
        .groupBy("stretch")
        .applyInArrow(add, "class long, shared long")
        # A class with copies is sent from several stretches; each gives the whole count.
        .groupBy("class")
        .agg(F.max("shared").alias("shared"))
    )


def sets_of(docs: DataFrame, members: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """``class``, ``n`` and ``grams`` (array) of the classes in ``wanted``, from one text of each."""
    first = members.join(wanted, "class", "left_semi").groupBy("class").agg(F.min("doc_id").alias("id"))
    ids = first.select("id").distinct()
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)

    def collect(batch: pa.RecordBatch) -> pa.Table:
        sets = ngram_sets(batch.column("text").to_pylist(), n)
        return pa.table(
            {
                "class": pa.array([class_id(s) for s in sets], pa.int64()),
                "n": pa.array(map(len, sets), pa.int64()),
                "grams": pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
            }
        )

    texts = docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    return (
        map_text(texts.select("text"), collect, "class long, n long, grams array<long>")
        .join(wanted, "class", "left_semi")  # other texts of one id, or of null ids
        .dropDuplicates(["class"])
    )


def postings(sets: DataFrame, bounds: Bounds) -> DataFrame:
    """``gram``, ``class``, ``n``, ``place`` and ``weight`` of every set's prefix in the order of rarity.

    N-grams of one class alone come first and can be left out, but they count for the prefix's length and
    for ``place``. ``weight`` is how common the class's n-grams are on average: highest for the middle of a
    group.
    """
    grams = sets.select("class", "n", F.explode("grams").alias("gram"))
    shared = grams.groupBy("gram").agg(F.count("*").alias("df")).filter("df > 1")
    own = (
        grams.join(shared, "gram")
        .groupBy("class", "n")
        .agg(F.collect_list(F.struct("df", "gram")).alias("own"))
        .filter(F.size("own") >= bounds.need_column(F.col("n")))
    )

    def order(batch: pa.RecordBatch) -> pa.Table:
        n, lists = batch.column("n").to_numpy(), batch.column("own")
        flat = lists.flatten()
        df, gram = flat.field("df").to_numpy(), flat.field("gram").to_numpy()
        sizes = np.diff(lists.offsets.to_numpy())
        row = np.repeat(np.arange(len(n)), sizes)
        weight = np.bincount(row, df, len(n)) / n
        by = np.lexsort((gram, df, row))
        rank = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        place = np.repeat(n - sizes, sizes) + rank
        left = n - np.array([bounds.need(x) for x in n.tolist()], dtype=np.int64) + 1
        kept = place < left[row]
        columns = {
            "gram": gram[by][kept],
            "class": batch.column("class").to_numpy()[row[kept]],
            "n": n[row[kept]],
            "place": place[kept],
        }
        return pa.table({k: pa.array(v, pa.int64()) for k, v in columns.items()} | {"weight": pa.array(weight[row[kept]])})

    return map_text(own, order, "gram long, class long, n long, place long, weight double")


def verified(pairs: DataFrame, sets: DataFrame, bounds: Bounds) -> DataFrame:
    """The pairs (a, b, na, nb) that are similar: fragments count common n-grams, counts are summed.

    Pairs are dealt out by ``b``, so each set is sent once as a ``b``, and as an ``a`` to every block of
    its partners. A block takes some thousand sets.
    """
    pairs = store(pairs, "pairs")
    partners, mean = pairs.select("b").distinct().count(), sets.agg(F.avg("n")).first()[0] or 0
    blocks = max(1, int(2 * partners * mean / (VERTICAL * FRAGMENT)) + 1)
    pairs = pairs.withColumn("block", F.pmod(F.xxhash64("b"), F.lit(blocks)))
    place = F.col("block").alias("place")
    needed = pairs.select(place, F.col("a").alias("class")).unionByName(pairs.select(place, F.col("b").alias("class")))

    def fragment(k: int) -> Column:
        """The n-grams in the k-th quarter of the order of hashes."""
        return F.filter("grams", lambda g: F.shiftrightunsigned(g, 62) == k)

    slices = (
        needed.distinct()
        .join(sets.select("class", "grams"), "class")
        .select("place", "class", F.posexplode(F.array(*map(fragment, range(VERTICAL)))).alias("part", "grams"))
    )
    asked = pairs.select("block", F.explode(F.array(*map(F.lit, range(VERTICAL)))).alias("fragment"), "a", "b")

    def overlaps(wanted: pa.Table, have: pa.Table) -> pa.Table:
        own = dict(zip(have.column("class").to_pylist(), (s.values.to_numpy() for s in have.column("grams"))))
        a, b = wanted.column("a").to_pylist(), wanted.column("b").to_pylist()
        n = [len(np.intersect1d(own[x], own[y], assume_unique=True)) for x, y in zip(a, b)]
        return pa.table({"a": wanted.column("a"), "b": wanted.column("b"), "common": pa.array(n, pa.int64())})

    counts = (
        asked.groupBy("block", "fragment")
        .cogroup(slices.groupBy("place", "part"))
        .applyInArrow(overlaps, "a long, b long, common long")
        .groupBy("a", "b")
        .agg(F.sum("common").alias("common"))
    )
    return pairs.join(counts, ["a", "b"]).filter(bounds.linked(F.col("common"), F.col("na"), F.col("nb")))


def _grouped(posted: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Postings with the component of their class (the class itself at first)."""
    if labels is None:
        return posted.withColumn("component", F.col("class"))
    return posted.join(labels, F.col("class") == F.col("node"), "left").select(
        *posted.columns, F.coalesce("component", "class").alias("component")
    )


def _pairs(left: DataFrame, right: DataFrame, bounds: Bounds) -> DataFrame:
    """Different pairs of classes of one n-gram, in different components, whose lengths and places allow a link.

    The first n-gram that partners share has all their other common ones behind it, on both sides, so a
    pair that is refused at each of its n-grams is no link.
    """
    names = ["class", "n", "place", "component"]
    x = left.select("gram", *(F.col(c).alias(f"a_{c}") for c in names))
    y = right.select("gram", *(F.col(c).alias(f"b_{c}") for c in names))
    na, nb = F.col("a_n"), F.col("b_n")
    behind = F.least(na - F.col("a_place"), nb - F.col("b_place"))
    fits = (
        (F.col("a_component") != F.col("b_component"))
        & bounds.lengths(na, nb)
        & ((100 + bounds.percent) * behind >= bounds.percent * (na + nb))
    )
    found = x.join(y, (x["gram"] == y["gram"]) & fits)
    return found.select(
        F.col("a_class").alias("a"), F.col("b_class").alias("b"), na.alias("na"), nb.alias("nb")
    ).distinct()


def link(posted: DataFrame, sets: DataFrame, bounds: Bounds, rounds: int = 2) -> DataFrame | None:
    """``node`` and ``component`` of linked classes (step 2); None if no two are linked."""
    labels, edges = None, None
    for k in range(rounds):
        now = _grouped(posted, labels)
        # The middle of each n-gram's classes first, then others in a changing order.
        order = F.col("weight") if k == 0 else F.xxhash64("class", F.lit(k), "gram").cast("double")
        leads = now.groupBy("gram").agg(
            F.max_by(F.struct("class", "n", "place", "component"), F.struct(order, "class")).alias("lead"),
            F.min("component").alias("low"),
            F.max("component").alias("high"),
        )
        leads = leads.filter("low != high").select("gram", "lead.*")
        found = store(verified(_pairs(leads, now, bounds), sets, bounds).select("a", "b"), "links")
        if not found.take(1):
            break
        edges = found if edges is None else edges.unionByName(found)
        labels = store(components(edges), "labels")
    now = store(_grouped(posted, labels), "postings")
    mixed = now.groupBy("gram").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    now = now.join(mixed.filter("low != high").select("gram"), "gram", "left_semi")
    rest = _pairs(now, now, bounds).filter("a < b")
    found = store(verified(rest, sets, bounds).select("a", "b"), "links")
    if found.take(1):
        edges = found if edges is None else edges.unionByName(found)
        labels = store(components(edges), "labels")
    return labels


def _candidates(docs: DataFrame, n: int, bounds: Bounds) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Class of every row; least id and size of every class; sets of the classes that may have a partner."""
    members = store(classes(docs, n), "classes")
    total = members.agg(F.sum("n_shingles")).first()[0] or 0
    full = members.filter(F.col("class").isNotNull())
    known = full.groupBy("class").agg(F.min("doc_id").alias("least"), F.first("n_shingles").alias("n"))
    asked = F.greatest(F.lit(1), F.floor(bounds.need_column(F.col("n")) / 4))
    shared = possible_classes(docs, n, bounds, int(total * bounds.prefix(100) / 100))
    wanted = store(shared.join(known, "class").filter(F.col("shared") >= asked).select("class"), "wanted")
    return members, known, store(sets_of(docs, full, wanted, n), "sets")


def similar_pairs(docs: DataFrame, n: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Every link between different sets, and who has them: the whole join, without expanding copies.

    First ``a`` < ``b`` (classes), ``na``, ``nb``, ``common``; second ``doc_id``, ``text_hash``, ``n_shingles``, ``class`` of
    every row of ``docs`` (null class: no n-grams, no links). Rows of one class are linked with each other. A group
    of k different near copies has up to k * (k - 1) / 2 pairs; ``similar_groups`` does without them.
    """
    bounds = Bounds(percent)
    members, _, sets = _candidates(docs, n, bounds)
    posted = store(_grouped(postings(sets, bounds), None), "postings")
    found = verified(_pairs(posted, posted, bounds).filter("a < b"), sets, bounds)
    return store(found.select("a", "b", "na", "nb", "common"), "pairs"), members


def similar_groups(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): ``doc_id``, ``text_hash``, ``n_shingles``, ``component_id``
    and ``component``.

    Two rows are linked when 100 * common n-grams >= ``percent`` * n-grams of both; ``component_id`` is the
    least ``doc_id`` that links lead to, ``component`` a number of the group. A text of fewer than n words is one
    n-gram. Null and empty texts have no n-grams and are linked with nothing: their ``component_id`` is their
    own id, their ``component`` null. Rows that share an id are separate rows; a null id stays, and stands for a
    group only if no other id is in it. An empty table gives no rows; extra columns are not read.
    """
    bounds = Bounds(percent)
    members, known, sets = _candidates(docs, n, bounds)
    labels = link(store(postings(sets, bounds), "postings"), sets, bounds)
    if labels is None:
        least = known.select("class", F.col("class").alias("component"), F.col("least").alias("component_id"))
    else:
        placed = known.join(labels, F.col("class") == F.col("node"), "left").select(
            "class", "least", F.coalesce("component", "class").alias("component")
        )
        heads = placed.groupBy("component").agg(F.min("least").alias("component_id"))
        least = placed.join(heads, "component").select("class", "component", "component_id")
    own = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return members.join(least, "class", "left").select(
        "doc_id", "text_hash", "n_shingles", own.alias("component_id"), "component"
    )


def deduplicate(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of linked rows: the one of the least id (null last), then text.

    Rows without n-grams stay. Equal rows of one id are a group, so one of them stays.
    """
    groups = store(similar_groups(docs, n, percent), "groups").filter(F.col("component").isNotNull())
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    first = groups.groupBy("component").agg(F.min(row).alias("first"))
    gone = groups.join(first, "component").filter(row != F.col("first")).select("doc_id", "text_hash")
    kept = without(docs, gone)
    repeated = groups.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).filter("n > 1")
    if repeated.take(1):
        texts = F.coalesce("text", F.lit(""))
        full = F.regexp_count(texts, F.lit(r"[^\x20\x09-\x0D]")) > 0
        kept = kept.filter(full).dropDuplicates(["doc_id", "text"]).unionByName(kept.filter(~full))
    return kept
