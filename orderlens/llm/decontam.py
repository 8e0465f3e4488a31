"""Benchmark decontamination: prefix-filtered set join of item windows with documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.text import alnum_words, let, row_hash
from orderlens.operators.storage import store

#: Windows of the benchmark that one pass over the documents looks for.
WINDOWS_PER_PASS = 50_000


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """``words`` and sorted ``items`` of every different window of ``window`` consecutive item words.

    An item of fewer words is one window; an item without words has none.
    """

    def cut(words: Column) -> Column:
        last = F.greatest(F.size(words) - window, F.lit(0))
        windows = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(words, i + 1, window))
        return F.when(F.size(words) > 0, windows)

    return (
        items.select(
            F.col("item_id").cast("string").alias("item"), F.explode(let(alnum_words(F.col("text")), cut)).alias("words")
        )
        .groupBy("words")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )


def rarest_words(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """``windows`` with its necessary prefix: the word that fewest documents hold, and its ``place``.

    A window is contained as a whole or not at all, so its prefix in the order by rarity is one word.
    """
    vocabulary = windows.select(F.explode("words").alias("word")).distinct()
    counts = (
        docs.select(F.explode(F.array_distinct(alnum_words(F.col("text")))).alias("word"))
        # At most WINDOWS_PER_PASS windows at a time, so the vocabulary is bounded too.
        .join(F.broadcast(vocabulary), "word", "left_semi")
        .groupBy("word")
        .agg(F.count("*").alias("n"))
    )
    placed = windows.select("words", "items", F.posexplode("words").alias("place", "word"))
    rank = F.struct(F.coalesce("n", F.lit(0)), "word", "place")
    return (
        placed.join(counts, "word", "left")
        .groupBy("words")
        .agg(F.min(rank).alias("first"), F.first("items").alias("items"))
        .select("words", "items", F.col("first.word").alias("word"), F.col("first.place").alias("place"))
    )


def _matches(docs: DataFrame, heads: DataFrame, window: int) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``text_hash``, ``n_words`` and ``hits`` (start, length, items)."""
    by_word = heads.groupBy("word").agg(
        F.collect_list(F.struct("place", "words", "items")).alias("windows")
    )
    words = [r["word"] for r in by_word.select("word").collect()]  # at most WINDOWS_PER_PASS

    def candidates(w: Column) -> Column:
        n = F.size(w)
        inside = F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.get(w, i).isin(words))
        around = F.transform(
            F.when(n > 0, inside),
            lambda i: F.struct(
                i.alias("at"),
                F.get(w, i).alias("word"),
                F.least(i, F.lit(window - 1)).alias("before"),
                F.slice(w, F.greatest(i - (window - 1), F.lit(0)) + 1, 2 * window - 1).alias("around"),
            ),
        )
        return F.struct(n.cast("long").alias("n_words"), around.alias("c"))

    rows = docs.select(
        "doc_id", row_hash(F.col("text")).alias("text_hash"), let(alnum_words(F.col("text")), candidates).alias("d")
    ).select("doc_id", "text_hash", "d.n_words", F.explode_outer("d.c").alias("c"))
    joined = rows.select("doc_id", "text_hash", "n_words", "c", F.col("c.word").alias("word")).join(
        F.broadcast(by_word), "word", "left"
    )
    c = F.col("c")

    # Position bounds: the window's words before and after the shared one must lie in the document.
    def holds(x: Column) -> Column:
        fits = (c["before"] >= x["place"]) & (
            F.size(c["around"]) - c["before"] >= F.size(x["words"]) - x["place"]
        )
        return fits & (F.slice(c["around"], c["before"] - x["place"] + 1, F.size(x["words"])) == x["words"])

    # slice() starts at 1; a window that doesn't fit is refused before its words are compared.
    safe = F.filter(F.col("windows"), lambda x: F.when(c["before"] >= x["place"], holds(x)).otherwise(False))
    hits = F.transform(
        safe,
        lambda x: F.struct(
            (c["at"] - x["place"]).alias("start"), F.size(x["words"]).alias("length"), x["items"].alias("items")
        ),
    )
    return joined.select("doc_id", "text_hash", "n_words", hits.alias("hits"))


def scan(docs: DataFrame, items: DataFrame, window: int = 10, per_pass: int = WINDOWS_PER_PASS) -> DataFrame:
    """One row per different (``doc_id``, ``text``): its words inside occurrences of item windows.

    Columns ``doc_id``, ``text_hash``, ``n_words``, ``n_hit`` (words inside any occurrence), ``spans``
    (merged word spans, end exclusive), ``items`` (sorted ids of the items found), ``contaminated``.

    Null texts have no words, are in no window and hold none. Repeated rows count once; rows with one id
    and different texts are separate rows. Items that share a window are all reported. With more than
    ``per_pass`` different windows the benchmark is searched in blocks, one pass over ``docs`` each, so
    what is broadcast is bounded. An empty benchmark or empty ``docs`` gives no hits or no rows. Only the
    named columns are read, so extra columns may have any name.
    """
    docs = docs.select("doc_id", "text")
    windows = store(item_windows(items.select("item_id", "text"), window), "windows")
    passes = max(1, -(-windows.count() // per_pass))
    found = None
    for k in range(passes):
        block = windows
        if passes > 1:
            # By the words, so that every pass has about the same number of windows.
            block = windows.filter(F.pmod(F.xxhash64("words"), F.lit(passes)) == k)
        heads = store(rarest_words(docs, block), "heads")
        part = _matches(docs, heads, window)
        found = part if found is None else found.unionByName(part)
    hit = F.array_sort(
        F.transform(F.flatten(F.collect_set("hits")), lambda x: F.struct(x["start"], x["length"]))
    )
    grouped = found.groupBy("doc_id", "text_hash").agg(
        F.max("n_words").alias("n_words"),
        hit.alias("hits"),
        F.array_sort(
            F.array_distinct(F.flatten(F.transform(F.flatten(F.collect_set("hits")), lambda x: x["items"])))
        ).alias("items"),
    )
    return grouped.select(
        "doc_id", "text_hash", "n_words", _merged(F.col("hits")).alias("spans"), "items"
    ).select(
        "doc_id",
        "text_hash",
        "n_words",
        F.aggregate("spans", F.lit(0), lambda a, s: a + s["end"] - s["start"]).cast("long").alias("n_hit"),
        "spans",
        "items",
        (F.size("spans") > 0).alias("contaminated"),
    )


def _merged(hits: Column) -> Column:
    """Union of (start, length) intervals that are sorted by start."""
    none = F.array().cast("array<struct<start:int,end:int>>")

    def add(spans: Column, hit: Column) -> Column:
        end = hit["start"] + hit["length"]
        last = F.element_at(spans, F.size(spans))
        grown = F.concat(
            F.slice(spans, 1, F.size(spans) - 1),
            F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], end).alias("end"))),
        )
        fresh = F.concat(spans, F.array(F.struct(hit["start"].alias("start"), end.alias("end"))))
        joins = F.when(F.size(spans) > 0, hit["start"] <= last["end"]).otherwise(False)
        return F.when(joins, grown).otherwise(fresh)

    return F.aggregate(hits, none, add)
