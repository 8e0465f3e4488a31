"""Packing: shortest-pack-first over the length histogram, patterns joined back by rank."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderlens.llm.text import map_text
from orderlens.llm.tokens import REMEMBERED, definition, encoder
from orderlens.operators.storage import store


def pieces(
    docs: DataFrame, tokenizer_path: str, blanks: str, end_id: int, size: int, with_ids: bool = False, remembered: int = REMEMBERED
) -> DataFrame:
    """Token ids of each text and an end id, cut into pieces of ``size`` and a rest.

    ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens`` and, if asked for, ``ids`` (unsigned
    32-bit little-endian numbers).
    """
    text = definition(tokenizer_path)
    end = struct.pack("<I", end_id)
    names = ["start", "length", "ids_crc32", "doc_tokens"]

    def cut(batch: pa.RecordBatch) -> pa.Table:
        encode = encoder(text, blanks, remembered).encode
        doc_ids, rows = [], []
        for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text").to_pylist())):
            ids += end
            for at in range(0, len(ids), 4 * size):
                part = ids[at : at + 4 * size]
                doc_ids.append(doc_id)
                rows.append((at // 4, len(part) // 4, zlib.crc32(part), len(ids) // 4, part))
        columns = dict(zip([*names, "ids"], zip(*rows)))
        out = {"doc_id": pa.array(doc_ids, pa.int64())} | {n: pa.array(columns[n], pa.int64()) for n in names}
        return pa.table(out | ({"ids": pa.array(columns["ids"], pa.binary())} if with_ids else {}))

    schema = "doc_id long, " + ", ".join(f"{n} long" for n in names) + ", ids binary" * with_ids
    return map_text(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), cut, schema, keeps=True)


def patterns(histogram: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Packing patterns (lengths, longest first) and how many sequences follow each.

    Lengths are placed longest first, all pieces of a length at once: into the open patterns with the most
    room, that is the shortest packs, as many as there are, else into new ones. Each step ends a length or
    a pattern, so the work depends on the number of different lengths (at most ``size``) alone.
    """
    room: dict[int, dict[tuple[int, ...], int]] = {}
    for length in range(size, 0, -1):
        left = histogram.get(length, 0)
        while left:
            free = max((r for r in room if r >= length), default=None)
            if free is None:
                room.setdefault(size - length, {})[(length,)] = left
                break
            pattern, count = room[free].popitem()
            used = min(left, count)
            if count > used:
                room[free][pattern] = count - used
            elif not room[free]:
                del room[free]
            grown = room.setdefault(free - length, {})
            grown[(*pattern, length)] = grown.get((*pattern, length), 0) + used
            left -= used
    return [(p, n) for r in sorted(room) for p, n in sorted(room[r].items(), reverse=True)]


def slots(found: Iterable[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset): the pieces of a length whose ranks lie in a
    span go to consecutive sequences, at one offset. Every rank of a length lies in one span."""
    ranks: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, count in found:
        offset = 0
        for length in pattern:
            rank = ranks.get(length, 0)
            rows.append((length, rank, rank + count, sequence, offset))
            ranks[length] = rank + count
            offset += length
        sequence += count
    return rows


def ranked(rows: DataFrame, buckets: int) -> DataFrame:
    """``rank`` of each row among those of its ``length``, from 0.

    A length may have a third of all rows (copies), so rows are numbered within (length, bucket) and the
    buckets of a length are lined up afterwards. ``rows`` must be stored: they are read twice.
    """
    keys = ["doc_id", "start", "ids_crc32", "doc_tokens"]
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)))
    counts = rows.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    line = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "bucket", F.coalesce(F.sum("n").over(line), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "bucket").orderBy(*keys)
    return (
        rows.withColumn("number", F.row_number().over(inside) - 1)
        .join(first, ["length", "bucket"])
        .withColumn("rank", F.col("first") + F.col("number"))
        .drop("bucket", "number", "first")
    )


def pack(rows: DataFrame, size: int = 2048) -> DataFrame:
    """``rows`` (stored pieces) with ``sequence_id`` and ``offset``.

    The histogram (at most ``size`` rows) is all that reaches the driver; the spans, a few per length, are
    broadcast. Ties within a length are ordered by document, start and checksum; rows equal in all of these
    are the same, so it does not matter which is which. No rows give no sequences.
    """
    spark: SparkSession = rows.sparkSession
    histogram = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    spans = spark.createDataFrame(
        slots(patterns(histogram, size)), "span_length long, low long, high long, first_sequence long, offset long"
    )
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (
        ranked(rows, buckets)
        .join(
            F.broadcast(spans),
            (F.col("length") == F.col("span_length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")),
        )
        .withColumn("sequence_id", F.col("first_sequence") + F.col("rank") - F.col("low"))
        .drop("rank", "span_length", "low", "high", "first_sequence")
    )


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    blanks: str = "dropped",
    end_id: int = 1,
    size: int = 2048,
    with_ids: bool = False,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """Every piece of every document of ``docs`` (``doc_id``, ``text``) with its place in a sequence.

    Null and empty texts are the end id alone. Repeated rows are packed each for itself. ``remembered``: words whose
    ids a worker keeps; it changes time and memory only.
    """
    return pack(store(pieces(docs, tokenizer_path, blanks, end_id, size, with_ids, remembered), "pieces"), size)


def sequences(packed: DataFrame, size: int = 2048, pad_id: int = 0) -> DataFrame:
    """``sequence_id``, ``n_tokens`` and ``ids`` of each sequence of pieces that carry ``ids``.

    Filled up with ``pad_id`` to ``size``, unless its tokens are a power of two in number.
    """
    parts = F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p))
    n = F.col("n_tokens")
    rows = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("raw"))
    whole = n.bitwiseAND(n - 1) == 0
    pad = F.unhex(F.repeat(F.lit(struct.pack("<I", pad_id).hex()), (size - n).cast("int")))
    return rows.select("sequence_id", "n_tokens", F.when(whole, F.col("raw")).otherwise(F.concat("raw", pad)).alias("ids"))
