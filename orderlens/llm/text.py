"""Helpers shared by the text operators: column expressions and small batch functions."""

from __future__ import annotations

import ctypes
import string
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderlens.operators.storage import store

#: Words of the licence and benchmark operators, after lower-casing A-Z.
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ALNUM_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rows and bytes of text in one Arrow batch at most; a batch should fit in memory many times.
BATCH_ROWS, BATCH_BYTES = "1024", "4m"
#: What a worker keeps from task to task; a task that does not use it gives it up.
KEPT: dict = {}

#: Ids that are broadcast at most.
BROADCAST_ROWS = 4_000_000


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once a row, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else unchanged; null is the empty text."""
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, upper, lower))


def alnum_words(text: Column) -> Column:
    """Array of the words of a text: runs of 0-9, a-z and characters beyond ASCII."""
    # Splitting is several times faster than extracting; at most the first and last part are empty.
    return F.array_remove(F.split(lower_ascii(text), ALNUM_GAP), "")


def row_hash(text: Column) -> Column:
    """Tells rows of one id with different texts apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows (``doc_id``, ``text_hash``) of ``gone``.

    Up to BROADCAST_ROWS ids are broadcast (16 bytes each); more are joined by a shuffle.
    """
    own, other = free_name(docs, "gone_id"), free_name(docs, "gone_hash")
    gone = store(gone.distinct().select(F.col("doc_id").alias(own), F.col("text_hash").alias(other)), "gone")
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    same = F.col("doc_id").eqNullSafe(F.col(own)) & (row_hash(F.col("text")) == F.col(other))
    return docs.join(gone, same, "left_anti")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until ``df`` has no column of that name."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def map_text(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], pa.Table | Iterable[pa.RecordBatch]],
    schema: str | StructType,
    keeps: bool = False,
) -> DataFrame:
    """``mapInArrow`` in batches of few rows; ``function`` gets one batch at a time. ``keeps``: it uses ``KEPT``."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            release()
        for batch in batches:
            if batch.num_rows:
                out = function(batch)
                yield from out.to_batches() if isinstance(out, pa.Table) else out
        hand_back()

    return df.mapInArrow(run, schema)


def release() -> None:
    """Give up what earlier tasks of this worker have kept."""
    if KEPT:
        KEPT.clear()
        hand_back()


def hand_back() -> None:
    """Return unused memory to the system. Workers live on after a task, and share the executor's memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


# 64-bit hashes of words, for a whole batch at once. Odd multipliers have an inverse modulo 2**64, so
# a word's hash is a difference of running sums, shifted back by the inverse power of its start.
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes below 128 other than letters and digits.
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers, one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[str | None], gaps: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (runs without white space, A-Z lowered) and the number of words per text.

    ``gaps`` marks other bytes that separate words; the line feed must be one. Null has no words. Equal words have equal hashes; different ones differ but for a chance of 2**-64.
    """
    data = [(t or "").encode() for t in texts]
    raw = np.frombuffer(b"\n".join(data) + b"\n", dtype=np.uint8)
    lengths = np.fromiter(map(len, data), dtype=np.int64, count=len(data)) + 1
    space = gaps[raw]
    edge = np.flatnonzero(np.diff(space.astype(np.int8), prepend=np.int8(1)))
    begin, end = edge[0::2], edge[1::2]
    if not len(begin):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(data), dtype=np.int64)
    terms = (_LOWER[raw].astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(raw))
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(terms, dtype=np.uint64)])
    hashes = (total[end] - total[begin]) * _powers(_INVERSE, len(raw))[begin]
    counts = np.diff(np.searchsorted(begin, np.concatenate([[0], np.cumsum(lengths)])))
    return mix(hashes), counts
