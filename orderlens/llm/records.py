"""Token ids as length-delimited binary records, with a separate offset index.

A data file is a sequence of frames. A frame is the payload's length (8 bytes), the masked checksum of
these 8 bytes (4), the payload, and the payload's masked checksum (4); all numbers are little-endian. A
payload is the document id (8 bytes), one byte telling whether the id is null (1) or not (0), one byte for
the width of an id (2 or 4), and the ids. The checksum is CRC-32, turned right by 15 bits, plus 0xA282EAD8.

Frames are written in stretches, a batch of documents each, so a task holds one batch and not a file. A stretch closes
with a frame of one byte (1 if the file ends there, else 0) and a line feed. A file has at most STRETCHES
stretches, so its size is bounded by the batches' bytes, whatever the number of documents. Files are numbered;
documents ascend within and from file to file.

The index has one row per record: file, record, doc_id, offset and length of the frame, n_tokens, and
start, the ids before it. A reader that shuffles records takes (offset, length) from there.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.text import map_text, small_batches
from orderlens.llm.tokens import definition, encoder
from orderlens.operators.running import running
from orderlens.operators.storage import new_path, store

#: Stretches of a file at most. A stretch has at most 1,024 documents or some 4 MB of text.
STRETCHES = 32
_MORE, _END = b"\x00", b"\x01"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return head + struct.pack("<I", masked(head)) + payload + struct.pack("<I", masked(payload))


def stretch(framed: list[bytes], last: bool) -> bytes:
    """Frames with their closing one; the writer adds the line feed."""
    return b"".join(framed) + frame(_END if last else _MORE)


def frames(data: bytes) -> Iterator[tuple[int, bytes]]:
    """(offset, payload) of every record's frame in a file; an error if a checksum or the end is wrong."""
    at, ended = 0, False
    while at < len(data):
        if ended:
            raise ValueError(f"data after the end at {at}")
        if at + 12 > len(data):
            raise ValueError(f"the file is cut off at {at}")
        (size, check) = struct.unpack_from("<QI", data, at)
        if masked(data[at : at + 8]) != check:
            raise ValueError(f"wrong checksum of the length at {at}")
        payload = data[at + 12 : at + 12 + size]
        if at + 16 + size > len(data) or masked(payload) != struct.unpack_from("<I", data, at + 12 + size)[0]:
            raise ValueError(f"wrong checksum of the record at {at}")
        after = at + 16 + size
        if size == 1:
            if data[after : after + 1] != b"\n":
                raise ValueError(f"no line feed at {after}")
            ended, at = payload == _END, after + 1
        else:
            yield at, payload
            at = after
    if not ended:
        raise ValueError("the file is cut off")


def pack_record(doc_id: int | None, ids: bytes, width: int) -> bytes:
    """``ids``: unsigned 32-bit numbers; they are stored in ``width`` bytes each."""
    narrow = np.frombuffer(ids, "<u4").astype(f"<u{width}").tobytes()
    return struct.pack("<qBB", doc_id or 0, doc_id is None, width) + narrow


def unpack_record(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, null, width = struct.unpack_from("<qBB", payload)
    return None if null else doc_id, np.frombuffer(payload, f"<u{width}", offset=10).astype("<u4")


def write(
    docs: DataFrame, path: str, tokenizer_path: str, blanks: str, end_id: int, parts: int | None = None
) -> None:
    """Encode every text, append ``end_id``, and write data files to ``path``, by ascending ``doc_id``.

    Null ids come first; rows with one id are ordered by text. Null and empty texts are records of the end
    id alone. Repeated rows are repeated records. ``parts`` (default: the number of shuffle partitions) is the number
    of tasks; each writes as many files as its bytes ask for.
    """
    spark = docs.sparkSession
    small_batches(spark)
    text = definition(tokenizer_path)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(text, blanks).encode
        width = 2 if encoder(text, blanks).tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else 4
        end = struct.pack("<I", end_id)
        waiting, done = None, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if waiting is not None:
                done += 1
                yield _row(stretch(waiting, last=done % STRETCHES == 0))
            ids = encode(batch.column("text").to_pylist())
            waiting = [frame(pack_record(d, i + end, width)) for d, i in zip(batch.column("doc_id").to_pylist(), ids)]
        if waiting is not None:
            yield _row(stretch(waiting, last=True))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sorted_rows = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    # One row per stretch. The text writer writes a string's bytes as they are, and a line feed.
    lines = sorted_rows.mapInArrow(pack, "data binary").select(F.col("data").cast("string").alias("value"))
    lines.write.option("maxRecordsPerFile", STRETCHES).text(path)


def _row(data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"data": pa.array([data], pa.large_binary())})


def file_number(name: str) -> int:
    """Number of a data file: its task's, then its place among the task's files."""
    part, place = re.search(r"/part-(\d+)-[^/]*-c(\d+)[^/]*$", name).groups()
    return int(part) << 24 | int(place)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Read data files back: file, record, doc_id, n_tokens, ids_crc32, offset, length, tokens_before (in the file)."""

    def parse(batch: pa.RecordBatch) -> pa.Table:
        rows = []
        for name, data in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
            before, number = 0, file_number(name)
            for k, (offset, payload) in enumerate(frames(data)):
                doc_id, ids = unpack_record(payload)
                rows.append((number, k, doc_id, len(ids), zlib.crc32(ids.tobytes()), offset, len(payload) + 16, before))
                before += len(ids)
        columns = list(zip(*rows)) or [[]] * 8
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})

    names = ["file", "record", "doc_id", "n_tokens", "ids_crc32", "offset", "length", "tokens_before"]
    # A row is a whole file here; its size is bounded.
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return map_text(raw, parse, ", ".join(f"{n} long" for n in names))


def index(records: DataFrame) -> DataFrame:
    """The offset index: ``start`` counts the ids before a record over all files."""
    totals = records.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    starts = running(totals, [], ["file"], sums={"until": "n"})
    starts = starts.select("file", (F.col("until") - F.col("n")).alias("file_start"))
    return records.join(starts, "file").select(
        "file",
        "record",
        "doc_id",
        "offset",
        "length",
        (F.col("file_start") + F.col("tokens_before")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )


def save(docs: DataFrame, tokenizer_path: str, blanks: str, end_id: int, path: str | None = None) -> tuple[str, DataFrame]:
    """Write data files and, in a folder beside them, the index; the data's path and the stored index.

    An empty table gives no records and an empty index.
    """
    path = path or new_path(docs.sparkSession, "records")
    write(docs, path, tokenizer_path, blanks, end_id)
    stored = store(read(docs.sparkSession, path), "read")
    index(stored).write.parquet(f"{path}-index")
    return path, docs.sparkSession.read.parquet(f"{path}-index")
