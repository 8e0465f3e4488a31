"""Reply trees: root-to-leaf paths by iterative self-joins, ranked, each formatted as one conversation."""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderlens.llm.text import map_text, small_batches
from orderlens.operators.storage import store

#: Marks of a turn. Every control string starts with "<|".
START, STOP = "<|im_start|>", "<|im_end|>"
_OPEN, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)


def escape(text: str) -> str:
    """No "<|" is left: it gets a backslash, and so does each that has some already."""
    return _OPEN.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(turns: list[tuple[str | None, str | None]], learn: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The conversation and the spans (code points, end exclusive) of the texts that are learnt."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape_role(role or '')}\n", escape(text or "")
        if role == learn:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, f"{STOP}\n"]
        at += len(head) + len(body) + len(STOP) + 1
    return "".join(parts), spans


def parse(conversation: str) -> list[tuple[str, str]]:
    """Roles and texts of a rendered conversation."""
    turns, at = [], 0
    for m in _TURN.finditer(conversation):
        if m.start() != at:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape_role(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(conversation):
        raise ValueError(f"no turn at {at}")
    return turns


def linked_turns(rows: DataFrame) -> DataFrame:
    """Messages of linear conversations (``conv_id``, ``turn``, ``role``, ``text``) as replies to the one before.

    Columns ``tree``, ``node``, ``parent``, ``role``, ``text``, ``score`` (0). The order is by turn; ties by role
    and text, and equal rows in any order, which makes no difference. A null ``conv_id`` is one conversation.
    Rows are numbered after a sort by range, so a conversation may be spread over many tasks.
    """
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    small_batches(rows.sparkSession)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k, last = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            node, parent = [], []
            for conv in batch.column("conv_id").to_pylist():
                node.append((part << 40) + k)
                parent.append(node[-1] - 1 if k and conv == last else None)
                k, last = k + 1, conv
            columns = {"part": [part] * len(node), "node": node, "parent": parent}
            arrays = [*batch.columns, *(pa.array(v, pa.int64()) for v in columns.values())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, *columns])

    order = ["conv_id", "turn", "role", "text"]
    kinds = dict(rows.dtypes)
    schema = "".join(f"{c} {kinds[c]}, " for c in order) + "part long, node long, parent long"
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Stored, as numbers given to rows must not change when a task is run again.
    sorted_rows = store(
        rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(number, schema), "turns"
    )
    # A conversation that goes on in the next part: one row per part decides.
    ends = (
        sorted_rows.groupBy("part")
        .agg(
            F.min_by(F.struct("conv_id"), "node").alias("first"),
            F.max_by(F.struct("conv_id"), "node").alias("last"),
            F.min("node").alias("low"),
            F.max("node").alias("high"),
        )
        .orderBy("part")
        .collect()
    )
    goes_on = {b["low"]: a["high"] for a, b in zip(ends, ends[1:]) if a["last"] == b["first"]}
    parent = F.col("parent")
    if goes_on:
        bridge = F.create_map(*(F.lit(x).cast("long") for pair in goes_on.items() for x in pair))
        parent = F.when(F.col("node").isin(list(goes_on)), bridge[F.col("node")]).otherwise(parent)
    return sorted_rows.select(
        F.col("conv_id").alias("tree"), "node", parent.alias("parent"), "role", "text", F.lit(0.0).alias("score")
    )


def chosen_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """``path`` (the leaf's node), ``rank``, ``depth`` and ``node`` of every message on a chosen path.

    ``messages``: ``node`` (unique long), ``parent`` (null, or unknown: a root), ``score``. The score of a
    branch is the mean over its messages; each tree gives its ``branches`` best, ties by the leaf's node.
    Messages that reply to each other in a circle have no root and are on no path.

    Distances double with each self-join: after k rounds each message knows its ancestor 2**k steps up.
    Messages that have reached their root take no further part. Going down the stored tables of jumps, the
    messages on a path are put together in as many joins. Tables hold ids only.
    """
    nodes = messages.select("node", "parent", F.coalesce("score", F.lit(0.0)).cast("double").alias("score"))
    nodes = nodes.groupBy("node").agg(F.min("parent").alias("parent"), F.max("score").alias("score"))
    # Roots stay out of the join: null parents would all meet in one task.
    nodes = store(nodes, "nodes")
    known = nodes.select(F.col("node").alias("known"))
    roots = nodes.filter("parent is null").select("node", F.col("parent").alias("up"), "score")
    replies = nodes.filter("parent is not null").join(known, F.col("parent") == F.col("known"), "left")
    nodes = replies.select("node", F.col("known").alias("up"), "score").unionByName(roots)
    # ``root`` is the furthest ancestor so far, ``total`` and ``depth`` cover the steps up to it without it.
    now = store(
        nodes.select(
            "node",
            "up",
            F.coalesce("up", "node").alias("root"),
            F.when(F.col("up").isNull(), 0.0).otherwise(F.col("score")).alias("total"),
            F.when(F.col("up").isNull(), 0).otherwise(1).alias("depth"),
        ),
        "up",
    )
    jumps, done = [], now.filter("up is null")
    tops = nodes.filter("up is null").select(F.col("node").alias("top"), F.col("score").alias("top_score"))
    count = nodes.count()
    while True:
        open_ = now.filter("up is not null")
        if not open_.take(1) or 1 << len(jumps) > count:
            break
        jumps.append(open_.select("node", F.col("up").alias("above")))
        higher = now.select(
            F.col("node").alias("at"),
            F.col("up").alias("next"),
            F.col("root").alias("high"),
            F.col("total").alias("more"),
            F.col("depth").alias("steps"),
        )
        now = store(
            open_.join(higher, F.col("up") == F.col("at")).select(
                "node",
                F.col("next").alias("up"),
                F.col("high").alias("root"),
                (F.col("total") + F.col("more")).alias("total"),
                (F.col("depth") + F.col("steps")).alias("depth"),
            )
            # Those that are finished are still looked up by others.
            .unionByName(done),
            "up",
        )
        done = now.filter("up is null")
    replied = messages.select(F.col("parent").alias("replied")).filter("replied is not null").distinct()
    leaves = done.join(replied, F.col("node") == F.col("replied"), "left_anti").join(tops, F.col("root") == F.col("top"))
    mean = (F.col("total") + F.col("top_score")) / (F.col("depth") + 1)
    # Spark keeps at most ``branches`` rows of a tree per task before they meet.
    best = Window.partitionBy("root").orderBy(F.desc("mean"), "node")
    ranked = leaves.withColumn("mean", mean).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= branches)
    paths = store(ranked.select(F.col("node").alias("path"), "rank", "depth", "node"), "paths")
    for k in reversed(range(len(jumps))):
        step = jumps[k].withColumnRenamed("node", "at")
        higher = paths.join(step, F.col("node") == F.col("at")).select(
            "path", "rank", (F.col("depth") - (1 << k)).alias("depth"), F.col("above").alias("node")
        )
        paths = store(paths.unionByName(higher), "paths")
    return paths


def format_paths(messages: DataFrame, branches: int = 1, learn: str = "assistant") -> DataFrame:
    """One row per chosen path: ``tree``, ``rank``, ``conversation`` and ``loss`` (start, end of learnt texts).

    Null roles and texts are empty. Rows with one ``node`` are one message (any one of them is taken). An
    empty table gives no conversations. The turns of one conversation pass through one task in order, as
    they end up in one string; a task holds one conversation at a time.
    """
    paths = chosen_paths(messages, branches)
    texts = messages.dropDuplicates(["node"]).select(F.col("node").alias("own"), "tree", "role", "text")
    turns = paths.join(texts, F.col("node") == F.col("own")).select("tree", "path", "rank", "depth", "role", "text")
    small_batches(messages.sparkSession)
    parts = int(messages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = messages.schema["tree"].dataType

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, tree_type = None, [], None

        def done() -> pa.RecordBatch:
            text, spans = render(held, learn)
            loss = pa.array([[{"start": a, "end": b} for a, b in spans]], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            return pa.RecordBatch.from_arrays(
                [pa.array([last[1]], tree_type), pa.array([last[2]], pa.int32()), pa.array([text]), loss],
                names=["tree", "rank", "conversation", "loss"],
            )

        for batch in batches:
            tree_type = batch.schema.field("tree").type
            columns = [batch.column(c).to_pylist() for c in ("path", "tree", "rank", "role", "text")]
            for path, tree, rank, role, text in zip(*columns):
                if last is not None and path != last[0]:
                    yield done()
                    held = []
                last = (path, tree, rank)
                held.append((role, text))
        if held:
            yield done()

    schema = f"tree {kind.simpleString()}, rank int, conversation string, loss array<struct<start:long,end:long>>"
    return turns.repartition(parts, "path").sortWithinPartitions("path", "depth").mapInArrow(join, schema)


def read_back(conversations: DataFrame) -> DataFrame:
    """Numbers and digests of rendered conversations, from their strings and loss spans."""
    kind = conversations.schema["tree"].dataType.simpleString()

    def read(batch: pa.RecordBatch) -> pa.Table:
        rows = []
        for text, loss in zip(batch.column("conversation").to_pylist(), batch.column("loss").to_pylist()):
            turns = parse(text)
            learnt = "".join(unescape(text[s["start"] : s["end"]]) for s in loss)
            whole = "".join(f"{role}\n{body}\n" for role, body in turns)
            rows.append(
                (
                    len(turns),
                    sha256(whole.encode()).hexdigest(),
                    len(learnt),
                    sha256(learnt.encode()).hexdigest(),
                    len(text),
                )
            )
        names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        return pa.table({"tree": batch.column("tree"), "rank": batch.column("rank")} | dict(zip(names, map(list, zip(*rows)))))

    return map_text(
        conversations,
        read,
        f"tree {kind}, rank int, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
