"""Quality rules: per-document rules, aggregated by host and shrunk with an empirical beta prior."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.text import map_text
from orderlens.operators.storage import store

#: Symbols that mark leftovers of code and markup.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
FACTS = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"


def facts(text: str | None) -> tuple[int, int, int, int, int, int]:
    """Numbers of words, code points in words, symbols, lines with a word, such lines that are equal to
    an earlier one, and words inside a window of eight words that stands in the text twice or more."""
    text = text or ""
    data = text.encode()
    words = data.split()  # bytes split at the six ASCII blanks only
    blanks = sum(map(data.count, b" \t\n\r\x0b\x0c"))
    lines = [line for line in data.split(b"\n") if line.strip()]
    repeated = 0
    windows = list(zip(*(words[k:] for k in range(WINDOW))))
    counts = Counter(windows)
    if len(counts) < len(windows):
        reach = 0
        for i, w in enumerate(windows):
            if counts[w] > 1:
                repeated += i + WINDOW - max(i, reach)
                reach = i + WINDOW
    return (
        len(words),
        len(text) - blanks,
        sum(map(text.count, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated,
    )


def document_facts(docs: DataFrame, host: str = "source") -> DataFrame:
    """``doc_id``, ``host`` and the numbers of ``facts`` for every row."""
    names = [f.split()[0] for f in FACTS.split(", ")]

    def measure(batch: pa.RecordBatch) -> pa.Table:
        columns = list(zip(*map(facts, batch.column("text").to_pylist())))
        return pa.table(
            {
                "doc_id": batch.column("doc_id"),
                "host": batch.column("host"),
                **{n: pa.array(c, pa.int64()) for n, c in zip(names, columns)},
            }
        )

    rows = docs.select("doc_id", F.col(host).cast("string").alias("host"), "text")
    kind = dict(rows.dtypes)["doc_id"]
    return map_text(rows, measure, f"doc_id {kind}, host string, {FACTS}")


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """Beta prior of the hosts' failure rates by moments: mean and variance over hosts, the variance
    less what chance alone makes of it. Without any spread the prior is as strong as the mean host."""
    rate = F.col("failed") / F.col("documents")
    m, v, size, chance = (
        hosts.agg(F.avg(rate), F.var_pop(rate), F.avg("documents"), F.avg(1 / F.col("documents"))).first()
    )
    if m is None:
        return 1.0, 1.0
    m = min(max(m, 1e-3), 1 - 1e-3)
    spread = max((v or 0.0) - m * (1 - m) * chance, 0.0)
    strength = m * (1 - m) / spread - 1 if spread else size
    strength = min(max(strength, 2.0), max(size, 2.0))
    return m * strength, (1 - m) * strength


def judge(
    docs: DataFrame,
    host: str = "source",
    min_words: int = 20,
    max_repeat_pct: int = 30,
    max_symbol_pct: int = 10,
    max_dup_line_pct: int = 30,
    max_host_rate: float = 0.5,
) -> DataFrame:
    """One row per row of ``docs`` with its facts, the failed rules, and the verdict of its host.

    ``base_failed``: too short or too repetitive; ``failed``: that, or too many symbols or equal lines;
    ``host_rate``: the host's failure rate, shrunk by the beta prior of all hosts; ``kept``: not
    ``base_failed``, and the host's rate is at most ``max_host_rate``.

    Null and empty texts have no words and fail as too short. A null host is a host of its own. Repeated
    rows are judged, and counted for their host, one by one. An empty table gives no rows. A host with a
    third of all rows is one row after the map-side aggregation, and its documents are joined back by
    broadcast or by a join that Spark splits.
    """
    words, lines = F.col("n_words"), F.col("n_lines")
    base = (words < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * words)
    more = (100 * F.col("n_symbols") > max_symbol_pct * words) | (
        100 * F.col("n_dup_lines") > max_dup_line_pct * lines
    )
    # Numbers only, no text: a small part of the input.
    rows = store(
        document_facts(docs, host).withColumn("base_failed", base).withColumn("failed", base | more), "facts"
    )
    hosts = rows.groupBy("host").agg(
        F.sum(F.col("failed").cast("long")).alias("failed"), F.count("*").alias("documents")
    )
    a, b = beta_prior(hosts)
    verdicts = hosts.select(
        F.col("host").alias("judged"),
        ((F.col("failed") + a) / (F.col("documents") + a + b)).alias("host_rate"),
    )
    return rows.join(verdicts, F.col("host").eqNullSafe(F.col("judged")), "left").select(
        *rows.columns, "host_rate", (~F.col("base_failed") & (F.col("host_rate") <= max_host_rate)).alias("kept")
    )
