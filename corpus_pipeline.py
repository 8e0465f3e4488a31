"""From raw documents to packed training sequences, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderlens.llm import decontam, jaccard, packing, pii, queries, toxicity
from orderlens.llm.text import without
from orderlens.operators.storage import new_path


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go."""
    return toxicity.accepted(docs, queries.toxicity_model(spark, docs, sf_dir), queries.TOXIC)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard.deduplicate(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    found = decontam.scan(docs, queries.table(spark, sf_dir, "benchmark"))
    return without(docs, found.filter("contaminated").select("doc_id", "text_hash"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data, and terms that give it away, are generalised or removed."""
    return pii.sanitise(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids, placed in sequences. Few words are kept: earlier stages hold memory too."""
    return packing.pack_documents(docs, queries.tokenizer("word_bpe_49k.json"), "dropped", 1, 2048, remembered=160_000)


STAGES = [
    ("toxicity", reject_toxic),
    ("ngram_jaccard", drop_near_copies),
    ("decontamination", drop_leaks),
    ("personal_data", hide_personal_data),
    ("packing", pack),
]

#: The classifier and the tokenizer have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is stored and read again by the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
