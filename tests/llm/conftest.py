from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from brute import FOLDER  # noqa: E402

#: Names that the operators use themselves.
EXTRA = ["class", "component", "n", "word", "base", "own", "gone_id", "gone_hash", "found_id", "found_hash", "clean", "row", "block", "toxic", "score", "spans", "train", "part"]


@pytest.fixture(scope="session")
def texts(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text for r in rows}


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text), with extra columns of clashing names."""

    def make(rows, extra=True):
        df = spark.createDataFrame(list(rows), "doc_id long, text string")
        if extra:
            from pyspark.sql import functions as F

            df = df.select("*", *(F.lit(f"x{k}").alias(name) for k, name in enumerate(EXTRA)))
        return df

    return make
