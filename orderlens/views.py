"""SQL access to the two published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def register_views(clean: DataFrame, people: DataFrame) -> None:
    """Make the tables available to ``spark.sql`` as ``clean_orders`` and ``people``."""
    clean.createOrReplaceTempView("clean_orders")
    people.createOrReplaceTempView("people")
