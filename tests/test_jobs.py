"""The batch jobs one after another, from CSV files to published views."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from orderlens import jobs, schemas
from orderlens.plans import tables
from orderlens.sources import readers, writers
from orderlens.sources.star import StarTables


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    star = StarTables(spark, "/root/testdata/sf0.001")
    inputs = str(tmp_path_factory.mktemp("csv"))
    for name in ("transactions", "customers", "products", "behavior"):
        df = getattr(star, name)()
        padded = df.select(*(F.col(c).cast("string").alias(f" {c} ") for c in df.columns))
        padded.write.option("header", True).csv(f"{inputs}/{name}.csv")
    return inputs, str(tmp_path_factory.mktemp("tables"))


def test_build_report_publish(spark, folders):
    inputs, output = folders
    checks = jobs.build(spark, inputs, output)
    assert checks["grain"].first()["grain"] == "order"
    assert checks["people"].first()["customers"] == 178  # 150 known ones and 28 unknown
    stages = [tuple(r) for r in checks["join_inflation"].select("rows_n", "gmv").collect()]
    assert stages == [(1500, 374446791.61)] * 2

    results = jobs.report(spark, output)
    assert {name: df.count() for name, df in results.items()}["country"] == 25
    assert results["totals"].first()["gmv"] == 374446791.61

    orders, people = jobs.publish(spark, output)
    assert orders.columns == [*schemas.ORDER_COLUMNS, "profit"]
    assert people.columns == [*schemas.PEOPLE_COLUMNS, "churn_label"]
    row = spark.sql(
        "SELECT count(*) AS n, sum(order_value) AS gmv FROM clean_orders JOIN people USING (customer_id)"
    ).first()
    assert (row["n"], float(row["gmv"])) == (1500, 374446791.61)


def test_scores_are_replaced_on_a_second_report(spark, folders):
    inputs, output = folders
    first = readers.latest_people(spark, output)
    jobs.report(spark, output)
    assert readers.latest_people(spark, output) > first
    people = readers.read_people(spark, output)
    assert people.columns.count("segment") == 1 and people.columns.count("R") == 1
    assert people.where("length(segment) <> 3 OR R IS NULL").count() == 0


def test_train(spark, folders):
    results = jobs.train(spark, folders[0], "churn", trees=10)
    assert 0 < results["logistic"].first()["auc"] <= 1
    assert results["forest_confusion"].agg(F.sum(F.col("predicted_0") + F.col("predicted_1"))).first()[0] > 0
    assert results["logistic_top"].count() == 12


def test_results_are_saved_whole(spark, folders, tmp_path):
    results = jobs.report(spark, folders[1])
    paths = jobs.save_results({k: results[k] for k in ("products", "country")}, str(tmp_path))
    assert spark.read.parquet(paths["products"]).count() == results["products"].count() > 20
    assert spark.read.parquet(paths["country"]).count() == 25


def test_publishing_needs_segments(spark, folders):
    star = StarTables(spark, "/root/testdata/sf0.001")
    orders = tables.add_order_key(star.transactions())
    with pytest.raises(ValueError, match="segment"):
        writers.published_people(tables.build_people(orders), orders)
    with pytest.raises(ValueError, match="country"):
        writers.published_orders(orders)


def test_publish_as_table(spark, folders, tmp_path):
    orders, _ = jobs.publish(spark, folders[1])
    name = "published_orders_test"
    writers.publish_table(orders, name, str(tmp_path))
    writers.publish_table(orders.limit(10), name, str(tmp_path))
    assert spark.table(name).count() == 10
    # A task fails after others have written; the published table stays.
    broken = orders.repartition(6).withColumn("profit", F.when(F.col("transaction_id") == orders.first()["transaction_id"], F.raise_error(F.lit("lost"))).otherwise(F.col("profit")))
    with pytest.raises(Exception, match="lost"):
        writers.publish_table(broken, name, str(tmp_path))
    assert spark.table(name).count() == 10
    writers.publish_table(orders, name, str(tmp_path))
    assert spark.table(name).count() == 1500
    # Two whole versions and a broken one are older than the newest.
    assert len(writers.remove_versions(spark, str(tmp_path), name, keep=1)) == 3
    assert writers.remove_versions(spark, str(tmp_path), name) == []
    assert spark.table(name).count() == 1500
    writers.publish_table(orders.drop("profit"), name, str(tmp_path))
    assert "profit" not in spark.table(name).columns
    assert writers.remove_versions(spark, str(tmp_path), "unknown") == []
    spark.sql(f"DROP TABLE {name}")
