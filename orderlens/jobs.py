"""The batch jobs: build the tables, report on them, publish them, train the models.

Each takes and leaves tables in folders, so the jobs run one after another or apart.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from orderlens.models import features, metrics, training
from orderlens.operators.storage import store
from orderlens.plans import customers, products, quality, retention, rfm, risk, sales, tables
from orderlens.session import open_session
from orderlens.sources import readers, writers
from orderlens.views import register_views


def staged(data: readers.Inputs) -> readers.Inputs:
    """The inputs as columnar tables: text is parsed once, later passes prune columns."""
    return readers.Inputs(
        **{name: table if table is None else store(table, name) for name, table in vars(data).items()}
    )


def build(spark: SparkSession, inputs: str, output: str) -> dict[str, DataFrame]:
    """Read the CSV inputs, check them, write the order and customer tables.

    Only the raw row and order counts read the text of the orders a second time.
    """
    data = staged(readers.read_inputs(spark, inputs))
    raw = readers.read_csv(spark, f"{inputs}/transactions.csv")
    keyed = tables.add_order_key(data.transactions)
    dims = {
        "customers": (data.customers, "customer_id"),
        "products": (data.products, "product_id"),
        "behavior": (data.behavior, "customer_id"),
    }
    joined = tables.clean_orders(keyed, data.customers, data.products, data.behavior)
    # The customer table reads the stored orders, so the joins run once.
    clean = writers.save_tables(joined, None, output)
    people = tables.build_people(clean)
    writers.save_people(people, output)
    return {
        "grain": quality.grain(keyed),
        "sanity": quality.sanity(raw, data.transactions),
        "bad_orders": quality.bad_orders(keyed),
        "dim_duplicates": quality.dim_duplicates(dims),
        "orphan_keys": quality.orphan_keys(keyed, dims),
        "join_inflation": quality.join_inflation(keyed, clean),
        "people": customers.people_summary(readers.read_people(spark, output)),
    }


def report(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All reports; adds segment and recency score to the customer table."""
    clean, people = readers.read_tables(spark, folder)
    scores = rfm.score_by_quantiles(clean, people)
    months = store(retention.calendars(clean), "calendars")
    writers.save_people(rfm.with_segments(clean, people), folder)
    return {
        "totals": sales.totals_with_spread(clean),
        "country": sales.by_dimension(clean, "country"),
        "year_month": sales.by_year_month(clean),
        "repeat": customers.repeat_report(people),
        "cohorts": retention.cohort_summary(months),
        "period_1_median": retention.first_period_median(months),
        "retention": retention.retention_matrix(months),
        "recency": rfm.recency_summary(scores),
        "segments": rfm.segment_sizes(scores),
        "champions": rfm.champions_and_cold(scores),
        "mixed_churn": quality.mixed_labels(clean),
        "churn": customers.churn_slice(clean, people),
        "margin": products.margin(clean),
        "products": products.by_product(clean),
        "categories": products.by_category(clean),
        "fraud": risk.fraud_overall(clean),
        "fraud_by_payment": risk.fraud_by(clean, "payment_method"),
        "fraud_by_device": risk.fraud_by(clean, "device_type"),
    }


def publish(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Check the contract and make both tables queryable by SQL."""
    clean, people = readers.read_tables(spark, folder)
    orders = writers.published_orders(clean)
    register_views(orders, writers.published_people(people, clean))
    return spark.table("clean_orders"), spark.table("people")


def train(
    spark: SparkSession, inputs: str, target: str, trees: int | None = None, max_depth: int = 30
) -> dict[str, DataFrame]:
    """Fit both classifiers for 'churn' or 'fraud' and report on the test rows.

    Only the inputs that the target needs are read; features, split and scores are stored once.
    """
    if target == "churn":
        data = staged(readers.read_inputs(spark, inputs, {"transactions", "customers", "behavior"}))
        table = features.churn_features(data.customers, data.behavior, data.transactions)
        settings = ("customer_id", features.CHURN_CATEGORIES)
        trees = trees or 200
    else:
        data = staged(readers.read_inputs(spark, inputs, {"transactions", "customers", "products"}))
        table = features.fraud_features(data.transactions, data.customers, data.products)
        settings = ("transaction_id", features.FRAUD_CATEGORIES)
        trees = trees or 100
    ready = training.prepare(table, *settings)
    logistic = training.fit_logistic(ready, *settings)
    forest = training.fit_forest(ready, *settings, trees=trees, max_depth=max_depth)
    return {
        "logistic": metrics.summary(logistic.scores, "logistic regression"),
        "logistic_confusion": metrics.confusion(logistic.scores),
        "logistic_classes": metrics.class_report(logistic.scores),
        "logistic_top": training.coefficients(logistic),
        "forest": metrics.summary(forest.scores, "random forest"),
        "forest_confusion": metrics.confusion(forest.scores),
        "forest_classes": metrics.class_report(forest.scores),
        "forest_top": training.importances(forest),
    }


def save_results(results: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """Every result as a parquet table of its own, whole; the paths by name."""
    paths = {}
    for name, df in results.items():
        paths[name] = f"{folder}/{name}"
        df.write.mode("overwrite").parquet(paths[name])
    return paths


def main() -> None:
    parser = argparse.ArgumentParser(prog="python -m orderlens.jobs")
    parser.add_argument("job", choices=["build", "report", "publish", "churn", "fraud"])
    parser.add_argument("folder", help="CSV inputs for build and training, tables otherwise")
    parser.add_argument("output", nargs="?", help="folder for tables and results (default: the first)")
    parser.add_argument("--depth", type=int, default=30, help="depth of the trees, at most 30")
    args = parser.parse_args()
    output = args.output or args.folder
    spark = open_session(f"orderlens {args.job}")
    if args.job == "build":
        results = build(spark, args.folder, output)
    elif args.job == "report":
        results = report(spark, args.folder)
    elif args.job == "publish":
        for name, df in zip(("clean_orders", "people"), publish(spark, args.folder)):
            writers.publish_table(df, f"published_{name}", output)
        results = {}
    else:
        results = train(spark, args.folder, args.job, max_depth=args.depth)
    for name, path in save_results(results, f"{output}/results/{args.job}").items():
        print(f"{name}: {path}")


if __name__ == "__main__":
    main()
