"""Every operator as a callable over the test tables, by key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens import schemas
from orderlens.models import features, metrics, training
from orderlens.operators.lookup import lookup_join
from orderlens.operators.storage import new_path, store
from orderlens.plans import (
    customers,
    dashboard,
    products,
    quality,
    retention,
    rfm,
    risk,
    sales,
    tables,
)
from orderlens.sources import readers, writers
from orderlens.sources.star import StarTables
from orderlens.views import register_views
from registry import logistic

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[StarTables], DataFrame]) -> Callable[[StarTables], DataFrame]:
    """Register ``build`` under its name. Decimals leave as doubles."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = build(StarTables(spark, sf_dir))
        decimals = [name for name, kind in out.dtypes if kind.startswith("decimal")]
        return out.withColumns({name: F.col(name).cast("double") for name in decimals})

    QUERIES[build.__name__] = run
    return build


def keyed(star: StarTables) -> DataFrame:
    return tables.add_order_key(star.transactions())


def with_customers(star: StarTables) -> DataFrame:
    return tables.clean_orders(keyed(star), customers=customer_facts(star))


def customer_facts(star: StarTables) -> DataFrame:
    return star.customers().select("customer_id", "country", "churn_label")


def product_facts(star: StarTables) -> DataFrame:
    return star.products().select("product_id", "category", "margin_percentage")


def full_orders(star: StarTables) -> DataFrame:
    return tables.clean_orders(keyed(star), customer_facts(star), product_facts(star))


def priced_orders(star: StarTables) -> DataFrame:
    return tables.clean_orders(keyed(star), products=product_facts(star))


def priced_lines(star: StarTables) -> DataFrame:
    return tables.clean_orders(star.order_lines(), products=product_facts(star))


def people_of(star: StarTables) -> DataFrame:
    return tables.build_people(keyed(star))


def stored_people(star: StarTables) -> DataFrame:
    """For reports that pass over the customers more than once."""
    return store(people_of(star), "people")


def people_with_churn(star: StarTables) -> DataFrame:
    return people_of(star).join(
        tables.customer_churn(with_customers(star)), "customer_id", "left"
    )


def quantile_scores(star: StarTables) -> DataFrame:
    return rfm.score_by_quantiles(keyed(star), people_of(star))


def tile_scores(star: StarTables) -> DataFrame:
    return rfm.score_by_tiles(keyed(star), people_of(star))


def dimensions(star: StarTables) -> dict[str, tuple[DataFrame, str]]:
    return {
        "customers": (star.customers(), "customer_id"),
        "products": (star.products(), "product_id"),
        "behavior": (star.behavior(), "customer_id"),
    }


# Sources and sinks


@query
def src_csv(star: StarTables) -> DataFrame:
    """Orders written as CSV with a padded header and doubled quotes, read back and typed."""
    path = new_path(star.spark, "csv")
    text = star.text_transactions()
    padded = text.toDF(*(f" {name} " for name in text.columns))
    padded.write.option("header", True).option("escape", '"').csv(path)
    return tables.typed_orders(readers.read_csv(star.spark, path))


@query
def sink_parquet(star: StarTables) -> DataFrame:
    """Both tables written, read back, and joined."""
    folder = new_path(star.spark, "tables")
    writers.save_tables(full_orders(star), people_of(star), folder)
    clean, people = readers.read_tables(star.spark, folder)
    totals = people.select("customer_id", "gmv", "orders")
    orders = clean.select("transaction_id", "customer_id", "country", "category", "order_value")
    return lookup_join(orders, totals, "customer_id", ["transaction_id"], "inner")


@query
def people_rfm(star: StarTables) -> DataFrame:
    people = stored_people(star)
    return rfm.with_segments(keyed(star), people).drop("last_order")


@query
def publish_orders(star: StarTables) -> DataFrame:
    """The published table, written and read back."""
    return store(writers.published_orders(full_orders(star)), "published")


@query
def publish_people(star: StarTables) -> DataFrame:
    people = stored_people(star)
    scored = rfm.with_segments(keyed(star), people)
    return store(writers.published_people(scored, with_customers(star)), "published")


@query
def sql_views(star: StarTables) -> DataFrame:
    """Amount and customers per segment by SQL over the two published tables."""
    people = stored_people(star)
    scored = rfm.with_segments(keyed(star), people)
    register_views(full_orders(star), scored)
    return star.spark.sql(
        "SELECT segment, count(DISTINCT customer_id) AS customers,"
        " CAST(sum(order_value) AS DOUBLE) AS gmv"
        " FROM clean_orders JOIN people USING (customer_id) GROUP BY segment"
    )


@query
def preview_orders(star: StarTables) -> DataFrame:
    """The dimension adds columns to the five rows kept, not to all."""
    columns = ["transaction_id", "order_key", "customer_id", "order_value", "order_date"]
    first = quality.preview(keyed(star), columns, ["order_key"])
    country = star.customers().select("customer_id", "country")
    return lookup_join(first, country, "customer_id", ["transaction_id"])


@query
def preview_people(star: StarTables) -> DataFrame:
    columns = ["customer_id", "gmv", "orders", "first_order"]
    first = quality.preview(people_of(star), columns, ["customer_id"])
    labels = star.customers().select("customer_id", "churn_label")
    return lookup_join(first, labels, "customer_id", ["customer_id"])


# Typing and checks


@query
def typed_orders(star: StarTables) -> DataFrame:
    return tables.typed_orders(star.text_transactions())


@query
def grain_orders(star: StarTables) -> DataFrame:
    return quality.grain(star.transactions())


@query
def grain_lines(star: StarTables) -> DataFrame:
    return quality.grain(star.order_lines())


@query
def sanity_check(star: StarTables) -> DataFrame:
    """Text orders against typed ones."""
    raw = star.text_transactions()
    return quality.sanity(raw, tables.typed_orders(raw))


@query
def duplicate_rows(star: StarTables) -> DataFrame:
    """Copies among orders and among lines, over all columns."""
    lines = star.spark.read.parquet(f"{star.folder}/lineitem.parquet")
    orders = quality.duplicate_rows(star.transactions()).withColumn("source", F.lit("orders"))
    return orders.unionByName(quality.duplicate_rows(lines).withColumn("source", F.lit("lines")))


@query
def bad_orders(star: StarTables) -> DataFrame:
    """Orders, and shipments (several suppliers and days per order)."""
    orders = quality.bad_orders(keyed(star)).withColumn("source", F.lit("orders"))
    return orders.unionByName(
        quality.bad_orders(star.shipments()).withColumn("source", F.lit("shipments"))
    )


@query
def bad_orders_by_day(star: StarTables) -> DataFrame:
    """Orders, and events seen as orders of one user."""
    events = star.table("events").select(
        F.col("user_id").cast("string").alias("order_key"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.col("ts").alias("order_date"),
    )
    orders = quality.bad_orders(keyed(star), by_day=True).withColumn("source", F.lit("orders"))
    return orders.unionByName(
        quality.bad_orders(events, by_day=True).withColumn("source", F.lit("events"))
    )


@query
def dim_duplicates(star: StarTables) -> DataFrame:
    return quality.dim_duplicates(dimensions(star))


@query
def orphan_keys(star: StarTables) -> DataFrame:
    return quality.orphan_keys(keyed(star), dimensions(star))


@query
def join_inflation(star: StarTables) -> DataFrame:
    joined = tables.clean_orders(
        keyed(star), customer_facts(star), product_facts(star), star.behavior()
    )
    return quality.join_inflation(keyed(star), joined)


@query
def mixed_churn(star: StarTables) -> DataFrame:
    """Customers with two churn labels, and with two fraud labels."""
    churn = quality.mixed_labels(with_customers(star)).withColumn("label", F.lit("churn_label"))
    fraud = quality.mixed_labels(keyed(star), "fraud_label")
    return churn.unionByName(fraud.withColumn("label", F.lit("fraud_label")))


@query
def contract_check(star: StarTables) -> DataFrame:
    """Required columns and keys of both tables."""
    orders = quality.contract_check(keyed(star), schemas.CLEAN_ORDERS, "clean_orders")
    return orders.unionByName(quality.contract_check(people_of(star), schemas.PEOPLE, "people"))


@query
def sanity_rows(star: StarTables) -> DataFrame:
    return quality.row_count(keyed(star))


@query
def sanity_sql(star: StarTables) -> DataFrame:
    return quality.order_totals(priced_orders(star))


@query
def sanity_people(star: StarTables) -> DataFrame:
    return quality.people_totals(people_of(star))


# Tables


@query
def clean_orders(star: StarTables) -> DataFrame:
    return full_orders(star)


@query
def clean_lines(star: StarTables) -> DataFrame:
    return tables.clean_orders(star.dated_lines(), customer_facts(star), product_facts(star))


@query
def clean_behavior(star: StarTables) -> DataFrame:
    return tables.clean_orders(keyed(star), behavior=star.behavior())


@query
def people(star: StarTables) -> DataFrame:
    return people_of(star).drop("last_order")


@query
def customer_churn(star: StarTables) -> DataFrame:
    return tables.customer_churn(with_customers(star))


# Sales


@query
def kpi_totals(star: StarTables) -> DataFrame:
    return sales.totals_with_spread(keyed(star))


@query
def kpi_totals_sql(star: StarTables) -> DataFrame:
    return sales.totals(keyed(star))


@query
def kpi_country(star: StarTables) -> DataFrame:
    return sales.by_dimension(with_customers(star), "country")


@query
def kpi_country_sql(star: StarTables) -> DataFrame:
    return sales.by_dimension(with_customers(star), "country", keep_null=True)


@query
def kpi_year_month(star: StarTables) -> DataFrame:
    return sales.by_year_month(keyed(star))


# Customers


@query
def people_summary(star: StarTables) -> DataFrame:
    return customers.people_summary(stored_people(star))


@query
def kpi_repeat(star: StarTables) -> DataFrame:
    return customers.repeat_report(stored_people(star))


@query
def kpi_repeat_sql(star: StarTables) -> DataFrame:
    return customers.repeat_report_averages(people_of(star))


@query
def kpi_medians_sql(star: StarTables) -> DataFrame:
    return customers.lower_medians(stored_people(star))


@query
def churn_slice(star: StarTables) -> DataFrame:
    return customers.churn_slice(with_customers(star), people_of(star))


@query
def churn_slice_sql(star: StarTables) -> DataFrame:
    return customers.churn_slice_averages(people_with_churn(star))


# Cohorts


@query
def customer_cohort(star: StarTables) -> DataFrame:
    return retention.customer_cohorts(keyed(star))


@query
def cohort_size(star: StarTables) -> DataFrame:
    return retention.cohort_sizes(keyed(star))


@query
def cohort_active(star: StarTables) -> DataFrame:
    return retention.cohort_activity(keyed(star))


@query
def retention_long(star: StarTables) -> DataFrame:
    return retention.retention_long(keyed(star))


@query
def retention_matrix(star: StarTables) -> DataFrame:
    return retention.retention_matrix(keyed(star))


@query
def retention_full(star: StarTables) -> DataFrame:
    return retention.retention_full(keyed(star))


@query
def retention_m1_median(star: StarTables) -> DataFrame:
    return retention.first_period_median(keyed(star))


@query
def cohort_summary(star: StarTables) -> DataFrame:
    return retention.cohort_summary(keyed(star))


@query
def cohort_summary_sql(star: StarTables) -> DataFrame:
    return retention.cohort_summary_of_people(people_of(star))


# Recency, frequency, monetary


@query
def rfm_customers(star: StarTables) -> DataFrame:
    return quantile_scores(star)


@query
def rfm_ranks(star: StarTables) -> DataFrame:
    return rfm.ranks_of_customers(people_of(star))


@query
def rfm_segments(star: StarTables) -> DataFrame:
    return rfm.segment_sizes(quantile_scores(star))


@query
def recency_summary(star: StarTables) -> DataFrame:
    return rfm.recency_summary(rfm.rfm_base(keyed(star), people_of(star)))


@query
def rfm_champions(star: StarTables) -> DataFrame:
    return rfm.champions_and_cold(quantile_scores(star))


@query
def rfm_by_recency(star: StarTables) -> DataFrame:
    return rfm.customers_by_recency(quantile_scores(star))


@query
def rfm_sql_customers(star: StarTables) -> DataFrame:
    return tile_scores(star)


@query
def rfm_sql_segments(star: StarTables) -> DataFrame:
    return rfm.segment_sizes(tile_scores(star))


@query
def rfm_sql_champions(star: StarTables) -> DataFrame:
    return rfm.champions_and_cold(tile_scores(star)).drop("cold_pct")


@query
def recency_summary_sql(star: StarTables) -> DataFrame:
    return rfm.recency_averages(rfm.rfm_base(keyed(star), people_of(star), "inner"))


# Products, at line grain


@query
def kpi_margin(star: StarTables) -> DataFrame:
    return products.margin(priced_lines(star))


@query
def product_kpi(star: StarTables) -> DataFrame:
    return products.by_product(priced_lines(star))


@query
def top_products(star: StarTables) -> DataFrame:
    return products.top_products(priced_lines(star))


@query
def kpi_category(star: StarTables) -> DataFrame:
    return products.by_category(priced_lines(star))


@query
def kpi_category_sql(star: StarTables) -> DataFrame:
    return products.by_category_with_null(priced_lines(star))


# Fraud


@query
def fraud_overall(star: StarTables) -> DataFrame:
    return risk.fraud_overall(keyed(star))


@query
def fraud_by_payment(star: StarTables) -> DataFrame:
    return risk.fraud_by(keyed(star), "payment_method")


@query
def fraud_by_device(star: StarTables) -> DataFrame:
    return risk.fraud_by(keyed(star), "device_type")


# Dashboard measures


@query
def bi_sales(star: StarTables) -> DataFrame:
    return dashboard.sales_measures(priced_orders(star))


@query
def bi_customers(star: StarTables) -> DataFrame:
    return dashboard.customer_measures(stored_people(star))


@query
def bi_fraud(star: StarTables) -> DataFrame:
    return dashboard.fraud_measure(keyed(star))


# Models


def churn_table(star: StarTables) -> DataFrame:
    return features.churn_features(star.customers(), star.behavior(), star.transactions())


def fraud_table(star: StarTables) -> DataFrame:
    return features.fraud_features(star.transactions(), star.customers(), star.products())


def fixed_scores(star: StarTables) -> DataFrame:
    """A formula in place of a model, so that SQL can recompute the metrics."""
    labelled = people_with_churn(star).where(F.col("churn_label").isNotNull())
    return labelled.select(
        "customer_id",
        F.col("churn_label").alias(features.LABEL),
        (F.col("orders") / 30.0).cast("double").alias("probability"),
        F.when(F.col("orders") >= 10, 1).otherwise(0).alias("prediction"),
    )


def churn_logistic(star: StarTables) -> training.Fitted:
    return training.fit_logistic(churn_table(star), "customer_id", features.CHURN_CATEGORIES)


def fraud_logistic(star: StarTables) -> training.Fitted:
    return training.fit_logistic(fraud_table(star), "transaction_id", features.FRAUD_CATEGORIES)


def churn_trees(star: StarTables) -> training.Fitted:
    return training.fit_forest(
        churn_table(star), "customer_id", features.CHURN_CATEGORIES, trees=200
    )


def fraud_trees(star: StarTables) -> training.Fitted:
    return training.fit_forest(
        fraud_table(star), "transaction_id", features.FRAUD_CATEGORIES, trees=100
    )


def rounded(df: DataFrame, name: str) -> DataFrame:
    """One column to the digits that its SQL twin is compared in."""
    return df.withColumn(name, F.round(name, logistic.DIGITS))


@query
def txn_features(star: StarTables) -> DataFrame:
    return features.order_features(star.transactions())


@query
def churn_features(star: StarTables) -> DataFrame:
    return churn_table(star)


@query
def fraud_features(star: StarTables) -> DataFrame:
    return fraud_table(star)


@query
def label_share(star: StarTables) -> DataFrame:
    churn = features.label_share(star.customers(), "churn_label", 1)
    fraud = features.label_share(star.transactions(), "fraud_label", 2)
    return churn.withColumn("label", F.lit("churn")).unionByName(
        fraud.withColumn("label", F.lit("fraud"))
    )


@query
def split_shares(star: StarTables) -> DataFrame:
    labelled = star.transactions().withColumnRenamed("fraud_label", features.LABEL)
    return training.split_shares(labelled, "transaction_id")


@query
def split_rows(star: StarTables) -> DataFrame:
    """The rows held back for testing the fraud models."""
    labelled = star.transactions().withColumnRenamed("fraud_label", features.LABEL)
    return training.split(labelled, "transaction_id")[1].select("transaction_id", features.LABEL)


@query
def model_auc(star: StarTables) -> DataFrame:
    return metrics.auc_table(store(fixed_scores(star), "scores"), digits=12)


@query
def confusion(star: StarTables) -> DataFrame:
    return metrics.confusion(fixed_scores(star))


@query
def class_report(star: StarTables) -> DataFrame:
    return metrics.class_report(fixed_scores(star))


@query
def churn_logreg(star: StarTables) -> DataFrame:
    return metrics.summary(churn_logistic(star).scores, "logistic regression")


@query
def churn_forest(star: StarTables) -> DataFrame:
    return metrics.summary(churn_trees(star).scores, "random forest")


@query
def churn_scores(star: StarTables) -> DataFrame:
    return rounded(churn_logistic(star).scores, "probability")


@query
def churn_coefs(star: StarTables) -> DataFrame:
    return rounded(training.coefficients(churn_logistic(star)), "coefficient")


@query
def churn_importance(star: StarTables) -> DataFrame:
    return training.importances(churn_trees(star))


@query
def fraud_logreg(star: StarTables) -> DataFrame:
    return metrics.summary(fraud_logistic(star).scores, "logistic regression")


@query
def fraud_forest(star: StarTables) -> DataFrame:
    return metrics.summary(fraud_trees(star).scores, "random forest")


@query
def fraud_scores(star: StarTables) -> DataFrame:
    return rounded(fraud_logistic(star).scores, "probability")


@query
def fraud_coefs(star: StarTables) -> DataFrame:
    return rounded(training.coefficients(fraud_logistic(star)), "coefficient")


@query
def fraud_importance(star: StarTables) -> DataFrame:
    return training.importances(fraud_trees(star))
