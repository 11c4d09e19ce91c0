"""Upload, storage and reuse of marts and models per session."""

from __future__ import annotations

from collections import OrderedDict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry import schemas
from basketry.operators import experiment, model
from basketry.operators.eda import eda_records
from basketry.operators.quality import table_counts, table_digests
from basketry.plans.views import RetailViews
from basketry.session import (
    drop_old_versions, drop_version, lease, new_version, publish, resolve_namespace, version_number,
)
from basketry.sources.files import read_upload
from basketry.sources.loader import read_marketplace
from basketry.sources.tables import read_tables, replace_table, replace_tables

MARTS = ("fct_customers", "fct_orders", "order_weights", "first_order_features")
ORDER_WEIGHTS = ("order_id string, customer_id string, purchase_ts timestamp_ntz, order_value double, "
                 "was_late int, n_rows bigint, score_rows bigint, score_sum bigint")
FEATURES = ("order_id string, customer_id string, order_value double, was_late int, "
            "review_score int, payment_type string, installments int, state string, "
            "is_repeat_customer int")
EMPTY = {
    "fct_customers": schemas.FCT_CUSTOMERS,
    "fct_orders": schemas.FCT_ORDERS,
    "order_weights": ORDER_WEIGHTS,
    "first_order_features": FEATURES,
}


# The models used last, with their scored test rows, by application and upload. Others are trained anew.
_models: OrderedDict[tuple[str, str], tuple[model.RepeatModel, DataFrame]] = OrderedDict()
MODELS_KEPT = 32


def ingest(spark: SparkSession, paths: list[str], session_id: str | None = None,
           on_bad_ts: str = "raise") -> DataFrame:
    """Load CSV files into the session's database and build its marts.

    Nothing is written if a file or column is missing. Returns rows per raw table.
    """
    raw = read_upload(spark, paths)
    return store(spark, raw, session_id, on_bad_ts)


def ingest_marketplace(spark: SparkSession, paths: list[str], session_id: str | None = None,
                       on_bad_ts: str = "raise") -> DataFrame:
    """The same for the CSV files of a marketplace, which are brought to the raw model."""
    return store(spark, read_marketplace(spark, paths), session_id, on_bad_ts)


# The raw tables that each stored view is made of.
MADE_OF = {
    "int_order_economics": {"orders", "order_items"},
    "fct_customers": {"customers", "orders", "order_items", "reviews"},
    "fct_orders": {"orders", "order_items", "reviews", "payments"},
    "order_weights": {"orders", "order_items", "reviews", "payments"},
    "first_order_features": set(schemas.RAW_TABLES),
}
# Name of the table of digests, and what the views are like: another number, and all are made anew.
DIGESTS = "upload_digests"
DEFINITIONS = 1


def _unchanged(spark: SparkSession, digests: DataFrame, earlier: str) -> set[str]:
    """The raw tables that the earlier upload had with the same rows."""
    table = f"`{earlier}`.`{DIGESTS}`"
    if not spark.catalog.tableExists(table):
        return set()
    return {row.table for row in digests.intersect(spark.table(table)).collect()}


def store(spark: SparkSession, raw: dict[str, DataFrame], session_id: str | None = None,
          on_bad_ts: str = "raise") -> DataFrame:
    """Write the raw tables and the marts to a new database and make it the session's current one.

    Views of raw tables that are as they were in the current upload are copied, not computed again;
    a digest per table tells. If anything fails, the earlier upload stays as it is; so does that of
    another upload that became current since this one began (UploadConflict). Results that are still
    read from the earlier one stay valid for the time of a lease.
    """
    expected, earlier = version_number(spark, session_id), resolve_namespace(spark, session_id)
    database = new_version(spark)
    try:
        replace_tables(raw, database)
        stored = read_tables(spark, database, list(raw))
        digests = f"`{database}`.`{DIGESTS}`"
        replace_table(table_digests(stored).withColumn("definitions", F.lit(f"{DEFINITIONS} {on_bad_ts}")), digests)
        same = _unchanged(spark, spark.table(digests), earlier)
        views = RetailViews(stored, on_bad_ts)
        for name in ("int_order_economics", *MARTS):
            target = f"`{database}`.`{name}`"
            if MADE_OF[name] <= same:
                replace_table(spark.table(f"`{earlier}`.`{name}`"), target)
            else:
                replace_table(getattr(views, name), target)
            if name == "int_order_economics":
                # every mart starts from the stored economics instead of computing it again
                views.int_order_economics = spark.table(target)
        publish(spark, session_id, database, expected)
    except Exception:
        drop_version(spark, database)
        raise
    drop_old_versions(spark, session_id)
    return table_counts(stored)


def load_mart(spark: SparkSession, name: str, session_id: str | None = None) -> DataFrame:
    """A stored mart of the session, else the shared one, else an empty one."""
    if name not in MARTS:
        raise ValueError(f"no such mart: {name}")
    table = f"`{lease(spark, session_id)}`.`{name}`"
    if spark.catalog.tableExists(table):
        return spark.table(table)
    return spark.createDataFrame([], EMPTY[name])


def eda(spark: SparkSession, session_id: str | None = None) -> DataFrame:
    return eda_records(load_mart(spark, "order_weights", session_id),
                       load_mart(spark, "fct_customers", session_id))


def ab_test(spark: SparkSession, lift_pp: float = experiment.DEFAULT_LIFT_PP,
            session_id: str | None = None) -> DataFrame:
    customers = load_mart(spark, "fct_customers", session_id)
    return experiment.business_case(
        experiment.simulate_outcome(experiment.assign_groups(customers), lift_pp))


def _trained(spark: SparkSession, session_id: str | None) -> tuple[model.RepeatModel, DataFrame]:
    key = (spark.sparkContext.applicationId, lease(spark, session_id))
    if key not in _models:
        _models[key] = model.train(load_mart(spark, "first_order_features", session_id))
    _models.move_to_end(key)
    while len(_models) > MODELS_KEPT:
        _models.popitem(last=False)
    return _models[key]


def session_model(spark: SparkSession, session_id: str | None = None) -> model.RepeatModel:
    """The model of the session's first orders, trained once per upload."""
    return _trained(spark, session_id)[0]


def evaluate_model(spark: SparkSession, session_id: str | None = None) -> model.Evaluation:
    """Metrics of the session's model on the test rows, which it has not learned from."""
    return model.evaluate(_trained(spark, session_id)[1])


def train_model(spark: SparkSession, path: str, session_id: str | None = None) -> model.RepeatModel:
    """Train on the session's first orders and save the pipeline under `path`."""
    fitted = session_model(spark, session_id)
    model.save(fitted, path)
    return fitted


def score_orders(path: str, orders: DataFrame) -> DataFrame:
    """Repeat probability of orders, by a saved pipeline."""
    return model.score(model.load(path), orders)
