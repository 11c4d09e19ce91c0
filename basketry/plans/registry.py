"""Every query by name: (spark, folder of the star tables) → DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.columns import hash_uniform
from basketry.operators import eda, experiment, features, marts, model, quality, sketches
from basketry.plans.views import RetailViews
from basketry.session import materialize, scratch_folder
from basketry.sources import adapters, files, loader

DIGITS = 6
MODEL_DIGITS = 3


def views(spark: SparkSession, folder: str) -> RetailViews:
    return RetailViews(adapters.raw_tables(spark, folder))


def _rounded(df: DataFrame, *columns: str, digits: int = DIGITS) -> DataFrame:
    """Doubles that come from sums of doubles, without their last digits."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _view(name: str) -> Callable:
    return lambda spark, folder: getattr(views(spark, folder), name)


def data_tests(spark, folder):
    v = views(spark, folder)
    customers = materialize(v.fct_customers.select("customer_id", "is_repeat_customer"))
    groups = experiment.group_counts(experiment.simulate_outcome(
        experiment.assign_groups(customers)))
    return quality.data_tests(v.raw["payments"], v.stg_payments, v.int_order_economics,
                              customers, v.fct_orders, groups)


def amount_quality(spark, folder):
    raw = views(spark, folder).raw
    return quality.amount_quality([(table, raw[table], column) for table, column in (
        ("order_items", "price"), ("order_items", "freight_value"), ("payments", "payment_value"))])


def preview_customers(spark, folder):
    return views(spark, folder).fct_customers.orderBy(
        "customer_id", "state", "lifetime_order_count").limit(5)


def _stored_values(spark, folder) -> DataFrame:
    """Order values with their number of rows, written once for the passes over them."""
    return materialize(views(spark, folder).order_weights.select("order_value", "n_rows"))


def eda_json(spark, folder):
    v = views(spark, folder)
    weights = materialize(v.order_weights.drop("order_id", "customer_id", "purchase_ts"))
    return eda.eda_records(weights, materialize(
        v.fct_customers.select("state", "is_repeat_customer")))


def eda_metrics(spark, folder):
    v = views(spark, folder)
    return eda.eda_metrics(v.order_weights, v.fct_customers)


def order_value_kde(spark, folder):
    return _rounded(eda.order_value_kde(_stored_values(spark, folder)), "x", "density")


# --------------------------------------------------------------------- sketches

QUANTILES = (0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99)


def order_value_sketch(spark, folder):
    """Sketches per month of purchase, merged: are the quantiles of order values within the stated bound?"""
    values = materialize(views(spark, folder).int_order_economics.select("purchase_ts", "order_value"))
    parts = sketches.quantile_sketches(values, part=F.date_format("purchase_ts", "yyyy-MM"))
    estimates = sketches.quantiles(parts, QUANTILES)
    return sketches.check_quantiles(estimates, values, "order_value", sketches.rank_error())


def late_and_on_time(spark, folder):
    v = views(spark, folder)
    return sketches.late_and_on_time(sketches.customer_sketches(v.int_order_economics, v.stg_customers))


# ------------------------------------------------------------------- experiment

def _assigned(spark, folder) -> DataFrame:
    return experiment.assign_groups(views(spark, folder).fct_customers)


def _stored_customers(spark, folder) -> DataFrame:
    """Customer facts the experiment needs, written once: the base rate is a pass of its own."""
    return materialize(views(spark, folder).fct_customers.select(
        "customer_id", "is_repeat_customer", "avg_order_value", "lifetime_value"))


def _experiment(spark, folder) -> DataFrame:
    return experiment.simulate_outcome(
        experiment.assign_groups(_stored_customers(spark, folder)))


def ab_outcome(spark, folder):
    return _experiment(spark, folder).select("customer_id", "group", "outcome")


def ab_balance(spark, folder):
    return _rounded(experiment.balance_test(_assigned(spark, folder)),
                    "mean_control", "mean_treatment", "t_stat", "p_value")


def ab_ztest(spark, folder):
    return _rounded(experiment.z_test(_experiment(spark, folder)), "z_stat", "p_value")


def ab_business(spark, folder):
    return _rounded(experiment.business_case(_experiment(spark, folder)),
                    "z_stat", "p_value", "incremental_revenue", "discount_cost")


# ------------------------------------------------------------------------ model

def features_imputed(spark, folder):
    stored = materialize(views(spark, folder).first_order_features)
    return features.impute(stored, features.fill_values(stored))


def features_onehot(spark, folder):
    stored = materialize(views(spark, folder).first_order_features)
    imputed = features.impute(stored, features.fill_values(stored))
    return features.one_hot(imputed, features.categories(imputed))


def split_train_test(spark, folder):
    rows = features.split(views(spark, folder).first_order_features)
    return rows.select("order_id", "customer_id", features.LABEL, "split")


def split_stratified(spark, folder):
    stored = materialize(features.with_label(views(spark, folder).first_order_features))
    return features.split_exactly(stored).select("order_id", "customer_id", features.LABEL, "split")


def features_scaled(spark, folder):
    stored = materialize(views(spark, folder).first_order_features)
    prep = features.learn(stored)
    scaled = features.standardise(features.encode(stored, prep), *features.moments(prep))
    return _rounded(scaled.select("order_id", "customer_id", "split", *prep.columns), *prep.columns)


def _trained(spark, folder):
    stored = materialize(views(spark, folder).first_order_features)
    return stored, *model.train(stored)


def lr_coefficients(spark, folder):
    return _rounded(model.coefficients(spark, _trained(spark, folder)[1]), "coefficient",
                    digits=MODEL_DIGITS)


def lr_scores(spark, folder):
    scored = _trained(spark, folder)[2]
    return _rounded(scored.select("order_id", "customer_id", features.LABEL, "prediction",
                                  "probability_repeat"), "probability_repeat", digits=MODEL_DIGITS)


def score_new_orders(spark, folder):
    """The orders that are not delivered yet, one score each, by a model of the first orders."""
    v = views(spark, folder)
    _, fitted, _ = _trained(spark, folder)
    rows = (v.stg_orders.filter("order_status IS DISTINCT FROM 'delivered'").select("order_id")
            .join(v.item_agg.select("order_id", "order_value"), "order_id", "left")
            .join(marts.mean_review(v.stg_reviews), "order_id", "left")
            .join(marts.largest_payment(v.stg_payments), "order_id", "left")
            .select("order_id", "order_value", "review_score", "payment_type", "installments",
                    F.lit(0).alias("was_late")))
    scored = model.score(fitted.pipeline, rows)
    return _rounded(scored.select("order_id", "prediction", "probability_repeat"),
                    "probability_repeat", digits=MODEL_DIGITS)


def _test_scores(spark, folder) -> DataFrame:
    """A label with a score made by a hash, to check the metrics apart from the solver."""
    u = hash_uniform("9|a|", F.col("order_id"))
    raw = F.floor((F.lit(0.8) * u + F.lit(0.2) * F.col("was_late")) * 1000) / F.lit(1000.0)
    return views(spark, folder).int_order_economics.select(
        F.col("was_late").alias("label"), raw.alias("score"),
        (raw >= 0.5).cast("int").alias("prediction"))


def confusion_matrix(spark, folder):
    return model.confusion_matrix(_test_scores(spark, folder), "label", "prediction")


def classification_report(spark, folder):
    matrix = model.confusion_matrix(_test_scores(spark, folder), "label", "prediction")
    return _rounded(model.classification_report(matrix), "precision", "recall", "f1_score", digits=9)


def roc_auc(spark, folder):
    auc = model.roc_auc(_test_scores(spark, folder), "label", "score")
    return spark.createDataFrame([(round(auc, 9),)], "roc_auc double")


# ----------------------------------------------------------------------- loader

def identity_map(spark, folder):
    return loader.identity_map(adapters.marketplace_files(spark, folder)["customers"])


def dedup_customers(spark, folder):
    return loader.dedup_customers(adapters.marketplace_files(spark, folder)["customers"])


def rekey_orders(spark, folder):
    market = adapters.marketplace_files(spark, folder)
    return loader.rekey_orders(market["orders"], loader.identity_map(market["customers"]))


def item_category(spark, folder):
    market = adapters.marketplace_files(spark, folder)
    return loader.item_category(market["order_items"], loader.product_categories(
        market["products"], market["translation"]))


def _market(spark, folder) -> dict[str, DataFrame]:
    return loader.load_marketplace(adapters.marketplace_files(spark, folder))


def validate_schema_missing(spark, folder):
    """The column check on tables of which one is missing and two lack a column."""
    raw = views(spark, folder).raw
    return files.check_report({
        "customers": raw["customers"], "orders": raw["orders"].drop("delivered_ts"),
        "order_items": raw["order_items"], "payments": raw["payments"].drop("payment_value")})


def _as_csv(raw) -> str:
    """Folder of CSV files with the rows of a table as text."""
    path = f"{scratch_folder(raw.sparkSession).rstrip('/')}/basketry-{uuid.uuid4().hex}"
    raw.select(*[F.col(c).cast("string") for c in raw.columns]).write.csv(path, header=True)
    return path


def csv_orders(spark, folder):
    """Orders written as CSV text and read from it, to staged rows."""
    path = _as_csv(views(spark, folder).raw["orders"])
    return RetailViews({"orders": files.typed(files.read_csv(spark, path), "orders")}).stg_orders


def csv_types(spark, folder):
    """Types of the columns of raw tables written as CSV text, by all their records."""
    rows = []
    for table, raw in views(spark, folder).raw.items():
        types = files.infer_types(files.read_csv(spark, _as_csv(raw)))
        rows += [(table, column, kind.simpleString()) for column, kind in types.items()]
    return spark.createDataFrame(rows, "table string, column string, type string")


def lr_report(spark, folder):
    """Report of the trained model on its test rows."""
    return _rounded(model.evaluate(_trained(spark, folder)[2]).report,
                    "precision", "recall", "f1_score", digits=9)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    **{name: _view(name) for name in (
        "stg_customers", "stg_orders", "stg_order_items", "stg_payments", "stg_reviews",
        "item_agg", "int_order_economics", "int_order_review", "int_customer_order_sequence",
        "fct_customers", "fct_orders", "late_vs_repeat", "first_order_features")},
    "fct_orders_order_grain": lambda s, f: views(s, f).fct_orders_at("order"),
    "payment_quality_counts": lambda s, f: quality.payment_quality_counts(views(s, f).stg_payments),
    "data_tests": data_tests,
    "amount_quality": amount_quality,
    "table_counts": lambda s, f: quality.table_counts(views(s, f).raw),
    "validate_schema": lambda s, f: files.check_report(views(s, f).raw),
    "validate_schema_missing": validate_schema_missing,
    "csv_orders": csv_orders,
    "csv_types": csv_types,
    "preview_customers": preview_customers,
    "eda_metrics": eda_metrics,
    "eda_json": eda_json,
    "order_histogram": lambda s, f: eda.order_histogram(_stored_values(s, f)),
    "order_value_kde": order_value_kde,
    "repeat_by_state": lambda s, f: eda.repeat_by_state(views(s, f).fct_customers),
    "repeat_by_state_top15": lambda s, f: eda.repeat_by_state(views(s, f).fct_customers, 15),
    "review_by_delivery": lambda s, f: eda.review_by_delivery(views(s, f).order_weights),
    "order_value_sketch": order_value_sketch,
    "late_and_on_time": late_and_on_time,
    "identity_map": identity_map,
    "dedup_customers": dedup_customers,
    "rekey_orders": rekey_orders,
    "item_category": item_category,
    "market_payments": lambda s, f: _market(s, f)["payments"],
    "market_reviews": lambda s, f: _market(s, f)["reviews"],
    "market_customers": lambda s, f: _market(s, f)["customers"],
    "ab_assignment": lambda s, f: _assigned(s, f).select("customer_id", "group"),
    "ab_outcome": ab_outcome,
    "ab_balance": ab_balance,
    "ab_counts": lambda s, f: experiment.group_counts(_experiment(s, f)),
    "ab_ztest": ab_ztest,
    "ab_business": ab_business,
    "ab_lift_sweep": lambda s, f: experiment.lift_sweep(
        experiment.assign_groups(_stored_customers(s, f))),
    "ab_report": lambda s, f: experiment.report(_experiment(s, f)),
    "features_imputed": features_imputed,
    "features_onehot": features_onehot,
    "split_train_test": split_train_test,
    "split_stratified": split_stratified,
    "features_scaled": features_scaled,
    "lr_coefficients": lr_coefficients,
    "lr_scores": lr_scores,
    "lr_report": lr_report,
    "score_new_orders": score_new_orders,
    "confusion_matrix": confusion_matrix,
    "classification_report": classification_report,
    "roc_auc": roc_auc,
}
