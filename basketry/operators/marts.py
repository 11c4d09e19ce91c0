"""Marts: customer facts, order facts, and the first-order features built on them.

Two plans give the same rows. Where every order_id is one order (measured, see
KeyProfile), the order sequence needs no join back on order_id and reviews are
aggregated per order before anything is joined, so a customer or order with very
many rows is reduced before its rows meet. Otherwise the joins are kept as they
are defined, since repeated order ids multiply rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import PARTS, parts_sql, ratio, round_ratio, round_total, wide_sql
from basketry.operators.intermediate import (
    int_customer_order_sequence,
    int_order_review,
    item_agg,
    with_reviews_and_payments,
)
from basketry.operators.profile import KeyProfile
from basketry.operators.skew import expand_join, lookup_join, number_rows

ORDER_COLUMNS = ("order_id", "customer_id", "order_value", "was_late", "review_score",
                 "payment_type", "installments", "payment_quality_flag", "order_seq_num",
                 "is_repeat_order")


def review_totals(reviews: DataFrame) -> DataFrame:
    """Per order: number of reviews and sum of scores."""
    return reviews.filter("order_id IS NOT NULL").groupBy("order_id").agg(
        F.count("*").alias("n_reviews"),
        F.expr("sum(CAST(review_score AS BIGINT))").alias("score_sum"))


def payment_counts(payments: DataFrame) -> DataFrame:
    return payments.filter("order_id IS NOT NULL").groupBy("order_id").agg(
        F.count("*").alias("n_payments"))


# ---------------------------------------------------------------- customer facts

def fct_customers(customers: DataFrame, economics: DataFrame, reviews: DataFrame,
                  profile: KeyProfile) -> DataFrame:
    """One row per customer, state and number of delivered orders."""
    if profile.unique_orders:
        totals = _customer_totals(economics, reviews, profile)
    else:
        totals = _customer_totals_by_definition(economics, reviews, profile)
    copies = customers.filter("customer_id IS NOT NULL").groupBy("customer_id", "state").agg(
        F.count("*").alias("copies"))
    return copies.join(totals, "customer_id").select(
        "customer_id", "state", "lifetime_order_count",
        F.expr("CASE WHEN lifetime_order_count > 1 THEN 1 ELSE 0 END").alias("is_repeat_customer"),
        round_total(*_VALUE, "1", "value_rows", 2).alias("avg_order_value"),
        round_total(*_VALUE, "copies", "1", 2).alias("lifetime_value"),
        round_ratio("late_rows * 100", "all_rows", 1).alias("pct_orders_late"),
        round_ratio("score_sum", "n_reviews", 2).alias("avg_review_score"),
        "first_purchase_ts", "last_purchase_ts",
    )


_VALUE = tuple(f"value_{part}" for part in PARTS)


def _value_sums(times: str) -> dict[str, str]:
    """Sums of the parts of order_value, each `times` as often."""
    units, rest, odd = parts_sql("order_value")
    return {"value_units": f"sum({wide_sql(units)} * {times})",
            "value_rest": f"sum({rest} * CAST({times} AS DECIMAL(10,0)))", "value_odd": f"sum({odd} * {times})"}


# Sums per customer over orders that count `n` times each.
_CUSTOMER_SUMS = {
    **_value_sums("n"),
    "value_rows": "sum(CASE WHEN order_value IS NOT NULL THEN n ELSE 0 END)",
    "late_rows": "sum(was_late * n)",
    "all_rows": "sum(n)",
    "first_purchase_ts": "min(CASE WHEN n > 0 THEN purchase_ts END)",
    "last_purchase_ts": "max(CASE WHEN n > 0 THEN purchase_ts END)",
}


def _sums(expressions: dict[str, str]) -> list[Column]:
    return [F.expr(sql).alias(name) for name, sql in expressions.items()]


def _customer_totals(economics: DataFrame, reviews: DataFrame, profile: KeyProfile) -> DataFrame:
    """Sums per customer; an order counts once per review, as in a join with reviews.

    An order without an id is in no join, so it adds to the number of orders only.
    """
    reviewed = lookup_join(economics.filter("customer_id IS NOT NULL"), review_totals(reviews),
                           "order_id", profile.heavy_orders)
    counted = reviewed.withColumn("n", F.expr(
        "CASE WHEN order_id IS NULL THEN 0 ELSE greatest(coalesce(n_reviews, 0), 1) END"))
    return counted.groupBy("customer_id").agg(*_sums({
        "lifetime_order_count": "count(*)", **_CUSTOMER_SUMS,
        **_value_sums("nullif(n, 0)"),
        "score_sum": "sum(score_sum)",
        "n_reviews": "coalesce(sum(n_reviews), 0)",
    })).filter("all_rows > 0")


def _customer_totals_by_definition(economics: DataFrame, reviews: DataFrame,
                                   profile: KeyProfile) -> DataFrame:
    """The same sums where an order_id has several rows, each of which meets the others."""
    sequence = int_customer_order_sequence(economics, profile.heavy_customers)
    lifetimes = (sequence.filter("order_id IS NOT NULL")
                 .groupBy("order_id", "lifetime_order_count")
                 .agg(F.count("*").alias("matches")))
    heavy = profile.repeated_orders
    # every id has lifetimes, so those without rows here are orders without a customer
    met = expand_join(lifetimes, economics, "order_id", heavy, left_is_unique=False).filter(
        "customer_id IS NOT NULL")
    counted = lookup_join(met, review_totals(reviews), "order_id", heavy).withColumn(
        "n", F.expr("matches * greatest(coalesce(n_reviews, 0), 1)"))
    return counted.groupBy("customer_id", "lifetime_order_count").agg(*_sums({
        **_CUSTOMER_SUMS,
        "score_sum": "sum(score_sum * matches)",
        "n_reviews": "coalesce(sum(n_reviews * matches), 0)",
    }))


# ------------------------------------------------------------------- order facts

def fct_orders(economics: DataFrame, reviews: DataFrame, payments: DataFrame,
               profile: KeyProfile, grain: str = "row") -> DataFrame:
    """One row per order, review and payment; with grain="order" one per order.

    At order grain the review score is the mean of the order's scores, and the
    payment is the one with the largest value.
    """
    if grain not in ("row", "order"):
        raise ValueError("grain is 'row' or 'order'")
    if grain == "order":
        reviews, payments = mean_review(reviews), largest_payment(payments)
    heavy_reviews = profile.heavy_reviews if grain == "row" else []
    heavy_payments = profile.heavy_payments if grain == "row" else []
    if profile.unique_orders:
        numbered = number_rows(
            economics.select("order_id", "customer_id", "purchase_ts", "order_value", "was_late"),
            "customer_id", "purchase_ts", "order_id", profile.heavy_customers,
        ).filter("order_id IS NOT NULL").drop(
            "purchase_ts", "prev_order_ts", "lifetime_order_count")
        rows = with_reviews_and_payments(numbered, reviews, payments, True,
                                         heavy_reviews, heavy_payments)
    else:
        sequence = int_customer_order_sequence(economics, profile.heavy_customers)
        reviewed = int_order_review(economics, reviews, payments, False, heavy_reviews, heavy_payments)
        # every id is in the sequence, so the left join is the inner one
        rows = expand_join(reviewed.filter("order_id IS NOT NULL"),
                           sequence.select("order_id", "order_seq_num"), "order_id",
                           profile.repeated_orders, left_is_unique=False)
    return rows.selectExpr(*ORDER_COLUMNS[:-1],
                           "CASE WHEN order_seq_num > 1 THEN 1 ELSE 0 END AS is_repeat_order")


def mean_review(reviews: DataFrame) -> DataFrame:
    return review_totals(reviews).select(
        "order_id", ratio(F.col("score_sum"), F.col("n_reviews")).alias("review_score"))


def largest_payment(payments: DataFrame) -> DataFrame:
    """Per order the payment of the largest value; ties go to the larger type and installments."""
    best = F.max(F.struct("payment_value", "payment_type", "installments",
                          "payment_quality_flag")).alias("best")
    return payments.filter("order_id IS NOT NULL").groupBy("order_id").agg(best).select(
        "order_id", "best.payment_type", "best.installments", "best.payment_value",
        "best.payment_quality_flag")


def order_weights(economics: DataFrame, reviews: DataFrame, payments: DataFrame,
                  profile: KeyProfile) -> DataFrame:
    """fct_orders folded to orders: how many rows it has, how many with a score, their sum.

    Every sum over fct_orders that needs neither payment columns nor the sequence
    can be taken from these few columns, without the fan-out. An order without an
    id is in no row of fct_orders and has n_rows = 0. purchase_ts is NULL where ids repeat.
    """
    if not profile.unique_orders:
        rows = fct_orders(economics, reviews, payments, profile)
        return rows.selectExpr(
            "order_id", "customer_id", "CAST(NULL AS TIMESTAMP_NTZ) AS purchase_ts", "order_value",
            "was_late", "1L AS n_rows",
            "CAST(review_score IS NOT NULL AS BIGINT) AS score_rows",
            "CAST(coalesce(review_score, 0) AS BIGINT) AS score_sum")
    paid = "CASE WHEN order_id IS NULL THEN 0 ELSE greatest(coalesce(n_payments, 0), 1) END"
    reviewed = lookup_join(economics, review_totals(reviews), "order_id", profile.heavy_orders)
    return (lookup_join(reviewed, payment_counts(payments), "order_id", profile.heavy_orders)
            .selectExpr("order_id", "customer_id", "purchase_ts", "order_value", "was_late",
                        f"greatest(coalesce(n_reviews, 0), 1) * {paid} AS n_rows",
                        f"coalesce(n_reviews, 0) * {paid} AS score_rows",
                        f"coalesce(score_sum, 0) * {paid} AS score_sum"))


def first_order(*carry: str) -> Column:
    """Aggregate: a group's first order (NULL time last, then id) with the `carry` columns.

    It has a partial step and needs no window, so no customer is too large for it.
    """
    columns = ", ".join(("purchase_ts", "order_id", *carry))
    return F.expr(f"min(struct(purchase_ts IS NULL AS undated, {columns}))").alias("first")


def late_vs_repeat(economics: DataFrame, reviews: DataFrame, payments: DataFrame,
                   profile: KeyProfile) -> DataFrame:
    """By late flag: customers, share of repeat orders in percent, mean review."""
    if profile.unique_orders:
        totals = _late_totals(order_weights(economics, reviews, payments, profile))
    else:
        totals = fct_orders(economics, reviews, payments, profile).groupBy("was_late").agg(
            F.countDistinct("customer_id").alias("customers"),
            F.sum("is_repeat_order").alias("repeats"),
            F.count("*").alias("n_rows"),
            F.sum("review_score").alias("score_sum"),
            F.count("review_score").alias("score_rows"))
    return totals.select(
        "was_late", "customers",
        round_ratio("repeats * 100", "n_rows", 1).alias("repeat_rate_pct"),
        round_ratio("score_sum", "score_rows", 2).alias("avg_review_score"))


def _late_totals(weights: DataFrame) -> DataFrame:
    """Fold orders to customers, then customers to the two delivery classes."""
    classes = ((0, "on_time"), (1, "late"))
    customers = weights.groupBy("customer_id").agg(first_order("was_late", "n_rows"), *_sums({
        f"{name}_{measure}": f"sum(CASE WHEN was_late = {flag} THEN {measure} END)"
        for flag, name in classes for measure in ("n_rows", "score_rows", "score_sum")}))
    per_class = [
        f"named_struct('was_late', {flag}, "
        f"'customers', count(CASE WHEN {name}_n_rows > 0 THEN customer_id END), "
        f"'repeats', sum({name}_n_rows) - sum(CASE WHEN first.was_late = {flag} "
        f"THEN first.n_rows ELSE 0 END), "
        f"'n_rows', sum({name}_n_rows), 'score_sum', sum({name}_score_sum), "
        f"'score_rows', coalesce(sum({name}_score_rows), 0))"
        for flag, name in classes]
    return (customers.agg(F.expr(f"array({', '.join(per_class)})").alias("classes"))
            .selectExpr("inline(classes)").filter("n_rows > 0"))


# ---------------------------------------------------------- first-order features

def first_order_features(customers: DataFrame, delivered: DataFrame, items: DataFrame,
                         reviews: DataFrame, payments: DataFrame,
                         profile: KeyProfile) -> DataFrame:
    """Each customer's first order with the label is_repeat_customer.

    Only values known after the first order; no lifetime sums (they give the label
    away). Equals fct_orders ⋈ fct_customers where order_seq_num = 1, for unique
    order ids.
    """
    first = (delivered.filter("customer_id IS NOT NULL").groupBy("customer_id")
             .agg(first_order("was_late"), F.count("*").alias("lifetime_order_count"))
             .select("customer_id", "first.order_id", "first.was_late", "lifetime_order_count")
             .filter("order_id IS NOT NULL"))
    states = customers.select("customer_id", "state").distinct()
    known = first.join(states, "customer_id")
    values = item_agg(items.filter("order_id IS NOT NULL")).select("order_id", "order_value")
    valued = known.join(values, "order_id", "left")
    # several states per customer repeat an order: no broadcast of the left side
    rows = with_reviews_and_payments(valued, reviews, payments, False,
                                     profile.heavy_reviews, profile.heavy_payments)
    return rows.selectExpr(
        "order_id", "customer_id", "order_value", "was_late", "review_score", "payment_type",
        "installments", "state",
        "CASE WHEN lifetime_order_count > 1 THEN 1 ELSE 0 END AS is_repeat_customer")


def first_order_features_by_definition(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """The same from the two marts, for order ids that repeat."""
    return (orders.filter("order_seq_num = 1")
            .join(customers.select("customer_id", "state", "is_repeat_customer"), "customer_id")
            .select("order_id", "customer_id", "order_value", "was_late", "review_score",
                    "payment_type", "installments", "state", "is_repeat_customer"))
