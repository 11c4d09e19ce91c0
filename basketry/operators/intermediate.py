"""Intermediate views: order economics, order reviews, customer order sequence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import PARTS, parts_sql, total_sql
from basketry.operators.skew import expand_join, lookup_join, number_rows


def item_agg(items: DataFrame) -> DataFrame:
    """Per order: rows, price, freight, and price plus freight (NULL freight adds nothing).

    Sums are exact and then the nearest double. NaN and infinity give themselves.
    """
    parts = [f"{sql} AS {c}_{part}" for c in ("price", "freight_value")
             for part, sql in zip(PARTS, parts_sql(c))]
    rows = items.selectExpr("order_id", "price", "freight_value", *parts)
    rests = "price_rest IS NOT NULL OR freight_value_rest IS NOT NULL"
    sums = {
        "merchandise": [f"price_{part}" for part in PARTS],
        "freight": [f"freight_value_{part}" for part in PARTS],
        # an item whose price or freight is odd is odd as a whole
        "order": ["price_units + freight_value_units",
                  f"CASE WHEN price_units + freight_value_units IS NOT NULL AND ({rests}) "
                  "THEN coalesce(price_rest, 0) + coalesce(freight_value_rest, 0) END",
                  "coalesce(price_odd + freight_value, price + freight_value_odd)"],
    }
    totals = [F.expr(f"sum({sql})").alias(f"{name}_{part}") for name, three in sums.items()
              for part, sql in zip(PARTS, three)]
    values = [F.expr(total_sql(*(f"{name}_{part}" for part in PARTS))).alias(f"{name}_value") for name in sums]
    return rows.groupBy("order_id").agg(F.count("*").alias("n_items"), *totals).select("order_id", "n_items", *values)


def delivered_orders(orders: DataFrame) -> DataFrame:
    """Delivered orders with delivery delta in whole days and the late flag."""
    return orders.filter("order_status = 'delivered'").selectExpr(
        "order_id", "customer_id", "order_status", "purchase_ts", "estimated_delivery_ts",
        "delivered_ts",
        "CAST(extract(DAY FROM delivered_ts - estimated_delivery_ts) AS INT) AS delivery_delta_days",
        "CASE WHEN delivered_ts > estimated_delivery_ts THEN 1 ELSE 0 END AS was_late",
    )


def int_order_economics(orders: DataFrame, items: DataFrame,
                        heavy_orders: Sequence = ()) -> DataFrame:
    """Delivered orders with their item totals; orders without items keep NULLs."""
    totals = item_agg(items.filter(F.col("order_id").isNotNull()))
    return lookup_join(delivered_orders(orders), totals, "order_id", heavy_orders).select(
        "order_id", "customer_id", "order_status", "purchase_ts", "estimated_delivery_ts",
        "delivered_ts", "n_items", "merchandise_value", "freight_value", "order_value",
        "delivery_delta_days", "was_late",
    )


def with_reviews_and_payments(orders: DataFrame, reviews: DataFrame, payments: DataFrame,
                              unique_orders: bool, heavy_reviews: Sequence = (),
                              heavy_payments: Sequence = ()) -> DataFrame:
    """orders ⟕ reviews ⟕ payments on order_id, each match its own row.

    All three joins of an order share one partitioning by order_id.
    """
    reviewed = expand_join(orders, reviews, "order_id", heavy_reviews, unique_orders)
    paid = payments.select("order_id", "payment_type", "installments", "payment_quality_flag")
    # after the first join an order may have several rows: no broadcast in the second
    return expand_join(reviewed, paid, "order_id", heavy_payments, left_is_unique=False)


def int_order_review(economics: DataFrame, reviews: DataFrame, payments: DataFrame,
                     unique_orders: bool = False, heavy_reviews: Sequence = (),
                     heavy_payments: Sequence = ()) -> DataFrame:
    """Orders with their reviews and payments; the fan-out is kept."""
    orders = economics.select("order_id", "customer_id", "order_value", "was_late")
    return with_reviews_and_payments(orders, reviews, payments, unique_orders, heavy_reviews,
                                     heavy_payments).select(
        "order_id", "customer_id", "order_value", "was_late", "review_score",
        "payment_type", "installments", "payment_quality_flag")


def int_customer_order_sequence(economics: DataFrame, heavy_customers: Sequence = ()) -> DataFrame:
    """Each customer's orders numbered by time, with the time before and the count."""
    rows = economics.select("order_id", "customer_id", "purchase_ts", "order_value")
    numbered = number_rows(rows, "customer_id", "purchase_ts", "order_id", heavy_customers)
    return numbered.select("order_id", "customer_id", "purchase_ts", "order_value",
                           "order_seq_num", "prev_order_ts", "lifetime_order_count")
