"""Staging views: one function per raw table, cleaning only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ORDER_TIMES = ("purchase_ts", "approved_ts", "estimated_delivery_ts", "delivered_ts")


def stg_customers(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", "city", F.upper("state").alias("state"))


def typed_orders(orders: DataFrame, on_bad_ts: str = "raise") -> DataFrame:
    """Orders with timestamps; text that is no timestamp raises, or is NULL with "null"."""
    if on_bad_ts not in ("raise", "null"):
        raise ValueError("on_bad_ts is 'raise' or 'null'")

    cast = "CAST" if on_bad_ts == "raise" else "TRY_CAST"
    return orders.selectExpr(
        "order_id", "customer_id", "order_status",
        *[f"{cast}({name} AS TIMESTAMP_NTZ) AS {name}" for name in ORDER_TIMES])


def stg_orders(orders: DataFrame, on_bad_ts: str = "raise") -> DataFrame:
    """Typed orders without exact copies; copies collapse before the shuffle."""
    return typed_orders(orders, on_bad_ts).distinct()


def stg_order_items(items: DataFrame) -> DataFrame:
    return items.selectExpr(
        "order_id", "item_no", "product_id", "seller_id", "category",
        "CAST(price AS DOUBLE) AS price", "CAST(freight_value AS DOUBLE) AS freight_value",
    )


def stg_payments(payments: DataFrame) -> DataFrame:
    """Payments, all kept; doubtful amounts are flagged."""
    return payments.selectExpr(
        "order_id", "payment_type", "installments", "payment_value",
        "CASE WHEN payment_value IS NULL THEN 'missing_value' "
        "WHEN payment_value < 0 THEN 'negative_value' ELSE 'ok' END AS payment_quality_flag")


def stg_reviews(reviews: DataFrame) -> DataFrame:
    """Reviews with a score of 1 to 5; others and NULL are dropped."""
    return reviews.select("order_id", "review_score").filter("review_score BETWEEN 1 AND 5")
