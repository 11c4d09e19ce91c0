"""Raw model: the five input tables, their types, and which columns are required."""

from __future__ import annotations

from pyspark.sql import types as T

# Column types of the raw model. Timestamps arrive as ISO text.
RAW_TABLES: dict[str, T.StructType] = {
    "customers": T.StructType([
        T.StructField("customer_id", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
    ]),
    "orders": T.StructType([
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("order_status", T.StringType()),
        T.StructField("purchase_ts", T.StringType()),
        T.StructField("approved_ts", T.StringType()),
        T.StructField("estimated_delivery_ts", T.StringType()),
        T.StructField("delivered_ts", T.StringType()),
    ]),
    "order_items": T.StructType([
        T.StructField("order_id", T.StringType()),
        T.StructField("item_no", T.IntegerType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("seller_id", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("freight_value", T.DoubleType()),
    ]),
    "payments": T.StructType([
        T.StructField("order_id", T.StringType()),
        T.StructField("payment_type", T.StringType()),
        T.StructField("installments", T.IntegerType()),
        T.StructField("payment_value", T.DoubleType()),
    ]),
    "reviews": T.StructType([
        T.StructField("order_id", T.StringType()),
        T.StructField("review_score", T.IntegerType()),
    ]),
}

# Columns an upload must have (fixed values). The views also read the other
# columns of RAW_TABLES; those are reported as "needed_by_view".
REQUIRED_COLUMNS: dict[str, tuple[str, ...]] = {
    "customers": ("customer_id", "city", "state"),
    "orders": ("order_id", "customer_id", "order_status"),
    "order_items": ("order_id", "item_no", "price"),
    "payments": ("order_id", "payment_type", "payment_value"),
    "reviews": ("order_id", "review_score"),
}

# Result columns of the two marts, used for empty results.
FCT_CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("lifetime_order_count", T.LongType()),
    T.StructField("is_repeat_customer", T.IntegerType()),
    T.StructField("avg_order_value", T.DoubleType()),
    T.StructField("lifetime_value", T.DoubleType()),
    T.StructField("pct_orders_late", T.DoubleType()),
    T.StructField("avg_review_score", T.DoubleType()),
    T.StructField("first_purchase_ts", T.TimestampNTZType()),
    T.StructField("last_purchase_ts", T.TimestampNTZType()),
])
FCT_ORDERS = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("order_value", T.DoubleType()),
    T.StructField("was_late", T.IntegerType()),
    T.StructField("review_score", T.IntegerType()),
    T.StructField("payment_type", T.StringType()),
    T.StructField("installments", T.IntegerType()),
    T.StructField("payment_quality_flag", T.StringType()),
    T.StructField("order_seq_num", T.LongType()),
    T.StructField("is_repeat_order", T.IntegerType()),
])
