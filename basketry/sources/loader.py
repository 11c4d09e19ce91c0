"""Marketplace files (order-level customer keys, product categories) to the raw model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators.skew import expand_join, heavy_keys, lookup_join
from basketry.schemas import RAW_TABLES
from basketry.sources.files import InputError, as_type, read_csv, route

NO_CATEGORY = "other"
# Columns that the loader needs of each marketplace file (fixed values).
MARKETPLACE_COLUMNS: dict[str, tuple[str, ...]] = {
    "customers": ("customer_id", "customer_unique_id"),
    "orders": ("order_id", "customer_id", "order_status"),
    "order_items": ("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"),
    "payments": ("order_id", "payment_type", "payment_installments", "payment_value"),
    "reviews": ("order_id", "review_score"),
    "products": ("product_id", "product_category_name"),
    "translation": ("product_category_name", "product_category_name_english"),
}
OPTIONAL_FILES = {"products", "translation"}


def identity_map(customers: DataFrame) -> DataFrame:
    """Distinct pairs of order-level customer_id and the person's customer_unique_id."""
    return customers.select("customer_id", "customer_unique_id").distinct()


def dedup_customers(customers: DataFrame) -> DataFrame:
    """One row per person: city and state of the smallest customer_id."""
    def column(name: str) -> Column:
        return F.col(name) if name in customers.columns else F.lit(None).cast("string")

    first = F.min(F.struct("customer_id", column("customer_city").alias("city"),
                           column("customer_state").alias("state"))).alias("first")
    return (customers.groupBy(F.col("customer_unique_id")).agg(first)
            .select(F.col("customer_unique_id").alias("customer_id"), "first.city", "first.state"))


def rekey_orders(orders: DataFrame, identities: DataFrame) -> DataFrame:
    """Orders of known customers under the person's id; absent time columns are NULL.

    Customers with very many orders are split.
    """
    def column(source: str, name: str) -> Column:
        found = F.col(source) if source in orders.columns else F.lit(None).cast("string")
        return found.alias(name)

    joined = expand_join(identities, orders, "customer_id", heavy_keys(orders, "customer_id"),
                         left_is_unique=False, how="inner")
    return joined.select(
        "order_id", F.col("customer_unique_id").alias("customer_id"), "order_status",
        column("order_purchase_timestamp", "purchase_ts"),
        column("order_approved_at", "approved_ts"),
        column("order_estimated_delivery_date", "estimated_delivery_ts"),
        column("order_delivered_customer_date", "delivered_ts"))


def product_categories(products: DataFrame, translation: DataFrame) -> DataFrame:
    """(product_id, category): translated name, else the product's own, else 'other'.

    A product or name that occurs twice gets the largest, so reruns agree.
    """
    names = translation.filter(F.col("product_category_name").isNotNull()).groupBy(
        "product_category_name").agg(F.max("product_category_name_english").alias("english"))
    heavy = heavy_keys(products, "product_category_name")
    named = lookup_join(products.select("product_id", "product_category_name"), names,
                        "product_category_name", heavy)
    category = F.coalesce("english", "product_category_name", F.lit(NO_CATEGORY))
    return named.groupBy("product_id").agg(F.max(category).alias("category"))


def item_category(items: DataFrame, categories: DataFrame | None) -> DataFrame:
    """Order items of the raw model with their product's category, 'other' if unknown."""
    if categories is None:
        own = (F.col("product_category_name") if "product_category_name" in items.columns
               else F.lit(NO_CATEGORY))
        found = items.withColumn("category", own)
    else:
        found = lookup_join(items, categories, "product_id", heavy_keys(items, "product_id"))
        found = found.withColumn("category", F.coalesce("category", F.lit(NO_CATEGORY)))
    return found.select("order_id", F.col("order_item_id").alias("item_no"), "product_id",
                        "seller_id", "category", "price", "freight_value")


def payments(source: DataFrame) -> DataFrame:
    return source.select("order_id", "payment_type",
                         F.col("payment_installments").alias("installments"), "payment_value")


def reviews(source: DataFrame) -> DataFrame:
    return source.select("order_id", "review_score")


def read_marketplace(spark: SparkSession, paths: list[str]) -> dict[str, DataFrame]:
    """The raw model from a marketplace's CSV files; raises InputError with all reasons at once.

    Products and translation may be absent, but not one without the other.
    """
    routed, errors = route(paths, tuple(MARKETPLACE_COLUMNS))
    files = {name: read_csv(spark, path) for name, path in routed.items()}
    optional = set() if OPTIONAL_FILES & set(files) else OPTIONAL_FILES
    for name, columns in MARKETPLACE_COLUMNS.items():
        if name in files:
            errors += [f"{routed[name]} lacks the column {c}" for c in columns
                       if c not in files[name].columns]
        elif name not in optional:
            errors.append(f"no file for the table {name}")
    if errors:
        raise InputError(errors)
    return load_marketplace(files)


def load_marketplace(files: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The raw model from the marketplace tables.

    `files` holds customers, orders, order_items, payments and reviews, and
    optionally products with translation.
    """
    categories = None
    if "products" in files and "translation" in files:
        categories = product_categories(files["products"], files["translation"])
    raw = {
        "customers": dedup_customers(files["customers"]),
        "orders": rekey_orders(files["orders"], identity_map(files["customers"])),
        "order_items": item_category(files["order_items"], categories),
        "payments": payments(files["payments"]),
        "reviews": reviews(files["reviews"]),
    }
    return {
        table: df.select(*[as_type(F.col(f.name), f.dataType).alias(f.name)
                           for f in RAW_TABLES[table]])
        for table, df in raw.items()
    }
