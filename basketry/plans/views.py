"""The view stack over one set of raw tables, built in order and only where used."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from basketry.operators import intermediate, marts, staging
from basketry.operators.profile import KeyProfile
from basketry.operators.skew import HEAVY_ROWS
from basketry.schemas import RAW_TABLES

VIEWS = ("stg_customers", "stg_orders", "stg_order_items", "stg_payments", "stg_reviews",
         "int_order_economics", "int_order_review", "int_customer_order_sequence",
         "fct_customers", "fct_orders")


# what the join of orders and items needs to know
_JOINED = ("heavy_orders", "repeated_orders")


class RetailViews:
    """Each view as a DataFrame; key facts are measured when a view first needs them."""

    def __init__(self, raw: dict[str, DataFrame], on_bad_ts: str = "raise",
                 heavy_rows: int = HEAVY_ROWS, profile: KeyProfile | None = None):
        # the views know the columns of the raw model only
        self.raw = {t: df.select([c for c in df.columns if c in RAW_TABLES[t].names]) if t in RAW_TABLES else df
                    for t, df in raw.items()}
        self._on_bad_ts = on_bad_ts
        self._heavy_rows = heavy_rows
        self._profile = profile

    @cached_property
    def profile(self) -> KeyProfile:
        if self._profile is not None:
            return self._profile
        return KeyProfile(self._delivered, lambda: self.stg_reviews, lambda: self.stg_payments,
                          self._heavy_rows)

    def _delivered(self) -> DataFrame:
        orders = staging.typed_orders(self.raw["orders"], self._on_bad_ts)
        return orders.filter("order_status = 'delivered'")

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.raw["customers"])

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.raw["orders"], self._on_bad_ts)

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return staging.stg_order_items(self.raw["order_items"])

    @cached_property
    def stg_payments(self) -> DataFrame:
        return staging.stg_payments(self.raw["payments"])

    @cached_property
    def stg_reviews(self) -> DataFrame:
        return staging.stg_reviews(self.raw["reviews"])

    @cached_property
    def item_agg(self) -> DataFrame:
        return intermediate.item_agg(self.stg_order_items)

    @cached_property
    def int_order_economics(self) -> DataFrame:
        self.profile.measure("heavy_orders", "repeated_orders")
        heavy = self.profile.heavy_orders + [k for k in self.profile.repeated_orders if k is not None]
        return intermediate.int_order_economics(self.stg_orders, self.stg_order_items, heavy)

    @cached_property
    def int_order_review(self) -> DataFrame:
        self.profile.measure("unique_orders", *_JOINED, "heavy_reviews", "heavy_payments")
        return intermediate.int_order_review(
            self.int_order_economics, self.stg_reviews, self.stg_payments,
            self.profile.unique_orders, self.profile.heavy_reviews, self.profile.heavy_payments)

    @cached_property
    def int_customer_order_sequence(self) -> DataFrame:
        self.profile.measure(*_JOINED, "heavy_customers")
        return intermediate.int_customer_order_sequence(
            self.int_order_economics, self.profile.heavy_customers)

    @cached_property
    def fct_customers(self) -> DataFrame:
        self.profile.measure("unique_orders", *_JOINED)
        return marts.fct_customers(self.stg_customers, self.int_order_economics,
                                   self.stg_reviews, self.profile)

    @cached_property
    def fct_orders(self) -> DataFrame:
        return self.fct_orders_at("row")

    def fct_orders_at(self, grain: str) -> DataFrame:
        facts = ["unique_orders", *_JOINED, "heavy_customers"]
        if grain == "row":
            facts += ["heavy_reviews", "heavy_payments"]
        self.profile.measure(*facts)
        return marts.fct_orders(self.int_order_economics, self.stg_reviews, self.stg_payments,
                                self.profile, grain)

    @cached_property
    def order_weights(self) -> DataFrame:
        self.profile.measure("unique_orders", *_JOINED)
        return marts.order_weights(self.int_order_economics, self.stg_reviews,
                                   self.stg_payments, self.profile)

    @cached_property
    def late_vs_repeat(self) -> DataFrame:
        self.profile.measure("unique_orders", *_JOINED)
        return marts.late_vs_repeat(self.int_order_economics, self.stg_reviews,
                                    self.stg_payments, self.profile)

    @cached_property
    def first_order_features(self) -> DataFrame:
        self.profile.measure("unique_orders", "heavy_reviews", "heavy_payments")
        if not self.profile.unique_orders:
            return marts.first_order_features_by_definition(self.fct_orders, self.fct_customers)
        delivered = intermediate.delivered_orders(self.stg_orders)
        return marts.first_order_features(self.stg_customers, delivered, self.stg_order_items,
                                          self.stg_reviews, self.stg_payments, self.profile)

    def register(self, spark: SparkSession) -> None:
        """All views as temporary views of the session."""
        for name in VIEWS:
            getattr(self, name).createOrReplaceTempView(name)
