"""The given star-schema tables as retail raw tables and as marketplace files."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.columns import UNITS

# Columns used of the star tables; given here, no job has to look into the files for them.
STAR_SCHEMAS = {
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_extendedprice double, l_tax double",
    "part": "p_partkey bigint, p_type string",
}

# Order columns of the raw model as SQL over the star table (fixed values).
ORDER_COLUMNS = {
    "order_id": "o_orderkey",
    "customer_id": "o_custkey",
    "order_status": "CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' "
                    "ELSE 'processing' END",
    "purchase_ts": "o_orderdate",
    "approved_ts": "o_orderdate + INTERVAL 1 DAY",
    "estimated_delivery_ts": "o_orderdate + make_dt_interval(cast(7 + o_orderkey % 14 AS int))",
    "delivered_ts": "CASE WHEN o_orderstatus = 'F' AND o_orderkey % 50 <> 3 THEN o_orderdate "
                    "+ make_dt_interval(cast(3 + o_orderkey * 7 % 19 AS int), "
                    "cast(o_orderkey % 24 AS int)) END",
}


class Tables(Mapping):
    """Tables by name, each built when it is first asked for."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def star_tables(spark: SparkSession, folder: str) -> Tables:
    def reader(name: str) -> Callable[[], DataFrame]:
        return lambda: spark.read.schema(STAR_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")

    return Tables({name: reader(name) for name in STAR_SCHEMAS})


def raw_tables(spark: SparkSession, folder: str) -> Tables:
    """The five raw tables, with duplicates, doubtful payments and repeated reviews."""
    star = star_tables(spark, folder)
    return Tables({
        "customers": lambda: _customers(star),
        "orders": lambda: _with_copies(_orders(star)),
        "order_items": lambda: _items(star),
        "payments": lambda: _payments(star),
        "reviews": lambda: _reviews(star),
    })


def _customers(star: Tables) -> DataFrame:
    joined = star["customer"].join(star["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.selectExpr(
        "c_custkey AS customer_id", "concat('city_', c_nationkey) AS city",
        "CASE WHEN c_custkey % 20 = 0 THEN lower(n_name) ELSE n_name END AS state")


def _orders(star: Tables) -> DataFrame:
    return star["orders"].selectExpr(*[f"{sql} AS {name}" for name, sql in ORDER_COLUMNS.items()])


def _with_copies(orders: DataFrame) -> DataFrame:
    """Some rows twice, in one scan."""
    return orders.selectExpr(
        "*", "explode(CASE WHEN order_id % 67 = 0 THEN array(1, 2) ELSE array(1) END) AS copy"
    ).drop("copy")


def _items(star: Tables) -> DataFrame:
    # one row per part: the join goes away where the category is not read
    part = star["part"].groupBy("p_partkey").agg(F.max("p_type").alias("p_type"))
    joined = star["lineitem"].join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    return joined.selectExpr(
        "l_orderkey AS order_id", "l_linenumber AS item_no", "l_partkey AS product_id",
        "l_suppkey AS seller_id", "p_type AS category", "l_extendedprice AS price",
        f"floor(l_extendedprice * l_tax * {UNITS}D + 0.5D) / {UNITS}D AS freight_value")


def _payments(star: Tables) -> DataFrame:
    own = ("named_struct('payment_type', CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' "
           "WHEN '2-HIGH' THEN 'boleto' WHEN '3-MEDIUM' THEN 'voucher' "
           "WHEN '5-LOW' THEN 'debit_card' END, 'installments', cast(1 + o_orderkey % 10 AS int))")
    second = "named_struct('payment_type', 'voucher', 'installments', 1)"
    return star["orders"].selectExpr(
        "o_orderkey AS order_id",
        "CASE WHEN o_orderkey % 100 = 2 THEN NULL WHEN o_orderkey % 100 = 1 THEN -o_totalprice "
        "ELSE o_totalprice END AS payment_value",
        f"inline(CASE WHEN o_orderkey % 25 = 0 THEN array({own}, {second}) ELSE array({own}) END)",
    ).select("order_id", "payment_type", "installments", "payment_value")


def _reviews(star: Tables) -> DataFrame:
    return star["orders"].selectExpr(
        "o_orderkey AS order_id",
        "explode(concat(CASE WHEN o_orderkey % 12 <> 0 THEN array(cast(o_orderkey % 7 AS int)) "
        "ELSE cast(array() AS array<int>) END, "
        "CASE WHEN o_orderkey % 91 = 0 THEN array(5) ELSE cast(array() AS array<int>) END)) "
        "AS review_score")


def marketplace_files(spark: SparkSession, folder: str) -> Tables:
    """The same orders as marketplace files: every order has its own customer_id."""
    star, raw = star_tables(spark, folder), raw_tables(spark, folder)

    def customers() -> DataFrame:
        home = star["customer"].join(star["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
        joined = star["orders"].join(home, F.col("o_custkey") == F.col("c_custkey"), "left")
        return joined.selectExpr(
            "o_orderkey AS customer_id", "o_custkey AS customer_unique_id",
            "concat('city_', o_orderkey % 50) AS customer_city", "n_name AS customer_state")

    def orders() -> DataFrame:
        return _orders(star).selectExpr(
            "order_id", "order_id AS customer_id", "order_status",
            "purchase_ts AS order_purchase_timestamp", "approved_ts AS order_approved_at",
            "estimated_delivery_ts AS order_estimated_delivery_date",
            "delivered_ts AS order_delivered_customer_date")

    def products() -> DataFrame:
        return star["part"].selectExpr(
            "p_partkey AS product_id",
            "CASE WHEN p_partkey % 11 <> 0 THEN p_type END AS product_category_name")

    def translation() -> DataFrame:
        names = star["part"].select("p_type").distinct().filter("p_type <> 'ECONOMY'")
        return names.selectExpr("p_type AS product_category_name",
                                "concat('en_', lower(p_type)) AS product_category_name_english")

    return Tables({
        "customers": customers,
        "orders": orders,
        "order_items": lambda: raw["order_items"].drop("category").withColumnRenamed(
            "item_no", "order_item_id"),
        "products": products,
        "translation": translation,
        "payments": lambda: raw["payments"].withColumnRenamed(
            "installments", "payment_installments"),
        "reviews": lambda: raw["reviews"],
    })
