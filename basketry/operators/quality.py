"""Data tests on the raw tables and the marts, and counts per table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import parts_sql


def payment_quality_counts(payments: DataFrame) -> DataFrame:
    return payments.groupBy("payment_quality_flag").agg(F.count("*").alias("n_payments"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, n_rows) of each table."""
    counts = [df.agg(F.lit(name).alias("table"), F.count("*").alias("n_rows"))
              for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def table_digests(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, n_rows, total, mixed) of each table: equal for equal rows, in any order and partitioning."""
    def digest(name: str, df: DataFrame) -> DataFrame:
        cells = [c for column in df.columns for c in (F.col(f"`{column}`"), F.col(f"`{column}`").isNull())]
        row = F.xxhash64(F.lit(",".join(f"{c} {t}" for c, t in df.dtypes)), *cells)
        return df.agg(F.lit(name).alias("table"), F.count("*").alias("n_rows"),
                      F.coalesce(F.sum(row.cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias("total"),
                      F.coalesce(F.bit_xor(row), F.lit(0)).alias("mixed"))

    return reduce(DataFrame.unionByName, [digest(*item) for item in tables.items()])


def amount_quality(columns: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """(amount, n_rows, n_missing, n_not_finite, n_fine, passed) of each (table's name, table, column).

    Not finite are NaN and infinity, which the test does not pass; fine are amounts with more digits
    than ten-thousandths, which sums keep.
    """
    def count(condition: str) -> Column:
        return F.count(F.when(F.expr(condition), 1))

    parts = []
    for name, df, column in columns:
        _, rest, _ = parts_sql(column)
        odd = count(f"isnan({column}) OR abs({column}) = double('infinity')")
        parts.append(df.agg(F.lit(f"{name}.{column}").alias("amount"), F.count("*").alias("n_rows"),
                            count(f"{column} IS NULL").alias("n_missing"), odd.alias("n_not_finite"),
                            count(f"({rest}) IS NOT NULL").alias("n_fine"), (odd == 0).alias("passed")))
    return reduce(DataFrame.unionByName, parts)


def _result(test: str, value: Column, passed: Column) -> Column:
    return F.struct(F.lit(test).alias("test"), F.coalesce(value, F.lit(0)).cast("long").alias("value"),
                    passed.alias("passed"))


def data_tests(raw_payments: DataFrame, payments: DataFrame, economics: DataFrame,
               customers: DataFrame, orders: DataFrame, groups: DataFrame) -> DataFrame:
    """(test, value, passed); each test can fail.

    `groups` has one row per experiment group with its size n.
    """
    def failures(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0))

    n = F.count("*")
    on_orders = orders.agg(F.array(
        _result("fct_orders is not empty", n, n > 0),
        _result("fct_orders has no negative order_value", failures(F.col("order_value") < 0),
                failures(F.col("order_value") < 0) == 0)).alias("r"))

    per_customer = customers.groupBy("customer_id").agg(n.alias("n"))
    repeated = failures(F.col("n") > 1)
    on_customers = per_customer.agg(F.array(
        _result("fct_customers is not empty", F.sum("n"), F.coalesce(F.sum("n"), F.lit(0)) > 0),
        _result("fct_customers has one row per customer", repeated, repeated == 0)).alias("r"))

    ids = economics.groupBy("order_id").agg(n.alias("n"))
    on_economics = ids.agg(F.array(
        _result("int_order_economics has unique order_id", repeated, repeated == 0)).alias("r"))

    flagged = payment_quality_counts(payments).agg(F.sum("n_payments").alias("a"))
    raw = raw_payments.agg(n.alias("b"))
    on_payments = _compare("payment flags add up to the raw payments", flagged, raw)

    sizes = groups.agg(F.sum("n").alias("a"))
    subjects = customers.agg(n.alias("b"))
    on_groups = _compare("experiment groups add up to all customers", sizes, subjects)

    parts = [on_orders, on_customers, on_economics, on_payments, on_groups]
    return reduce(DataFrame.unionByName, parts).select(F.inline("r"))


def _compare(test: str, left: DataFrame, right: DataFrame) -> DataFrame:
    """A test that two one-row totals `a` and `b` are equal; the value is the difference."""
    both = left.select("a", F.lit(None).cast("long").alias("b")).unionByName(
        right.select(F.lit(None).cast("long").alias("a"), "b"))
    gap = F.coalesce(F.sum("a"), F.lit(0)) - F.coalesce(F.sum("b"), F.lit(0))
    return both.agg(F.array(_result(test, gap, gap == 0)).alias("r"))
