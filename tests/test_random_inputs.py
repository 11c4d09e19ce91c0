"""The views on random small raw tables, against SQL that joins as defined.

The tables have what the given data lacks: NULL and repeated ids, customers with
several rows and states, NULL times, orders with many reviews and payments.
"""

import datetime as dt
import random

import duckdb
import pytest

from basketry.operators.profile import KeyProfile
from basketry.plans.oracles import BODIES, DERIVED, with_views
from basketry.plans.views import RetailViews
from basketry.operators import eda
from oracle import _normal

VIEW_NAMES = ("int_order_economics", "int_order_review", "int_customer_order_sequence",
              "fct_customers", "fct_orders", "late_vs_repeat", "first_order_features")


def random_raw(seed: int, unique: bool) -> dict[str, list[tuple]]:
    r = random.Random(seed)
    start = dt.datetime(2020, 1, 1)
    ids = [f"o{i:02d}" for i in range(40)]
    customers = [(c, r.choice(["x", None]), r.choice(["sp", "SP", "rj", None]))
                 for c in [f"c{i}" for i in range(8)] for _ in range(r.choice([1, 1, 2, 3]))]
    customers.append((None, "x", "sp"))
    orders = []
    for k in range(60):
        if unique:
            if k >= len(ids):
                order_id = None
            else:
                order_id = ids[k]
        else:
            order_id = r.choice(ids[:25] + [None])
        customer = r.choice(["c0", "c0", "c0", None] + [f"c{i}" for i in range(10)])
        # distinct times: ties would leave the order of repeated ids open
        bought = None if unique and k % 17 == 5 and order_id else start + dt.timedelta(hours=7 * k)
        estimate = r.choice([None, start + dt.timedelta(hours=7 * k + 24 * r.randint(3, 9))])
        arrived = r.choice([None, start + dt.timedelta(hours=7 * k + r.randint(40, 260))])
        row = (order_id, customer, r.choice(["delivered"] * 5 + ["shipped", None]), bought, bought,
               estimate, arrived)
        orders += [row] * r.choice([1, 1, 1, 2])
    items = [(r.choice(ids[:30] + [None]), n, "p", "s", "k", r.choice([None, r.randint(1, 9999) / 100]),
              r.choice([None, r.randint(1, 99999) / 10000])) for n in range(80)]
    payments = [(r.choice(ids[:35] + ["o01"] * 9 + [None]), r.choice(["boleto", "card", None]),
                 r.choice([1, 2, None]), r.choice([None, -1.5, 0.0, 10.25])) for _ in range(70)]
    reviews = [(r.choice(ids[:35] + ["o02"] * 9 + ["o01"] * 3 + [None]), r.choice([0, 1, 3, 5, 6, None]))
               for _ in range(70)]
    return {"customers": customers, "orders": orders, "order_items": items, "payments": payments,
            "reviews": reviews}


SPARK_TYPES = {
    "customers": "customer_id string, city string, state string",
    "orders": "order_id string, customer_id string, order_status string, purchase_ts timestamp_ntz, "
              "approved_ts timestamp_ntz, estimated_delivery_ts timestamp_ntz, delivered_ts timestamp_ntz",
    "order_items": "order_id string, item_no int, product_id string, seller_id string, category string, "
                   "price double, freight_value double",
    "payments": "order_id string, payment_type string, installments int, payment_value double",
    "reviews": "order_id string, review_score int",
}
SQL_TYPES = {
    "customers": ("raw_customers", "customer_id VARCHAR, city VARCHAR, state VARCHAR"),
    "orders": ("raw_orders", "order_id VARCHAR, customer_id VARCHAR, order_status VARCHAR, "
               "purchase_ts TIMESTAMP, approved_ts TIMESTAMP, estimated_delivery_ts TIMESTAMP, "
               "delivered_ts TIMESTAMP"),
    "order_items": ("raw_items", "order_id VARCHAR, item_no INTEGER, product_id VARCHAR, "
                    "seller_id VARCHAR, category VARCHAR, price DECIMAL(12,2), freight_value DECIMAL(16,4)"),
    "payments": ("raw_payments", "order_id VARCHAR, payment_type VARCHAR, installments INTEGER, "
                 "payment_value DOUBLE"),
    "reviews": ("raw_reviews", "order_id VARCHAR, review_score INTEGER"),
}


def both(spark, raw):
    con = duckdb.connect()
    frames = {}
    for table, rows in raw.items():
        frames[table] = spark.createDataFrame(rows, SPARK_TYPES[table]).repartition(3)
        name, columns = SQL_TYPES[table]
        con.execute(f"CREATE TABLE {name} ({columns})")
        if rows:
            con.executemany(f"INSERT INTO {name} VALUES ({','.join('?' * len(rows[0]))})", rows)
    return frames, con


def assert_same(df, con, body):
    cursor = con.execute(with_views(body, DERIVED))
    expected = _normal([d[0] for d in cursor.description], cursor.fetchall())
    assert _normal(df.columns, df.collect()) == expected


@pytest.mark.parametrize("seed, unique, heavy_rows", [
    (1, True, 1_000_000), (1, False, 1_000_000), (2, True, 4), (2, False, 4)])
def test_views(spark, seed, unique, heavy_rows):
    frames, con = both(spark, random_raw(seed, unique))
    views = RetailViews(frames, heavy_rows=heavy_rows)
    assert views.profile.unique_orders is unique
    if heavy_rows == 4:
        assert views.profile.heavy_customers and views.profile.heavy_reviews
        assert views.profile.heavy_payments and (views.profile.heavy_orders or not unique)
        assert unique or views.profile.repeated_orders
    for name in VIEW_NAMES:
        assert_same(getattr(views, name), con, BODIES[name])
    assert_same(eda.review_by_delivery(views.order_weights), con, BODIES["review_by_delivery"])
    assert_same(eda.repeat_by_state(views.fct_customers), con, BODIES["repeat_by_state"])
    assert_same(eda.eda_metrics(views.order_weights, views.fct_customers), con, BODIES["eda_metrics"])
    assert_same(eda.order_histogram(views.order_weights), con, BODIES["order_histogram"])


def test_order_grain(spark):
    frames, con = both(spark, random_raw(3, True))
    assert_same(RetailViews(frames).fct_orders_at("order").filter("order_id IS NOT NULL"), con,
                BODIES["fct_orders_order_grain"])


def test_plans_agree_on_unique_ids(spark):
    """The plan for repeated ids is right for unique ids too."""
    frames, _ = both(spark, random_raw(4, True))
    fast = RetailViews(frames)
    general = RetailViews(frames, profile=KeyProfile(
        unique_orders=False, repeated_orders=[], heavy_orders=[], heavy_customers=[],
        heavy_reviews=[], heavy_payments=[]))
    for name in ("fct_customers", "fct_orders", "late_vs_repeat", "first_order_features"):
        a, b = getattr(fast, name), getattr(general, name)
        assert _normal(a.columns, a.collect()) == _normal(b.columns, b.collect())


def test_empty_tables(spark):
    frames, _ = both(spark, {name: [] for name in SPARK_TYPES})
    views = RetailViews(frames)
    for name in VIEW_NAMES:
        assert getattr(views, name).count() == 0
    assert eda.order_histogram(views.order_weights).count() == 0
    assert eda.order_value_kde(views.order_weights).count() == 0
    metrics = eda.eda_metrics(views.order_weights, views.fct_customers).first()
    assert tuple(metrics) == (0.0, None, None)


def test_results_do_not_depend_on_partitions(spark):
    frames, _ = both(spark, random_raw(5, True))
    results = []
    for n in (1, 64):
        views = RetailViews({t: df.repartition(n) for t, df in frames.items()})
        results.append([_normal(df.columns, df.collect()) for df in (
            views.fct_customers, views.fct_orders, views.late_vs_repeat)])
    assert results[0] == results[1]
