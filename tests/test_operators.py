"""Single operators on literal rows."""

import datetime as dt
import decimal
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from basketry.functions import stats
from basketry.functions.columns import hash_uniform, round_ratio
from basketry.operators import eda, intermediate, quality, skew, staging
from basketry.operators.quantile import exact_medians

DAY = dt.datetime(2021, 3, 10)


def orders(spark, rows):
    full = [(f"o{i}", "c1", status, DAY, DAY, estimate, arrived)
            for i, (status, estimate, arrived) in enumerate(rows)]
    return spark.createDataFrame(
        full, "order_id string, customer_id string, order_status string, purchase_ts timestamp_ntz, "
              "approved_ts timestamp_ntz, estimated_delivery_ts timestamp_ntz, delivered_ts timestamp_ntz")


def test_delivery_delta_and_late_flag(spark):
    days = [-1.5, -0.5, 0, 0.5, 1.5]
    rows = [("delivered", DAY, DAY + dt.timedelta(days=d)) for d in days]
    rows += [("delivered", DAY, None), ("delivered", None, DAY), ("shipped", DAY, DAY)]
    got = (intermediate.delivered_orders(orders(spark, rows)).orderBy("order_id")
           .select("delivery_delta_days", "was_late").collect())
    assert [tuple(r) for r in got] == [(-1, 0), (0, 0), (0, 0), (0, 1), (1, 1), (None, 0), (None, 0)]


def test_item_totals_with_missing_freight(spark):
    items = spark.createDataFrame(
        [("a", 10.0, None), ("a", 5.25, 1.5), ("b", None, None)],
        "order_id string, price double, freight_value double")
    got = {r.order_id: tuple(r)[1:] for r in intermediate.item_agg(items).collect()}
    assert got == {"a": (2, 15.25, 1.5, 6.75), "b": (1, None, None, None)}


def test_timestamps_from_text(spark):
    rows = [("o1", "c", "delivered", "2020-01-01 10:00:00.25", "2020-01-02", "x", None)]
    raw = spark.createDataFrame(rows, "order_id string, customer_id string, order_status string, "
                                      "purchase_ts string, approved_ts string, "
                                      "estimated_delivery_ts string, delivered_ts string")
    got = staging.stg_orders(raw, on_bad_ts="null").first()
    assert got.purchase_ts == dt.datetime(2020, 1, 1, 10, 0, 0, 250000)
    assert got.approved_ts == dt.datetime(2020, 1, 2) and got.estimated_delivery_ts is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stg_orders(raw).collect()
    with pytest.raises(ValueError):
        staging.stg_orders(raw, on_bad_ts="drop")


def test_payment_flags_and_review_filter(spark):
    payments = spark.createDataFrame([("a", "x", 1, v) for v in (-0.01, 0.0, None)],
                                     "order_id string, payment_type string, installments int, "
                                     "payment_value double")
    flags = sorted(r.payment_quality_flag for r in staging.stg_payments(payments).collect())
    assert flags == ["missing_value", "negative_value", "ok"]
    reviews = spark.createDataFrame([("a", s) for s in (0, 1, 5, 6, None)],
                                    "order_id string, review_score int")
    assert sorted(r.review_score for r in staging.stg_reviews(reviews).collect()) == [1, 5]


@pytest.mark.parametrize("numerator, denominator, digits, expected", [
    (1005, 1000, 2, 1.01), (1, 8, 2, 0.13), (-1, 8, 2, -0.13), (2, 3, 1, 0.7), (5, 0, 2, None),
    (None, 3, 2, None), (0, 3, 2, 0.0)])
def test_round_ratio(spark, numerator, denominator, digits, expected):
    df = spark.createDataFrame([(numerator, denominator)], "a bigint, b bigint")
    assert df.select(round_ratio("a", "b", digits)).first()[0] == expected


def test_hash_uniform_is_uniform_and_stable(spark):
    u = spark.range(4000).select(hash_uniform("7|g|", F.col("id")).alias("u"))
    mean, low, high = u.agg(F.avg("u"), F.min("u"), F.max("u")).first()
    assert 0 <= low and high < 1 and abs(mean - 0.5) < 0.02
    assert u.repartition(7).agg(F.min("u")).first()[0] == low


# ------------------------------------------------------------------ heavy keys

def test_heavy_keys_with_null(spark):
    df = spark.createDataFrame([(k,) for k in [1] * 5 + [None] * 4 + [2] * 2], "k int")
    assert skew.heavy_keys(df, "k", 4) == [1, None]
    assert skew.heavy_keys(df, "k", 6) == []


@pytest.mark.parametrize("heavy", [[], ["a"], ["a", None], ["a", "b"]])
@pytest.mark.parametrize("unique", [True, False])
def test_expand_join_equals_left_join(spark, heavy, unique):
    left = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4)], "k string, x int")
    right = spark.createDataFrame([("a", i) for i in range(6)] + [("b", 7), (None, 8), ("d", 9)],
                                  "k string, y int")
    expected = sorted(left.join(right, "k", "left").collect(), key=str)
    got = skew.expand_join(left, right, "k", heavy, unique).select("k", "x", "y").collect()
    assert sorted(got, key=str) == expected


@pytest.mark.parametrize("heavy", [[], ["a"], ["a", None]])
def test_lookup_join_equals_left_join(spark, heavy):
    left = spark.createDataFrame([("a", i) for i in range(6)] + [("b", 7), (None, 8)], "k string, x int")
    lookup = spark.createDataFrame([("a", 10), ("c", 11)], "k string, y int")
    expected = sorted(left.join(lookup, "k", "left").collect(), key=str)
    assert sorted(skew.lookup_join(left, lookup, "k", heavy).collect(), key=str) == expected


def test_heavy_groups_are_numbered_over_slices(spark):
    r = random.Random(1)
    rows = [(f"o{i:04d}", r.choice(["hot", "hot", None, "a", "b"]),
             r.choice([None] + [DAY + dt.timedelta(days=d) for d in range(9)])) for i in range(400)]
    df = spark.createDataFrame(rows, "order_id string, customer_id string, purchase_ts timestamp_ntz")
    arguments = ("customer_id", "purchase_ts", "order_id")
    plain = skew.number_rows(df, *arguments, [])
    sliced = skew.number_rows(df, *arguments, ["hot", None])
    assert sorted(sliced.collect(), key=str) == sorted(plain.collect(), key=str)
    assert len(set(plain.filter("customer_id = 'hot'").select("order_seq_num").collect())) > 100


def test_heavy_plan_has_no_window_per_heavy_group(spark):
    df = spark.createDataFrame([("o", "c", DAY)], "order_id string, customer_id string, "
                                                  "purchase_ts timestamp_ntz")
    numbered = skew._number_by_slices(df, "customer_id", "purchase_ts", "order_id")
    assert [c for c in numbered.columns] == [*df.columns, "order_seq_num", "prev_order_ts",
                                             "lifetime_order_count"]


# --------------------------------------------------------------------- medians

@pytest.mark.parametrize("values", [
    [3.0, 1.0, 2.0], [4.0, 1.0, 3.0, 2.0], [5.0] * 50 + [1.0] * 50, [None, 7.0],
    [float(i * 37 % 1009) for i in range(1000)], [1.0] * 70 + [float(i) for i in range(60)]])
def test_exact_median(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    expected = statistics.median([v for v in values if v is not None])
    assert exact_medians(df, "v")["v"] == expected


def test_median_of_nothing(spark):
    assert exact_medians(spark.createDataFrame([(None,)], "v double"), "v") == {"v": None}


# ------------------------------------------------------------------- summaries

def weights(spark, values):
    return spark.createDataFrame([(v, n) for v, n in values], "order_value double, n_rows bigint")


def test_histogram_of_one_value(spark):
    rows = eda.order_histogram(weights(spark, [(7.0, 3)]), bins=4).orderBy("bin_no").collect()
    assert [r["count"] for r in rows] == [0, 0, 3, 0]
    assert rows[0]["bin"] == "7-7"


def test_histogram_keeps_empty_bins_and_closes_the_last(spark):
    rows = eda.order_histogram(weights(spark, [(0.0, 1), (10.0, 2), (None, 5)]), bins=5)
    assert [r["count"] for r in rows.orderBy("bin_no").collect()] == [1, 0, 0, 0, 2]


def test_curve_equals_brute_force(spark):
    r = random.Random(3)
    values = [(r.gauss(100, 15), r.choice([1, 1, 2])) for _ in range(300)]
    flat = [v for v, n in values for _ in range(n)]
    h = len(flat) ** -0.2 * statistics.stdev(flat)
    rows = eda.order_value_kde(weights(spark, values), points=30, bins=40).orderBy("point_no").collect()
    assert len(rows) == 30
    low, high = min(flat), max(flat)
    for row in rows:
        x = low + row.point_no * (high - low) / 29
        density = sum(math.exp(-0.5 * ((x - v) / h) ** 2) for v in flat) / (h * math.sqrt(2 * math.pi))
        assert row.x == pytest.approx(x)
        assert row.density == pytest.approx(density * (high - low) / 40, rel=1e-4, abs=1e-6)


def test_curve_of_one_value_has_no_points(spark):
    assert eda.order_value_kde(weights(spark, [(5.0, 9)])).count() == 0


def test_states_without_name_are_left_out(spark):
    customers = spark.createDataFrame([("SP", 1), ("SP", 0), ("RJ", 1), (None, 1)],
                                      "state string, is_repeat_customer int")
    assert [tuple(r) for r in eda.repeat_by_state(customers).collect()] == [("RJ", 100.0), ("SP", 50.0)]
    assert eda.repeat_by_state(customers, top=1).count() == 1


def test_records_are_json(spark):
    record = eda.to_records("s", spark.createDataFrame([("a", 1)], "x string, n int")).first()
    assert tuple(record) == ("s", '{"x":"a","n":1}')


def test_data_tests_can_fail(spark):
    payments = spark.createDataFrame([("ok",)], "payment_quality_flag string")
    raw = spark.createDataFrame([(1,), (2,)], "x int")
    economics = spark.createDataFrame([("a",), ("a",)], "order_id string")
    customers = spark.createDataFrame([("c",), ("c",)], "customer_id string")
    orders_ = spark.createDataFrame([(-1.0,)], "order_value double")
    groups = spark.createDataFrame([(5,)], "n bigint")
    results = {r.test: (r.value, r.passed) for r in quality.data_tests(
        raw, payments, economics, customers, orders_, groups).collect()}
    assert results == {
        "fct_orders is not empty": (1, True),
        "fct_orders has no negative order_value": (1, False),
        "fct_customers is not empty": (2, True),
        "fct_customers has one row per customer": (1, False),
        "int_order_economics has unique order_id": (1, False),
        "payment flags add up to the raw payments": (-1, False),
        "experiment groups add up to all customers": (3, False),
    }
    empty = {r.test: r.passed for r in quality.data_tests(
        raw, payments, economics, customers.limit(0), orders_.limit(0), groups).collect()}
    assert not empty["fct_orders is not empty"] and not empty["fct_customers is not empty"]


# ---------------------------------------------------------- tail probabilities

@pytest.mark.parametrize("z, p", [(0.0, 0.5), (1.6448536269514722, 0.05), (-1.0, 0.8413447460685429)])
def test_normal_tail(z, p):
    assert stats.normal_upper_tail(z) == pytest.approx(p, abs=1e-12)


@pytest.mark.parametrize("t, dof, p", [
    (2.0, 10, 0.07338803477074039), (-2.0, 10, 0.07338803477074039), (0.0, 5, 1.0),
    (1.0, 1, 0.5), (12.706204736432095, 1, 0.05), (1.959963984540054, 1e9, 0.05)])
def test_t_tail(t, dof, p):
    assert stats.t_two_sided(t, dof) == pytest.approx(p, abs=1e-9)


@pytest.mark.parametrize("dof", [3, 57, 4000, 300_000])
def test_t_tail_equals_integral(dof):
    t, steps = 1.3, 4000
    front = math.exp(math.lgamma((dof + 1) / 2) - math.lgamma(dof / 2)) / math.sqrt(dof * math.pi)
    density = [front * (1 + (t * k / steps) ** 2 / dof) ** (-(dof + 1) / 2) for k in range(steps + 1)]
    area = (density[0] + density[-1] + 4 * sum(density[1:-1:2]) + 2 * sum(density[2:-1:2])) * t / steps / 3
    assert stats.t_two_sided(t, dof) == pytest.approx(1 - 2 * area, abs=1e-8)


@pytest.mark.parametrize("amount", [float("nan"), float("inf"), float("-inf"), 1e18])
def test_odd_amounts_give_themselves(spark, amount):
    items = spark.createDataFrame([("o", amount, 1.0), ("o", 2.0, 3.0)], "order_id string, price double, freight_value double")
    row = intermediate.item_agg(items).first()
    assert str(row.merchandise_value) == str(amount + 2.0) and str(row.order_value) == str(amount + 6.0)
    assert row.freight_value == 4.0
    found = quality.amount_quality([("items", items, "price")]).first()
    assert (found.n_not_finite, found.passed) == ((0, True) if amount == 1e18 else (1, False))


def test_sums_cut_no_digits(spark):
    rows = [("a", 0.00004, None)] * 3 + [("b", -0.00005, 0.0), ("c", None, 1.0), ("d", 1e14, 1e-9), ("d", -1e14, 2e-9)]
    rows += [("e", 0.1, 0.2), ("f", 0.1234567890123456, 0.5), ("f", 1.0, -0.1234567890123456)]
    items = spark.createDataFrame(rows, "order_id string, price double, freight_value double")
    got = {r.order_id: (r.merchandise_value, r.freight_value, r.order_value)
           for r in intermediate.item_agg(items.repartition(3)).collect()}
    assert got == {"a": (0.00012, None, None), "b": (-0.00005, 0.0, -0.00005), "c": (None, 1.0, None),
                   "d": (0.0, 3e-9, 3e-9), "e": (0.1, 0.2, 0.3), "f": (1.1234567890123457, 0.3765432109876544, 1.5)}


def test_sums_do_not_depend_on_row_order(spark):
    r = random.Random(6)
    amounts = [r.choice([r.uniform(0, 1e-4), r.uniform(0, 100), round(r.uniform(0, 1e6), 2)]) for _ in range(2000)]
    exact = sum(map(decimal.Decimal, map(repr, amounts)))
    for seed in range(3):
        r.shuffle(amounts)
        items = spark.createDataFrame([("o", a, 0.0) for a in amounts], "order_id string, price double, freight_value double")
        assert intermediate.item_agg(items.repartition(seed + 1)).first().order_value == float(exact)


def test_salted_join_keeps_every_match_of_equal_rows(spark):
    left = spark.createDataFrame([("a", i) for i in range(3)] + [("b", 9)], "k string, x int")
    right = spark.createDataFrame([("a", 1)] * 50 + [("b", 2)], "k string, y int")
    got = skew.expand_join(left, right, "k", ["a"], False).groupBy("k", "x").count().collect()
    assert {tuple(r) for r in got} == {("a", 0, 50), ("a", 1, 50), ("a", 2, 50), ("b", 9, 1)}
