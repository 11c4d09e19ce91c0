"""Sketches against exact answers, within their stated bounds."""

import random

import pytest
from pyspark.sql import functions as F

from basketry.operators import sketches


@pytest.mark.parametrize("k", [64, 4096])
def test_quantiles_of_merged_parts_are_within_the_bound(spark, k):
    r = random.Random(k)
    values = [r.choice([r.gauss(100, 30), r.expovariate(0.01), 50.0]) for _ in range(20000)] + [None] * 50
    rows = spark.createDataFrame([(v, i % 7) for i, v in enumerate(values)], "order_value double, part int")
    parts = sketches.quantile_sketches(rows, part=F.col("part"), k=k)
    assert parts.count() == 7
    estimates = sketches.quantiles(parts, [0.0, 0.01, 0.5, 0.9, 1.0])
    checked = sketches.check_quantiles(estimates, rows, "order_value", sketches.rank_error(k)).collect()
    assert len(checked) == 5 and all(c.within and c.n == 20000 for c in checked)
    # the check can fail
    wrong = estimates.withColumn("value", F.col("value") + 60)
    assert not all(c.within for c in sketches.check_quantiles(wrong, rows, "order_value", 0.01).collect())
    whole = sketches.quantiles(sketches.quantile_sketches(rows, k=k), [0.5]).first()
    assert whole.n == 20000
    assert sketches.quantiles(sketches.quantile_sketches(rows.limit(0)), [0.5]).collect() == []


@pytest.mark.parametrize("log2", [9, 16])
def test_distinct_customers_by_delivery(spark, log2):
    r = random.Random(log2)
    orders = [(f"c{r.randrange(6000)}", int(r.random() < 0.4)) for _ in range(12000)] + [(None, 1), ("lone", 1)]
    state = {f"c{i}": "ab"[i % 2] for i in range(6000)} | {"lone": "z"}
    sketched = sketches.customer_sketches(
        spark.createDataFrame(orders, "customer_id string, was_late int"),
        spark.createDataFrame([*state.items(), *list(state.items())[:9], (None, "a")], "customer_id string, state string"), log2)
    by_state = {row.state: row for row in sketches.late_and_on_time(sketched, log2=log2).collect()}
    by_state["all"] = sketches.late_and_on_time(sketched, by_state=False, log2=log2).first()
    for name, row in by_state.items():
        late, on_time = ({c for c, x in orders if c and x == v and name in (state[c], "all")} for v in (1, 0))
        error = sketches.distinct_error(log2) * len(late | on_time) if log2 < 12 else 0
        for got, want in ((row.n_late, late), (row.n_on_time, on_time), (row.n_both, late & on_time), (row.n_either, late | on_time)):
            assert abs(got - len(want)) <= error, name
