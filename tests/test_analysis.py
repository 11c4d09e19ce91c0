"""Experiment analysis and the repeat-purchase model."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.operators import experiment, features, model

CUSTOMER = "customer_id string, is_repeat_customer int, avg_order_value double, lifetime_value double"


def customers(spark, n=2000, share=0.3):
    r = random.Random(2)
    return spark.createDataFrame(
        [(f"c{i}", int(r.random() < share), r.choice([None, 50 + 10 * r.random()]), 100.0 + i % 7)
         for i in range(n)], CUSTOMER)


def outcomes(spark, rows):
    return spark.createDataFrame(rows, "group string, outcome int, avg_order_value double, "
                                       "lifetime_value double")


def test_assignment_does_not_depend_on_partitions(spark):
    df = customers(spark)
    a = experiment.assign_groups(df.repartition(1)).select("customer_id", "group").collect()
    b = experiment.assign_groups(df.repartition(16)).select("customer_id", "group").collect()
    assert sorted(a) == sorted(b)
    assert 900 < sum(r.group == "control" for r in a) < 1100


def test_outcome_probability_is_clipped(spark):
    assigned = experiment.assign_groups(customers(spark, share=0.999))
    treated = experiment.simulate_outcome(assigned, lift_pp=50).filter("group = 'treatment'")
    assert treated.agg(F.min("outcome")).first()[0] == 1
    none = experiment.simulate_outcome(assigned, lift_pp=-100).filter("group = 'treatment'")
    assert none.agg(F.max("outcome")).first()[0] == 0


def test_z_test_and_business_case(spark, tmp_path):
    rows = ([("treatment", 1, 10.0, 200.0)] * 60 + [("treatment", 0, 10.0, 200.0)] * 40
            + [("control", 1, 10.0, None)] * 40 + [("control", 0, 10.0, 200.0)] * 60)
    r = experiment.business_case(outcomes(spark, rows)).first()
    assert r.treatment_rate == 0.6 and r.control_rate == 0.4
    assert r.z_stat == pytest.approx(0.2 / math.sqrt(0.25 * 0.02))
    assert r.p_value == pytest.approx(0.5 * math.erfc(r.z_stat / math.sqrt(2)))
    assert r.incremental_revenue == pytest.approx(20 * 200.0)
    assert r.discount_cost == pytest.approx(0.1 * 100 * 10.0)
    assert r.recommend_ship is True
    figures = experiment.report(outcomes(spark, rows))
    found = {(x.section, x.name): x.value for x in figures.collect()}
    assert found["result", "lift_pp"] == "20.00" and found["decision", "ship"] == "true"
    experiment.write_report(figures, str(tmp_path / "report"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "report")).collect()]
    assert len(lines) == 11 and lines[-1] == "decision ship: true"


def test_without_treated_customers_there_is_no_result(spark):
    r = experiment.business_case(outcomes(spark, [("control", 1, 10.0, 5.0)])).first()
    assert (r.treatment_rate, r.z_stat, r.p_value, r.recommend_ship) == (None, None, None, False)
    assert experiment.balance_test(outcomes(spark, [("control", 1, 10.0, 5.0)])).first().t_stat is None


def test_balance_test_leaves_nulls_out(spark):
    rows = [("control", 0, v, 1.0) for v in (1.0, 2.0, 3.0, None)]
    rows += [("treatment", 0, v, 1.0) for v in (2.0, 4.0, 6.0, 8.0)]
    r = experiment.balance_test(outcomes(spark, rows)).first()
    pooled = (2 * 1.0 + 3 * 20 / 3) / 5
    assert (r.n_control, r.n_treatment) == (3, 4)
    assert r.t_stat == pytest.approx((2.0 - 5.0) / math.sqrt(pooled * (1 / 3 + 1 / 4)))
    assert r.balanced is True


def test_sweep_equals_single_runs(spark):
    assigned = experiment.assign_groups(customers(spark))
    sweep = {(r.lift_pp, r.group): (r.n, r.successes) for r in experiment.lift_sweep(assigned).collect()}
    assert len(sweep) == 42
    for lift in (0.0, 4.0, 10.0):
        for r in experiment.group_counts(experiment.simulate_outcome(assigned, lift)).collect():
            assert sweep[lift, r.group] == (r.n, r.successes)


# ------------------------------------------------------------------------ model

FEATURES = ("order_id string, order_value double, was_late int, review_score int, payment_type string, "
            "installments int, is_repeat_customer int")


@pytest.fixture(scope="module")
def rows():
    r = random.Random(4)
    out = []
    for i in range(1500):
        value, late, score = r.gauss(100, 30), int(r.random() < 0.4), r.choice([None, 1, 2, 3, 4, 5])
        pay = r.choice(["boleto", "card", "voucher", None])
        label = int(r.random() < 1 / (1 + math.exp(-(0.02 * (value - 100) - late + (pay == "card") + 0.8))))
        out.append((f"o{i}", value if i % 50 else None, late, score, pay, r.choice([None, 1, 2, 6]), label))
    return out


def test_coefficients_solve_the_penalised_problem(spark, rows):
    df = spark.createDataFrame(rows, FEATURES)
    fitted, scored = model.train(df)
    prep = features.learn(df)
    encoded = features.encode(df, prep)
    assert prep.categories == ("boleto", "card", "unknown", "voucher")
    assert fitted.columns == prep.columns
    train = features.standardise(encoded, *features.moments(prep)).filter("split = 'train'").toPandas()
    x = np.column_stack([np.ones(len(train)), train[list(prep.columns)].to_numpy()])
    assert np.allclose(x[:, 1:].mean(axis=0), 0, atol=1e-9) and np.allclose(x[:, 1:].std(axis=0), 1)
    y = train["is_repeat_customer"].to_numpy().astype(float)
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    penalty = np.eye(x.shape[1])
    penalty[0, 0] = 0
    w = np.zeros(x.shape[1])
    for _ in range(50):  # Newton steps on sum(weight * loss) + |w|²/2
        p = 1 / (1 + np.exp(-x @ w))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + penalty,
                               x.T @ (weight * (p - y)) + penalty @ w)
        w -= step
    assert np.allclose(fitted.coefficients, w[1:], atol=1e-4)
    assert fitted.intercept == pytest.approx(w[0], abs=1e-4)
    ranked = model.coefficients(spark, fitted).orderBy("rank").collect()
    assert [abs(r.coefficient) for r in ranked] == sorted((abs(c) for c in fitted.coefficients), reverse=True)
    assert scored.count() == encoded.filter("split = 'test'").count()


def test_auc_equals_pairs(spark):
    r = random.Random(5)
    data = [(int(r.random() < 0.4), round(r.random(), 1)) for _ in range(200)]
    df = spark.createDataFrame(data, "is_repeat_customer int, probability_repeat double")
    pos, neg = [s for y, s in data if y], [s for y, s in data if not y]
    expected = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)
    assert model.roc_auc(df) == pytest.approx(expected, abs=1e-12)
    flipped = df.withColumn("probability_repeat", 1 - F.col("probability_repeat"))
    assert model.roc_auc(flipped) == pytest.approx(1 - expected, abs=1e-12)


def test_report_with_an_empty_class(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 0)], "is_repeat_customer int, prediction int")
    matrix = model.confusion_matrix(df)
    assert tuple(matrix.first()) == (0, 0, 1, 2)
    report = {r["class"]: tuple(r)[1:] for r in model.classification_report(matrix).collect()}
    assert report["not_repeat"] == (0.0, 0.0, 0.0, 0)
    assert report["repeat"] == (1.0, pytest.approx(2 / 3), 0.8, 3)
    assert report["accuracy"][0] == pytest.approx(2 / 3)


def test_constant_feature_and_single_category(spark, rows):
    df = spark.createDataFrame([(*r[:2], 0, r[3], "card", 1, r[6]) for r in rows[:300]], FEATURES)
    fitted, _ = model.train(df)
    assert fitted.columns == features.NUMBERS
    constant = dict(zip(fitted.columns, fitted.coefficients))
    assert constant["was_late"] == 0.0 and constant["installments"] == 0.0


def test_unseen_categories_score_like_the_first(spark, rows, tmp_path):
    fitted, _ = model.train(spark.createDataFrame(rows, FEATURES))
    new = spark.createDataFrame([(f"n{i}", 90.0, 0, 4, pay, 1, 0) for i, pay in enumerate(["boleto", "new", None, "card"])],
                                FEATURES)
    model.save(fitted, str(tmp_path / "a"))
    (tmp_path / "a").rename(tmp_path / "moved")
    for pipeline in (fitted.pipeline, model.load(str(tmp_path / "moved"))):
        p = {r.order_id: r.probability_repeat for r in model.score(pipeline, new).collect()}
        assert p["n0"] == p["n1"] and len(set(p.values())) == 3


def test_any_number_of_categories(spark, rows, monkeypatch):
    """100,000 categories are sparse vectors: the plan is that of four, and no names reach the driver."""
    few = spark.createDataFrame(rows, FEATURES)
    many = spark.range(150_000).selectExpr(
        "concat('o', id) AS order_id", "double(pmod(xxhash64(id), 1000)) AS order_value", "int(id % 3 = 0) AS was_late",
        "int(id % 5 + 1) AS review_score", "concat('type', id % 100000) AS payment_type", "int(id % 4) AS installments",
        "int(pmod(xxhash64(id, 1), 3) = 0) AS is_repeat_customer")
    monkeypatch.setattr(model, "TOLERANCE", 1e-3)
    size = {}
    for name, df in (("few", few), ("many", many)):
        fitted, scored = model.train(df)
        size[name] = len(scored._jdf.queryExecution().optimizedPlan().toString())
        assert len(fitted.coefficients) == len(features.NUMBERS) + fitted.prep.n_slots
    assert fitted.prep.n_slots == 99_999
    assert size["many"] < 1.2 * size["few"]
    with pytest.raises(ValueError, match="do not become columns"):
        fitted.columns
    ranked = model.coefficients(spark, fitted)
    assert ranked.count() == 100_003 and ranked.filter("rank = 1").first().feature is not None


def test_split_share_and_stability(spark, rows):
    df = spark.createDataFrame(rows, FEATURES)
    split = features.split(df)
    share = split.groupBy("is_repeat_customer").agg(F.avg((F.col("split") == "train").cast("int")).alias("s"))
    assert all(0.7 < r.s < 0.8 for r in share.collect())
    assert split.filter("split = 'train'").count() == features.split(df.repartition(9)).filter(
        "split = 'train'").count()


def test_exact_split(spark, rows):
    df = spark.createDataFrame(rows, FEATURES)
    for r in features.split_exactly(df).groupBy("is_repeat_customer").agg(
            F.count("*").alias("n"), F.count(F.when(F.col("split") == "test", 1)).alias("test")).collect():
        assert r.test == math.ceil(0.25 * r.n)
