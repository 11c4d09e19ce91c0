"""Promotion experiment: assignment, simulated outcome, tests and cost/benefit.

The analysis functions take any table with (customer_id, group, outcome,
avg_order_value, lifetime_value), simulated or not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import clip01, from_units, hash_uniform, ratio, units_sql, wide_sql
from basketry.functions.stats import normal_upper_tail_col, t_two_sided_col

SEED = 7
DEFAULT_LIFT_PP = 4.0
DISCOUNT_RATE = 0.10
SIGNIFICANCE = 0.05
SWEEP_PP = tuple(step * 0.5 for step in range(21))


def _treated() -> Column:
    return F.col("group") == "treatment"


def assign_groups(customers: DataFrame, seed: int = SEED) -> DataFrame:
    """Half of the customers to each group, by a hash of the id: reruns agree."""
    u = hash_uniform(f"{seed}|g|", F.col("customer_id"))
    return customers.withColumn("group", F.when(u < 0.5, "control").otherwise("treatment"))


def base_rate(customers: DataFrame) -> Column:
    """Share of repeat customers, as a scalar subquery."""
    return customers.agg(
        ratio(F.sum("is_repeat_customer"), F.count("is_repeat_customer"))).scalar()


def simulate_outcome(assigned: DataFrame, lift_pp: float = DEFAULT_LIFT_PP,
                     seed: int = SEED) -> DataFrame:
    """Add outcome 0/1: repeat with the base rate, raised by `lift_pp` when treated."""
    p = base_rate(assigned) + F.when(_treated(), lift_pp / 100.0).otherwise(0.0)
    u = hash_uniform(f"{seed}|o|", F.col("customer_id"))
    return assigned.withColumn("outcome", F.when(u < clip01(p), 1).otherwise(0))


def group_counts(experiment: DataFrame) -> DataFrame:
    """Size and successes of each group; a rate's base is its own group."""
    return experiment.groupBy("group").agg(
        F.count("outcome").alias("n"), F.sum("outcome").alias("successes"))


def balance_test(experiment: DataFrame) -> DataFrame:
    """One row: means before treatment and the pooled two-sided t-test of their difference."""
    known = experiment.filter(F.col("avg_order_value").isNotNull())

    def of(group: str, column: str) -> Column:
        return F.max(F.when(F.col("group") == group, F.col(column)))

    per_group = known.groupBy("group").agg(
        F.count("*").alias("n"), F.avg("avg_order_value").alias("mean"),
        F.coalesce(F.var_samp("avg_order_value"), F.lit(0.0)).alias("variance"))
    one = per_group.agg(
        of("control", "n").alias("n_control"), of("treatment", "n").alias("n_treatment"),
        of("control", "mean").alias("mean_control"), of("treatment", "mean").alias("mean_treatment"),
        of("control", "variance").alias("v_control"), of("treatment", "variance").alias("v_treatment"))
    n0, n1 = F.col("n_control"), F.col("n_treatment")
    dof = n0 + n1 - 2
    pooled = ratio((n0 - 1) * F.col("v_control") + (n1 - 1) * F.col("v_treatment"), dof)
    spread = F.sqrt(pooled * (ratio(F.lit(1), n0) + ratio(F.lit(1), n1)))
    return (one.withColumn("t_stat", ratio(F.col("mean_control") - F.col("mean_treatment"), spread))
            .withColumn("p_value", t_two_sided_col("t_stat", dof.cast("double")))
            .select("n_control", "n_treatment", "mean_control", "mean_treatment", "t_stat",
                    "p_value", (F.col("p_value") > SIGNIFICANCE).alias("balanced")))


def _rates(experiment: DataFrame, *extra: Column) -> DataFrame:
    """One row: sizes, successes and the `extra` aggregates, in one pass."""
    def among(condition: Column, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, value)), F.lit(0))

    control, outcome = F.col("group") == "control", F.col("outcome")
    counted = outcome.isNotNull().cast("long")
    return experiment.agg(
        among(_treated(), counted).alias("n_treatment"), among(control, counted).alias("n_control"),
        among(_treated(), outcome).alias("successes_treatment"),
        among(control, outcome).alias("successes_control"), *extra)


def _with_z(rates: DataFrame) -> DataFrame:
    """Add rates, lift, z and the one-sided p-value (treatment larger)."""
    n1, n0 = F.col("n_treatment"), F.col("n_control")
    s1, s0 = F.col("successes_treatment"), F.col("successes_control")
    pooled = ratio(s1 + s0, n1 + n0)
    spread = F.sqrt(pooled * (1 - pooled) * (ratio(F.lit(1), n1) + ratio(F.lit(1), n0)))
    return (rates.withColumn("treatment_rate", ratio(s1, n1)).withColumn("control_rate", ratio(s0, n0))
            .withColumn("absolute_lift_pp", (F.col("treatment_rate") - F.col("control_rate")) * 100)
            .withColumn("z_stat", ratio(F.col("treatment_rate") - F.col("control_rate"), spread))
            .withColumn("p_value", normal_upper_tail_col("z_stat")))


def z_test(experiment: DataFrame) -> DataFrame:
    """One row: the two-proportion pooled z-test."""
    return _with_z(_rates(experiment)).select(
        "treatment_rate", "control_rate", "absolute_lift_pp", "z_stat", "p_value")


def business_case(experiment: DataFrame) -> DataFrame:
    """One row: the z-test, modelled revenue against discount cost, and the decision."""
    value = F.expr(wide_sql(units_sql("avg_order_value")))
    lifetime = F.expr(wide_sql(units_sql("lifetime_value")))
    rates = _with_z(_rates(
        experiment,
        ratio(F.sum(lifetime), F.count("lifetime_value") * 10_000).alias("mean_lifetime_value"),
        F.sum(F.when(_treated(), 1).otherwise(0)).alias("treated"),
        from_units(F.coalesce(F.sum(F.when(_treated(), value)), F.lit(0))).alias("treated_value")))
    revenue = F.col("absolute_lift_pp") / 100 * F.col("treated") * F.col("mean_lifetime_value")
    cost = F.col("treated_value") * DISCOUNT_RATE
    ship = (F.col("p_value") < SIGNIFICANCE) & (F.col("incremental_revenue") > F.col("discount_cost"))
    return (rates.withColumn("incremental_revenue", revenue).withColumn("discount_cost", cost)
            .select("treatment_rate", "control_rate", "absolute_lift_pp", "z_stat", "p_value",
                    "incremental_revenue", "discount_cost",
                    F.coalesce(ship, F.lit(False)).alias("recommend_ship")))


def lift_sweep(assigned: DataFrame, lifts_pp: tuple[float, ...] = SWEEP_PP,
               seed: int = SEED) -> DataFrame:
    """(lift_pp, group, n, successes) for each lift, all in one pass over the customers."""
    base = base_rate(assigned)
    drawn = assigned.select("group", hash_uniform(f"{seed}|o|", F.col("customer_id")).alias("u"),
                            base.alias("base"))

    def success(lift: float) -> Column:
        p = clip01(F.col("base") + F.when(_treated(), lift / 100.0).otherwise(0.0))
        return F.when(F.col("u") < p, 1).otherwise(0)

    sums = [F.sum(success(lift)).alias(f"s{i}") for i, lift in enumerate(lifts_pp)]
    totals = drawn.groupBy("group").agg(F.count("*").alias("n"), *sums)
    steps = F.array(*[F.struct(F.lit(lift).alias("lift_pp"), F.col(f"s{i}").alias("successes"))
                      for i, lift in enumerate(lifts_pp)])
    return totals.select("group", "n", F.inline(steps)).select("lift_pp", "group", "n", "successes")


def report(experiment: DataFrame) -> DataFrame:
    """(line_no, section, name, value): the figures of balance, result and decision as text."""
    balance = balance_test(experiment).agg(F.first(F.struct("*"))).scalar()
    one = business_case(experiment).select("*", balance.alias("balance"))

    def digits(column: str, n: int) -> Column:
        return F.format_string(f"%.{n}f", F.col(column))

    figures = [
        ("balance", "t_stat", digits("balance.t_stat", 3)),
        ("balance", "p_value", digits("balance.p_value", 3)),
        ("balance", "groups_alike", F.col("balance.balanced").cast("string")),
        ("result", "treatment_rate", digits("treatment_rate", 4)),
        ("result", "control_rate", digits("control_rate", 4)),
        ("result", "lift_pp", digits("absolute_lift_pp", 2)),
        ("result", "z_stat", digits("z_stat", 3)),
        ("result", "p_value", digits("p_value", 4)),
        ("decision", "revenue", digits("incremental_revenue", 0)),
        ("decision", "cost", digits("discount_cost", 0)),
        ("decision", "ship", F.col("recommend_ship").cast("string")),
    ]
    entries = F.array(*[F.struct(F.lit(i).alias("line_no"), F.lit(section).alias("section"),
                                 F.lit(name).alias("name"), value.alias("value"))
                        for i, (section, name, value) in enumerate(figures, 1)])
    return one.select(F.inline(entries))


def write_report(figures: DataFrame, path: str) -> None:
    """The report as one text file in a folder, a figure a line; there are a dozen."""
    line = F.concat_ws(" ", "section", F.concat("name", F.lit(":")), F.coalesce("value", F.lit("-")))
    (figures.coalesce(1).sortWithinPartitions("line_no").select(line.alias("value"))
     .write.mode("overwrite").text(path))
