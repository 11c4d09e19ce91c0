"""Mergeable sketches: quantiles of values and numbers of different customers, per part of the data.

A sketch is small whatever the number of rows, and sketches of parts merge to that of the whole, so a
new upload or month adds its own and nothing is read again. Exact answers are in `quantile` and `marts`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Size of a quantile sketch, and log2 of that of a distinct sketch, which is exact up to so many.
QUANTILE_K = 4096
DISTINCT_LOG2 = 16
VALUES = ("order_value",)


def rank_error(k: int = QUANTILE_K) -> float:
    """Largest difference of a quantile's rank from the wanted share, in 99 of 100 cases (fixed formula)."""
    return 2.296 / k**0.9021


def distinct_error(log2: int = DISTINCT_LOG2, deviations: float = 3.0) -> float:
    """Relative error of an estimated number of different values, at so many standard deviations."""
    return deviations / 2 ** (log2 / 2)


def quantile_sketches(rows: DataFrame, columns: Sequence[str] = VALUES, part: Column | None = None,
                      k: int = QUANTILE_K) -> DataFrame:
    """(part, what, n, sketch): a quantile sketch of each column in each part; NULL values are left out.

    A sketch is built per task and merged, so a large part is not one task's work.
    """
    part = F.lit("all") if part is None else part
    values = rows.select(part.alias("part"), F.explode(F.array(*(
        F.struct(F.lit(c).alias("what"), F.col(c).cast("double").alias("v")) for c in columns))).alias("x"))
    return (values.select("part", "x.what", "x.v").filter("v IS NOT NULL").groupBy("part", "what")
            .agg(F.count("*").alias("n"), F.kll_sketch_agg_double("v", k).alias("sketch")))


def merge_quantiles(sketches: DataFrame) -> DataFrame:
    """(what, n, sketch) over all given parts."""
    return sketches.groupBy("what").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def quantiles(sketches: DataFrame, shares: Sequence[float]) -> DataFrame:
    """(what, share, n, value): estimated quantiles of the given parts together."""
    found = F.array(*(F.struct(F.lit(x).alias("share"), F.kll_sketch_get_quantile_double("sketch", F.lit(x)).alias("value"))
                      for x in shares))
    return merge_quantiles(sketches).select("what", "n", F.explode(found).alias("x")).select(
        "what", "x.share", "n", "x.value")


def check_quantiles(estimates: DataFrame, rows: DataFrame, what: str, error: float) -> DataFrame:
    """(share, n, within): is each estimate of a column at a rank that is at most `error` away from its share?

    The ranks are counted exactly. `estimates` has a row per share, so it is broadcast.
    """
    mine = estimates.filter(F.col("what") == what)
    values = rows.filter(F.col(what).isNotNull()).groupBy(F.col(what).cast("double").alias("v")).agg(F.count("*").alias("m"))
    counted = values.join(F.broadcast(mine), F.col("v") <= F.col("value")).groupBy("share", "n", "value").agg(
        F.sum("m").alias("up_to"), F.sum(F.when(F.col("v") < F.col("value"), F.col("m")).otherwise(0)).alias("below"))
    # the value takes all ranks from those below it to its own last
    return counted.select("share", "n", (
        (F.col("below") / F.col("n") <= F.col("share") + error)
        & (F.col("up_to") / F.col("n") >= F.col("share") - error)).alias("within"))


def customer_sketches(orders: DataFrame, customers: DataFrame, log2: int = DISTINCT_LOG2) -> DataFrame:
    """(state, was_late, sketch): the different customers of delivered orders, by state and delivery.

    `orders` has customer_id and was_late, `customers` customer_id and state.
    """
    of_state = customers.filter("customer_id IS NOT NULL").select("customer_id", "state").distinct()
    pairs = orders.select("customer_id", "was_late").distinct()
    return (pairs.join(of_state, "customer_id").groupBy("state", "was_late")
            .agg(F.theta_sketch_agg(F.col("customer_id").cast("string"), log2).alias("sketch")))


def late_and_on_time(sketches: DataFrame, by_state: bool = True, log2: int = DISTINCT_LOG2) -> DataFrame:
    """(state, n_late, n_on_time, n_both, n_either): estimated numbers of different customers.

    The sketches of a state and class are united, those of the classes united and intersected.
    """
    def of(late: int) -> Column:
        return F.theta_union_agg(F.when(F.col("was_late") == late, F.col("sketch")), log2)

    grouped = (sketches.groupBy("state") if by_state else sketches.groupBy(F.lit("all").alias("state"))).agg(
        of(1).alias("late"), of(0).alias("on_time"))

    def size(*sketches: Column) -> Column:
        return F.coalesce(*map(F.theta_sketch_estimate, sketches), F.lit(0).cast("long"))

    late, on_time = F.col("late"), F.col("on_time")
    return grouped.select("state", size(late).alias("n_late"), size(on_time).alias("n_on_time"),
                          size(F.theta_intersection(late, on_time)).alias("n_both"),
                          size(F.theta_union(late, on_time, log2), late, on_time).alias("n_either"))
