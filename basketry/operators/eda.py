"""Exploratory summaries of the marts.

Functions named for orders take `order_weights` (orders with their number of
fct_orders rows), so nothing is fanned out to be summed again.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import UNITS, parts_sql, ratio, total_sql, units_sql, wide_sql

HISTOGRAM_BINS = 40
CURVE_POINTS = 200
CURVE_CELLS = 2000


def eda_metrics(weights: DataFrame, customers: DataFrame) -> DataFrame:
    """One row: total revenue, repeat rate and late rate in percent."""
    repeat_rate = customers.agg(
        ratio(F.sum("is_repeat_customer"), F.count("is_repeat_customer")) * 100).scalar()
    units, rest, odd = parts_sql("order_value")
    revenue = total_sql(f"sum({wide_sql(units)} * n_rows)", f"sum({rest} * CAST(n_rows AS DECIMAL(10,0)))",
                        f"sum({odd} * n_rows)")
    return weights.agg(
        F.expr(f"coalesce({revenue}, 0D)").alias("total_revenue"),
        F.expr("CAST(sum(was_late * n_rows) AS DOUBLE) / nullif(sum(n_rows), 0) * 100").alias("late_rate"),
    ).select("total_revenue", repeat_rate.alias("repeat_rate"), "late_rate")


def _valued(weights: DataFrame) -> DataFrame:
    return weights.filter("order_value IS NOT NULL AND n_rows > 0")


def order_histogram(weights: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """(bin_no, bin, count) over [min, max] in equal widths, empty bins included.

    The last bin has a closed end; a single value gets bins half a unit around it.
    `weights` is read twice, for its limits first, so pass a stored frame.
    """
    values = _valued(weights)
    lo, hi = values.agg(F.min("order_value"), F.max("order_value")).first()
    if lo is None:
        bins, lo, hi = 0, 0.0, 1.0
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / max(bins, 1)
    number = F.least(F.floor((F.col("order_value") - lo) / width), F.lit(bins - 1)).cast("int")
    counts = values.groupBy(number.alias("bin_no")).agg(F.sum("n_rows").alias("count"))
    # every bin gets a row with count 0, then equal bins are added up
    empty = weights.sparkSession.range(bins).select(
        F.col("id").cast("int").alias("bin_no"), F.lit(0).cast("long").alias("count"))
    filled = counts.unionByName(empty).groupBy("bin_no").agg(F.sum("count").alias("count"))
    edges = [F.lit(lo) + F.col("bin_no") * width, F.lit(lo) + (F.col("bin_no") + 1) * width]
    return filled.select("bin_no", F.format_string("%.0f-%.0f", *edges).alias("bin"), "count")


def order_value_kde(weights: DataFrame, points: int = CURVE_POINTS, bins: int = HISTOGRAM_BINS,
                    cells: int = CURVE_CELLS) -> DataFrame:
    """(point_no, x, density): Gaussian curve over the histogram, in counts.

    Bandwidth: n^(-1/5) times the sample standard deviation. Values are counted in
    narrow cells first (at least `cells` over the range and four per bandwidth), and
    a cell adds to every point from its mean. The work after one aggregate depends on
    the cells, not on the number of orders. With a cell width c = h/4 at most, the
    error of the curve is below c²/8 times the largest second derivative of the kernel
    sum, 1/128 of the kernel's height for each value at most. `weights` is read twice, so pass a stored frame. Without
    spread there is no curve: no rows.
    """
    values = _valued(weights)
    u, n_rows = F.expr(wide_sql(units_sql("order_value"))), F.col("n_rows")
    n = F.sum(n_rows).cast("double")
    mean, square = F.sum(u * n_rows).cast("double") / n, F.sum(u * u * n_rows).cast("double") / n
    spread = F.sqrt((square - mean * mean) * ratio(n, n - 1.0)) / UNITS
    lo, hi, n, sd = values.agg(F.min("order_value"), F.max("order_value"), n, spread).first()
    if not sd:
        points, lo, hi, n, sd = 0, 0.0, 1.0, 1.0, 1.0
    h, step = n ** -0.2 * sd, (hi - lo) / max(points - 1, 1)
    cell_width = min((hi - lo) / cells, h / 4.0)
    centre = F.col("centre")
    counted = (values.groupBy(F.floor((F.col("order_value") - lo) / cell_width).alias("cell"))
               .agg(F.sum(n_rows).alias("weight"),
                    (F.sum(u * n_rows).cast("double") / UNITS / F.sum(n_rows)).alias("centre")))
    all_points = F.sequence(F.lit(0), F.lit(points - 1)) if points else F.array().cast("array<int>")
    x = F.lit(lo) + F.col("point_no") * step
    z = (x - centre) / h
    height = (hi - lo) / bins / (h * math.sqrt(2.0 * math.pi))
    terms = (counted.withColumn("point_no", F.explode(all_points))
             .select("point_no", (F.col("weight") * F.exp(-0.5 * z * z) * height).alias("density")))
    none = weights.sparkSession.range(points).select(
        F.col("id").cast("int").alias("point_no"), F.lit(0.0).alias("density"))
    summed = terms.unionByName(none).groupBy("point_no").agg(F.sum("density").alias("density"))
    return summed.select("point_no", x.alias("x"), "density")


def repeat_by_state(customers: DataFrame, top: int | None = None) -> DataFrame:
    """Repeat rate in percent by state, highest first; customers without a state are left out."""
    rates = (customers.filter(F.col("state").isNotNull()).groupBy("state")
             .agg((ratio(F.sum("is_repeat_customer"), F.count("*")) * 100).alias("repeat_rate_pct"))
             .orderBy(F.desc("repeat_rate_pct"), "state"))
    return rates if top is None else rates.limit(top)


def review_by_delivery(weights: DataFrame) -> DataFrame:
    """Mean review score of late and of on-time deliveries."""
    delivery = F.when(F.col("was_late") == 1, "Late").when(F.col("was_late") == 0, "On time")
    return (weights.filter(F.col("score_rows") > 0).groupBy(delivery.alias("delivery"))
            .agg(ratio(F.sum("score_sum"), F.sum("score_rows")).alias("avg_review_score"))
            .filter(F.col("delivery").isNotNull()))


def to_records(section: str, df: DataFrame) -> DataFrame:
    """Each row as a JSON record of the named section, fractions with six digits."""
    plain = df.select(*[F.col(c).cast("decimal(38,6)").alias(c) if t == "double" else F.col(c)
                        for c, t in df.dtypes])
    return plain.select(F.lit(section).alias("section"), F.to_json(F.struct("*")).alias("record"))


def eda_records(weights: DataFrame, customers: DataFrame) -> DataFrame:
    """All summaries as JSON records (section, record); both frames are read several times."""
    return (to_records("metrics", eda_metrics(weights, customers))
            .unionByName(to_records("order_distribution", order_histogram(weights).drop("bin_no")))
            .unionByName(to_records("repeat_rate_by_state", repeat_by_state(customers)))
            .unionByName(to_records("review_by_delivery", review_by_delivery(weights))))
